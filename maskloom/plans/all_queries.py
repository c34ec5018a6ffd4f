"""Imports every query module and exposes the merged registry."""

from __future__ import annotations

import importlib
import pkgutil

from maskloom import plans
from maskloom.plans import catalog


def _load() -> None:
    for mod in pkgutil.iter_modules(plans.__path__):
        if mod.name.startswith("queries_"):
            importlib.import_module(f"maskloom.plans.{mod.name}")


def queries():
    _load()
    return catalog.spark_queries()


def oracle_sql():
    _load()
    return catalog.check_sql()
