"""Bone and material names to regions: fixed lookups, then keyword rules, then fuzzy tokens.

The lookups are small fixed dimensions (broadcast); the rules are Column expressions, so a
name is resolved in one projection without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.functions.bone_tables import ALIASES, AVATAR_NAMES, FUZZY_RULES, KEYWORD_RULES, RIG_NAMES
from maskloom.functions.names import BONE_PREFIXES, strip_bone_prefix, tokenize_name

MIXAMO_PREFIXES = ["mixamorig:", *[f"mixamorig{n}:" for n in range(1, 13)]]


def exact_names() -> dict[str, int]:
    return {prefix + name: region for prefix in MIXAMO_PREFIXES for name, region in RIG_NAMES.items()}


FUZZY_MIN_SCORE = 0.6


def lookup_rows() -> list[tuple[str, int, str]]:
    """Name, region, method; the stronger method wins for a name in several lists."""
    rows: dict[str, tuple[int, str]] = {}
    for names, method in ((exact_names(), "exact"), (ALIASES, "alias"), (AVATAR_NAMES, "alias")):
        for name, region in names.items():
            rows.setdefault(name, (region, method))
    return [(n, r, m) for n, (r, m) in rows.items()]


def lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(lookup_rows(), "lookup_name string, lookup_region int, lookup_method string")


def _all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def by_keywords(name: Column, rules: Sequence[tuple[Sequence[str], int]] = KEYWORD_RULES) -> Column:
    """First rule whose words all occur; a lone l/r must be a token of its own."""
    low = F.lower(name)
    tokens = F.split(low, r"[_.\-\s]+")
    hits = []
    for words, region in rules:
        conds = [F.array_contains(tokens, w) if w in ("l", "r") else F.contains(low, F.lit(w)) for w in words]
        hits.append(F.when(_all(conds), F.lit(region)))
    return F.coalesce(*hits)


def by_fuzzy_tokens(name: Column, rules: Sequence[tuple[Sequence[str], int]] = FUZZY_RULES) -> Column:
    """Best (score, keywords, earliest) pattern at or above the score floor, as a struct."""
    tokens = tokenize_name(name)
    scored = [
        F.struct(
            (F.size(F.array_intersect(F.array(*[F.lit(w) for w in words]), tokens)) / float(len(words))).alias("score"),
            F.lit(len(words)).alias("words"), F.lit(-i).alias("order"), F.lit(region).alias("region"),
        )
        for i, (words, region) in enumerate(rules)
    ]
    return F.array_max(F.filter(F.array(*scored), lambda s: s.score >= FUZZY_MIN_SCORE))


def map_bones(names: DataFrame, overrides: DataFrame | None = None, name: str = "name", rig: str = "rig") -> DataFrame:
    """Region, method and score of every bone name.

    Order: override, exact, alias, prefix stripped, keywords, fuzzy tokens, unmapped.
    ``overrides(rig, name, region)`` is a table of any size and is joined without a hint.
    """
    spark = names.sparkSession
    known = lookup(spark)
    df = names.withColumn("_bare", strip_bone_prefix(F.col(name), BONE_PREFIXES))
    if overrides is not None:
        o = overrides.select(F.col(rig), F.col(name), F.col("region").alias("_override"))
        df = df.join(o, [rig, name], "left")
    else:
        df = df.withColumn("_override", F.lit(None).cast("int"))
    df = df.join(F.broadcast(known), F.col(name) == F.col("lookup_name"), "left").drop("lookup_name")
    bare = known.where("NOT startswith(lookup_name, 'mixamorig')").select(
        F.col("lookup_name").alias("_bare_name"), F.col("lookup_region").alias("_bare_region")
    )
    bare = bare.where(F.col("_bare_name").isin(list(ALIASES)))
    stripped = (F.col("_bare") == F.col("_bare_name")) & (F.col("_bare") != F.col(name))
    df = df.join(F.broadcast(bare), stripped, "left")
    found = F.coalesce("_override", "lookup_region", "_bare_region")
    df = df.withColumn("_keyword", F.when(found.isNull(), by_keywords(F.col(name))))
    df = df.withColumn("_fuzzy", F.when(found.isNull() & F.col("_keyword").isNull(), by_fuzzy_tokens(F.col(name))))
    method = (
        F.when(F.col("_override").isNotNull(), "override").when(F.col("lookup_region").isNotNull(), F.col("lookup_method"))
        .when(F.col("_bare_region").isNotNull(), "prefix").when(F.col("_keyword").isNotNull(), "substring")
        .when(F.col("_fuzzy").isNotNull(), "fuzzy").otherwise("unmapped")
    )
    return df.select(
        *names.columns, F.coalesce(found, "_keyword", F.col("_fuzzy.region")).cast("int").alias("region"),
        method.alias("method"), F.col("_fuzzy.score").alias("score"),
    )


def load_overrides(raw: DataFrame, doc: str = "doc", rig: str = "rig") -> DataFrame:
    """Name -> id pairs of JSON override documents; nulls, non-integers and ids outside 1..19 are dropped."""
    pairs = raw.select(rig, F.explode(F.from_json(doc, "map<string,string>")).alias("name", "_v"))
    region = F.col("_v").try_cast("int")
    return pairs.select(rig, "name", region.alias("region")).where(F.col("region").between(1, 19))
