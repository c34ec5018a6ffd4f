"""Risk-controlled quality rules (operator 6).

Four measures of a text are compared with cutoffs. The cutoffs are not set by hand: for each stratum and rule, a
labelled holdout is counted, and a cutoff may be used only if an exact binomial (Clopper-Pearson) bound shows that it
rejects at most its share of good texts. In a stratum all rules together reject at most ``RISK`` of the good texts, with
probability ``1 - ERROR`` for all strata at once: the risk is divided by the rules, the error by rules and strata, and the
cutoffs of a rule are tested from the loosest to the tightest up to the first that fails (fixed-sequence testing, which
needs no further correction). Of the certified cutoffs the one that catches most bad texts is used, the loosest if tied; a rule
that catches none stays off. A stratum with too few labels gets no cutoffs.

Measures come from one pass over whole texts; holdout counts are a join on the id and a partial aggregation.

Defined cases: a null or empty text has only zeros and fails the base rule; a null stratum is a stratum of its own; a document with
several labels is good only if all say so; labels that are null are left out; equal rows are judged alike; without
labels only the base rule works; an empty table gives no rows. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.ranking import null_safe_join
from maskloom.llm import text as scan
from maskloom.session import cut

RISK = 0.02
ERROR = 0.05
#: loosest first
CUTOFFS = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02)
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "upper": ("n_upper", "n_letters"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")
ADDED = (*MEASURES, "base_failed", "kept", "rejected_by")
#: a cutoff table of more strata is joined by shuffle
BROADCAST_STRATA = 10_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def measure(texts: scan.Texts) -> dict[str, np.ndarray]:
    data, offsets, n = texts.data, texts.offsets, texts.rows
    w = scan.words(texts, scan.SPACES, lower=False)
    out = {"n_words": w.per_row, "word_chars": _per_row(~scan.SPACES[data] & ((data & 0xC0) != 0x80), offsets)}
    out["n_symbols"], out["n_letters"], out["n_upper"] = (_per_row(c[data], offsets) for c in (_SYMBOL, _LETTER, _UPPER))
    row, start, end = scan.spans(data != 10, offsets)
    ink = np.concatenate([[0], np.cumsum(~scan.SPACES[data])])
    filled = ink[end] > ink[start]
    row, start, end = row[filled], start[filled], end[filled]
    out["n_lines"] = np.bincount(row, minlength=n)
    once, _ = scan.distinct(row, scan.span_hash(scan.prefix_hash(data), start, end))
    out["n_dup_lines"] = out["n_lines"] - np.bincount(once, minlength=n)
    out["n_repeat_words"] = np.bincount(w.row[_repeated(w)], minlength=n)
    return out


def _repeated(w: scan.Words, size: int = 3) -> np.ndarray:
    """Words in a window of ``size`` words that its text holds at least twice."""
    covered = np.zeros(len(w.hash), bool)
    at = np.flatnonzero(w.row[: max(0, len(w.row) - size + 1)] == w.row[size - 1 :]) if len(w.row) >= size else np.zeros(0, np.int64)
    if not len(at):
        return covered
    row, value = scan.shingles(w, size, whole_if_short=False)
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.int32), kind="stable")]
    same = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    for j in range(size):
        covered[at[twice] + j] = True
    return covered


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with the measures of each text (long)."""
    kept = [f for f in docs.schema.fields if f.name != "text" and f.name not in ADDED]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure(t) for t in scan.chunks(batch.column("text"))]
            got = {m: pa.array(np.concatenate([p[m] for p in parts]) if parts else [], pa.int64()) for m in MEASURES}
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names} | got)

    schema = T.StructType([*kept, *[T.StructField(m, T.LongType()) for m in MEASURES]])
    return docs.select(*[F.col(f"`{n}`") for n in names], F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def share(rule: str) -> Column:
    part, whole = RULES[rule]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def at_most(x: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= x)."""
    if x >= n:
        return 1.0
    at = np.arange(x + 1)
    logs = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(x + 1)])
    return float(min(1.0, np.exp(logs + at * math.log(p) + (n - at) * math.log1p(-p)).sum()))


def choose(good: np.ndarray, bad: np.ndarray, n_good: int, risk: float, error: float) -> int:
    """Index of the cutoff to use, or -1. ``good`` and ``bad``: texts that each cutoff, loosest first, rejects."""
    best, caught = -1, 0
    for i, (g, b) in enumerate(zip(good.tolist(), bad.tolist(), strict=True)):
        if not n_good or g > risk * n_good or at_most(g, n_good, risk) > error:
            break
        if b > caught:
            best, caught = i, b
    return best


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum that has labels: a cutoff (or null) for each rule."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q_good"))
    held = measured.where(~base_failed()).select(
        "doc_id", F.col(stratum).alias("q_stratum"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), sum((share(r) > F.lit(c)).cast("int") for c in CUTOFFS).alias("above")) for r in RULES])).alias("q"),
    ).join(known, "doc_id")
    counts = cut(held.groupBy("q_stratum", "q.rule", "q.above").agg(
        F.sum((F.col("q_good") == 1).cast("long")).alias("good"), F.sum((F.col("q_good") == 0).cast("long")).alias("bad")))
    strata = counts.select("q_stratum").distinct().count()
    tests = len(RULES) * max(1, strata)
    each, level, m = risk / len(RULES), error / tests, len(CUTOFFS)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, float | None] = {}
        for rule in RULES:
            own = rows[rows["rule"] == rule]
            # a text above k cutoffs is above the k smallest, which come last
            good, bad = (np.array([own.loc[own["above"] >= m - i, c].sum() for i in range(m)]) for c in ("good", "bad"))
            at = choose(good, bad, int(own["good"].sum()), each, level)
            found[f"q_{rule}"] = CUTOFFS[at] if at >= 0 else None
        return pd.DataFrame({"q_stratum": [rows["q_stratum"].iloc[0]]} | {k: pd.Series([v], dtype="float64") for k, v in found.items()})

    kind = measured.schema[stratum].dataType.simpleString()
    return counts.groupBy("q_stratum").applyInPandas(one, f"q_stratum {kind}, " + ", ".join(f"q_{r} double" for r in RULES))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``docs`` without the text, with its measures, ``base_failed``, ``kept`` and ``rejected_by`` (rules, comma-joined)."""
    measured = cut(measures(docs))
    cutoffs = cut(calibrate(measured, labels, stratum, risk, error).withColumnRenamed("q_stratum", stratum))
    joined = null_safe_join(measured, F.broadcast(cutoffs) if cutoffs.count() <= BROADCAST_STRATA else cutoffs, [stratum], "left")
    hits = F.concat_ws(",", F.when(base_failed(), F.lit("base")), *[F.when(share(r) > F.col(f"q_{r}"), F.lit(r)) for r in RULES])
    return joined.withColumn("base_failed", base_failed()).withColumn("rejected_by", hits).withColumn("kept", F.col("rejected_by") == "").drop(
        *[f"q_{r}" for r in RULES])
