"""Quality classifier (operator 10): importance resampling with hashed n-gram models and Gumbel top-k.

Two generative models count hashed unigrams and bigrams of lower-cased tokens (runs of letters and digits, runs of symbols): one of
target texts (labelled good), one of all raw texts. A bigram of one token twice has a bucket of its own, whatever the token.
A document's log importance weight is the log ratio of the two models. It is taken per n-gram, ``sum / (n + PRIOR)``, times ``SCALE``: the plain
sum would rank long texts by small differences between the language shares of target and raw.

Sampling without replacement by these weights is Gumbel top-k: seeded Gumbel noise, a hash of the id, is added and the k best stay. k is the number of
documents whose log weight reaches the value that ``KEEP`` of the target texts reach, less ``MARGIN`` (below which Gumbel noise hardly ever falls), so
clean documents stay whatever the share of junk is. The k-th score is found exactly: a histogram of the scores names the bin, and only that bin's rows are ranked.

The target model is fitted on at most ``TARGET_ROWS`` labelled texts, first by a hash of the id; the raw model, the scores, the level of the target texts and the
selection use all documents. What is collected is bounded by ``BUCKETS``.

Defined cases: a null or empty text has weight 0; equal rows have equal weights and noise, and are kept or rejected together unless the k-th
place lies between them, where any of them goes first; a document is a target only if all its labels are good and none toxic; without target texts all are
kept; an empty table gives no rows. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.llm import text as scan
from maskloom.session import cut

BUCKETS = 1 << 14
TARGET_ROWS = 20_000
KEEP, MARGIN = 0.998, 4.0
SCALE, PRIOR, SMOOTHING = 64.0, 16.0, 1.0
BINS = 1 << 16
ADDED = ("log_weight", "score", "kept")


def grams(texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every unigram and bigram."""
    data = scan.LOWER[texts.data]
    space, symbol = scan.SPACES[data], scan.NOT_WORD[data]
    runs = [scan.spans(inside, texts.offsets) for inside in (~symbol, symbol & ~space)]
    row, start, end = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.argsort(start)
    row = row[order]
    value = scan.span_hash(scan.prefix_hash(data), start[order], end[order])
    pair = row[1:] == row[:-1]
    left, right = value[:-1][pair], value[1:][pair]
    both = scan.mix(left * scan.U64(3) + right)
    both[left == right] = 1
    return np.concatenate([row, row[1:][pair]]), (np.concatenate([value, both]) % scan.U64(BUCKETS)).astype(np.int64)


def _good(labels: DataFrame) -> DataFrame:
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("q"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("t"))
    return good.where("q = 1 AND t = 0").select(F.col("doc_id").alias("c_id"))


def _targets(labels: DataFrame) -> DataFrame:
    """The texts that the target model is fitted on."""
    return _good(labels).orderBy(F.xxhash64("c_id"), "c_id").limit(TARGET_ROWS)


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Log ratio of the target and the raw model for each bucket."""
    target = F.broadcast(_targets(labels).withColumn("c_hit", F.lit(True)))  # at most TARGET_ROWS ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            hit = np.asarray(batch.column("hit").to_numpy(zero_copy_only=False), bool)
            for part in scan.chunks(batch.column("text")):
                row, bucket = grams(part)
                counts[0] += np.bincount(bucket, minlength=BUCKETS)
                chosen = hit[part.first : part.first + part.rows][row]
                counts[1] += np.bincount(bucket[chosen], minlength=BUCKETS)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_pydict({"bucket": at, "raw": counts[0, at], "target": counts[1, at]})

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(target, F.col("doc_id") == F.col("c_id"), "left")
    found = rows.select(F.col("c_hit").isNotNull().alias("hit"), "text").mapInArrow(run, "bucket long, raw long, target long")
    counts = np.zeros((2, BUCKETS))
    for r in found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        counts[:, r.bucket] = r.raw, r.target
    if not counts[1].sum():
        return None
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    return logs[1] - logs[0]


def weigh(docs: DataFrame, ratio: np.ndarray, with_text: bool) -> DataFrame:
    """Add ``log_weight``; the text stays only if asked for."""
    kept = [f for f in docs.schema.fields if f.name not in ADDED and f.name != "text"]
    text = [f for f in docs.schema.fields if f.name == "text"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.chunks(batch.column("c_text")):
                row, bucket = grams(part)
                total = np.bincount(row, weights=ratio[bucket], minlength=part.rows)
                n = np.bincount(row, minlength=part.rows)
                rows = batch.slice(part.first, part.rows)
                out = {c: rows.column(c) for c in names} | {"log_weight": pa.array(SCALE * total / (n + PRIOR))}
                if with_text:
                    out["text"] = rows.column("c_text")
                yield pa.RecordBatch.from_pydict(out)
        scan.release_memory()

    schema = T.StructType([*kept, T.StructField("log_weight", T.DoubleType()), *([T.StructField("text", T.StringType())] if with_text and text else [])])
    return docs.select(*[F.col(f"`{c}`") for c in names], F.col("text").cast("string").alias("c_text")).mapInArrow(run, schema)


def gumbel(seed: int) -> Column:
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 12), 16, 10)
    uniform = (digits.cast("double") + 0.5) / float(16**12)
    return -F.log(-F.log(uniform))


def top_k(scored: DataFrame, k: int) -> tuple[float, str, int] | None:
    """The k-th best place: rows of a higher score are in, and of its score those up to a tie key and count. ``scored`` should be pinned."""
    low, high, n = scored.agg(F.min("score"), F.max("score"), F.count(F.lit(1))).first()
    if k <= 0 or not n:
        return None
    width = (high - low) / BINS
    bin_ = F.least(F.lit(BINS - 1), F.floor((F.col("score") - F.lit(low)) / F.lit(width))).cast("long") if width > 0 else F.lit(0).cast("long")
    sizes = sorted((r.c_bin, r.n) for r in scored.groupBy(bin_.alias("c_bin")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most BINS rows
    above, at = 0, sizes[0][0]
    for c_bin, size in reversed(sizes):
        at = c_bin
        if above + size >= k:
            break
        above += size
    place = scored.where(bin_ == at).groupBy("score", tie_key().alias("tie")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.col("score").desc(), "tie").rowsBetween(Window.unboundedPreceding, 0))
    row = place.withColumn("upto", upto).where(F.col("upto") >= k - above).orderBy("upto").first()
    return (row.score, row.tie, row.n) if row else (low, "g", 0)


def level(weights: DataFrame, share: float) -> float | None:
    """The quantile of ``log_weight`` at ``share``, between the two nearest weights. A histogram names the bins of both, and only their weights are ranked."""
    weights = cut(weights)
    low, high, n = weights.agg(F.min("log_weight"), F.max("log_weight"), F.count("log_weight")).first()
    if not n:
        return None
    place = share * (n - 1)
    wanted = [math.floor(place), math.ceil(place)]
    width = (high - low) / BINS
    bin_ = F.least(F.lit(BINS - 1), F.floor((F.col("log_weight") - F.lit(low)) / F.lit(width))).cast("long") if width > 0 else F.lit(0).cast("long")
    sizes = sorted((r.c_bin, r.n) for r in weights.groupBy(bin_.alias("c_bin")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most BINS rows
    ends = np.cumsum([size for _, size in sizes])
    found = []
    for rank in wanted:
        at = int(np.searchsorted(ends, rank, "right"))
        before = int(ends[at]) - sizes[at][1]
        values = weights.where(bin_ == sizes[at][0]).groupBy("log_weight").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.orderBy("log_weight").rowsBetween(Window.unboundedPreceding, 0))
        found.append(values.withColumn("upto", upto).where(F.col("upto") > rank - before).orderBy("upto").first().log_weight)
    return found[0] + (found[1] - found[0]) * (place - wanted[0])


def tie_key() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))


def score(docs: DataFrame, labels: DataFrame, seed: int = 0, with_text: bool = False, keep: float = KEEP) -> DataFrame:
    """``docs`` with ``log_weight``, ``score`` (with Gumbel noise) and ``kept``."""
    ratio = fit(docs, labels)
    if ratio is None:
        ratio = np.zeros(BUCKETS)
    scored = cut(weigh(docs.select("doc_id", "text"), ratio, False).withColumn("score", F.col("log_weight") + gumbel(seed)))
    least = level(scored.join(_good(labels), F.col("doc_id") == F.col("c_id"), "left_semi").select("log_weight"), 1 - keep)
    k = scored.where(F.col("log_weight") >= (least - MARGIN if least is not None else float("-inf"))).count()
    end = top_k(scored, k)
    if end is None:
        kept = F.lit(False)
    else:
        kept = (F.col("score") > end[0]) | ((F.col("score") == end[0]) & (tie_key() <= end[1]))
    rows = weigh(docs, ratio, True).withColumn("score", F.col("log_weight") + gumbel(seed)) if with_text else scored
    return rows.withColumn("kept", kept)
