"""Token counts (operator 1): additive rollups that are maintained by signed deltas.

A batch is a set of signed events: an insert adds a document's tokens, a delete takes them back, a revision carries the count
before and after. Each batch is pre-aggregated to one delta row per (source, lang, tokenizer_version) and written under its own name in
the store's folder; Spark's ``_SUCCESS`` file is its commit mark. Totals are the sums of all committed deltas, so the order of
batches does not matter and no old document is read again.

Commits are idempotent: a batch that has its mark is left alone, one without (a writer died) is written anew. ``compact`` sums the
committed batches into one base and keeps the list of their names with it, so even a late repeat of a compacted batch changes nothing. One writer at a time.

Defined cases: within a batch every row is an event, so equal rows count as often as they occur; null keys are keys of their own; a null
count is 0; a null or empty text has 0 tokens and is still a document; an empty batch is committed with no rows; totals that
sum to nothing stay as rows of 0. Extra columns of the events are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer_version")
DELTA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
COMPACT = "base"

#: versions that SQL can count: words between white space, and letter, digit and symbol runs
COUNTERS: dict[str, str] = {"words-1": r"[^\x20\x09-\x0D]+", "runs-2": r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]+"}


def count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(COUNTERS[version])), F.lit(0)).cast("long")


def events(docs: DataFrame, kind: str, version: str, before: Column | None = None, after: Column | None = None) -> DataFrame:
    """Signed events: ``insert`` needs ``after``, ``delete`` needs ``before``, ``revise`` both."""
    if {"insert": (False, True), "delete": (True, False), "revise": (True, True)}.get(kind) != (before is not None, after is not None):
        raise ValueError(f"wrong counts for {kind}")
    old, new = (F.coalesce(c, F.lit(0)) if c is not None else F.lit(0) for c in (before, after))
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.lit(version).alias("tokenizer_version"),
        F.lit({"insert": 1, "delete": -1, "revise": 0}[kind]).cast("long").alias("n_docs"), (new - old).cast("long").alias("n_tokens"))


def bpe_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens`` by a public byte-level vocabulary, for real tokenizer versions."""
    from maskloom.llm import byte_bpe

    return byte_bpe.encode(docs, path, pattern).withColumn("n_tokens", F.floor(F.length("ids") / 4).cast("long")).drop("ids")


class Rollup:
    """Committed deltas in a shared folder, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, batch: str) -> str:
        if not batch or not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError(f"not a batch name: {batch!r}")
        return f"{self.folder}/batch={batch}"

    def _done(self, folder: str) -> bool:
        return self._fs.exists(self._path(f"{folder}/_SUCCESS"))

    def batches(self) -> list[str]:
        """Names of the batches that are in the totals and not compacted."""
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        done = [n.removeprefix("batch=") for n in names if n.startswith("batch=") and self._done(f"{self.folder}/{n}")]
        return sorted(set(done) - self._compacted())

    def _base(self) -> str | None:
        if not self._fs.exists(self._path(self.folder)):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]
        bases = [n for n in names if n.startswith(f"{COMPACT}=") and self._done(f"{self.folder}/{n}/names")]
        return max(bases, key=lambda n: int(n.partition("=")[2]), default=None)

    def _compacted(self) -> set[str]:
        base = self._base()
        return {r.batch for r in self.spark.read.parquet(f"{self.folder}/{base}/names").collect()} if base else set()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of events; False if it was committed before."""
        at = self._at(batch)
        if self._done(at) or batch in self._compacted():
            return False
        sums = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.write.mode("overwrite").parquet(at)
        return True

    def totals(self) -> DataFrame:
        base, names = self._base(), self.batches()
        paths = [f"{self.folder}/{base}/totals"] * bool(base) + [self._at(n) for n in names]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def compact(self) -> None:
        """Sum all committed batches into a new base; it counts once its list of names is written."""
        names, base = self.batches(), self._base()
        if not names:
            return
        at = f"{self.folder}/{COMPACT}={int(base.partition('=')[2]) + 1 if base else 1}"
        self.totals().write.mode("overwrite").parquet(f"{at}/totals")
        self.spark.createDataFrame([(n,) for n in sorted({*names, *self._compacted()})], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{at}/names")
