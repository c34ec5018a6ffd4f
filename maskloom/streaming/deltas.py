"""A keyed table kept as a log of per-batch deltas, for streams and scheduled batches.

A batch writes what it knows of its own keys, and nothing else: its work follows its own rows, however large the table has become. A table's rows are what
an associative ``merge`` makes of all deltas, on read. Entries of the log are folders named by the batches they hold (``00000012-00000012``), divided by a hash of the key, and
count once Spark has marked them complete; so a batch that is repeated replaces itself, and one that failed half-way does not exist.

Compaction works like a counter: each time ``fan`` entries of one size are there, they are merged into one of the next size. A row is rewritten once per size,
so ``n`` batches write ``n log n`` deltas in all, and a read meets at most ``fan`` entries of each size. A merged entry hides those it holds as soon as it is complete;
they are deleted one compaction later, when no reader of the time before can still need them.

``merge`` takes rows of the table's columns, several for a key, and returns rows of the same columns; it must not depend on their order or on what was merged before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: tasks that a large bucket is written by
SPREAD = 16


@dataclass(frozen=True)
class Entry:
    first: int
    last: int
    path: str

    def holds(self, other: Entry) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


def hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


@dataclass(frozen=True)
class DeltaTable:
    folder: str
    keys: Sequence[str]
    merge: Callable[[DataFrame], DataFrame]
    buckets: int = 8
    fan: int = 4

    def _path(self, first: int, last: int) -> str:
        return f"{self.folder}/log/{first:08d}-{last:08d}"

    def _complete(self, spark: SparkSession) -> list[Entry]:
        fs, log = hadoop(spark, f"{self.folder}/log")
        names = sorted(s.getPath().getName() for s in fs.listStatus(log)) if fs.exists(log) else []
        ranges = [(*map(int, n.split("-")), f"{self.folder}/log/{n}") for n in names if n.replace("-", "").isdigit()]
        return [Entry(*r) for r in ranges if fs.exists(hadoop(spark, f"{r[2]}/_SUCCESS")[1])]

    def entries(self, spark: SparkSession) -> list[Entry]:
        """What a reader reads: complete entries that no other one holds, oldest first."""
        found = self._complete(spark)
        return [e for e in found if not any(o.holds(e) for o in found)]

    def _write(self, rows: DataFrame, path: str) -> None:
        code = F.xxhash64(*self.keys)
        bucket, part = F.pmod(code, F.lit(self.buckets)), F.pmod(F.shiftright(code, 32), F.lit(SPREAD))
        # a bucket is written by several tasks; AQE merges them while they are small
        rows.withColumn("bucket", bucket.cast("int")).repartition("bucket", part).write.partitionBy("bucket").mode("overwrite").parquet(path)

    def _rows(self, spark: SparkSession, entries: Sequence[Entry]) -> DataFrame:
        # each entry is a base path of its own, or Spark could not tell the bucket folders
        parts = [spark.read.parquet(e.path) for e in entries]
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        return rows

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write the delta of a batch, then compact what is due. A batch that a merged entry holds already is left alone."""
        spark = batch.sparkSession
        own = Entry(batch_id, batch_id, self._path(batch_id, batch_id))
        if not any(e.holds(own) for e in self._complete(spark)):
            self._write(self.merge(batch), own.path)
        self._compact(spark, batch_id)

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        size = self.fan
        while (batch_id + 1) % size == 0:
            whole = Entry(batch_id + 1 - size, batch_id, self._path(batch_id + 1 - size, batch_id))
            found = self._complete(spark)
            parts = [e for e in found if whole.holds(e) and not any(o.holds(e) for o in found if whole.holds(o))]
            if whole not in found and len(parts) > 1:
                self._write(self.merge(self._rows(spark, parts).drop("bucket")), whole.path)
                self._remove(spark, [e for e in found if any(p.holds(e) for p in parts)])
            size *= self.fan

    def _remove(self, spark: SparkSession, entries: Sequence[Entry]) -> None:
        for e in entries:
            fs, path = hadoop(spark, e.path)
            fs.delete(path, True)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table: all deltas, merged."""
        return self.merge(self._rows(spark, self.entries(spark)).drop("bucket"))

    def lookup(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        """The rows of some keys; only the buckets of these are read."""
        keys = wanted.select(*self.keys).distinct()
        hit = [r[0] for r in keys.select(F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("b")).distinct().collect()]  # at most `buckets`
        rows = self._rows(spark, self.entries(spark)).where(F.col("bucket").isin(hit)).drop("bucket")
        return self.merge(rows.join(keys, list(self.keys), "left_semi"))
