"""Incremental work: batch form and Structured Streaming form of the same operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskloom.operators.masks import confusion
from maskloom.operators.review import effective_reviews, status_transitions
from maskloom.session import ensure_checkpoint_dir
from maskloom.streaming.deltas import DeltaTable, hadoop


def state_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint location."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files appearing under ``path`` (a folder or a glob)."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without an output."""
    return inputs.join(done.select(key), key, "left_anti")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], folder: str, mode: str = "append") -> None:
    """Process everything that is available, then stop; restarts continue from ``folder``."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def versions(spark: SparkSession, folder: str, before: int | None = None) -> list[int]:
    """Finished versions of a table kept by :func:`upsert`, oldest first."""
    fs, path = hadoop(spark, f"{folder}/state")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    found = sorted(int(n[1:]) for n in names if n[1:].isdigit() and fs.exists(hadoop(spark, f"{folder}/state/{n}/_SUCCESS")[1]))
    return [v for v in found if before is None or v < before]


def upsert(folder: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A sink that keeps one table: version n is ``merge(version before, batch n)``.

    A repeated batch starts from the same version and replaces its own; versions that no batch can need are removed.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = versions(spark, folder, batch_id)
        merge(spark.read.parquet(f"{folder}/state/v{old[-1]}") if old else None, batch).write.mode("overwrite").parquet(f"{folder}/state/v{batch_id}")
        for v in old[:-1]:
            fs, path = hadoop(spark, f"{folder}/state/v{v}")
            fs.delete(path, True)

    return sink


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/state/v{versions(spark, folder)[-1]}")


def first_rows(key: str) -> Callable[[DataFrame], DataFrame]:
    """Of each key the least row of the first batch that has it."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.min(F.struct("taken_in", "row")).alias("_r")).select(key, "_r.taken_in", "_r.row")

    return merge


def incremental_intake(stream: DataFrame, key: str, folder: str) -> DataFrame:
    """Every key once over all batches, with the least of its rows in the first batch that has it.

    A batch writes its own keys and never looks at those taken in before; which batch was first is told when the table is read.
    """
    table = DeltaTable(folder, [key], first_rows(key))

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.append(batch.select(key, F.lit(batch_id).cast("long").alias("taken_in"), F.struct(*batch.columns).alias("row")), batch_id)

    run_available(stream, sink, folder)
    return table.read(stream.sparkSession).select("row.*")


def running_confusion(stream: DataFrame, folder: str) -> DataFrame:
    """Confusion counts kept as stream state; ratios are derived on read."""
    run_available(confusion(stream), upsert(folder, lambda old, batch: batch), folder, "complete")
    return latest(stream.sparkSession, folder)


def merge_intervals(runs: DataFrame) -> DataFrame:
    """Disjoint runs of days (user_id, first, last) from runs that may overlap or touch, in any order."""
    w = Window.partitionBy("user_id").orderBy("first", "last")
    reach = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    marked = runs.distinct().withColumn("_b", begins).withColumn("_g", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("user_id", "_g").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_g")


def streak_state(stream: DataFrame, folder: str, user: str = "user_id", at: str = "created_at") -> DataFrame:
    """Streaming twin of the daily streak query. Late days join or extend runs like all others."""
    table = DeltaTable(folder, ["user_id"], merge_intervals)
    day = F.unix_date(F.to_date(at))
    days = stream.select(F.col(user).alias("user_id"), day.alias("first"), day.alias("last")).where("first IS NOT NULL")
    run_available(days, table.append, folder)
    runs = table.read(stream.sparkSession).withColumn("len", (F.col("last") - F.col("first") + 1).cast("long"))
    return runs.groupBy("user_id").agg(
        F.max_by("len", "last").alias("current_streak"), F.max("len").alias("longest_streak"), F.date_from_unix_date(F.max("last")).alias("last_active"))


def first_reviews(stream: DataFrame, folder: str) -> DataFrame:
    """Stream of reviews: the first of an annotation by time and id wins, whenever it arrives."""
    table = DeltaTable(folder, ["annotation_id"], effective_reviews)
    run_available(stream.select("annotation_id", "reviewed_at", "review_id", "status"), table.append, folder)
    return table.read(stream.sparkSession)


def made_annotations(rows: DataFrame) -> DataFrame:
    """Of each annotation the row by which it was made first."""
    first = F.min(F.struct("created_at", "image_id")).alias("_r")
    return rows.groupBy("annotation_id").agg(first).select("annotation_id", "_r.created_at", "_r.image_id")


def made_state(stream: DataFrame, folder: str) -> DataFrame:
    """Stream of annotations (annotation_id, created_at, image_id): each once, as it was made first."""
    table = DeltaTable(folder, ["annotation_id"], made_annotations)
    run_available(stream.select("annotation_id", "created_at", "image_id"), table.append, folder)
    return table.read(stream.sparkSession)


def status_state(annotations: DataFrame, reviews: DataFrame, images: DataFrame, folder: str) -> DataFrame:
    """Status of every image after two streams, of annotations and of their reviews, in whatever order both arrive; a second review is ignored."""
    return status_transitions(images, made_state(annotations, f"{folder}/annotations"), first_reviews(reviews, f"{folder}/reviews"))


def activity_runs(activity: DataFrame, folder: str, user: str = "user_id", at: str = "created_at") -> DataFrame:
    """Runs of active days (user_id, first_day, last_day) from one scheduled batch a year, the latest first."""
    spark = activity.sparkSession
    table = DeltaTable(folder, ["user_id"], merge_intervals)
    day = F.unix_date(F.to_date(at))
    days = activity.select(F.col(user).alias("user_id"), F.year(at).alias("year"), day.alias("first"), day.alias("last")).where("first IS NOT NULL")
    for i, (year,) in enumerate(days.select("year").distinct().orderBy(F.desc("year")).collect()):  # calendar years
        table.append(days.where(F.col("year") == year).drop("year"), i)
    if not table.entries(spark):
        table.append(days.drop("year"), 0)
    return table.read(spark).select("user_id", F.date_from_unix_date("first").alias("first_day"), F.date_from_unix_date("last").alias("last_day"))
