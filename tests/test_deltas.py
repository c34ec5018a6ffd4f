"""Delta tables: right whatever the order, the restarts and the compactions, and work per batch that follows the batch."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from maskloom.operators import review as R
from maskloom.streaming import intake
from maskloom.streaming.deltas import DeltaTable

ROWS = "k long, v long"


def least(rows):
    return rows.groupBy("k").agg(F.min("v").alias("v"))


def size(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def want(batches):
    out = {}
    for b in batches:
        for k, v in b:
            out[k] = min(v, out.get(k, v))
    return sorted(out.items())


def test_bytes_written_follow_the_batch(spark, tmp_path):
    """Ten equal batches without compaction write the same; with it, each row is written once per size of entry."""
    rnd = random.Random(1)
    batches = [[(rnd.randrange(10**9), rnd.randrange(1000)) for _ in range(4000)] for _ in range(10)]
    plain = DeltaTable(str(tmp_path / "plain"), ["k"], least, fan=100)
    written = []
    for i, b in enumerate(batches):
        before = size(tmp_path / "plain")
        plain.append(spark.createDataFrame(b, ROWS), i)
        written.append(size(tmp_path / "plain") - before)
    assert max(written) < 1.1 * min(written)
    assert sorted(map(tuple, plain.read(spark).collect())) == want(batches)


def test_compaction_hides_and_later_removes(spark, tmp_path):
    rnd = random.Random(2)
    batches = [[(rnd.randrange(60), rnd.randrange(1000)) for _ in range(50)] for _ in range(17)]
    table = DeltaTable(str(tmp_path), ["k"], least, buckets=4, fan=2)
    for i, b in enumerate(batches):
        table.append(spark.createDataFrame(b, ROWS), i)
        assert sorted(map(tuple, table.read(spark).collect())) == want(batches[: i + 1])
    spans = [(e.first, e.last) for e in table.entries(spark)]
    assert spans == [(0, 15), (16, 16)]
    on_disk = sorted(p.name for p in (tmp_path / "log").iterdir())
    assert len(on_disk) < 8  # what the last merge replaced may still be there, nothing older


def test_repeated_failed_and_compacted_batches(spark, tmp_path):
    table = DeltaTable(str(tmp_path), ["k"], lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v")), fan=3)
    rows = spark.createDataFrame([(1, 5), (1, 6), (2, 1)], ROWS)
    table.append(rows, 0)
    table.append(rows, 0)
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, 11), (2, 1)]
    # a batch that failed half-way has no mark of completion
    table.append(rows, 1)
    (tmp_path / "log" / "00000001-00000001" / "_SUCCESS").unlink()
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, 11), (2, 1)]
    table.append(rows, 1)
    table.append(rows, 2)  # merges 0 to 2
    assert [(e.first, e.last) for e in table.entries(spark)] == [(0, 2)]
    table.append(rows, 2)  # comes again after it was merged
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, 33), (2, 3)]
    # a merge that failed half-way is done again by the repeated batch
    (tmp_path / "log" / "00000000-00000002" / "_SUCCESS").unlink()
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, 33), (2, 3)]
    table.append(rows, 2)
    assert [(e.first, e.last) for e in table.entries(spark)] == [(0, 2)]
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, 33), (2, 3)]


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_path):
    table = DeltaTable(str(tmp_path), ["k"], least, buckets=16)
    table.append(spark.createDataFrame([(i, i) for i in range(500)], ROWS), 0)
    table.append(spark.createDataFrame([(i, i - 1) for i in range(0, 500, 2)], ROWS), 1)
    got = table.lookup(spark, spark.createDataFrame([(4,), (7,), (7,), (9999,)], "k long"))
    assert sorted(map(tuple, got.collect())) == [(4, 3), (7, 7)]
    assert "PartitionFilters: [bucket" in got._jdf.queryExecution().toString() or "PartitionFilters: [isnotnull(bucket" in got._jdf.queryExecution().toString()


def files(spark, tmp_path, df, parts):
    for cond in parts:
        df.where(cond).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_a_stream_goes_on_after_a_restart(spark, tmp_path):
    """Late days arrive after a restart and join two runs; five batches pass a compaction."""
    days = [(1, d) for d in (0, 1, 2, 4, 5, 9)] + [(2, d) for d in (3, 8)]
    df = spark.createDataFrame(days, "user_id long, d int").withColumn("created_at", F.expr("timestamp'2024-01-01 10:00:00' + make_dt_interval(d)"))
    intake.streak_state(files(spark, tmp_path, df, ["d IN (9, 8)", "d = 0", "d IN (4, 5)"]), str(tmp_path / "state"))
    got = intake.streak_state(files(spark, tmp_path, df, ["d = 1", "d IN (2, 3)"]), str(tmp_path / "state"))
    cols = ["user_id", "current_streak", "longest_streak", "last_active"]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(tuple(r[c] for c in cols) for r in R.daily_streaks(df).collect())


@pytest.mark.parametrize("parts", [["p = 1", "p = 2"], ["p = 2", "p = 1"]])
def test_status_of_two_streams(spark, tmp_path, parts):
    made = spark.createDataFrame([(10, "2024-01-01", 1, 1), (11, "2024-01-03", 1, 2), (12, "2024-01-02", 2, 1), (13, "2024-01-05", 3, 2)], "annotation_id long, created_at string, image_id long, p int")
    reviews = spark.createDataFrame([(10, 5, "2024-01-02", "approved", 2), (10, 6, "2024-01-04", "rejected", 1), (12, 7, "2024-01-06", "rejected", 1)], "annotation_id long, review_id long, reviewed_at string, status string, p int")
    images = spark.createDataFrame([(i,) for i in range(1, 5)], "image_id long")
    (tmp_path / "a").mkdir()
    (tmp_path / "r").mkdir()
    got = intake.status_state(files(spark, tmp_path / "a", made, parts), files(spark, tmp_path / "r", reviews, parts), images, str(tmp_path / "state"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, R.status_transitions(images, made, reviews).collect()))
    assert dict(map(tuple, got.collect())) == {1: "annotated", 2: "rejected", 3: "annotated", 4: "pending"}


def test_late_rows_are_made_once(spark):
    """Four spans of arrival read rows that were written, they do not make them again."""
    from maskloom.plans.queries_review import _late_first

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(1000).selectExpr("id AS annotation_id", "timestamp_seconds(id) AS reviewed_at", "id AS review_id", "'approved' AS status").mapInArrow(count, "annotation_id long, reviewed_at timestamp, review_id long, status string")
    got = _late_first(None, rows, "reviewed_at", intake.first_reviews)
    assert got.count() == 1000 and made.value == 1000


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    table = DeltaTable(str(tmp_path), ["k"], least, buckets=1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table.append(spark.range(4000).selectExpr("id AS k", "id AS v"), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list(Path(tmp_path).rglob("*.parquet"))) > 1 and table.read(spark).count() == 4000
