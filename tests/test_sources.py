"""Files in, files out, and streams over several batches."""

import json
import struct
import zlib

import duckdb  # noqa: F401
import numpy as np
import pytest
from pyspark.sql import functions as F

from maskloom.operators import masks as M
from maskloom.operators import review as R
from maskloom.sources import documents as D
from maskloom.sources import files, sinks
from maskloom.streaming import intake


def png(path, arr):
    """A minimal PNG writer for 8-bit grey and RGBA arrays."""
    h, w = arr.shape[:2]
    kind = 0 if arr.ndim == 2 else 6
    raw = b"".join(b"\x00" + arr[y].astype(np.uint8).tobytes() for y in range(h))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture
def corpus(tmp_path):
    mask = np.zeros((8, 10), np.uint8)
    mask[2:4, 3:7], mask[5, 0:10], mask[6, 9] = 1, 3, 5
    for name in ("a_pose_00", "b_pose_01_side"):
        png(tmp_path / f"masks/{name}.png", mask)
    for name in ("a_pose_00_flat", "a_pose_00_soft_cel", "b_pose_01_side_cel", "c_pose_00_flat"):
        png(tmp_path / f"images/{name}.png", np.dstack([mask] * 3 + [np.where(mask > 0, 255, 0)]))
    (tmp_path / "sources").mkdir()
    (tmp_path / "sources/a.json").write_text(json.dumps({"source": "", "unmapped_bones": ["x"]}))
    (tmp_path / "sources/mixamo_7.json").write_text(json.dumps({"id": "mixamo_7", "name": "n"}))
    (tmp_path / "sources/bad.json").write_text("{broken")
    return tmp_path, mask


def test_flat_scan(spark, corpus):
    root, _ = corpus
    got = {r.stem for r in files.scan_flat(spark, str(root)).collect()}
    assert got == {"a_pose_00_flat", "a_pose_00_soft_cel", "b_pose_01_side_cel"}
    assert files.scan_images(spark, str(root)).count() == 6


def test_rasters_become_runs(spark, corpus):
    root, mask = corpus
    runs = files.mask_runs(files.scan_rasters_to_runs(spark, str(root / "masks")), "d")
    assert {r.example_id for r in runs.collect()} == {"a_pose_00", "b_pose_01_side"}
    back = np.zeros_like(mask)
    for r in runs.where("example_id = 'a_pose_00'").collect():
        back[r.y, r.x0 : r.x0 + r.len] = r.class_id
    assert (back == mask).all()
    alpha = files.scan_rasters_to_runs(spark, str(root / "images/a_pose_00_flat.png"), channel=3)
    assert alpha.agg(F.sum("len")).first()[0] == int((mask > 0).sum())
    assert M.class_distribution(runs).where("share > 0").count() == 3


def test_source_documents(spark, corpus):
    root, _ = corpus
    docs = files.read_documents(spark, str(root / "sources"))
    assert {(r.char_id, r.source) for r in D.scan_sources(docs).collect()} == {("a", "unknown"), ("mixamo_7", "mixamo")}
    assert [r.stem for r in D.malformed(docs).collect()] == ["bad"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("c2", "train", "s"), ("c1", "train", "s"), ("c3", "test", "s")], "char_id string, split string, source string")
    sinks.write_sorted_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), "char_id string, split string, source string")
    assert [r.char_id for r in back.orderBy("split", "char_id").collect()] == ["c3", "c1", "c2"]
    sinks.write_report(df.groupBy("split").count(), str(tmp_path / "report"))
    assert {json.loads(r.value)["split"] for r in spark.read.text(str(tmp_path / "report")).collect()} == {"train", "test"}
    sinks.fan_out_by_key(df, "split", str(tmp_path / "fan"))
    assert spark.read.json(str(tmp_path / "fan")).where("split = 'train'").count() == 2


def test_wide_cuts_from_csv(spark, tmp_path):
    (tmp_path / "cuts.csv").write_text("STYLE_NAME,BR_START,BR_STOP,FW_START,FW_STOP\nold,3,9,N/A,N/A\nyoung,0,4,5,6\n")
    got = files.scan_wide_frame_cuts(spark, str(tmp_path / "cuts.csv"), ["BR", "FW", "SR"])
    assert sorted(tuple(r) for r in got.collect()) == [("old", "BR", 3, 9), ("young", "BR", 0, 4), ("young", "FW", 5, 6)]


def test_coco_export(spark, tmp_path):
    runs = spark.createDataFrame([("d", e, 0, 0, 6, 2) for e in range(30)] + [("d", e, 3, 0, 2, 4) for e in range(30)], "dataset string, example_id int, y int, x0 int, len int, class_id int")
    sinks.export_coco(runs, str(tmp_path / "coco"))
    back = spark.read.json(str(tmp_path / "coco"))
    assert back.count() == 30
    for r in back.groupBy("split").agg(F.count("id").alias("n"), F.max("id").alias("top"), F.max("image_id").alias("imgs")).collect():
        assert r.n == r.top == r.imgs


def batches(spark, tmp_path, df, parts):
    """Write ``df`` as files that a stream picks up one by one."""
    for i, cond in enumerate(parts):
        df.where(cond).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_running_confusion_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i % 5, (i * 3) % 5, i) for i in range(60)], "gt int, pred int, w long")
    stream = batches(spark, tmp_path, df, ["w < 20", "w >= 20 AND w < 45", "w >= 45"])
    got = intake.running_confusion(stream, str(tmp_path / "state"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, M.confusion(df).collect()))


def test_streak_state_over_batches(spark, tmp_path):
    df = spark.sql("""SELECT u AS user_id, CAST(timestamp'2024-01-01 10:00:00' + make_dt_interval(d) AS timestamp) AS created_at
        FROM VALUES (1, 0), (1, 1), (1, 1), (1, 2), (1, 5), (2, 3), (2, 9), (3, 4) AS t(u, d)""").withColumn("user_id", F.col("user_id").cast("long"))
    stream = batches(spark, tmp_path, df, ["day(created_at) <= 2", "day(created_at) BETWEEN 3 AND 5", "day(created_at) > 5"])
    got = intake.streak_state(stream, str(tmp_path / "state"))
    want = R.daily_streaks(df)
    cols = ["user_id", "current_streak", "longest_streak", "last_active"]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(tuple(r[c] for c in cols) for r in want.collect())


@pytest.mark.parametrize("order", [[1, 2, 3], [3, 1, 2], [2, 3, 1]])
def test_streaks_do_not_depend_on_arrival_order(spark, tmp_path, order):
    df = spark.sql("""SELECT CAST(u AS BIGINT) AS user_id, p, CAST(timestamp'2024-01-01 10:00:00' + make_dt_interval(d) AS timestamp) AS created_at
        FROM VALUES (1, 0, 1), (1, 1, 3), (1, 2, 2), (1, 3, 1), (1, 3, 2), (1, 7, 2), (2, 3, 3), (2, 4, 1), (3, 4, 3), (3, 6, 3), (3, 5, 1) AS t(u, d, p)""")
    stream = batches(spark, tmp_path, df, [f"p = {p}" for p in order])
    got = intake.streak_state(stream, str(tmp_path / "state"))
    cols = ["user_id", "current_streak", "longest_streak", "last_active"]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(tuple(r[c] for c in cols) for r in R.daily_streaks(df).collect())


def test_first_review_wins_when_it_is_late(spark, tmp_path):
    rows = [(1, 11, "2024-01-02", "rejected", 1), (1, 10, "2024-01-01", "approved", 2), (2, 13, "2024-01-01", "rejected", 2), (2, 12, "2024-01-01", "approved", 1)]
    df = spark.createDataFrame(rows, "annotation_id long, review_id long, reviewed_at string, status string, p int")
    got = intake.first_reviews(batches(spark, tmp_path, df, ["p = 1", "p = 2"]), str(tmp_path / "state"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, R.effective_reviews(df).collect()))


def test_intake_takes_a_key_once(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (3, 2), (3, 2)], "annotation_id long, b int")
    stream = batches(spark, tmp_path, df, ["b = 1", "b = 2"])
    got = intake.incremental_intake(stream, "annotation_id", str(tmp_path / "state"))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 2)]
    assert intake.pending(df, got, "annotation_id").count() == 0


def test_raster_layouts_and_unreadable_files(spark, tmp_path):
    mask = np.array([[0, 3], [3, 3]], np.uint8)
    for name in ("a/segmentation.png", "b/front/segmentation.png", "masks/c_pose_00.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        png(tmp_path / name, mask)
    (tmp_path / "a" / "broken.png").write_bytes(b"not an image")
    runs = files.mask_runs(files.scan_rasters_to_runs(spark, str(tmp_path)), "d", str(tmp_path))
    assert {(r.example_id, r.n) for r in runs.groupBy("example_id").agg(F.sum("len").alias("n")).collect()} == {("a", 3), ("b_front", 3), ("c_pose_00", 3)}
    bad = files.unreadable_rasters(spark, str(tmp_path)).collect()
    assert [(r.origin.rsplit("/", 1)[1], r.reason) for r in bad] == [("broken.png", "read_error")]


def _png(lines, width, height, colour):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def test_rasters_read_in_batches_equal_those_of_the_image_source(spark, tmp_path, monkeypatch):
    """Plain files never reach the image source; line filters it alone knows, and names with special characters, still do."""
    rnd = np.random.default_rng(1)
    for colour, channels in ((0, 1), (2, 3), (6, 4)):
        for kind in range(4):
            lines = rnd.integers(0, 3, (5, 6 * channels + 1), np.uint8)
            lines[:, 0] = kind if kind < 3 else [0, 1, 2, 3, 4]
            (tmp_path / f"a {colour}{{{kind}}}[x].png").write_bytes(_png(lines.tobytes(), 6, 5, colour))
    (tmp_path / "cut.png").write_bytes((tmp_path / "a 0{0}[x].png").read_bytes()[:-20])
    image = files._images(spark, str(tmp_path)).where("height > 0").select("origin", "height", "width", "nChannels", "data")
    for channel in (0, 1, 3):
        for limit in (10_000, 1):
            monkeypatch.setattr(files, "OTHERS", limit)
            want = image.mapInArrow(lambda it, c=channel: files._runs_of(it, c, True), files.schemas.RUNS)
            got = files.scan_rasters_to_runs(spark, str(tmp_path), channel, keep_zero=True)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.select("origin").distinct().count() >= 12
    seen = []
    monkeypatch.setattr(files, "_images", lambda _, names: seen.append(names) or image.limit(0))
    sinks.write_rasters(spark.createDataFrame([("d", i, y, 0, 3, 1 + y) for i in range(40) for y in range(4)], "dataset string, example_id long, y int, x0 int, len int, class_id int"), str(tmp_path / "new"), 8, 8)
    assert files.scan_rasters_to_runs(spark, str(tmp_path / "new")).count() == 160 and not seen


def test_many_small_rasters_are_read_by_few_tasks(spark, tmp_path):
    """The file source alone deals 2,100 masks to 66 partitions, and a folder of a million to 30,000."""
    runs = spark.range(2100).selectExpr("'d' AS dataset", "id AS example_id", "0 AS y", "0 AS x0", "2 AS len", "CAST(1 + id % 9 AS INT) AS class_id")
    sinks.write_rasters(runs, str(tmp_path), 4, 4)
    got = files.scan_rasters_to_runs(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert got.select("origin").distinct().count() == 2100 and got.agg(F.sum("value")).first()[0] == sum(1 + i % 9 for i in range(2100))


@pytest.mark.parametrize("limit", [10_000, 1])
def test_named_rasters_are_read_without_a_list_of_files(spark, tmp_path, monkeypatch, limit):
    """Files that are not plain and odd names give the same rows as a scan of the folder."""
    rnd = np.random.default_rng(2)
    folder = f"file:{tmp_path}/a b"
    runs = spark.createDataFrame([(d, i, y, 0, 3, 1 + y) for d in ("d", "é {x}[1]", "50%,+&") for i in range(20) for y in range(4)], "dataset string, example_id long, y int, x0 int, len int, class_id int")
    names = sinks.write_rasters(runs, folder, 8, 8)
    for kind in (3, 4):
        lines = rnd.integers(0, 3, (5, 7), np.uint8)
        lines[:, 0] = kind
        (tmp_path / f"a b/d/{kind} [x].png").write_bytes(_png(lines.tobytes(), 6, 5, 0))
    names = names.select("name").unionByName(spark.createDataFrame([(f"d/{kind} [x].png",) for kind in (3, 4)], "name string"))
    monkeypatch.setattr(files, "OTHERS", limit)
    monkeypatch.setattr(files, "HELD", 700)
    want = files.scan_rasters_to_runs(spark, folder).collect()
    monkeypatch.setattr(files, "_gathered", lambda scan: pytest.fail("files are listed"))
    got = files.scan_rasters_to_runs(spark, folder, names=names).collect()
    assert len(got) > 240 and sorted(map(tuple, got)) == sorted(map(tuple, want))
