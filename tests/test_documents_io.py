"""Large JSON documents in chunks, and sinks that publish in one commit."""

import json
import os
import random

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from maskloom.sources import json_array as J
from maskloom.sources import parts, sinks
from maskloom.sources.storage import CommitLog


def value(rnd, depth=0):
    kind = rnd.randrange(7 if depth < 4 else 4)
    if kind == 0:
        return rnd.choice(['a"b', "\\", '\\\\"', '{"x":[', "}]", "é日", "", '\\"]},{', "\n"]) * rnd.randrange(3)
    if kind == 1:
        return rnd.random()
    if kind == 2:
        return None
    if kind == 3:
        return rnd.randrange(100)
    if kind == 4:
        return [value(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {rnd.choice(["k", '"q', "\\"]) + str(i): value(rnd, depth + 1) for i in range(rnd.randrange(4))}


def document(rnd):
    rows = [{"id": i, "v": value(rnd)} if rnd.random() < 0.9 else value(rnd, 3) for i in range(rnd.randrange(20))]
    return rows if rnd.random() < 0.3 else {"info": value(rnd), 'ann"s': rows, "imgs": [{"i": value(rnd)} for _ in range(rnd.randrange(5))], "z": value(rnd)}


def wanted(doc):
    return {"": doc} if isinstance(doc, list) else {k: v for k, v in doc.items() if isinstance(v, list)}


def read_in_chunks(path, chunk):
    """What the index and the reader do, without Spark."""
    source = J.Bytes(fs.LocalFileSystem().open_input_file(path), os.path.getsize(path))
    states, inside, depth = [], False, 0
    for lo in range(0, source.size, chunk):
        hi = min(lo + chunk, source.size)
        odd, out_depth, out_least, in_depth, in_least = J.summary(source, lo, hi)
        states.append((path, lo, hi, inside, depth, depth + (in_least if inside else out_least)))
        depth += in_depth if inside else out_depth
        inside ^= odd
    events = [e for s in states if min(s[5], s[4]) <= 1 for e in J.arrays(source, s[1], s[2], s[3], s[4])]
    out = {}
    for begin, end in J.paired(events):
        for part in J._parts(begin, source.size if end is None else end, end is not None, states):
            out.setdefault(begin[0], []).extend(J.records(source, part))
    return {k: [json.loads(x) for _, x in sorted(v)] for k, v in out.items()}


@pytest.mark.parametrize("chunk", [1, 2, 7, 40, 1000])
def test_any_border_is_exact(tmp_path, monkeypatch, chunk):
    rnd = random.Random(chunk)
    for _ in range(40):
        monkeypatch.setattr(J, "BLOCK", rnd.choice([3, 17, 1 << 20]))
        monkeypatch.setattr(J, "LOOK_BACK", rnd.choice([8, 4096]))
        doc = document(rnd)
        (tmp_path / "d.json").write_text(json.dumps(doc, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1])), newline="")
        got = read_in_chunks(str(tmp_path / "d.json"), chunk)
        for key, rows in wanted(doc).items():
            assert got.get(key, []) == [r for r in rows if isinstance(r, dict)]


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    rnd = random.Random(9)
    doc = {"images": [{"id": i, "file_name": f"é {i} ]}}", "width": 4} for i in range(300)], "annotations": [{"id": i, "image_id": i % 300, "bbox": [1, 2], "note": rnd.choice(['"', "\\", "}{"]), "nested": [{"id": -1}]} for i in range(2000)]}
    (tmp_path / "big.json").write_text(json.dumps(doc))
    (tmp_path / "root.json").write_text(json.dumps([{"id": i} for i in range(50)]))
    (tmp_path / "cut.json").write_text('{"annotations": [{"id": 1}, {"id": 2')
    (tmp_path / "none.json").write_text("not json at all")
    got = J.read_arrays(spark, str(tmp_path), chunk=4096)
    assert J.read_arrays(spark, str(tmp_path / "big.json"), "annotations", 4096).rdd.getNumPartitions() > 10
    rows = J.parsed(got.where("key = 'annotations' AND file LIKE '%big.json'"), "id long, image_id long, note string").collect()
    assert sorted((r.id, r.image_id, r.note) for r in rows) == sorted((a["id"], a["image_id"], a["note"]) for a in doc["annotations"])
    assert J.parsed(got.where("key = 'images'"), "id long, file_name string").agg(F.count_distinct("file_name")).first()[0] == 300
    assert got.where("key = ''").count() == 50 and got.count() == 2351  # one table serves queries with different filters
    assert got.where("file LIKE '%cut.json'").count() == 1
    assert {(r.file.rsplit("/", 1)[1], r.reason) for r in J.broken(spark, str(tmp_path), 4096).collect()} == {("cut.json", "unfinished"), ("none.json", "no_array")}
    same = J.read_arrays(spark, str(tmp_path / "big.json"), "annotations", 1 << 30)
    assert same.rdd.getNumPartitions() == 1 and same.count() == 2000


def lines(spark, folder):
    return sorted((r.key, r.value) for r in parts.read(spark, str(folder)).collect())


def test_published_rows_come_back_once(spark, tmp_path):
    rows = spark.range(0, 5000, numPartitions=7).select((F.col("id") % 3).cast("string").alias("key"), F.concat(F.lit("é "), F.col("id")).alias("value"))
    parts.write(rows, str(tmp_path), rowsPerFile="400", batch="a")
    want = sorted((r.key, r.value) for r in rows.collect())
    assert lines(spark, tmp_path) == want
    parts.write(rows, str(tmp_path), overwrite=False, batch="a")  # the same batch again
    assert lines(spark, tmp_path) == want
    parts.write(rows.where("key = '1'"), str(tmp_path), overwrite=False, batch="b")
    assert len(lines(spark, tmp_path)) == len(want) + sum(k == "1" for k, _ in want)
    parts.write(rows.where("key = '2'"), str(tmp_path))
    assert lines(spark, tmp_path) == [r for r in want if r[0] == "2"]


def test_failed_jobs_publish_nothing(spark, tmp_path):
    good = spark.createDataFrame([("x", "1")], "key string, value string")
    parts.write(good, str(tmp_path))
    bad = spark.range(0, 100, numPartitions=4).select(F.lit("x").alias("key"), F.when(F.col("id") == 99, F.raise_error("stop")).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="stop"):
        parts.write(bad, str(tmp_path), overwrite=False)
    assert lines(spark, tmp_path) == [("x", "1")] and len(CommitLog(str(tmp_path)).batches()) == 1


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "a int, b string")
    sinks.publish_report(none, str(tmp_path / "r"))
    assert json.loads((tmp_path / "r" / "report.json").read_text()) == []
    sinks.publish_sorted_csv(none, str(tmp_path / "c"), ["a"], single="all.csv")
    assert parts.read(spark, str(tmp_path / "c")).count() == 0
    sinks.publish_by_key(none, "b", str(tmp_path / "k"))
    assert parts.published(str(tmp_path / "k")) == []


def test_one_file_keeps_the_order_and_has_a_limit(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 3000, numPartitions=6).select((F.col("id") * 7919 % 3000).alias("n"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('say "x", '), "id")).alias("t"))
    sinks.publish_sorted_csv(rows, str(tmp_path), ["n"], single="all.csv")
    back = spark.read.csv(str(tmp_path / "all.csv"), header=True, schema="n long, t string", escape='"')
    assert [r.n for r in back.coalesce(1).collect()] == list(range(3000))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()), key=lambda r: r[0])
    writer = parts.PartsWriter({"path": str(tmp_path / "big"), "single": "x"}, True)
    monkeypatch.setattr(parts, "LIMIT", 3)
    store = fs.LocalFileSystem()
    store.create_dir(str(tmp_path / "big"))
    with store.open_output_stream(str(tmp_path / "big" / "p")) as out:
        out.write(b"four")
    with pytest.raises(ValueError, match="bytes"):
        writer._join([{"name": "p"}])


def test_documents_by_split(spark, tmp_path):
    found = spark.createDataFrame([("train", 1, 1), ("train", 2, 1), ("val", 1, 1)], "split string, id long, image_id long")
    images = spark.createDataFrame([("train", 1, "a", 2, 2), ("val", 1, "b", 2, 2)], "split string, id long, file_name string, width int, height int")
    sinks.publish_coco(found, images, str(tmp_path))
    docs = [json.loads((tmp_path / "annotations" / f.split("/annotations/")[1]).read_text()) for f in parts.published(str(tmp_path / "annotations"))]
    assert sorted(a["id"] for d in docs for a in d["annotations"]) == [1, 1, 2]
    assert all(set(d) == {"annotations"} for d in docs)


def test_image_ids_hold_within_their_document(spark, tmp_path):
    from maskloom.plans.tables import Tables
    from maskloom.plans.queries_sinks import scan_coco_large

    spark.range(100_000, 100_010).union(spark.range(10)).selectExpr("id AS page_id", "concat('http://x/', id, '.png') AS url", "'<p>' AS html").write.parquet(str(tmp_path / "pages.parquet"))
    got = scan_coco_large(Tables(spark, str(tmp_path))).select("image_id", "annotation_id").collect()
    ids = [*range(10), *range(100_000, 100_010)]
    assert sorted(map(tuple, got)) == sorted([(i, i * 10) for i in ids] + [(i, i * 10 + 1) for i in ids if i % 3])


def test_chunks_do_not_grow_in_number_with_the_files(spark, tmp_path, monkeypatch):
    (tmp_path / "d.json").write_text(json.dumps([{"id": i} for i in range(5000)]))
    monkeypatch.setattr(J, "SPREAD", 8, raising=False)
    assert len(J.index(spark, str(tmp_path), 100)) <= 8
    rows = J.read_arrays(spark, str(tmp_path), "", 100)
    assert rows.rdd.getNumPartitions() <= 8 and rows.select("value").distinct().count() == 5000
