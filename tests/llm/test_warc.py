"""WARC archives: written, read back, skipped, split, repeated, and read by other means."""

import gzip
import hashlib
import io
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maskloom.llm import warc
from maskloom.sources.storage import CommitLog

PAGES = "page_id long, url string, html string, payload string, record_type string, refers_to string, w_key string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "t", "r", "k") for r in rows], PAGES)


def expected(rows, least=warc.LEAST):
    top = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            top[html] = max(top.get(html, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = html in top and page != top[html]
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top[html] if again else None))
    return sorted(out, key=repr)


def back(spark, folder, **options):
    return warc.read(spark, folder, **options)


def digest(df):
    return sorted([tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()], key=repr)


LONG = "long é page " * 300_000
ODD = [
    (1, "http://a/", None), (2, "http://a/", ""), (3, None, "short"), (4, "http://b/\r\nWARC-Type: x", "x" * 999), (5, "http://c/é", "x" * 999), (6, "u", "y" * 1000), (7, "u", "y" * 1000),
    (7, "u", "y" * 1000), (None, "u", "y" * 1000), (None, "n", "z" * 2000), (None, "n", "z" * 2000), (8, "l", LONG), (9, "l", LONG), (10, "g", "WARC/1.1\r\n\r\n" * 200), (11, "", "é" * 500),
    (12, "", "é" * 500), (-3, "m", "k" * 1500), (-9, "m", "k" * 1500),
]


def test_odd_pages(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc.write(warc.mark(pages(spark, ODD)), folder)
    for mode in ("keep", "check", "skip"):
        df = back(spark, folder, payload=mode)
        assert digest(df) == expected(ODD)
        rows = df.collect()
        assert all(r.intact is (None if mode == "skip" or r.record_type == "revisit" else True) for r in rows)
        held = [r for r in rows if r.payload is not None]
        assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in held) and len(held) == (sum(r.record_type == "response" for r in rows) if mode == "keep" else 0)
    ids = {(r.page_id, r.record_id) for r in rows if r.record_type == "response"}
    for r in rows:
        if r.record_type == "revisit":
            assert (r.refers_to, r.headers["warc-refers-to"]) in ids
        assert "\n" not in (r.target_uri or "")


def test_no_pages(spark, tmp_path):
    warc.write(warc.mark(pages(spark, [])), str(tmp_path))
    assert back(spark, str(tmp_path)).count() == 0


def test_a_hot_payload(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, "u", "hot " * 300 if i % 3 == 0 else f"page {rnd.randrange(400)} " * 120) for i in range(3000)]
    warc.write(warc.mark(pages(spark, rows)), str(tmp_path))
    assert digest(back(spark, str(tmp_path), payload="check")) == expected(rows)


def test_ranges_hold_each_record_once(spark, tmp_path):
    rows = [(i, f"http://h/{i}", os.urandom(700).hex()) for i in range(500)]
    warc.write(warc.mark(pages(spark, rows)), str(tmp_path), splitBytes="9000", fileBytes="60000")
    df = back(spark, str(tmp_path), payload="check", splitBytes="20000")
    assert df.rdd.getNumPartitions() > 10
    assert digest(df) == expected(rows)


def test_predicates_on_headers(spark, tmp_path):
    warc.write(warc.mark(pages(spark, ODD)), str(tmp_path))
    whole = [r.asDict() for r in back(spark, str(tmp_path)).collect()]
    cases = [
        ([("record_type", "=", "revisit")], lambda r: r["record_type"] == "revisit"), ([("page_id", "in", [7, 9])], lambda r: r["page_id"] in (7, 9)), ([("page_id", "null", True)], lambda r: r["page_id"] is None),
        ([("page_id", "null", False)], lambda r: r["page_id"] is not None), ([("target_uri", "starts", "http://")], lambda r: (r["target_uri"] or "").startswith("http://")),
        ([("page_id", ">", 6)], lambda r: r["page_id"] is not None and r["page_id"] > 6), ([("page_id", "<=", 6)], lambda r: r["page_id"] is not None and r["page_id"] <= 6),
        ([("page_id", ">=", 6), ("page_id", "<", 8)], lambda r: r["page_id"] in (6, 7)), ([("target_uri", "ends", "/")], lambda r: (r["target_uri"] or "").endswith("/")),
        ([("record_type", "=", "response"), ("target_uri", "contains", "c/")], lambda r: r["record_type"] == "response" and "c/" in (r["target_uri"] or "")),
    ]
    for filters, same in cases:
        assert sorted(map(repr, (r.asDict() for r in back(spark, str(tmp_path), filters=filters).collect()))) == sorted(repr(r) for r in whole if same(r))
    with pytest.raises(ValueError, match="no predicate"):
        warc.WarcReader({"path": str(tmp_path), "filters": '[["payload", "=", 1]]'})


def test_one_loaded_table_serves_many_queries(spark, tmp_path):
    """Filters of one query must not stay with the table."""
    warc.write(warc.mark(pages(spark, ODD)), str(tmp_path))
    df = back(spark, str(tmp_path))
    assert df.where("page_id = -999").count() == 0 and df.count() == len(ODD)
    again = df.where("record_type = 'revisit'")
    assert df.where("record_type = 'response'").unionByName(again).count() == len(ODD)
    assert again.join(df.where("record_type = 'response'").select(F.col("page_id").alias("p")), F.col("refers_to") == F.col("p")).count() > 0


def archive(tmp_path, records, name, pack):
    data = b"".join(pack(r) for r in records)
    (tmp_path / name).write_bytes(data)


def some_records():
    out = []
    for i in range(6):
        body = (f"body {i} " * 50_000).encode()
        d = hashlib.sha1(body).hexdigest()
        out.append(warc.record({"page_id": i, "url": f"http://x/{i}", "record_type": "response", "refers_to": None, "refers_digest": d, "payload_digest": d, "payload_bytes": len(body), "payload": body}))
    return out


@pytest.mark.parametrize(("name", "pack"), [("a.warc", bytes), ("a.warc.gz", gzip.compress), ("b.warc.gz", lambda r: warc.member(r, 6))])
def test_archives_of_others(spark, tmp_path, name, pack):
    archive(tmp_path, some_records(), name, pack)
    df = back(spark, str(tmp_path))
    assert sorted((r.page_id, r.payload_bytes, r.intact) for r in df.collect()) == [(i, 350_000, True) for i in range(6)]
    assert [r.page_id for r in back(spark, str(tmp_path), filters=[("page_id", "=", 4)]).collect()] == [4]
    assert sorted(r.payload_bytes for r in back(spark, str(tmp_path), payload="skip").collect()) == [350_000] * 6


def test_unwanted_payloads_are_not_inflated(tmp_path, monkeypatch):
    archive(tmp_path, some_records(), "a.warc.gz", lambda r: warc.member(r, 6))
    seen = []
    read = warc.Member.read

    def counted(self, n):
        out = read(self, n)
        seen.append(len(out))
        return out

    monkeypatch.setattr(warc.Member, "read", counted)
    reader = warc.WarcReader({"path": str(tmp_path), "filters": '[["page_id", "=", 2]]'})
    (part,) = reader.partitions()
    assert [r["page_id"] for r in reader.records(part)] == [2]
    assert sum(seen) < 350_000 + 2 * 6 * warc.HEAD


def test_a_changed_payload_is_seen(tmp_path):
    good = some_records()[0]
    archive(tmp_path, [good[:-5] + b"!" + good[-4:]], "a.warc", bytes)
    reader = warc.WarcReader({"path": str(tmp_path), "payload": "check"})
    assert [r["intact"] for p in reader.partitions() for r in reader.records(p)] == [False]


def test_members_are_plain_gzip():
    data = some_records()[1]
    assert gzip.decompress(warc.member(data, 3)) == data
    assert gzip.GzipFile(fileobj=io.BytesIO(warc.member(data, 3) + warc.member(b"x", 3))).read() == data + b"x"


def test_failed_tasks_and_repeated_batches_leave_no_records(spark, tmp_path):
    rows = [(i, "u", f"page {i} " * 200) for i in range(50)]
    records = warc.mark(pages(spark, rows))
    warc.write(records, str(tmp_path), batch="one")
    lost = warc.WarcWriter({"path": str(tmp_path)}, False)
    lost.write(iter([pa.RecordBatch.from_pylist([r.asDict() for r in records.collect()])]))  # a task that ended, in a job that did not
    warc.write(records, str(tmp_path), batch="one")
    assert digest(back(spark, str(tmp_path))) == expected(rows)
    warc.write(records.where("page_id < 10"), str(tmp_path), batch="two")
    assert back(spark, str(tmp_path)).count() == 60 and CommitLog(str(tmp_path)).batches() == ["one", "two"]
