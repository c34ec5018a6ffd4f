"""WARC archives as a data source (operator 11): ``spark.read.format("warc")`` and ``df.write.format("warc")``.

**Writing.** Each task writes archives of its own (``.warc.gz``, one gzip member per record), and the driver publishes all of them in one commit; files of failed
or repeated tasks are never listed. A member carries the ``sl`` extra field of the WARC standard (its compressed and plain length), and the commit
has offsets of members every ``SPLIT`` bytes, so readers can skip records and divide archives exactly at record borders.

**Reading.** Archives are planned into ranges of about ``SPLIT`` bytes. A record's WARC headers are inflated and parsed first, a few kilobytes. Predicates
on header columns (record type, address, page, date, digest) are pushed down and decided on these; an unwanted record is skipped by its length
without inflating the rest. Predicates are arguments of :func:`read`, as the option ``filters``. Spark 4.1 can also hand the filters of a query to a Python source, but keeps them with the
loaded table, so that later queries over it lose rows (measured: ``df.where(...)`` then ``df.count()``); this source does not take part in that. Option ``payload``: ``keep`` returns payloads, ``check`` hashes them and returns ``intact`` only, ``skip`` decodes none.
Archives of other writers, plain or compressed, are read whole, one task per file, in bounded chunks where nothing is wanted.

**Deduplication** (:func:`mark`): of pages with equal payloads of at least ``LEAST`` bytes that with the largest id is a ``response``; the others are
``revisit`` records that name it and have no payload. Equality is that of SHA-256. Copies are counted per (digest, salt), so a group of a third of all pages is spread.

Defined cases: a null payload is empty; a null id is written as no id, and is a response only if no equal page has an id; repeated rows of the
largest id are all responses (with one record id, as they are one page); line breaks and other controls in an address are percent-encoded, a null address has no header; payloads of any length are one
record; an empty table is an archive without records and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds

from maskloom.functions.ranking import attach_spread
from maskloom.sources.storage import CommitLog, files, locate

LEAST = 1000
SPLIT = 16 << 20
FILE_BYTES = 1 << 30
WINDOW = 1 << 20
HEAD = 4096
#: rows of an Arrow batch that are Python objects at a time
ROWS = 64
DATE = "1970-01-01T00:00:00Z"
RECORD = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, page_id long, refers_to long, payload_digest string, payload_bytes long, "
    "intact boolean, headers map<string,string>, payload binary"
)
INPUT = ("page_id", "url", "record_type", "refers_to", "refers_digest", "payload_digest", "payload_bytes", "payload")
_ARROW = pa.schema([
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("intact", pa.bool_()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
])


def mark(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Records to write for ``pages`` (page_id, url, html): the columns ``INPUT``."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # short payloads take no part: their key is null
    keyed = rows.withColumn("w_key", F.when(F.col("payload_bytes") >= least, F.unhex(F.sha2("payload", 256))))
    light = keyed.where(F.col("w_key").isNotNull()).select("w_key", "page_id")
    copies = attach_spread(
        light, ["w_key"], F.col("page_id"), {"w_n": F.count(F.lit(1)), "w_top": F.max("page_id")}, {"w_n": F.sum("w_n"), "w_top": F.max("w_top")}, F.col("w_n") > 1)
    later = copies.where(F.col("w_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("w_top"))).select(
        F.col("w_key").alias("r_key"), F.col("page_id").alias("r_page"), F.col("w_top").alias("refers_to")).distinct()
    same = (F.col("w_key") == F.col("r_key")) & F.col("page_id").eqNullSafe(F.col("r_page"))
    digest = F.sha1("payload")
    return keyed.join(later, same, "left").select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to", digest.alias("refers_digest"),
        digest.alias("payload_digest"), "payload_bytes", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD, f'{page}:{digest}')}>"


def base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def head(fields: list[tuple[str, str | None]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in fields if v is not None], "\r\n"]).encode()


def record(row: dict, date: str = DATE) -> bytes:
    """One record, plain, for a row of the columns ``INPUT``."""
    again = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    body = b"" if again else row["payload"] or b""
    page, other = row["page_id"], row["refers_to"]
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(page, row["payload_digest"])), ("WARC-Date", date),
        ("WARC-Target-URI", clean(row["url"]) if row["url"] is not None else None), ("WARC-Payload-Digest", f"sha1:{base32(row['payload_digest'])}"),
        ("Page-ID", None if page is None else str(page)),
    ]
    if again:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(other, row["refers_digest"])), ("Refers-To-Page-ID", str(other))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + len(body)))]
    return head(fields) + http + body + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member with skip lengths; records of 4 GB and more have none."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    packed = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    whole = 12 + 12 + len(packed) + len(tail)
    if whole > 0xFFFFFFFF or len(data) > 0xFFFFFFFF:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + packed + tail
    extra = b"sl" + struct.pack("<HII", 8, whole, len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed + tail


@dataclass
class Written(ds.WriterCommitMessage):
    entries: list[dict]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.folder, self.overwrite = options["path"], overwrite
        self.batch = options.get("batch") or uuid.uuid4().hex
        self.level, self.date = int(options.get("level", 3)), options.get("date", DATE)
        self.file_bytes, self.split = int(options.get("fileBytes", FILE_BYTES)), int(options.get("splitBytes", SPLIT))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = locate(self.folder)
        done: list[dict] = []
        out, entry = None, {}
        for batch in iterator:
            for row in (r for at in range(0, batch.num_rows, ROWS) for r in batch.slice(at, ROWS).to_pylist()):
                if out is None:
                    store.create_dir(folder, recursive=True)
                    entry = {"name": f"{uuid.uuid4().hex}.warc.gz", "bytes": 0, "records": 0, "splits": [0]}
                    out = store.open_output_stream(f"{folder}/{entry['name']}", compression=None)
                    done.append(entry)
                    info = head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date), ("Content-Length", "0")])
                    entry["bytes"] += out.write(member(info + b"\r\n\r\n", self.level))
                if entry["bytes"] - entry["splits"][-1] >= self.split:
                    entry["splits"].append(entry["bytes"])
                entry["bytes"] += out.write(member(record(row, self.date), self.level))
                entry["records"] += 1
                if entry["bytes"] >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        CommitLog(self.folder).publish(self.batch, [e for m in messages if m for e in m.entries], self.overwrite)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = locate(self.folder)
        for m in messages:
            for e in m.entries if m else ():
                store.delete_file(f"{folder}/{e['name']}")


class Window:
    """Forward reading of a file with cheap skips."""

    def __init__(self, f: pa.NativeFile, start: int, end: int):
        self.f, self.end, self.at = f, end, start
        self.data, self.first = b"", start

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, or what is left of the file, without moving on."""
        lo = self.at - self.first
        if lo < 0 or lo + n > len(self.data):
            if lo < 0 or lo > len(self.data):
                kept = b""
            else:
                kept = self.data[lo:]
            self.f.seek(self.at + len(kept))
            self.data, self.first, lo = kept + self.f.read(max(n - len(kept), WINDOW)), self.at, 0
        return self.data[lo : lo + n]


class Plain:
    """A record of an archive without compression."""

    def __init__(self, w: Window):
        self.w, self.size = w, None

    def read(self, n: int) -> bytes:
        out = self.w.take(n)
        self.w.at += len(out)
        return out

    def skip(self, n: int) -> None:
        self.w.at += n

    def close(self) -> None:
        """The next record begins after the line breaks."""
        while (c := self.w.take(1)) in (b"\r", b"\n"):
            self.w.at += 1


class Member:
    """A record in a gzip member of its own."""

    def __init__(self, w: Window):
        self.w, self.begin, self.whole = w, w.at, None
        start = w.take(12)
        if start[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {w.at}")
        w.at += 10
        if start[3] & 4:
            (n,) = struct.unpack("<H", start[10:12])
            extra = w.take(2 + n)[2:]
            w.at += 2 + n
            if extra[:4] == b"sl\x08\0":
                self.whole = struct.unpack("<I", extra[4:8])[0]
        for flag in (8, 16):  # file name, comment
            while start[3] & flag and w.take(1) != b"\0":
                w.at += 1
            w.at += bool(start[3] & flag)
        w.at += 2 * bool(start[3] & 2)
        self.inflater = zlib.decompressobj(-zlib.MAX_WBITS)

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and not self.inflater.eof:
            given = self.inflater.unconsumed_tail or self.w.take(1 << 14)
            if not self.inflater.unconsumed_tail:
                self.w.at += len(given)
                if not given:
                    raise ValueError("the archive ends inside a record")
            piece = self.inflater.decompress(given, n)
            out.append(piece)
            n -= len(piece)
        return b"".join(out)

    def skip(self, n: int) -> None:
        pass

    def close(self) -> None:
        if self.whole is not None:
            self.w.at = self.begin + self.whole
            return
        while not self.inflater.eof:
            self.read(WINDOW)
        self.w.at -= len(self.inflater.unused_data)
        self.w.at += 8


def headers(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in re.sub(r"\r?\n[ \t]+", " ", text).split("\n")[1:]:
        name, colon, value = line.rstrip("\r").partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def read_head(source: Plain | Member) -> tuple[dict[str, str], bytes] | None:
    """Headers of a record, and what was read of its block."""
    data = source.read(HEAD)
    while (end := data.find(b"\r\n\r\n")) < 0:
        more = source.read(HEAD)
        if not more:
            if not data.strip():
                return None
            raise ValueError("a record without an end of its headers")
        data += more
    if not data.lstrip().startswith(b"WARC/"):
        raise ValueError("a record that does not begin with its version")
    return headers(data[:end].decode("utf-8", "replace")), data[end + 4 :]


def number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


def sha1_hex(value: str | None) -> str | None:
    """Hex form of a labelled digest in base 32 or base 16."""
    label, _, text = (value or "").partition(":")
    if label.lower() != "sha1":
        return None
    return base64.b32decode(text.upper()).hex() if len(text) == 32 else text.lower()


#: header columns and how they come from the headers
COLUMNS: dict[str, Callable[[dict[str, str]], object]] = {
    "record_type": lambda h: h.get("warc-type"), "record_id": lambda h: h.get("warc-record-id"), "target_uri": lambda h: h.get("warc-target-uri"), "date": lambda h: h.get("warc-date"),
    "page_id": lambda h: number(h.get("page-id")), "refers_to": lambda h: number(h.get("refers-to-page-id")), "payload_digest": lambda h: sha1_hex(h.get("warc-payload-digest")),
}


#: predicates (column, operator, value); comparisons with null hold for nothing
OPERATORS: dict[str, Callable[[object, object], bool]] = {
    "=": lambda have, want: have is not None and have == want, "in": lambda have, want: have is not None and have in want, "<": lambda have, want: have is not None and have < want,
    "<=": lambda have, want: have is not None and have <= want, ">": lambda have, want: have is not None and have > want, ">=": lambda have, want: have is not None and have >= want,
    "starts": lambda have, want: have is not None and have.startswith(want), "ends": lambda have, want: have is not None and have.endswith(want),
    "contains": lambda have, want: have is not None and want in have, "null": lambda have, want: (have is None) == want,
}


@dataclass
class Ranges(ds.InputPartition):
    """(path, first byte, end) of whole records."""

    parts: list[tuple[str, int, int]]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.payload, self.split = options["path"], options.get("payload", "keep"), int(options.get("splitBytes", SPLIT))
        if self.payload not in ("keep", "check", "skip"):
            raise ValueError("payload is keep, check or skip")
        self.filters = [tuple(f) for f in json.loads(options.get("filters", "[]"))]
        for column, operator, _ in self.filters:
            if column not in COLUMNS or operator not in OPERATORS:
                raise ValueError(f"no predicate on headers: {column} {operator}")

    def partitions(self) -> list[Ranges]:
        store, folder = locate(self.folder)
        listed = CommitLog(self.folder).entries()
        if listed is None:
            ranges = [(path, 0, size) for path, size in files(store, folder, (".warc", ".warc.gz"))]
        else:
            ranges = [(f"{folder}/{e['name']}", lo, hi) for e in listed for lo, hi in zip(e["splits"], [*e["splits"][1:], e["bytes"]], strict=True)]
        out: list[Ranges] = []
        room = 0
        for path, lo, hi in ranges:
            if room < hi - lo or not out:
                out.append(Ranges([]))
                room = self.split
            out[-1].parts.append((path, lo, hi))
            room -= hi - lo
        return out

    def wanted(self, found: dict[str, str]) -> bool:
        return found.get("warc-type") != "warcinfo" and all(OPERATORS[op](COLUMNS[c](found), value) for c, op, value in self.filters)

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size = 0
        for row in self.records(partition):
            rows.append(row)
            size += 500 + len(row["payload"] or b"")
            if size >= WINDOW:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def records(self, partition: Ranges | None) -> Iterator[dict]:
        store, _ = locate(self.folder)
        for path, lo, hi in partition.parts if partition else ():
            with store.open_input_file(path) as f:
                w = Window(f, lo, hi)
                kind = Member if w.take(2) == b"\x1f\x8b" else Plain
                while w.at < hi:
                    source = kind(w)
                    found = read_head(source)
                    if found is None:
                        break
                    got, block = found
                    left = int(got["content-length"]) - len(block)
                    if self.wanted(got):
                        yield self.row(got, block, left, source)
                    elif left > 0:
                        source.skip(left)
                    elif kind is Plain:
                        w.at += left
                    source.close()

    def row(self, got: dict[str, str], block: bytes, left: int, source: Plain | Member) -> dict:
        out = {c: find(got) for c, find in COLUMNS.items()} | {"headers": list(got.items()), "payload": None, "intact": None}
        http = got.get("content-type", "").startswith("application/http")
        if left < 0:
            if isinstance(source, Plain):
                source.w.at += left
            block = block[:left]
        own = out["record_type"] not in ("revisit", "warcinfo")
        while http and left > 0 and b"\r\n\r\n" not in block:  # the HTTP head tells the length, so it is read in any case
            more = source.read(min(left, HEAD))
            block, left = block + more, left - len(more)
        lead, gap, body = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        said = number(headers(lead.decode("latin-1")).get("content-length")) if http else None
        if not own:
            out["payload_bytes"] = said
        elif self.payload == "skip":
            out["payload_bytes"] = len(body) + max(left, 0)
        else:
            digest, pieces, n = hashlib.sha1(body), [body], len(body)
            while left > 0:
                more = source.read(min(left, WINDOW))
                if not more:
                    raise ValueError("the archive ends inside a record")
                digest.update(more)
                n, left = n + len(more), left - len(more)
                if self.payload == "keep":
                    pieces.append(more)
            out["payload_bytes"] = n
            out["intact"] = digest.hexdigest() == out["payload_digest"] and said in (None, n)
            if self.payload == "keep":
                out["payload"] = b"".join(pieces)
        if left > 0:
            source.skip(left)
        return out


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        missing = set(INPUT) - set(schema.names)
        if missing:
            raise ValueError(f"columns are missing: {', '.join(sorted(missing))}")
        return WarcWriter(self.options, overwrite)


def write(records: DataFrame, folder: str, **options: str) -> None:
    """Append rows of the columns ``INPUT`` to the archives in ``folder``; ``batch`` names the commit, and one that comes again replaces itself."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").options(**options).save(folder)


def read(spark: SparkSession, folder: str, filters: Sequence[tuple[str, str, object]] = (), **options: str) -> DataFrame:
    """The records of the archives in ``folder`` for which all predicates hold: ``[("record_type", "=", "revisit"), ("target_uri", "starts", "https://")]``. ``warcinfo`` records are left out."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(**options).option("filters", json.dumps(list(filters))).load(folder)
