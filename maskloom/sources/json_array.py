"""Large JSON documents as a data source: one document is read by many tasks, each of which parses the objects that begin in its bytes.

Where an object begins cannot be told from the bytes nearby: a brace may stand in a string, and nested objects look like records. So files are read twice, both
times in parallel, in chunks of ``CHUNK`` bytes:

1. :func:`index` runs over all chunks. Each tells, for both cases, that it begins inside or outside a string, how far it goes down or up in depth and how deep it gets at least, and whether
   it changes sides. From one such row per chunk the state at every border follows exactly. Chunks that come up to the level of the document's own
   keys are looked at again for the arrays that begin and end there.
2. The reader (format ``json_array``) has one partition per part of an array. A task begins in the state that the index gives, drops the rest of an object that began before,
   and reads on past its end for the last one. Records are cut out as text, so the JVM parses them with a schema.

The array is that of a key of the document's outer object, or the document itself (key ``""``). Elements that are no objects are not records. Escapes are exact too: what stands before a quote
is looked up across the border. A file that is no JSON document, or ends early, has no arrays or an array without an end; it is reported by :func:`broken`.
"""

from __future__ import annotations

import json
import re
import uuid
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from maskloom.session import ensure_checkpoint_dir
from maskloom.sources.storage import files, locate, read_bytes, write_bytes

CHUNK = 8 << 20
BLOCK = 1 << 20
SPREAD = 256
LOOK_BACK = 1 << 12
SCHEMA = "file string, key string, at long, value string"
_ARROW = pa.schema([("file", pa.string()), ("key", pa.string()), ("at", pa.int64()), ("value", pa.large_string())])
_SUMMARY = {"file": "string", "nr": "long", "lo": "long", "hi": "long", "odd": "boolean", "out_depth": "long", "out_least": "long", "in_depth": "long", "in_least": "long"}
_EVENT = {"file": "string", "key": "string", "at": "long", "begins": "boolean"}
_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}

_DOWN = np.zeros(256, np.int8)
_DOWN[list(b"{[")] = 1
_DOWN[list(b"}]")] = -1


def quotes(data: np.ndarray, before: bytes) -> np.ndarray:
    """Quotes that are not escaped. ``before`` is what stands in front of ``data``, as far back as its last run of backslashes goes."""
    mark = data == 34
    slash = data == 92
    if not slash.any() and not before.endswith(b"\\"):
        return mark
    # length of the run of backslashes that ends before each place
    place = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(slash, -1, place))
    run = place - last_other
    lead = len(before) - len(before.rstrip(b"\\"))
    run[last_other < 0] += lead
    ends = np.concatenate([[lead], run[:-1]])
    return mark & (ends % 2 == 0)


@dataclass
class Bytes:
    """Positions in a file, read in blocks with what stands in front of them."""

    f: pa.NativeFile
    size: int

    def read(self, lo: int, hi: int) -> bytes:
        self.f.seek(lo)
        return self.f.read(hi - lo)

    def before(self, at: int) -> bytes:
        """What stands before a place, back to the first byte that is no backslash."""
        n = 16
        while True:
            got = self.read(max(0, at - n), at)
            if at <= n or got.strip(b"\\"):
                return got
            n *= 16


def summary(source: Bytes, lo: int, hi: int) -> tuple[bool, int, int, int, int]:
    """(odd number of quotes, then depth and least depth if the chunk begins outside, and if it begins inside a string)."""
    side, depth, least = 0, [0, 0], [0, 0]
    lead = source.before(lo)
    for at in range(lo, hi, BLOCK):
        raw = source.read(at, min(at + BLOCK, hi))
        data = np.frombuffer(raw, np.uint8)
        q = quotes(data, lead)
        inside = (np.cumsum(q) + side) % 2
        step = _DOWN[data]
        for case in (0, 1):
            path = np.cumsum(np.where(inside == case, step, 0), dtype=np.int64) + depth[case]
            least[case] = min(least[case], int(path.min(initial=least[case])))
            depth[case] = int(path[-1]) if len(path) else depth[case]
        side = (side + int(q.sum())) % 2
        kept = raw[-LOOK_BACK:]
        lead = kept if kept.strip(b"\\") else lead + raw
    return side == 1, depth[0], least[0], depth[1], least[1]


def structure(data: np.ndarray, before: bytes, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of brackets and braces outside strings, the depth after each, and whether the data ends inside a string."""
    q = quotes(data, before)
    within = (np.cumsum(q) + inside) % 2
    at = np.flatnonzero((_DOWN[data] != 0) & (within == 0))
    return at, depth + np.cumsum(_DOWN[data[at]], dtype=np.int64), bool(within[-1]) if len(data) else inside


_COLON = re.compile(rb'"\s*:\s*$')


def key_before(source: Bytes, where: int) -> str | None:
    """The key whose value begins at a place; None if none stands there."""
    n = LOOK_BACK
    while True:
        raw = source.read(max(0, where - n), where)
        close = _COLON.search(raw)
        if close is None and raw.rstrip(b" \t\r\n:"):
            return None
        at = close.start() if close else 0
        while close and (at := raw.rfind(b'"', 0, at)) >= 0:
            lead = len(raw[:at]) - len(raw[:at].rstrip(b"\\"))
            if lead == at and n < where:
                break  # the run of backslashes may be longer than what was read
            if lead % 2 == 0:
                return json.loads(raw[at : close.start() + 1])
        if n >= where:
            return None
        n *= 16


def arrays(source: Bytes, lo: int, hi: int, inside: bool, depth: int) -> list[tuple[str | None, int, bool]]:
    """(key, place, begins) of the arrays of the document's own level that begin or end in a chunk; an end has the key "" if the document itself ends."""
    out = []
    for at in range(lo, hi, BLOCK):
        data = np.frombuffer(source.read(at, min(at + BLOCK, hi)), np.uint8)
        place, after, ends_inside = structure(data, source.before(at), inside, depth)
        byte = data[place]
        for i in np.flatnonzero(((byte == 91) & (after <= 2)) | ((byte == 93) & (after <= 1))):
            where = at + int(place[i])
            if byte[i] == 93:
                out.append(("" if after[i] == 0 else None, where, False))
            elif after[i] == 1:
                out.append(("", where, True))
            elif (key := key_before(source, where)) is not None:  # an array in an array has no key
                out.append((key, where, True))
        if len(after):
            depth = int(after[-1])
        inside = ends_inside
    return out


def listing(path: str | Sequence[str]) -> list[tuple[str, int]]:
    """(URI, bytes) of JSON files; listed by the driver, as any file source does."""
    out = []
    for one in [path] if isinstance(path, str) else path:
        store, inner = locate(one)
        head = one[: len(one) - len(inner)] if one.endswith(inner) else ""
        out += [(head + p, n) for p, n in files(store, inner, (".json",))]
    return out


def room(total: int, chunk: int) -> int:
    """Bytes of a chunk: as asked, but more if that makes over ``SPREAD`` chunks of them all, up to ``CHUNK``; so tasks, and rows that meet in the driver, do not grow with small chunks."""
    return max(chunk, min(CHUNK, -(-total // SPREAD)))


def _map_ranges(spark: SparkSession, rows: list[tuple], schema: str, work, out: dict[str, str]) -> DataFrame:
    arrow = pa.schema([(name, _TYPES[kind]) for name, kind in out.items()])
    names = [field.split()[0] for field in schema.split(", ")]
    spans = [(r[names.index("lo")], r[names.index("hi")]) for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, inner = locate(row["file"])
                with store.open_input_file(inner) as f:
                    found = work(row, Bytes(f, f.size()))
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=arrow)

    tasks = max(min(len(rows), SPREAD), -(-sum(hi - lo for lo, hi in spans) // CHUNK), 1)
    return spark.createDataFrame(rows, schema).repartition(tasks).mapInArrow(run, ", ".join(map(" ".join, out.items())))


def index(spark: SparkSession, path: str | Sequence[str], chunk: int = CHUNK) -> list[dict]:
    """Parts of arrays: file, key, the bytes of the part, and the state in which it begins. One row per chunk of the files."""
    sizes = dict(listing(path))
    chunk = room(sum(sizes.values()), chunk)
    chunks = [(file, i, lo, min(lo + chunk, size)) for file, size in sizes.items() for i, lo in enumerate(range(0, size, chunk))]
    if not chunks:
        return []

    def told(row: dict, source: Bytes) -> list[dict]:
        odd, *values = summary(source, row["lo"], row["hi"])
        return [row | {"odd": odd} | dict(zip(("out_depth", "out_least", "in_depth", "in_least"), values, strict=True))]

    rows = sorted(_map_ranges(spark, chunks, "file string, nr long, lo long, hi long", told, _SUMMARY).collect(), key=lambda r: (r.file, r.nr))
    states, last, inside, depth = [], None, False, 0
    for r in rows:
        if r.file != last:
            last, inside, depth = r.file, False, 0
        states.append((r.file, r.lo, r.hi, inside, depth, depth + (r.in_least if inside else r.out_least)))
        depth += r.in_depth if inside else r.out_depth
        inside ^= r.odd
    shallow = [s for s in states if min(s[5], s[4]) <= 1]

    def bounds(row: dict, source: Bytes) -> list[dict]:
        return [{"file": row["file"], "key": k, "at": at, "begins": b} for k, at, b in arrays(source, row["lo"], row["hi"], row["inside"], row["depth"])]

    named = "file string, lo long, hi long, inside boolean, depth long, least long"
    events = _map_ranges(spark, shallow, named, bounds, _EVENT).collect()
    own, marks = defaultdict(list), defaultdict(list)
    for s in states:
        own[s[0]].append(s)
    for e in events:
        marks[e.file].append((e.key, e.at, e.begins))
    out = []
    for file in sizes:
        for begin, end in paired(marks[file]):
            out += _parts(begin, sizes[file] if end is None else end, end is not None, own[file])
    return out


def paired(events: list[tuple[str | None, int, bool]]) -> list[tuple[tuple[str, int], int | None]]:
    """((key, begin), end) of the arrays; the end is None if it is missing."""
    out, begin = [], None
    for key, at, begins in sorted(events, key=lambda e: e[1]):
        if begins and begin is None:
            begin = (key, at)
        elif not begins and begin is not None and (begin[0] == "") == (key == ""):
            out.append((begin, at))
            begin = None
    return out + ([(begin, None)] if begin else [])


def _parts(begin: tuple[str, int], end: int, whole: bool, states: list[tuple]) -> list[dict]:
    key, start = begin
    level = 1 if key == "" else 2
    out = []
    near = slice(bisect_right(states, start, key=lambda s: s[2]), bisect_left(states, end, key=lambda s: s[1]))
    for file, lo, hi, inside, depth, _ in states[near]:
        a, b = max(lo, start + 1), min(hi, end)
        if a < b:
            first = lo <= start
            out.append({"file": file, "key": key, "lo": a, "hi": b, "end": end, "inside": False if first else inside, "depth": level if first else depth, "level": level, "whole": whole})
    return out


def records(source: Bytes, part: dict) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the objects of an array that begin in a part."""
    level, inside, depth = part["level"], part["inside"], part["depth"]
    at, lead = part["lo"], source.before(part["lo"])
    open_at: int | None = None
    held: list[bytes] = []
    while at < part["end"] and (at < part["hi"] or open_at is not None):
        raw = source.read(at, min(at + BLOCK, part["end"]))
        data = np.frombuffer(raw, np.uint8)
        place, after, inside = structure(data, lead, inside, depth)
        byte = data[place]
        begins = (byte == 123) & (after == level + 1)
        ends = (byte == 125) & (after == level)
        done = 0
        for i in np.flatnonzero(begins | ends):
            where = int(place[i])
            if begins[i]:
                if at + where >= part["hi"]:
                    return
                open_at, done, held = at + where, where, []
            elif open_at is not None:
                yield open_at, b"".join([*held, raw[done : where + 1]])
                open_at, held = None, []
        if open_at is not None:
            held.append(raw[done:])
        depth = int(after[-1]) if len(after) else depth
        kept = raw[-LOOK_BACK:]
        lead = kept if kept.strip(b"\\") else lead + raw
        at += len(raw)


@dataclass
class Part(ds.InputPartition):
    rows: list[dict]


class JsonArrayReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.index, self.key, self.room = options["index"], options.get("key"), int(options.get("chunk", CHUNK))

    def partitions(self) -> list[Part]:
        store, path = locate(self.index)
        out: list[Part] = []
        found = [p for p in json.loads(read_bytes(store, path)) if self.key is None or p["key"] == self.key]
        most, left = room(sum(p["hi"] - p["lo"] for p in found), self.room), 0
        for part in found:
            size = part["hi"] - part["lo"]
            if not out or left < size:
                out.append(Part([]))
                left = most
            out[-1].rows.append(part)
            left -= size
        return out

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        for part in partition.rows if partition else ():
            store, inner = locate(part["file"])
            with store.open_input_file(inner) as f:
                rows: list[dict] = []
                size = 0
                for at, value in records(Bytes(f, f.size()), part):
                    rows.append({"file": part["file"], "key": part["key"], "at": at, "value": value.decode("utf-8", "replace")})
                    size += len(value)
                    if size >= BLOCK:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class JsonArraySource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> JsonArrayReader:
        return JsonArrayReader(self.options)


def write_index(spark: SparkSession, path: str | Sequence[str], chunk: int = CHUNK) -> str:
    """The index of some files, kept in the shared folder; returns where."""
    ensure_checkpoint_dir(spark)
    target = f"{spark.sparkContext.getCheckpointDir()}/json-index-{uuid.uuid4().hex}"
    store, inner = locate(target)
    write_bytes(store, inner, json.dumps(index(spark, path, chunk)).encode())
    return target


def read_indexed(spark: SparkSession, target: str, key: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Objects of the arrays of an index, or of those of one key only. The key is an option, not a pushed filter: Spark 4.1 keeps a pushed filter with the loaded table, for all its later scans."""
    spark.dataSource.register(JsonArraySource)
    reader = spark.read.format("json_array").option("index", target).option("chunk", chunk)
    return (reader if key is None else reader.option("key", key)).load()


def read_arrays(spark: SparkSession, path: str | Sequence[str], key: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Objects of the arrays of large documents as text: file, key, place in the file, value."""
    return read_indexed(spark, write_index(spark, path, chunk), key, chunk)


def parsed(rows: DataFrame, schema: str) -> DataFrame:
    """Records with the fields of ``schema``, and the file they stand in."""
    return rows.select("file", "at", F.from_json("value", schema).alias("_r")).select("file", "at", "_r.*")


def broken(spark: SparkSession, path: str | Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """Side table: files without an array (``no_array``) or with one that does not end (``unfinished``)."""
    parts = index(spark, path, chunk)
    unfinished = {p["file"] for p in parts if not p["whole"]}
    listed = [file for file, _ in listing(path)]
    have = {p["file"] for p in parts}
    rows = [(f, "unfinished" if f in unfinished else "no_array") for f in listed if f in unfinished or f not in have]
    return spark.createDataFrame(rows, "file string, reason string")
