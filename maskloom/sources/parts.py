"""Sinks that publish text files in one commit (format ``parts``): reports, sorted tables, one folder per key, JSON documents.

Tasks write their own files in parallel under names that no other attempt uses. The driver then publishes all of them at once in a commit log; files of failed or repeated
tasks are not in it, so a reader (of the same format) sees a whole export or none, and each row once. A batch that is written again under its name replaces itself.

Rows have ``key`` (a folder; null for none) and ``value`` (a line). A task opens one file at a time, so rows should be sorted by key within partitions (:func:`write` does). With ``head``,
``separator`` and ``tail`` each file is a document of its own, such as a JSON array. ``single`` also joins the files, in the order of their partitions, into one file of that
name, for small results: more than ``LIMIT`` bytes are refused, as they would pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from maskloom.sources.storage import CommitLog, files, locate

ROWS_PER_FILE = 1_000_000
LIMIT = 64 << 20
STEP = 1 << 20
SCHEMA = "key string, file string, part long, nr long, value string"
_ARROW = pa.schema([("key", pa.string()), ("file", pa.string()), ("part", pa.int64()), ("nr", pa.int64()), ("value", pa.string())])


@dataclass
class Files(ds.WriterCommitMessage):
    entries: list[dict]


class PartsWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.folder, self.overwrite = options["path"], overwrite
        self.batch = options.get("batch") or uuid.uuid4().hex
        self.head, self.separator, self.tail = options.get("head", ""), options.get("separator", "\n"), options.get("tail", "\n")
        self.suffix, self.rows, self.single = options.get("suffix", ".txt"), int(options.get("rowsPerFile", ROWS_PER_FILE)), options.get("single")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        from pyspark import TaskContext

        store, folder = locate(self.folder)
        part, done, out, entry = TaskContext.get().partitionId(), [], None, {}

        def close() -> None:
            if out is not None:
                out.write(self.tail.encode())
                out.close()

        for batch in iterator:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if out is None or key != entry["key"] or entry["rows"] == self.rows:
                    close()
                    where = "" if key is None else f"key={quote(key, safe='')}/"
                    store.create_dir(f"{folder}/{where}", recursive=True)
                    entry = {"key": key, "name": f"{where}part-{part:05d}-{uuid.uuid4().hex}{self.suffix}", "part": part, "nr": len(done), "rows": 0}
                    done.append(entry)
                    out = store.open_output_stream(f"{folder}/{entry['name']}", compression=None)
                    out.write(self.head.encode())
                if entry["rows"]:
                    out.write(self.separator.encode())
                out.write((value or "").encode())
                entry["rows"] += 1
        close()
        return Files(done)

    def commit(self, messages: list[Files | None]) -> None:
        entries = sorted((e for m in messages if m for e in m.entries), key=lambda e: (e["part"], e["nr"]))
        if self.single:
            self._join(entries)
        CommitLog(self.folder).publish(self.batch, entries, self.overwrite)

    def _join(self, entries: list[dict]) -> None:
        store, folder = locate(self.folder)
        names = [f"{folder}/{e['name']}" for e in entries]
        if sum(store.get_file_info(n).size for n in names) > LIMIT:
            raise ValueError(f"more than {LIMIT} bytes do not go into one file; read the parts instead")
        head, tail = len(self.head.encode()), len(self.tail.encode())
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/{self.single}.part", compression=None) as out:
            out.write(self.head.encode())
            for i, name in enumerate(names):
                if i:
                    out.write(self.separator.encode())
                with store.open_input_file(name) as f:
                    f.seek(head)
                    left = f.size() - head - tail
                    while left > 0:
                        left -= out.write(f.read(min(left, STEP)))
            out.write(self.tail.encode())
        store.move(f"{folder}/{self.single}.part", f"{folder}/{self.single}")

    def abort(self, messages: list[Files | None]) -> None:
        store, folder = locate(self.folder)
        for m in messages:
            for e in m.entries if m else ():
                store.delete_file(f"{folder}/{e['name']}")


@dataclass
class OneFile(ds.InputPartition):
    entry: dict


class PartsReader(ds.DataSourceReader):
    """Lines of the published files, with the number of the partition that wrote them and their place in the file."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]

    def partitions(self) -> list[OneFile]:
        return [OneFile(e) for e in CommitLog(self.folder).entries() or []]

    def read(self, partition: OneFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        store, folder = locate(self.folder)
        e, left, nr = partition.entry, b"", 0
        with store.open_input_file(f"{folder}/{e['name']}") as f:
            while True:
                raw = f.read(STEP)
                lines = (left + raw).split(b"\n")
                left = lines.pop() if raw else b""
                if not raw and lines and lines[-1] == b"":
                    lines.pop()
                if lines:
                    n = len(lines)
                    yield pa.RecordBatch.from_pydict(
                        {"key": [e["key"]] * n, "file": [e["name"]] * n, "part": [e["part"]] * n, "nr": list(range(nr, nr + n)), "value": [x.decode() for x in lines]}, schema=_ARROW)
                    nr += n
                if not raw:
                    return


class PartsSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "parts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PartsReader:
        return PartsReader(self.options)

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options, overwrite)


def write(rows: DataFrame, folder: str, overwrite: bool = True, **options: str) -> None:
    """Publish rows (key, value). Their order within partitions is kept, but for keys, which are brought together."""
    rows.sparkSession.dataSource.register(PartsSource)
    if "key" not in rows.columns:
        rows = rows.withColumn("key", F.lit(None).cast("string"))
    else:
        rows = rows.sortWithinPartitions("key")
    out = rows.select("key", F.col("value").cast("string").alias("value"))
    out.write.format("parts").mode("overwrite" if overwrite else "append").options(**options).save(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of what was published: key, file, part, nr within the file, value."""
    spark.dataSource.register(PartsSource)
    return spark.read.format("parts").load(folder)


def published(folder: str) -> list[str]:
    """URIs of the published files, for other readers."""
    return [f"{folder}/{e['name']}" for e in CommitLog(folder).entries() or []]


def strays(folder: str) -> list[str]:
    """Files right in the folder that no commit names: leftovers of failed tasks."""
    store, path = locate(folder)
    known = {e["name"] for e in CommitLog(folder).entries() or []}
    return [p for p, _ in files(store, path, ("",)) if p.rsplit("/", 1)[1] not in known and p.rsplit("/", 1)[1].startswith("part-")]
