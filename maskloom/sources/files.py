"""File listings, tables and rasters as DataFrames."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom import schemas
from maskloom.operators import assets as A
from maskloom.session import cut
from maskloom.sources.storage import locate, read_bytes


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Paths below ``root``, relative to it, with size and time; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    base = root.rstrip("/")
    rel = F.regexp_replace("path", r"^.*?\Q" + base + r"\E/", "")
    return reader.load(root).select(rel.alias("path"), F.col("path").alias("uri"), "length", "modificationTime")


def scan_flat(spark: SparkSession, root: str) -> DataFrame:
    """``images/*.png`` whose ``masks/{stem without style}.png`` exists."""
    files = list_files(spark, root, "*.png")
    stem = F.regexp_extract("path", r"([^/]+)\.png$", 1)
    images = files.where(F.startswith("path", F.lit("images/"))).select(stem.alias("stem"), F.col("uri").alias("image_uri"))
    masks = files.where(F.startswith("path", F.lit("masks/"))).select(stem.alias("view_key"))
    return A.scan_flat(images, masks)


def scan_per_example(spark: SparkSession, root: str) -> DataFrame:
    return A.scan_per_example(list_files(spark, root).select("path"))


def scan_images(spark: SparkSession, root: str, extensions: Sequence[str] = A.IMAGE_EXTENSIONS) -> DataFrame:
    return A.select_images(list_files(spark, root).select("path", "uri"), extensions)


def read_documents(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """One row per small document: file stem, uri and text."""
    df = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
    uri = F.col("_metadata.file_path")
    return df.select(F.regexp_extract(uri, r"([^/]+)\.[^./]+$", 1).alias("stem"), uri.alias("uri"), F.col("value").alias("text"))


def read_csv(spark: SparkSession, path: str | list[str], schema: str = schemas.CLIP_LABELS) -> DataFrame:
    """Header CSV with an explicit schema; columns are taken by position, quotes in quoted texts are doubled."""
    return spark.read.csv(path, header=True, schema=schema, escape='"')


def unpivot_frame_cuts(wide: DataFrame, codes: Sequence[str], key: str = "STYLE_NAME") -> DataFrame:
    """``{code}_START`` / ``{code}_STOP`` columns to rows; a pair with N/A is dropped."""
    have = [c for c in codes if f"{c}_START" in wide.columns and f"{c}_STOP" in wide.columns]
    pairs = F.array(*[
        F.struct(F.lit(c).alias("content"), F.col(f"{c}_START").try_cast("int").alias("start"), F.col(f"{c}_STOP").try_cast("int").alias("stop")) for c in have
    ])
    out = wide.select(F.col(key).alias("style"), F.explode(pairs).alias("_cut")).select("style", "_cut.content", "_cut.start", "_cut.stop")
    return out.where("start IS NOT NULL AND stop IS NOT NULL")


def scan_wide_frame_cuts(spark: SparkSession, path: str, codes: Sequence[str], key: str = "STYLE_NAME") -> DataFrame:
    return unpivot_frame_cuts(spark.read.csv(path, header=True), codes, key)


def _plane_runs(plane: np.ndarray, keep_zero: bool) -> list[np.ndarray]:
    """y, x0, len and value of the runs of one channel of an image."""
    new = np.ones(plane.shape, dtype=bool)
    new[:, 1:] = plane[:, 1:] != plane[:, :-1]
    ys, xs = np.nonzero(new)
    ends = np.full(len(xs), plane.shape[1])
    ends[:-1][ys[1:] == ys[:-1]] = xs[1:][ys[1:] == ys[:-1]]
    values = plane[ys, xs]
    cols = [c.astype(np.int32) for c in (ys, xs, ends - xs, values)]
    return cols if keep_zero else [c[values > 0] for c in cols]


_RUNS = pa.schema([("origin", pa.string())] + [(c, pa.int32()) for c in ("width", "height", "y", "x0", "len", "value")])


def _batch(images: list[tuple[str, int, int, list[np.ndarray]]]) -> pa.RecordBatch:
    """Run rows of several images (origin, width, height, runs)."""
    sizes = [len(runs[0]) for *_, runs in images]
    origin = pa.array([i[0] for i in images], pa.string()).take(pa.array(np.repeat(np.arange(len(images)), sizes)))
    frame = [pa.array(np.repeat(np.array([i[k] for i in images], np.int32), sizes)) for k in (1, 2)]
    return pa.RecordBatch.from_arrays([origin, *frame, *[pa.array(np.concatenate([i[3][k] for i in images])) for k in range(4)]], schema=_RUNS)


def _runs_of(batches: Iterator[pa.RecordBatch], channel: int, keep_zero: bool) -> Iterator[pa.RecordBatch]:
    """Run-length rows of one channel, one image at a time; the image source stores colours as BGR(A)."""
    for batch in batches:
        for i in range(batch.num_rows):
            origin, height, width, channels, data = (batch.column(c)[i].as_py() for c in ("origin", "height", "width", "nChannels", "data"))
            arr = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
            at = channel if channels == 1 or channel == 3 else 2 - channel
            yield _batch([(origin, width, height, _plane_runs(arr[:, :, min(at, channels - 1)], keep_zero))])


#: chunks that do not change the pixels of a PNG
_PLAIN_CHUNKS = {b"IHDR", b"IDAT", b"IEND", b"tEXt", b"zTXt", b"iTXt", b"pHYs", b"tIME"}
_CHANNELS = {0: 1, 2: 3, 6: 4}


def plain_png(data: bytes) -> np.ndarray | None:
    """Pixels (height, width, channels) of an 8-bit grey, RGB or RGBA PNG, not interlaced, whose lines are stored as they are or as differences; None for all else."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, packed, head = 8, [], None
    try:
        while True:
            size, kind = struct.unpack_from(">I4s", data, at)
            body = data[at + 8:at + 8 + size]
            if kind not in _PLAIN_CHUNKS or zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + size)[0]:
                return None
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", body)
            elif kind == b"IDAT":
                packed.append(body)
            elif kind == b"IEND":
                break
            at += 12 + size
        width, height, depth, colour, *method = head
        if depth != 8 or colour not in _CHANNELS or any(method) or not width or not height:
            return None
        lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width * _CHANNELS[colour] + 1)
    except (struct.error, zlib.error, ValueError, TypeError):
        return None
    filters, pixels = lines[:, 0], lines[:, 1:].reshape(height, width, _CHANNELS[colour])
    if filters.max() > 2:
        return None
    if filters.any():
        pixels = pixels.copy()
        for y in np.flatnonzero(filters):
            if filters[y] == 1:
                pixels[y] = np.cumsum(pixels[y], axis=0, dtype=np.uint8)
            elif y:
                pixels[y] += pixels[y - 1]
    return pixels


#: runs that a task hands on at once
BATCH = 100_000
#: up to so many files of other kinds are read by their names; more are found among all files
OTHERS = 10_000
#: partitions of the file source that one task reads
GATHERED = 32
#: bytes of named files that a task holds at once, unless a single one is larger
HELD = 16 << 20


def _runs_of_plain(batches: Iterator[pa.RecordBatch], channel: int, keep_zero: bool) -> Iterator[pa.RecordBatch]:
    """Run-length rows of plain files, of many small ones at once; all others are left out."""
    held, n = [], 0
    for batch in batches:
        for origin, content in zip(batch.column("origin"), batch.column("content"), strict=True):
            if (pixels := plain_png(content.as_py())) is None:
                continue
            height, width, channels = pixels.shape
            at = channel if channel < channels else 0  # as of the image source: a colour image without alpha gives its red
            held.append((origin.as_py(), width, height, _plane_runs(pixels[:, :, at], keep_zero)))
            n += len(held[-1][3][0])
            if n >= BATCH:
                yield _batch(held)
                held, n = [], 0
    if held:
        yield _batch(held)


def _not_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([plain_png(c.as_py()) is None for c in batch.column("content")], pa.bool_())).select(["origin", "path"])


def _gathered(scan: DataFrame) -> DataFrame:
    """A scan in fewer tasks. The file source puts no more than some 30 files in a partition, however small they are, and a task with Python takes longer to start than to read those."""
    parts, busy = scan.rdd.getNumPartitions(), 4 * scan.sparkSession.sparkContext.defaultParallelism
    return scan.coalesce(max(1, min(parts, busy), parts // GATHERED))


def _origin(path: str) -> str:
    """An absolute path as Spark's readers tell it."""
    scheme, rest = re.fullmatch(r"(?s)(?:file:(?://)?(?=/))?(\w[\w+.-]*://[^/]*)?(.*)", path).groups()
    safe = "/!$&'()*+,;=:@~"
    return (scheme or "file://") + (quote(rest, safe) if rest.isascii() else "".join(quote(c, safe) if c.isascii() else c for c in rest))


def _contents(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Files below a folder from their names."""
    store, root = locate(folder)
    found: list[tuple[str, bytes]] = []
    size = 0

    def held() -> pa.RecordBatch:
        paths = [f"{folder}/{name}" for name, _ in found]
        return pa.RecordBatch.from_pydict({"origin": pa.array([_origin(p) for p in paths], pa.string()), "path": pa.array(paths, pa.string()), "content": pa.array([c for _, c in found], pa.binary())})

    for batch in batches:
        for name in batch.column("name").to_pylist():
            found.append((name, read_bytes(store, f"{root}/{name}")))
            size += len(found[-1][1])
            if size >= HELD:
                yield held()
                found, size = [], 0
    if found:
        yield held()


def _images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(path).select("image.*")


def scan_rasters_to_runs(spark: SparkSession, path: str, channel: int = 0, keep_zero: bool = False, names: DataFrame | None = None) -> DataFrame:
    """Image files below ``path`` to run rows; channel 0 of multi-channel masks, 3 is alpha. What cannot be read is in ``unreadable_rasters``.

    Plain PNG masks are decoded in batches; the image source, which takes milliseconds for the smallest file, reads the others only.
    Files are read by tasks of about a thousand, so the number of tasks stays small beside that of files. Spark's list of files is held by the
    driver, some 0.9 KB for each. ``names``, as :func:`sinks.write_rasters` returns them, stand in for it: tasks open the files of their rows.
    """
    if names is None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        rows = _gathered(listed.select(F.regexp_replace("_metadata.file_path", "^file:/(?!/)", "file:///").alias("origin"), "path", "content"))
        read = lambda it: it
    else:
        rows, folder = names.select("name"), path.rstrip("/")
        read = lambda it: _contents(it, folder)
    runs = rows.mapInArrow(lambda it: _runs_of_plain(read(it), channel, keep_zero), schemas.RUNS)
    others = cut(rows.mapInArrow(lambda it: _not_plain(read(it)), "origin string, path string"))
    few = others.limit(OTHERS + 1).collect()
    if not few:
        return runs
    if len(few) <= OTHERS:
        img = _images(spark, [re.sub(r"([\[\]{}*?\\,^])", r"\\\1", n.path) for n in few])
    else:
        img = _images(spark, path).join(others.select("origin"), "origin", "left_semi")
    img = img.where("height > 0").select("origin", "height", "width", "nChannels", "data")
    return runs.unionByName(img.mapInArrow(lambda it: _runs_of(it, channel, keep_zero), schemas.RUNS))


def unreadable_rasters(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` that hold no image, with the reason a reader gives."""
    return _images(spark, path).where("height <= 0 OR height IS NULL").select("origin", F.lit("read_error").alias("reason"))


PER_EXAMPLE = ["image", "segmentation", "depth", "normals"]


def example_id(origin: Column, root: str | None = None) -> Column:
    """Example of a raster: the file stem, but ``{id}`` of ``{id}/segmentation.png`` and ``{id}_{view}`` of ``{id}/{view}/segmentation.png`` below ``root``."""
    stem = F.regexp_extract(origin, r"([^/]+)\.[^./]+$", 1)
    if root is None:
        return stem
    parts = F.split(F.regexp_replace(origin, r"^.*?\Q" + root.rstrip("/") + r"\E/", ""), "/")
    own = stem.isin(PER_EXAMPLE)
    return F.when(own & (F.size(parts) == 2), F.get(parts, F.lit(0))).when(own & (F.size(parts) == 3), F.concat_ws("_", F.slice(parts, 1, 2))).otherwise(stem)


def mask_runs(rasters: DataFrame, dataset: str, root: str | None = None) -> DataFrame:
    """Raster runs as label runs; ``root`` is the dataset folder if it has one folder per example."""
    return rasters.select(F.lit(dataset).alias("dataset"), example_id(F.col("origin"), root).alias("example_id"), "y", "x0", "len", F.col("value").alias("class_id"))
