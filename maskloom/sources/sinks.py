"""Exports: reports, sorted tables, per-key outputs and detection annotations."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.names import hash_split
from maskloom.functions.ranking import rank_sorted
from maskloom.operators.components import component_table, label_runs, new_key, whole_keys
from maskloom.operators.masks import EXAMPLE
from maskloom.session import cut, dealt
from maskloom.sources import parts
from maskloom.sources.storage import locate


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str] = ("split", "source", "char_id")) -> None:
    """Header CSV in global sort order; the part files follow each other."""
    df.orderBy(*order).write.mode("overwrite").csv(path, header=True, escape='"')


def write_report(df: DataFrame, path: str) -> None:
    """An aggregated report as JSON lines."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def fan_out_by_key(df: DataFrame, key: str, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per key value; a large key is spread over several files."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(key).json(path)


def clip_documents(frames: DataFrame, root: DataFrame, bones: Sequence[str] = tuple(dims.JOINT_NAMES)) -> DataFrame:
    """Frame rows as one JSON object per frame, keyed by bone; the root carries the position.

    Frames stay separate rows, so a long clip is never one value.
    """
    body = F.map_from_entries(F.array_sort(F.collect_list(F.struct("bone", F.array("rx", "ry", "rz").alias("rotation")))))
    per = frames.where(F.col("bone").isin(list(bones))).groupBy("clip", "frame").agg(body.alias("rotations"))
    pos = root.select("clip", "frame", F.array("px", "py", "pz").alias("position"))
    out = per.join(pos, ["clip", "frame"], "left")
    return out.select("clip", "frame", F.to_json(F.struct("position", "rotations")).alias("value"))


def weight_documents(weights: DataFrame) -> DataFrame:
    """Vertex rows as one JSON object per vertex."""
    w = F.map_from_entries(F.array_sort(F.collect_list(F.struct("bone", F.bround("w", 6).alias("w")))))
    v = weights.groupBy("example_id", "vertex").agg(F.first("x").alias("_x"), F.first("y").alias("_y"), w.alias("weights"))
    return v.select("example_id", "vertex", F.to_json(F.struct(F.array("_x", "_y").alias("position"), "weights")).alias("value"))


def coco_annotations(runs: DataFrame, min_area: int = 4, seed: int = 42) -> DataFrame:
    """Components as detection annotations with dense image and annotation ids per split."""
    comp = component_table(label_runs(runs)).where(F.col("area") >= min_area)
    comp = cut(comp.withColumn("split", hash_split(F.concat_ws("/", "dataset", F.col("example_id").cast("string")), seed)))
    images = rank_sorted(comp.select("split", *EXAMPLE).distinct(), EXAMPLE, ["split"], rank="image_id")
    order = [*EXAMPLE, "class_id", "root_y", "root_x"]
    ranked = rank_sorted(comp, order, ["split"], rank="id").join(images, ["split", *EXAMPLE])
    box = F.array("x_min", "y_min", F.col("x_max") - F.col("x_min") + 1, F.col("y_max") - F.col("y_min") + 1)
    return ranked.select("split", "id", "image_id", *EXAMPLE, F.col("class_id").alias("category_id"), box.alias("bbox"), "area", F.lit(0).alias("iscrowd"))


def export_coco(runs: DataFrame, path: str, **options) -> None:
    coco_annotations(runs, **options).write.mode("overwrite").partitionBy("split").json(path)


def csv_line(columns: Sequence[str]) -> Column:
    """A CSV line; a null is nothing, a text is quoted where it has to be."""
    def cell(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return F.when(text.rlike('[",\\n\\r]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return F.concat_ws(",", *[cell(c) for c in columns])


def publish_sorted_csv(df: DataFrame, folder: str, order: Sequence[str] = ("split", "source", "char_id"), single: str | None = None) -> None:
    """Header CSV in global sort order, published in one commit; ``single`` names one small file for all."""
    rows = df.orderBy(*order).select(csv_line(df.columns).alias("value"))
    parts.write(rows, folder, head=",".join(df.columns) + "\n", suffix=".csv", **({"single": single} if single else {}))


def publish_report(df: DataFrame, folder: str, name: str = "report.json") -> None:
    """An aggregated report as one JSON array, published in one commit."""
    parts.write(df.select(F.to_json(F.struct(*df.columns)).alias("value")), folder, head="[\n", separator=",\n", tail="\n]\n", suffix=".json", single=name)


def publish_by_key(df: DataFrame, key: str, folder: str, rows_per_file: int = 1_000_000) -> None:
    """JSON lines in one folder per key value, published in one commit; a large key is spread over several files and tasks."""
    rows = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("value"))
    parts.write(rows, folder, suffix=".json", rowsPerFile=str(rows_per_file))


def publish_coco(annotations: DataFrame, images: DataFrame, folder: str) -> None:
    """Detection documents per split, in parts that are documents themselves: ``images`` and ``annotations`` arrays, each published in one commit.

    ``annotations`` has the columns of :func:`coco_annotations`, ``images`` has split, id, file_name, width and height.
    """
    for name, table in (("images", images), ("annotations", annotations)):
        rows = table.select(F.col("split").alias("key"), F.to_json(F.struct(*[c for c in table.columns if c != "split"])).alias("value"))
        parts.write(rows, f"{folder}/{name}", head=f'{{"{name}": [\n', separator=",\n", tail="\n]}\n", suffix=".json")


def png_bytes(mask: np.ndarray) -> bytes:
    """An 8-bit grey PNG."""
    height, width = mask.shape
    rows = np.zeros((height, width + 1), np.uint8)
    rows[:, 1:] = mask
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def write_rasters(runs: DataFrame, folder: str, width: int, height: int) -> DataFrame:
    """One mask image per example, ``{dataset}/{example}.png``; returns the names with their sizes. A repeated task writes the same files again.

    Runs are sorted by example, so a task draws one image after the other and holds the runs of one batch.
    """

    def draw(y: np.ndarray, x0: np.ndarray, n: np.ndarray, class_id: np.ndarray) -> bytes:
        mask = np.zeros(height * width, np.uint8)
        mask[np.repeat(y * width + x0 - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] = np.repeat(class_id, n)
        return png_bytes(mask.reshape(height, width))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = locate(folder)
        made: set[str] = set()

        def save(table: pa.Table) -> pa.RecordBatch:
            names, sizes, starts = [], [], np.flatnonzero(new_key(table, EXAMPLE))
            cols = [table[c].to_numpy().astype(np.int64) for c in ("y", "x0", "len", "class_id")]
            for lo, hi in zip(starts, [*starts[1:], table.num_rows], strict=True):
                dataset = str(table["dataset"][lo].as_py())
                if dataset not in made:
                    store.create_dir(f"{path}/{dataset}", recursive=True)
                    made.add(dataset)
                names.append(f"{dataset}/{table['example_id'][lo].as_py()}.png")
                data = draw(*[c[lo:hi] for c in cols])
                with store.open_output_stream(f"{path}/{names[-1]}", compression=None) as f:
                    f.write(data)
                sizes.append(len(data))
            return pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "bytes": pa.array(sizes, pa.int64())})

        for table in whole_keys(batches, EXAMPLE):
            yield save(table)

    inside = runs.where((F.col("y") < height) & (F.col("x0") + F.col("len") <= width)).select("dataset", "example_id", "y", "x0", "len", "class_id")
    return cut(dealt(inside, "dataset", "example_id").sortWithinPartitions("example_id", "dataset").mapInArrow(write, "name string, bytes long"))
