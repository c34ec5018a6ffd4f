"""Queries that write through the committed sinks and read back what was published."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from maskloom import schemas
from maskloom.plans import queries_sources as Q
from maskloom.plans.catalog import QUERIES, query
from maskloom.session import cut, ensure_checkpoint_dir
from maskloom.sources import documents as D
from maskloom.sources import files, json_array, parts, sinks

#: bytes of a chunk in these queries, so that each file is read by several tasks
SMALL_CHUNK = 32 << 10


def _folder(t, name: str) -> str:
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


_IMAGE = "id long, file_name string, width int, height int"
_ANNOTATION = "id long, image_id long, category_id int, area double, iscrowd int"


@query(QUERIES["export_coco"].sql)
def coco_published(t):
    """Detection documents of all splits, written in parts and read back in chunks."""
    folder = _folder(t, "coco")
    found = cut(sinks.coco_annotations(t.v_runs))  # read for images and for annotations
    images = found.select("split", F.col("image_id").alias("id"), F.concat_ws("/", "dataset", F.col("example_id").cast("string")).alias("file_name")).distinct()
    sinks.publish_coco(found, images.withColumns({"width": F.lit(64), "height": F.lit(64)}), folder)
    rows = json_array.read_arrays(t.spark, parts.published(f"{folder}/annotations"), "annotations", SMALL_CHUNK)
    split = F.regexp_extract("file", "key=([^/]+)/", 1)
    out = json_array.parsed(rows, f"{_ANNOTATION}, bbox array<int>, dataset string, example_id long").select(split.alias("split"), "id", "image_id", "dataset", "example_id", "category_id", F.array_join("bbox", ",").alias("bbox"), F.col("area").cast("long").alias("area"), "iscrowd")
    names = json_array.parsed(json_array.read_arrays(t.spark, parts.published(f"{folder}/images"), "images", SMALL_CHUNK), _IMAGE)
    named = names.select(split.alias("split"), F.col("id").alias("image_id"), "file_name")
    whole = out.join(named, ["split", "image_id"]).where(F.col("file_name") == F.concat_ws("/", "dataset", F.col("example_id").cast("string")))
    return whole.drop("file_name")


@query(QUERIES["scan_coco_instances"].sql)
def scan_coco_large(t):
    """Images and annotations of large documents, cut at the borders of their objects."""
    folder = _folder(t, "coco-in")
    docs = t.sql(Q._COCO).select("stem", F.from_json("text", schemas.COCO).alias("d"))
    for name in ("images", "annotations"):
        parts.write(docs.select(F.col("stem").alias("key"), F.explode(f"d.{name}").alias("x")).select("key", F.to_json("x").alias("value")), f"{folder}/{name}", head=f'{{"info": {{"note": "\\"]}}{{"}}, "{name}": [', separator=", ", tail="]}", suffix=".json")
    index = json_array.write_index(t.spark, [f for name in ("images", "annotations") for f in parts.published(f"{folder}/{name}")], SMALL_CHUNK)
    stem = F.regexp_extract("file", "key=([^/]+)/", 1).alias("stem")  # an image id holds within its document
    images = json_array.parsed(json_array.read_indexed(t.spark, index, "images", SMALL_CHUNK), _IMAGE).select(stem, F.col("id").alias("image_id"), "file_name")
    annotations = json_array.parsed(json_array.read_indexed(t.spark, index, "annotations", SMALL_CHUNK), _ANNOTATION).select(stem, "image_id", F.col("id").alias("annotation_id"), "category_id", "area")
    return annotations.join(images, ["stem", "image_id"]).drop("stem")


@query(QUERIES["scan_label_keypoints"].sql)
def scan_label_export_large(t):
    """Tasks of large label-tool exports, whose outer value is the array."""
    folder = _folder(t, "tasks")
    tasks = t.sql(Q._TASKS).select(F.regexp_extract("text", r"(?s)^\[(.*)\]$", 1).alias("value"))
    parts.write(tasks, folder, head="[", separator=",\n", tail="]", suffix=".json")
    rows = json_array.read_arrays(t.spark, parts.published(folder), "", SMALL_CHUNK)
    docs = rows.select(F.concat_ws("#", "file", F.col("at").cast("string")).alias("stem"), F.concat(F.lit("["), "value", F.lit("]")).alias("text"))
    return D.scan_label_tool_keypoints(docs).select("task_id", "label", "x", "y")


_LABELS = "SELECT c_name AS filename, concat('act', CAST(c_nationkey AS STRING)) AS action_type, concat('say \"', c_mktsegment, '\", twice') AS subcategory, CASE WHEN mod(c_custkey, 4) = 0 THEN 'good' ELSE 'bad' END AS quality, CASE WHEN mod(c_custkey, 3) = 0 THEN NULL ELSE 'yes' END AS compatible FROM customer"


@query(f"SELECT *, row_number() OVER (ORDER BY action_type, filename) AS place FROM ({_LABELS})")
def labels_csv(t):
    """A sorted label table as CSV, read back with its order."""
    folder = _folder(t, "labels")
    sinks.publish_sorted_csv(t.sql(_LABELS), folder, ["action_type", "filename"])
    lines = parts.read(t.spark, folder).where("nr > 0")  # the first line of a file is its header
    sizes = lines.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # one row per file
    before, total = {}, 0
    for r in sizes:
        before[r.part], total = total, total + r.n
    start = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map()
    placed = lines.select("value", (F.element_at(start, F.col("part")) + F.col("nr")).alias("place"))
    read = files.read_csv(t.spark, parts.published(folder))
    names = placed.select(F.split("value", ",")[0].alias("filename"), "place")
    return read.join(names, "filename")


@query("SELECT class_id, CAST(sum(len) AS BIGINT) AS pixels, count(DISTINCT example_id) AS examples FROM v_runs GROUP BY 1")
def report_published(t):
    """A report in one file."""
    folder = _folder(t, "report")
    sinks.publish_report(t.v_runs.groupBy("class_id").agg(F.sum("len").alias("pixels"), F.count_distinct("example_id").alias("examples")), folder)
    return t.spark.read.schema("class_id int, pixels long, examples long").json(f"{folder}/report.json", multiLine=True)


@query("SELECT dataset, example_id, class_id, count(*) AS n, CAST(sum(len) AS BIGINT) AS pixels FROM v_runs GROUP BY ALL")
def fan_out_published(t):
    """Run rows in one folder per dataset."""
    folder = _folder(t, "fan-out")
    sinks.publish_by_key(t.v_runs, "dataset", folder, rows_per_file=5000)
    rows = parts.read(t.spark, folder).select(F.col("key").alias("dataset"), F.from_json("value", "example_id long, y int, x0 int, len int, class_id int").alias("r")).select("dataset", "r.*")
    return rows.groupBy("dataset", "example_id", "class_id").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("pixels"))


@query("SELECT dataset, example_id, y, class_id, CAST(sum(len) AS BIGINT) AS pixels, CAST(sum(len * x0 + len * (len - 1) // 2) AS BIGINT) AS x_sum FROM v_runs GROUP BY ALL")
def raster_runs(t):
    """Masks as image files, read back as runs; runs that touch come back as one, so their pixels are compared."""
    folder = _folder(t, "rasters")
    names = sinks.write_rasters(t.v_runs, folder, 64, 64)
    runs = files.scan_rasters_to_runs(t.spark, folder, names=names)
    name = F.substring_index(F.substring_index("origin", "/", -2), "/", 1), F.substring_index(F.substring_index("origin", "/", -1), ".", 1)
    x = F.col("len") * F.col("x0") + F.floor(F.col("len") * (F.col("len") - 1) / 2)
    return runs.groupBy(name[0].alias("dataset"), name[1].cast("long").alias("example_id"), "y", F.col("value").alias("class_id")).agg(F.sum("len").alias("pixels"), F.sum(x).alias("x_sum"))
