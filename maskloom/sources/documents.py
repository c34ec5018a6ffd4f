"""Annotation documents (JSON, text) to exploded tables.

Every parser takes rows with a ``stem`` and a ``text`` column, one small document per row, so
the same code serves files and tables. Documents that do not parse are kept by
:func:`malformed`, never dropped silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims, schemas
from maskloom.functions.names import infer_source


def malformed(docs: DataFrame) -> DataFrame:
    """Documents that are not a JSON object or array."""
    return docs.where(F.try_parse_json("text").isNull()).select("stem", "text") if hasattr(F, "try_parse_json") else docs.where(
        F.schema_of_json("text").isNull()
    )


def rejected_documents(docs: DataFrame, schema: str) -> DataFrame:
    """Documents that a parser with this schema gets nothing from: ``not_json``, or ``wrong_shape`` if no field of the schema has a value."""
    read = F.from_json("text", schema)
    fields = docs.select(read.alias("_d")).schema["_d"].dataType
    nothing = read.isNull()
    if hasattr(fields, "fieldNames"):
        empty = F.lit(True)
        for name in fields.fieldNames():
            empty = empty & read[name].isNull()
        nothing = nothing | empty
    reason = F.when(F.try_parse_json("text").isNull(), "not_json").when(nothing, "wrong_shape")
    return docs.select("stem", reason.alias("reason")).where("reason IS NOT NULL")


def scan_sources(docs: DataFrame) -> DataFrame:
    """Character metadata: the id defaults to the file stem, an empty source is inferred."""
    good = docs.where(F.try_parse_json("text").isNotNull())
    d = good.select("stem", F.from_json("text", schemas.SOURCES).alias("_d")).where("_d IS NOT NULL").select("stem", "_d.*")
    char = F.coalesce("id", "stem")
    source = F.coalesce(F.nullif("source", F.lit("")), infer_source(char))
    return d.select(char.alias("char_id"), source.alias("source"), "name", "license", "unmapped_bones", "bone_mapping_overrides", "accessories")


def scan_joints(docs: DataFrame, resolution: int = dims.RESOLUTION) -> DataFrame:
    """Both joint layouts to one table with positions over the image size.

    Names outside the 20-bone list are dropped and ``hair_back`` is never visible.
    """
    bones = [*dims.CLASS_NAMES[1:20], "hair_back"]
    is_list = F.startswith(F.ltrim("text"), F.lit("["))
    listed = docs.where(is_list).select("stem", F.explode(F.from_json("text", schemas.JOINTS_LIST)).alias("_j")).select(
        "stem", F.col("_j.name").alias("joint"), (F.coalesce("_j.x", F.lit(0.0)) / resolution).alias("x"), (F.coalesce("_j.y", F.lit(0.0)) / resolution).alias("y"),
        F.lit(None).cast("double").alias("confidence"), F.coalesce("_j.visible", F.lit(True)).alias("visible"),
    )
    d = docs.where(~is_list).select("stem", F.from_json("text", schemas.JOINTS_MAP).alias("_d"))
    size = lambda i: F.coalesce(F.get("_d.image_size", F.lit(i)), F.lit(float(resolution)))
    mapped = d.select("stem", size(0).alias("_w"), size(1).alias("_h"), F.explode("_d.joints").alias("joint", "_j")).select(
        "stem", "joint", (F.coalesce(F.get("_j.position", F.lit(0)), F.lit(0.0)) / F.col("_w")).alias("x"),
        (F.coalesce(F.get("_j.position", F.lit(1)), F.lit(0.0)) / F.col("_h")).alias("y"),
        F.col("_j.confidence").alias("confidence"), F.coalesce("_j.visible", F.lit(True)).alias("visible"),
    )
    both = listed.unionByName(mapped).where(F.col("joint").isin(bones))
    return both.withColumn("visible", F.col("visible") & (F.col("joint") != "hair_back"))


def scan_vertex_weights(docs: DataFrame) -> DataFrame:
    """Vertices x weights to rows; a vertex without weights keeps one row with a NULL bone."""
    d = docs.select("stem", F.posexplode(F.from_json("text", schemas.VERTICES)["vertices"]).alias("vertex", "_v"))
    d = d.select("stem", "vertex", F.get("_v.position", F.lit(0)).alias("x"), F.get("_v.position", F.lit(1)).alias("y"), "_v.weights")
    return d.select(F.col("stem").alias("example_id"), "vertex", "x", "y", F.explode_outer("weights").alias("bone", "w"))


def scan_clip_frames(docs: DataFrame, bones: Sequence[str] = tuple(dims.JOINT_NAMES)) -> DataFrame:
    """Clip documents to frame x bone rows; a missing bone or axis is 0; the root row has a position."""
    d = docs.select("stem", F.from_json("text", schemas.CLIP).alias("_d")).select(
        "stem", F.coalesce("_d.frame_rate", F.lit(30.0)).alias("frame_rate"), F.posexplode("_d.frames").alias("frame", "_f")
    )
    d = d.withColumn("bone", F.explode(F.array(*[F.lit(b) for b in bones]))).withColumn("_b", F.try_element_at("_f", F.col("bone")))
    at = lambda field, i: F.coalesce(F.get(F.col(f"_b.{field}"), F.lit(i)), F.lit(0.0))
    root = lambda i: F.when(F.col("bone") == "hips", at("position", i))
    return d.select(
        F.col("stem").alias("clip"), "frame", "bone", *[at("rotation", i).alias(c) for i, c in enumerate(("rx", "ry", "rz"))],
        *[root(i).alias(c) for i, c in enumerate(("px", "py", "pz"))], (1.0 / F.col("frame_rate")).alias("frame_time"),
    )


def scan_coco_instances(docs: DataFrame) -> DataFrame:
    """Annotations with their image."""
    d = docs.select("stem", F.from_json("text", schemas.COCO).alias("_d"))
    images = d.select("stem", F.explode("_d.images").alias("_i")).select("stem", F.col("_i.id").alias("image_id"), "_i.file_name", "_i.width", "_i.height")
    anns = d.select("stem", F.explode("_d.annotations").alias("_a")).select(
        "stem", "_a.image_id", F.col("_a.id").alias("annotation_id"), "_a.category_id", "_a.area", "_a.bbox", "_a.iscrowd"
    )
    return anns.join(images, ["stem", "image_id"])


def scan_depth_order(docs: DataFrame) -> DataFrame:
    """``"i < j"`` orders as (front, back) instance ids; malformed orders are dropped."""
    d = docs.select(F.explode(F.from_json("text", schemas.DEPTH_ORDER)["annotations"]).alias("_a"))
    d = d.select("_a.image_id", F.col("_a.instance_ids").alias("_ids"), F.explode("_a.depth").alias("_o"))
    part = lambda i: F.regexp_extract("_o.order", r"^\s*(-?\d+)\s*<\s*(-?\d+)\s*$", i).try_cast("int")
    d = d.select("image_id", "_ids", part(1).alias("_a"), part(2).alias("_b"))
    d = d.where((F.col("_a") < F.size("_ids")) & (F.col("_b") < F.size("_ids")))
    return d.select("image_id", F.get("_ids", F.col("_a")).alias("front_id"), F.get("_ids", F.col("_b")).alias("back_id"))


def _label_results(docs: DataFrame) -> DataFrame:
    d = docs.select("stem", F.explode(F.from_json("text", schemas.LABEL_TASKS)).alias("_t"))
    d = d.where(F.size("_t.annotations") > 0)
    last = F.element_at("_t.annotations", -1)
    return d.select("stem", F.col("_t.id").alias("task_id"), F.col("_t.width").alias("w"), F.col("_t.height").alias("h"), F.posexplode(last["result"]).alias("result", "_r"))


def scan_label_tool_keypoints(docs: DataFrame) -> DataFrame:
    """Keypoints of the last annotation: percent to clamped pixels, unknown labels dropped, the last one of a name wins."""
    r = _label_results(docs).where("_r.type = 'keypointlabels'").withColumn("label", F.get("_r.value.keypointlabels", F.lit(0)))
    px = lambda c, n: F.greatest(F.lit(0), F.least(F.bround(F.coalesce(F.col(f"_r.value.{c}"), F.lit(0.0)) / 100.0 * F.col(n), 0).cast("int"), F.col(n) - 1))
    r = r.where(F.col("label").isin(dims.CLASS_NAMES)).select("stem", "task_id", "label", "result", px("x", "w").alias("x"), px("y", "h").alias("y"))
    p = r.groupBy("stem", "task_id", "label").agg(F.max(F.struct("result", "x", "y")).alias("_p"))
    return p.select("stem", "task_id", "label", "_p.x", "_p.y")


def scan_label_tool_polygons(docs: DataFrame) -> DataFrame:
    """Polygon corners in pixels; background and unknown labels are dropped."""
    r = _label_results(docs).where("_r.type = 'polygonlabels'").withColumn("label", F.get("_r.value.polygonlabels", F.lit(0)))
    r = r.where(F.col("label").isin(dims.CLASS_NAMES[1:]))
    r = r.select("stem", "task_id", "result", "label", "w", "h", F.posexplode("_r.value.points").alias("corner", "_p"))
    at = lambda i, n: F.floor(F.get("_p", F.lit(i)) / 100.0 * F.col(n)).cast("int")
    return r.select("stem", "task_id", "result", "label", "corner", at(0, "w").alias("x"), at(1, "h").alias("y"))


# The line formats of training logs, tried in this order, with their metric names.
LOG_FORMATS = {
    "segmentation": (
        r"Epoch (\d+)/(\d+) .+ train_loss=([\d.]+), val_loss=([\d.]+), mIoU=([\d.]+), lr=([\d.e+-]+)",
        ["train_loss", "val_loss", "miou", "lr"],
    ),
    "joints": (
        r"Epoch (\d+)/(\d+) .+ train_loss=([\d.]+), val_loss=([\d.]+), mean_err=([\d.]+), pres_acc=([\d.]+), lr=([\d.e+-]+)",
        ["train_loss", "val_loss", "mean_err", "pres_acc", "lr"],
    ),
    "weights": (
        r"Epoch (\d+)/(\d+) .+ train_loss=([\d.]+), val_loss=([\d.]+), mae=([\d.]+), conf_acc=([\d.]+), lr=([\d.e+-]+)",
        ["train_loss", "val_loss", "mae", "conf_acc", "lr"],
    ),
    "inpainting": (
        r"Epoch (\d+)/(\d+) .+ lr=([\d.e+-]+) \| train/l1=([\d.]+) \| val/l1=([\d.]+) \| val/loss=([\d.]+)",
        ["lr", "train_l1", "val_l1", "val_loss"],
    ),
}


def parse_training_logs(lines: DataFrame) -> DataFrame:
    """Log lines ``(name, value)`` to typed metric rows; a file has the first format that occurs in it."""
    kind: Column = F.coalesce(*[F.when(F.rlike("value", F.lit(rx)), F.lit(i)) for i, (rx, _) in enumerate(LOG_FORMATS.values())])
    hit = lines.withColumn("_k", kind).where("_k IS NOT NULL")
    first = hit.groupBy("name").agg(F.min("_k").alias("_k"))
    hit = hit.join(first, ["name", "_k"])
    out = None
    for i, (name, (rx, metrics)) in enumerate(LOG_FORMATS.items()):
        got = lambda g, rx=rx: F.regexp_extract("value", rx, g)
        part = hit.where(F.col("_k") == i).select(
            "name", F.lit(name).alias("type"), got(1).cast("int").alias("epoch"), got(2).cast("int").alias("epochs"),
            *[got(j + 3).try_cast("double").alias(m) for j, m in enumerate(metrics)],
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def parse_labelmap(lines: DataFrame) -> DataFrame:
    """``name:r,g,b:...`` lines; comments and lines without a colour are skipped."""
    p = F.split(F.trim("value"), ":")
    rgb = F.split(F.get(p, F.lit(1)), ",")
    ok = ~F.startswith(F.trim("value"), F.lit("#")) & (F.size(p) >= 2) & (F.size(rgb) == 3)
    return lines.where(ok).select(F.trim(p[0]).alias("label"), *[F.trim(rgb[i]).try_cast("int").alias(c) for i, c in enumerate("rgb")])


def join_labelmap(labelmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Colours with their class, and the labels that name no class."""
    names = dims.classes(labelmap.sparkSession).select("class_id", F.col("class_name").alias("label"))
    known = labelmap.join(F.broadcast(names), "label")
    return known.select("r", "g", "b", "label", "class_id"), labelmap.join(F.broadcast(names), "label", "left_anti")
