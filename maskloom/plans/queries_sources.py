"""Queries over documents built from the tables, exports, and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom import dims, schemas
from maskloom.operators.masks import metrics_from_confusion
from maskloom.plans.catalog import query
from maskloom.plans.queries_masks import _CONF
from maskloom.plans.queries_quality import _COMP
from maskloom.sources import documents as D
from maskloom.sources import files
from maskloom.sources import sinks
from maskloom.streaming import intake

_SRC = """SELECT char_id AS stem, CASE WHEN mod(length(source), 2) = 0 THEN concat('{"id": "', char_id, '", "source": "', source, '", "unmapped_bones": ["a", "b"]}')
 WHEN unmapped THEN concat('{"source": "", "name": "x"}') ELSE concat('{"id": "', char_id, '", "source": "', source) END AS text FROM v_sources"""


@query("""SELECT char_id, CASE WHEN mod(length(source), 2) = 0 THEN source WHEN char_id LIKE 'custom%' THEN 'unknown' ELSE split_part(char_id, '_', 1) END AS source, CASE WHEN mod(length(source), 2) = 0 THEN 2 ELSE 0 END AS n_unmapped
FROM v_sources WHERE mod(length(source), 2) = 0 OR unmapped""")
def scan_sources(t):
    out = D.scan_sources(t.sql(_SRC))
    return out.select("char_id", "source", F.coalesce(F.size("unmapped_bones"), F.lit(0)).alias("n_unmapped"))


@query("SELECT char_id AS stem FROM v_sources WHERE mod(length(source), 2) <> 0 AND NOT unmapped")
def malformed_sources(t):
    return D.malformed(t.sql(_SRC)).select("stem")


@query("""SELECT example_id, joint, round(CASE WHEN mod(example_id, 2) = 0 THEN x / 64 ELSE x / 512 END, 6) AS x, round(CASE WHEN mod(example_id, 2) = 0 THEN y / 64 ELSE y / 512 END, 6) AS y, visible AND joint <> 'hair_back' AS visible
FROM (SELECT example_id, CASE WHEN class_id = 4 THEN 'hair_back' ELSE joint END AS joint, class_id, x, y, visible FROM v_joints) WHERE class_id <> 9""")
def scan_joints(t):
    j = t.v_joints.withColumn("joint", F.when(F.col("class_id") == 9, "tail").when(F.col("class_id") == 4, "hair_back").otherwise(F.col("joint")))
    even = j.where("example_id % 2 = 0").groupBy("example_id").agg(F.to_json(F.struct(
        F.map_from_entries(F.collect_list(F.struct("joint", F.struct(F.array("x", "y").alias("position"), "confidence", "visible")))).alias("joints"),
        F.array(F.lit(64), F.lit(64)).alias("image_size"),
    )).alias("text"))
    odd = j.where("example_id % 2 = 1").groupBy("example_id").agg(F.to_json(F.collect_list(F.struct(F.col("joint").alias("name"), "x", "y", "visible"))).alias("text"))
    docs = even.unionByName(odd).withColumnRenamed("example_id", "stem")
    return D.scan_joints(docs).select(F.col("stem").alias("example_id"), "joint", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "visible")


@query("SELECT example_id, vertex, x, y, bone, w FROM v_weights")
def scan_vertex_weights(t):
    """One document per vertex, written by the exporter and read back."""
    lines = sinks.weight_documents(t.v_weights)
    docs = lines.select(F.concat_ws("/", F.col("example_id").cast("string"), F.col("vertex").cast("string")).alias("stem"), F.concat(F.lit('{"vertices":['), "value", F.lit("]}")).alias("text"))
    out = D.scan_vertex_weights(docs)
    key = F.split("example_id", "/")
    return out.select(key[0].cast("long").alias("example_id"), key[1].cast("long").alias("vertex"), "x", "y", "bone", F.col("w").cast("long").alias("w"))


@query("""SELECT f.clip, f.frame, b.bone, coalesce(f2.rx, 0) AS rx, coalesce(f2.ry, 0) AS ry, coalesce(f2.rz, 0) AS rz, CASE WHEN b.bone = 'hips' THEN f.px END AS px
FROM v_root f CROSS JOIN (SELECT unnest(['hips', 'spine', 'chest', 'head']) AS bone) b LEFT JOIN v_frames f2 ON f2.clip = f.clip AND f2.frame = f.frame AND f2.bone = b.bone""")
def scan_clip_frames(t):
    """One document per frame, written by the exporter and read back."""
    lines = sinks.clip_documents(t.v_frames, t.v_root)
    body = F.from_json("value", "position array<double>, rotations map<string, array<double>>")
    lines = lines.withColumn("_b", body)
    bones = F.transform_values("_b.rotations", lambda k, v: F.struct(v.alias("rotation"), F.when(k == "hips", F.col("_b.position")).alias("position")))
    docs = lines.select(F.concat_ws("/", F.col("clip").cast("string"), F.col("frame").cast("string")).alias("stem"), F.to_json(F.struct(F.array(bones).alias("frames"))).alias("text"))
    out = D.scan_clip_frames(docs, ["hips", "spine", "chest", "head"])
    key = F.split("clip", "/")
    return out.select(key[0].cast("long").alias("clip"), key[1].cast("int").alias("frame"), "bone", "rx", "ry", "rz", "px")


_COCO = """SELECT CAST(mod(page_id, 7) AS STRING) AS stem, concat('{"images": [{"id": ', CAST(page_id AS STRING), ', "file_name": "', file, '", "width": 64, "height": 32}], "annotations": [{"id": ', CAST(page_id * 10 AS STRING), ', "image_id": ', CAST(page_id AS STRING),
 ', "category_id": 1, "area": ', CAST(size AS STRING), ', "bbox": [1, 2, 3, 4]}, {"id": ', CAST(page_id * 10 + 1 AS STRING), ', "image_id": ', CAST(page_id + CASE WHEN mod(page_id, 3) = 0 THEN 100000 ELSE 0 END AS STRING), ', "category_id": 2, "area": 5, "bbox": [0, 0, 1, 5]}]}') AS text FROM v_pages"""


@query("""SELECT page_id AS image_id, page_id * 10 AS annotation_id, 1 AS category_id, CAST(size AS DOUBLE) AS area, file AS file_name FROM v_pages
UNION ALL SELECT page_id, page_id * 10 + 1, 2, 5.0, file FROM v_pages WHERE mod(page_id, 3) <> 0""")
def scan_coco_instances(t):
    return D.scan_coco_instances(t.sql(_COCO)).select("image_id", "annotation_id", "category_id", "area", "file_name")


_ORD = """SELECT CAST(page_id AS STRING) AS stem, concat('{"annotations": [{"image_id": ', CAST(page_id AS STRING), ', "instance_ids": [', CAST(page_id * 3 AS STRING), ', ', CAST(page_id * 3 + 1 AS STRING), '], "depth": [{"order": "0 < 1"}, {"order": "',
 CASE mod(page_id, 4) WHEN 0 THEN '1<0' WHEN 1 THEN 'a < 1' WHEN 2 THEN '0 = 1' ELSE '0 < 7' END, '"}]}]}') AS text FROM v_pages"""


@query("SELECT page_id AS image_id, page_id * 3 AS front_id, page_id * 3 + 1 AS back_id FROM v_pages UNION ALL SELECT page_id, page_id * 3 + 1, page_id * 3 FROM v_pages WHERE mod(page_id, 4) = 0")
def scan_depth_order(t):
    return D.scan_depth_order(t.sql(_ORD))


_TASKS = """SELECT CAST(doc_id AS STRING) AS stem, concat('[{"id": ', CAST(doc_id AS STRING), ', "width": 200, "height": 100, "annotations": [{"result": []}, {"result": [{"type": "keypointlabels", "value": {"keypointlabels": ["head"], "x": 1, "y": 1}},
 {"type": "keypointlabels", "value": {"keypointlabels": ["head"], "x": ', CAST(mod(doc_id, 130) AS STRING), ', "y": 50.5}}, {"type": "keypointlabels", "value": {"keypointlabels": ["horn"], "x": 5, "y": 5}},
 {"type": "polygonlabels", "value": {"polygonlabels": ["', CASE WHEN mod(doc_id, 3) = 0 THEN 'background' ELSE 'chest' END, '"], "points": [[10.25, 20], [30, ', CAST(mod(doc_id, 90) AS STRING), '.5]]}}]}]}]') AS text FROM documents"""


@query("SELECT doc_id AS task_id, 'head' AS label, CAST(greatest(0, least(mod(doc_id, 130) * 2, 199)) AS INT) AS x, 50 AS y FROM documents")
def scan_label_keypoints(t):
    return D.scan_label_tool_keypoints(t.sql(_TASKS)).select("task_id", "label", "x", "y")


@query("""SELECT doc_id AS task_id, 'chest' AS label, 0 AS corner, 20 AS x, 20 AS y FROM documents WHERE mod(doc_id, 3) <> 0
UNION ALL SELECT doc_id, 'chest', 1, 60, CAST(floor(mod(doc_id, 90) + 5e-1) AS INT) FROM documents WHERE mod(doc_id, 3) <> 0""")
def scan_label_polygons(t):
    return D.scan_label_tool_polygons(t.sql(_TASKS)).select("task_id", "label", "corner", "x", "y")


_LOGS = """SELECT concat('log', CAST(mod(event_id, 8) AS STRING)) AS name, CASE mod(event_id, 4) WHEN 0 THEN concat('Epoch ', CAST(event_id AS STRING), '/50 (3s) train_loss=0.5, val_loss=', CAST(mod(event_id, 9) AS STRING), '.25, mIoU=0.61, lr=1.00e-04')
 WHEN 1 THEN concat('Epoch ', CAST(event_id AS STRING), '/50 (3s) train_loss=0.5, val_loss=0.75, mean_err=0.01, pres_acc=0.9, lr=1e-3') WHEN 2 THEN concat('Epoch ', CAST(event_id AS STRING), '/50 ok lr=1e-3 | train/l1=0.1 | val/l1=0.2 | val/loss=0.3') ELSE 'saved checkpoint' END AS value FROM events"""


@query("""SELECT concat('log', mod(event_id, 8)) AS name, CASE mod(event_id, 4) WHEN 0 THEN 'segmentation' WHEN 1 THEN 'joints' ELSE 'inpainting' END AS type, CAST(event_id AS INT) AS epoch, 50 AS epochs,
 CAST(CASE mod(event_id, 4) WHEN 0 THEN mod(event_id, 9) + 25e-2 WHEN 1 THEN 75e-2 ELSE 3e-1 END AS DOUBLE) AS val_loss, CAST(CASE WHEN mod(event_id, 4) = 0 THEN 61e-2 END AS DOUBLE) AS miou, CAST(CASE mod(event_id, 4) WHEN 0 THEN 1e-4 ELSE 1e-3 END AS DOUBLE) AS lr FROM events WHERE mod(event_id, 4) <> 3""")
def scan_training_logs(t):
    return D.parse_training_logs(t.sql(_LOGS)).select("name", "type", "epoch", "epochs", "val_loss", "miou", "lr")


_WIDE = "SELECT c_name AS STYLE_NAME, CAST(c_custkey AS STRING) AS BR_START, CASE WHEN mod(c_custkey, 3) = 0 THEN 'N/A' ELSE CAST(c_custkey + 50 AS STRING) END AS BR_STOP, 'N/A' AS FR_START, '9' AS FR_STOP, '4' AS ID_START, CAST(c_nationkey AS STRING) AS ID_STOP FROM customer"


@query("SELECT c_name AS style, 'BR' AS content, CAST(c_custkey AS INT) AS start, CAST(c_custkey + 50 AS INT) AS stop FROM customer WHERE mod(c_custkey, 3) <> 0 UNION ALL SELECT c_name, 'ID', 4, c_nationkey FROM customer")
def scan_wide_frame_cuts(t):
    return files.unpivot_frame_cuts(t.sql(_WIDE), ["BR", "FR", "ID", "SW"])


_LMAP = "SELECT CASE WHEN p_size = 3 THEN concat('# ', p_name) WHEN p_size < 22 THEN concat(c.class_name, ':', CAST(c.r AS STRING), ',', CAST(p_partkey AS STRING), ',7::') ELSE concat(p_name, ':1,2,3::') END AS value, p_partkey FROM part JOIN v_classes c ON c.class_id = CASE WHEN p_size < 22 THEN p_size ELSE 0 END"


@query("SELECT c.class_name AS label, c.r, CAST(p_partkey AS INT) AS g, 7 AS b, c.class_id FROM part JOIN v_classes c ON c.class_id = p_size WHERE p_size <> 3")
def join_labelmap(t):
    return D.join_labelmap(D.parse_labelmap(t.sql(_LMAP)))[0]


@query("SELECT p_name AS label, count(*) AS n FROM part WHERE p_size >= 22 GROUP BY 1")
def unknown_labels(t):
    return D.join_labelmap(D.parse_labelmap(t.sql(_LMAP)))[1].groupBy("label").agg(F.count(F.lit(1)).alias("n"))


_MOD = " + ".join(f"(('0x' || substr(md5('42:' || dataset || '/' || example_id), {1 + 8 * i}, 8))::BIGINT) % 1000 * {pow(2**32, 3 - i, 1000)}" for i in range(4))


@query(f"""WITH RECURSIVE {_COMP}, ct AS (SELECT dataset, example_id, class_id, root, sum(len) AS area, min(x0) AS a, min(y) AS b, max(x0 + len) AS c, max(y) + 1 AS d, ({_MOD}) % 1000 AS h FROM lr GROUP BY dataset, example_id, class_id, root HAVING sum(len) >= 4),
cs AS (SELECT *, CASE WHEN h < 800 THEN 'train' WHEN h < 900 THEN 'val' ELSE 'test' END AS split FROM ct)
SELECT split, row_number() OVER (PARTITION BY split ORDER BY dataset, example_id, class_id, root) AS id, dense_rank() OVER (PARTITION BY split ORDER BY dataset, example_id) AS image_id, dataset, example_id, class_id AS category_id,
 a || ',' || b || ',' || (c - a) || ',' || (d - b) AS bbox, CAST(area AS BIGINT) AS area, 0 AS iscrowd FROM cs""")
def export_coco(t):
    return sinks.coco_annotations(t.v_runs).withColumn("bbox", F.array_join("bbox", ","))


_MIXED = """SELECT CAST(doc_id AS STRING) AS stem, CASE mod(doc_id, 5) WHEN 0 THEN concat('{"id": "c', CAST(doc_id AS STRING), '", "source": "s"}') WHEN 1 THEN '{"id": '
  WHEN 2 THEN '[1, 2]' WHEN 3 THEN concat('{"other": ', CAST(n_chars AS STRING), '}') ELSE concat('{"name": "', source, '", "license": null}') END AS text FROM documents"""


@query(f"""WITH d AS ({_MIXED})
SELECT stem, CASE WHEN NOT json_valid(text) THEN 'not_json' ELSE 'wrong_shape' END AS reason FROM d WHERE NOT json_valid(text) OR (text NOT LIKE '%"id"%' AND text NOT LIKE '%"name"%')""")
def malformed_documents(t):
    """Side table of the document parsers: what they read nothing from."""
    return D.rejected_documents(t.sql(_MIXED), schemas.SOURCES)


# --- streams ---
@query("SELECT event_id, user_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE value > 20 OR event_type = 'signup')")
def incremental_intake(t):
    events = t.events.select("event_id", "user_id", "event_type", "value")
    return intake.pending(events, events.where("value > 20 OR event_type = 'signup'"), "event_id").drop("value")


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1")
def intake_stream(t):
    """Each key is taken in once, however often it arrives."""
    stream = intake.file_stream(t.spark, f"{t.sf_dir}/events*.parquet").select("user_id")
    out = intake.incremental_intake(stream, "user_id", intake.state_folder(t.spark, "intake"))
    return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query(_CONF + "SELECT class_id, class_name, gt_pixels, round(iou, 6) AS iou, round(accuracy, 6) AS accuracy FROM m")
def running_metrics(t):
    """Stream twin of the confusion metrics."""
    stream = intake.file_stream(t.spark, f"{t.sf_dir}/lineitem*.parquet").selectExpr(
        f"CAST(l_partkey % {dims.NUM_CLASSES} AS INT) AS gt",
        f"CAST((l_partkey + CASE WHEN l_linenumber <= 2 THEN l_suppkey % 3 ELSE 0 END) % {dims.NUM_CLASSES} AS INT) AS pred", "CAST(l_quantity AS BIGINT) AS w",
    )
    state = intake.running_confusion(stream, intake.state_folder(t.spark, "metrics"))
    return metrics_from_confusion(state).drop("correct").withColumns({c: F.round(c, 6) for c in ("iou", "accuracy")})


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS grp FROM d),
r AS (SELECT user_id, count(*) AS len, max(day) AS last FROM g GROUP BY user_id, grp)
SELECT user_id, CAST(arg_max(len, last) AS INT) AS current_streak, CAST(max(len) AS INT) AS longest_streak, CAST(max(last) AS DATE) AS last_active FROM r GROUP BY 1""")
def streak_state(t):
    stream = intake.file_stream(t.spark, f"{t.sf_dir}/events*.parquet")
    out = intake.streak_state(stream, intake.state_folder(t.spark, "streaks"), "user_id", "ts")
    return out.withColumns({c: F.col(c).cast("int") for c in ("current_streak", "longest_streak")})
