"""The given tables, and the annotation relations derived from them.

No mask data is supplied, so each annotation relation is derived from a given table by a
short SQL text that Spark and the check engine both run. All of them grow with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.ranking import rank_in_buckets

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_STYLES = ",".join(dims.STYLES)

#: angle names of the stand-in views, written out so that the check SQL does not depend on ``dims``; the last is no known angle
VIEW_ANGLES = (
    "front,front_22,three_quarter,three_quarter_67,side,side_112,three_quarter_back,three_quarter_back_157,back,three_quarter_back_left,side_left,"
    "three_quarter_left,front_high,three_quarter_high,side_high,back_high,front_low,three_quarter_low,side_low,iso_front,iso_front_right,iso_right,"
    "iso_back_right,iso_back,iso_back_left,iso_left,iso_front_left,topdown_front,topdown_right,topdown_back,topdown_left,worms_eye"
)

VIEW_SQL: dict[str, str] = {
    "v_classes": dims.classes_values_sql(),
    # mask regions: class id 0 is background, `len` is a pixel count
    "v_cells": """
        SELECT concat('ds', CAST(mod(CAST(floor(l_orderkey / 4) AS BIGINT), 5) AS STRING)) AS dataset,
               CAST(floor(l_orderkey / 4) AS BIGINT) AS example_id,
               CAST(mod(l_partkey, 22) AS INT) AS class_id,
               CAST(l_quantity AS BIGINT) AS len,
               CAST(l_suppkey AS INT) AS y, CAST(mod(l_partkey, 512) AS INT) AS x0,
               CAST(round(l_discount * 100) AS INT) AS z, CAST(round(l_tax * 1000) AS INT) AS conf,
               l_orderkey, l_linenumber
        FROM lineitem""",
    # run-length rows of 64 x 64 masks; blocks of 8 keep the runs disjoint
    "v_runs": """
        SELECT concat('ds', CAST(mod(example_id, 4) AS STRING)) AS dataset, example_id, y, x0, len,
               CAST(1 + mod(3 * line + CAST(floor(y / 22) AS INT), 21) AS INT) AS class_id
        FROM (SELECT CAST(floor(l_orderkey / 32) AS BIGINT) AS example_id,
                     CAST(mod(l_suppkey, 64) AS INT) AS y, CAST(8 * mod(l_partkey, 8) AS INT) AS x0,
                     CAST(1 + mod(max(CAST(l_quantity AS BIGINT)), 8) AS INT) AS len,
                     max(l_linenumber) AS line
              FROM lineitem GROUP BY 1, 2, 3) AS g""",
    # silhouette (alpha) runs of the same masks
    "v_alpha": """
        SELECT CAST(floor(l_orderkey / 32) AS BIGINT) AS example_id, CAST(mod(l_suppkey, 64) AS INT) AS y,
               CAST(16 * mod(l_partkey, 4) AS INT) AS x0, CAST(4 + mod(max(l_partkey), 12) AS INT) AS len
        FROM lineitem GROUP BY 1, 2, 3""",
    "v_joints": """
        SELECT j.example_id, j.class_id, c.class_name AS joint, j.x, j.y, j.visible, j.confidence, 64 AS img_w, 64 AS img_h
        FROM (SELECT CAST(floor(l_orderkey / 32) AS BIGINT) AS example_id, CAST(1 + mod(l_partkey, 19) AS INT) AS class_id,
                     CAST(mod(min(l_partkey), 66) - 1 AS INT) AS x, CAST(mod(min(l_suppkey), 66) - 1 AS INT) AS y,
                     min(l_linestatus) = 'F' AS visible, max(l_discount) * 10 AS confidence
              FROM lineitem GROUP BY 1, 2) AS j
        JOIN v_classes AS c ON c.class_id = j.class_id""",
    "v_grid": """
        SELECT CAST(floor(l_orderkey / 256) AS BIGINT) AS example_id, CAST(mod(l_partkey, 32) AS INT) AS x,
               CAST(mod(l_suppkey, 32) AS INT) AS y, CAST(max(l_linenumber) AS INT) AS class_id
        FROM lineitem GROUP BY 1, 2, 3""",
    "v_pred": """
        SELECT CAST(floor(l_orderkey / 4) AS BIGINT) AS example_id, CAST(mod(l_partkey, 22) AS INT) AS gt,
               CAST(mod(l_partkey + CASE WHEN l_linenumber <= 2 THEN mod(l_suppkey, 3) ELSE 0 END, 22) AS INT) AS pred,
               CAST(l_quantity AS BIGINT) AS w, l_discount AS p, l_tax AS q, l_orderkey, l_linenumber, l_suppkey
        FROM lineitem""",
    "v_weights": """
        SELECT CAST(floor(l_orderkey / 32) AS BIGINT) AS example_id, l_orderkey AS vertex,
               CAST(mod(l_orderkey * 7, 61) AS INT) AS x, CAST(mod(l_orderkey * 5, 53) AS INT) AS y,
               concat('bone_', CAST(mod(l_partkey, 26) AS STRING)) AS bone,
               CAST(mod(l_partkey, 26) AS INT) AS bone_order, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS w
        FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6""",
    "v_root": """
        SELECT user_id AS clip, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS frame,
               value AS px, CAST(mod(event_id, 10) AS DOUBLE) AS py, CAST(0 AS DOUBLE) AS pz,
               1.0 / 30 AS frame_time, event_id, event_type
        FROM events""",
    "v_frames": """
        SELECT r.clip, r.frame, b.bone, b.k,
               CAST(CASE WHEN b.k = 2 AND mod(r.clip, 3) = 0 THEN mod(CAST(round(r.px * 100) AS BIGINT), 7) - 3 ELSE mod(r.clip, 4) END AS DOUBLE) AS rx,
               CAST(CASE WHEN mod(r.frame + b.k * 2 + r.clip, 10) < 4 THEN -3 * mod(r.frame + b.k * 2 + r.clip, 10)
                    ELSE 2 * mod(r.frame + b.k * 2 + r.clip, 10) - 20 END AS DOUBLE) AS ry,
               CAST(CASE WHEN mod(r.clip, 5) = 4 THEN mod(r.event_id * (b.k + 2), 11) ELSE floor(r.frame / 9) END AS DOUBLE) AS rz
        FROM v_root AS r
        CROSS JOIN (SELECT * FROM (VALUES ('hips', 0), ('spine', 1), ('chest', 2)) AS t(bone, k)) AS b""",
    "v_clip_labels": """
        SELECT user_id AS clip, min(event_type) AS action, CASE WHEN mod(user_id, 3) = 0 THEN 'good' ELSE 'ok' END AS quality
        FROM events GROUP BY user_id
        UNION ALL SELECT c_custkey + 1000000000 AS clip, 'absent' AS action, 'ok' AS quality FROM customer WHERE c_nationkey = 7""",
    "v_assets": f"""
        SELECT doc_id, lang, n_chars AS size, source AS batch, n, pose, angle, style, prefix,
               concat(prefix, '_', digits) AS char_id,
               concat(prefix, '_', digits, '_pose_0', CAST(pose AS STRING)) AS pose_key,
               concat(prefix, '_', digits, '_pose_0', CAST(pose AS STRING), tail) AS view_key,
               concat(prefix, '_', digits, '_pose_0', CAST(pose AS STRING), tail, '_', style) AS stem,
               concat('/data/', prefix, '/images/', prefix, '_', digits, '_pose_0', CAST(pose AS STRING), tail, '_', style,
                      CASE WHEN mod(doc_id, 17) = 3 THEN '.jpg' ELSE '.png' END) AS path,
               CASE WHEN mod(doc_id, 13) = 5 THEN 256 ELSE 512 END AS width,
               CASE WHEN mod(doc_id, 26) = 5 THEN 512 ELSE 512 - mod(doc_id, 2) * CASE WHEN mod(doc_id, 13) = 5 THEN 256 ELSE 0 END END AS height,
               mod(n * 8 + pose * 4 + ai, 9) <> 0 AS has_mask, mod(n + pose, 5) <> 0 AS has_joints,
               mod(n, 6) <> 0 AS has_source
        FROM (SELECT doc_id, lang, n_chars, source, n, pose, ai, angle,
                     CASE WHEN ai = 0 AND angle = 'front' THEN '' ELSE concat('_', angle) END AS tail,
                     split_part('{_STYLES}', ',', CAST(1 + mod(doc_id + n * 3, 10) AS INT)) AS style,
                     split_part('mixamo,quaternius,kenney,sketchfab,custom', ',', CAST(1 + mod(n, 5) AS INT)) AS prefix,
                     lpad(CAST(n AS STRING), 9, '0') AS digits
              FROM (SELECT *, CASE WHEN mod(n, 4) = 3 THEN split_part('{VIEW_ANGLES}', ',', CAST(1 + mod(floor(n / 4) * 4 + ai, 32) AS INT))
                                   ELSE split_part('front,three_quarter,side,back', ',', CAST(ai + 1 AS INT)) END AS angle
                    FROM (SELECT doc_id, lang, n_chars, source, CAST(floor(doc_id / 24) AS BIGINT) AS n,
                                 CAST(floor(mod(doc_id, 24) / 12) AS BIGINT) AS pose,
                                 CAST(floor(mod(doc_id, 12) / 3) AS BIGINT) AS ai
                          FROM documents) AS a) AS c) AS b""",
    "v_masks": "SELECT DISTINCT view_key, char_id, prefix FROM v_assets WHERE has_mask",
    "v_joint_files": "SELECT DISTINCT pose_key, char_id FROM v_assets WHERE has_joints",
    "v_sources": """
        SELECT DISTINCT char_id, concat(prefix, '_pack') AS source, mod(n, 4) = 1 AS unmapped FROM v_assets WHERE has_source""",
    "v_docs": """
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id""",
    "v_pages": """
        SELECT page_id, url, clean, regexp_replace(clean, '/[^/]*$', '') AS directory,
               regexp_replace(clean, '^.*/', '') AS file, CAST(length(html) AS BIGINT) AS size
        FROM (SELECT page_id, url, html, regexp_replace(url, '[?#].*$', '') AS clean FROM pages) AS p""",
    "v_names": """
        SELECT p_partkey AS k, p_brand AS rig, p_size AS vertices, p_type AS kind,
               concat(CASE mod(p_partkey, 4) WHEN 0 THEN 'mixamorig:' WHEN 1 THEN 'Bip01_' WHEN 2 THEN 'DEF-' ELSE '' END,
                      CASE mod(p_partkey, 13) WHEN 0 THEN 'LeftForeArm' WHEN 1 THEN 'rightUpLeg' WHEN 2 THEN 'Spine1' WHEN 3 THEN 'hand.L'
                        WHEN 4 THEN 'thigh_r' WHEN 5 THEN 'HeadTop' WHEN 6 THEN 'neck 01' WHEN 7 THEN 'shoulderL' WHEN 8 THEN 'Hips'
                        WHEN 9 THEN 'foot-right' WHEN 10 THEN 'upper_arm.R' WHEN 11 THEN 'hair_back' ELSE p_name END,
                      CASE mod(p_partkey, 5) WHEN 0 THEN '.001' WHEN 1 THEN '_02' ELSE '' END) AS name
        FROM part""",
    "v_chars": """
        SELECT CAST(c_custkey AS STRING) AS char_id, lower(c_mktsegment) AS source, 1 AS source_rank, CAST(c_acctbal > 0 AS BOOLEAN) AS has_files,
               CASE WHEN mod(c_custkey, 29) = 4 THEN 256 ELSE 512 END AS width FROM customer
        UNION ALL
        SELECT CAST(s_suppkey AS STRING), 'supplier', 2, s_acctbal > 0, 512 FROM supplier
        UNION ALL
        SELECT CAST(c_custkey AS STRING), lower(c_mktsegment), 3, TRUE, 512 FROM customer WHERE c_nationkey < 5""",
    "v_users": "SELECT s_suppkey AS user_id, s_name AS name FROM supplier",
    "v_images": """
        SELECT p_partkey AS image_id, p_brand AS dataset, concat(p_type, '/', CAST(p_partkey AS STRING), '.png') AS filename,
               p_size AS priority, CASE mod(p_size, 3) WHEN 0 THEN 'pending' WHEN 1 THEN 'annotated' ELSE 'approved' END AS status
        FROM part""",
    "v_annotations": """
        SELECT l_orderkey * 8 + l_linenumber AS annotation_id, min(l_partkey) AS image_id, min(l_suppkey) AS user_id,
               CAST(max(l_quantity) AS BIGINT) AS seconds, min(l_shipdate) AS created_at, min(l_returnflag) AS flag
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "v_reviews": """
        SELECT annotation_id * 2 AS review_id, annotation_id, CASE WHEN flag = 'A' THEN 'approved' ELSE 'rejected' END AS status, created_at AS reviewed_at
        FROM v_annotations WHERE flag IN ('A', 'R')
        UNION ALL
        SELECT annotation_id * 2 + 1, annotation_id, 'rejected', created_at FROM v_annotations WHERE flag = 'A' AND seconds > 40""",
    "v_tree": """
        SELECT CAST(floor(p_partkey / 64) AS BIGINT) AS rig_id, CAST(mod(p_partkey, 64) AS INT) AS bone,
               CASE WHEN mod(p_partkey, 64) > 1 THEN CAST(floor(mod(p_partkey, 64) / 2) AS INT) END AS parent,
               CAST(p_size AS DOUBLE) AS x, CAST(mod(p_size, 7) AS DOUBLE) AS y,
               CAST(mod(p_size, 8) * 15 AS DOUBLE) AS rotation, 1 + mod(p_size, 3) * 125e-3 AS sx, 1 - mod(p_size, 5) * 625e-4 AS sy
        FROM part""",
    "v_vectors": "SELECT vec_id, label, "
    + ", ".join(
        f"CASE WHEN mod(vec_id, 11) = {i} THEN NULL ELSE CAST(list_extract(embedding, {i + 1}) AS DOUBLE) END AS f{i}"
        for i in range(9)
    )
    + " FROM embeddings",
}


class Tables:
    """Given tables and derived relations as attributes, e.g. ``t.lineitem`` or ``t.v_runs``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "v_root":
            return self._root()
        if name == "v_frames":
            return self._frames()
        if name == "v_classes":
            return dims.classes(self.spark)
        if name in VIEW_SQL:
            return self._derive(VIEW_SQL[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        return self._derive(text)

    def _derive(self, text: str) -> DataFrame:
        text = text.replace("{", "{{").replace("}", "}}")
        names = [n for n in [*GIVEN, *VIEW_SQL] if re.search(rf"(?i)\b(from|join)\s+{n}\b", text)]
        for n in names:
            text = re.sub(rf"(?i)\b(from|join)\s+{n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text.replace("list_extract(", "element_at("), **{n: getattr(self, n) for n in names})

    def _root(self) -> DataFrame:
        """Frame numbers per clip, one day of events at a time."""
        ranked = rank_in_buckets(
            self.events, [F.col("ts"), F.col("event_id")], F.to_date("ts"), ["user_id"], rank="_rank"
        )
        return ranked.select(
            F.col("user_id").alias("clip"), (F.col("_rank") - 1).cast("int").alias("frame"),
            F.col("value").alias("px"), (F.col("event_id") % 10).cast("double").alias("py"), F.lit(0.0).alias("pz"),
            F.lit(1.0 / 30).alias("frame_time"), "event_id", "event_type",
        )

    def _frames(self) -> DataFrame:
        """The frame relation with the three bones unfolded beside each root row."""
        text = VIEW_SQL["v_frames"]
        body = text[: text.index("FROM v_root")]
        bones = F.array(*[F.struct(F.lit(b).alias("bone"), F.lit(k).alias("k")) for b, k in (("hips", 0), ("spine", 1), ("chest", 2))])
        rows = self.v_root.withColumn("b", F.explode(bones))
        return self.spark.sql(body + "FROM {rows} AS r", rows=rows)
