"""Queries over masks: class balance, geometry, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom.operators import masks as M
from maskloom.plans.catalog import query

_TOTALS = """
WITH t AS (SELECT c.class_id, c.class_name, CAST(coalesce(sum(v.len), 0) AS BIGINT) AS pixels
           FROM v_classes c LEFT JOIN v_cells v ON v.class_id = c.class_id GROUP BY ALL)
"""


@query(_TOTALS + """
, f AS (SELECT *, pixels / (SELECT sum(pixels) FROM t) AS freq,
        CASE WHEN class_id > 0 THEN round_even(pixels / (SELECT sum(pixels) FROM t WHERE class_id > 0), 4) END AS share FROM t)
SELECT class_id, class_name, pixels, share,
  CASE WHEN share = 0 THEN 'missing' WHEN share < 0.01 THEN 'under_represented' ELSE 'ok' END AS gap,
  round(CASE WHEN freq > 0 THEN (SELECT quantile_cont(freq, 0.5) FROM f WHERE freq > 0) / freq ELSE 0 END, 6) AS weight FROM f""")
def class_balance_report(t):
    return M.class_balance_report(M.remap_labels(t.v_cells)).withColumn("weight", F.round("weight", 6))


@query(_TOTALS + """
SELECT class_id, class_name, round_even(pixels / (SELECT sum(pixels) FROM t WHERE class_id > 0), 4) AS share FROM t WHERE class_id > 0""")
def class_distribution(t):
    return M.class_distribution(t.v_cells)


@query("""
WITH t AS (SELECT c.class_id, c.class_name, count(v.x) AS pixels
  FROM v_classes c LEFT JOIN v_grid v ON v.class_id = c.class_id GROUP BY ALL),
s AS (SELECT class_id, class_name, round_even(pixels / (SELECT sum(pixels) FROM t WHERE class_id > 0), 4) AS share FROM t WHERE class_id > 0)
SELECT *, CASE WHEN share = 0 THEN 'missing' ELSE 'under_represented' END AS gap FROM s WHERE share < 0.01""")
def coverage_gaps(t):
    cells = t.v_grid.withColumn("len", F.lit(1).cast("long"))  # grid masks have few classes
    return M.coverage_gaps(M.class_distribution(cells))


@query(_TOTALS + """
, f AS (SELECT *, pixels / (SELECT sum(pixels) FROM t) AS freq FROM t)
SELECT class_id, class_name, round(freq, 6) AS freq,
 round(CASE WHEN freq > 0 THEN (SELECT quantile_cont(freq, 0.5) FROM f WHERE freq > 0) / freq ELSE 0 END, 6) AS weight FROM f""")
def median_frequency_weights(t):
    return M.median_frequency_weights(t.v_cells).withColumns({c: F.round(c, 6) for c in ("freq", "weight")})


@query("""
SELECT CASE WHEN class_id >= 20 THEN NULL WHEN class_id = 5 THEN 0 ELSE class_id END AS class_id,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(len) AS BIGINT) AS pixels FROM v_cells GROUP BY 1""")
def remap_labels(t):
    out = M.remap_labels(t.v_cells, {5: 0}, limit=20)
    return out.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"), F.sum("len").cast("long").alias("pixels"))


_GEO = """
WITH s AS (SELECT dataset, example_id, class_id, CAST(sum(len) AS BIGINT) AS pixel_count, min(x0) AS x_min, min(y) AS y_min,
    max(x0 + len - 1) AS x_max, max(y) AS y_max, sum(len * (2 * x0 + len - 1) / 2.0) / sum(len) AS cx, sum(y * len) / sum(len) AS cy
  FROM v_runs WHERE class_id > 0 GROUP BY ALL),
f AS (SELECT e.dataset, e.example_id, c.class_id, c.class_name, s.* EXCLUDE (dataset, example_id, class_id)
  FROM (SELECT DISTINCT dataset, example_id FROM s) e CROSS JOIN v_classes c
  LEFT JOIN s ON s.dataset = e.dataset AND s.example_id = e.example_id AND s.class_id = c.class_id WHERE c.class_id > 0)
"""


@query(_GEO + """
SELECT dataset, example_id, class_id, class_name AS region, CAST(coalesce(x_max - x_min + 1, 0) AS INT) AS apparent_width,
  CAST(coalesce(y_max - y_min + 1, 0) AS INT) AS apparent_height, x_min, y_min, CAST(x_max AS INT) AS x_max, y_max,
  coalesce(pixel_count, 0) AS pixel_count, pixel_count IS NOT NULL AS visible FROM f""")
def region_geometry_2d(t):
    return M.region_geometry_2d(t.v_runs)


@query(_GEO + """
SELECT dataset, example_id, class_name AS joint, CAST(coalesce(trunc(cx), -1) AS INT) AS x, CAST(coalesce(trunc(cy), -1) AS INT) AS y,
  CAST(CASE WHEN pixel_count IS NULL THEN 0 ELSE 0.8 END AS DOUBLE) AS confidence, pixel_count IS NOT NULL AS visible FROM f WHERE class_id <= 19""")
def region_centroid_joints(t):
    return M.region_centroid_joints(t.v_runs)


@query("""
WITH p AS (SELECT dataset, example_id, class_id, sum(len) AS n FROM v_cells WHERE class_id > 0 GROUP BY ALL),
f AS (SELECT *, n / sum(n) OVER (PARTITION BY dataset, example_id) AS frac FROM p)
SELECT f.class_id, class_name, count(*) AS examples,
 round_even(count(*) / (SELECT count(*) FROM (SELECT DISTINCT dataset, example_id FROM p)), 4) AS presence_rate,
 round_even(avg(frac), 5) AS mean, round_even(stddev_pop(frac), 5) AS std, round_even(quantile_cont(frac, 0.5), 5) AS median,
 round_even(quantile_cont(frac, 0.1), 5) AS p10, round_even(quantile_cont(frac, 0.9), 5) AS p90
FROM f JOIN v_classes c ON c.class_id = f.class_id GROUP BY ALL""")
def class_size_reference(t):
    return M.class_size_reference(t.v_cells)


@query("""SELECT dataset, example_id, class_id, round(avg(z), 6) AS mean_depth, count(*) AS n FROM v_cells GROUP BY ALL""")
def region_mean_depth(t):
    return M.region_mean_depth(t.v_cells).withColumn("mean_depth", F.round("mean_depth", 6))


_CONF = """
WITH r AS (SELECT gt AS class_id, sum(w) AS rs, sum(CASE WHEN gt = pred THEN w ELSE 0 END) AS hit FROM v_pred GROUP BY 1),
k AS (SELECT pred AS class_id, sum(w) AS cs FROM v_pred GROUP BY 1),
m AS (SELECT c.class_id, c.class_name, CAST(coalesce(rs, 0) AS BIGINT) AS gt_pixels, coalesce(hit, 0) AS hit,
   coalesce(coalesce(hit, 0) / nullif(coalesce(rs, 0) + coalesce(cs, 0) - coalesce(hit, 0), 0), 0) AS iou,
   coalesce(hit / nullif(rs, 0), 0) AS accuracy
 FROM v_classes c LEFT JOIN r ON r.class_id = c.class_id LEFT JOIN k ON k.class_id = c.class_id WHERE rs IS NOT NULL OR cs IS NOT NULL)
"""


@query(_CONF + "SELECT class_id, class_name, gt_pixels, round(iou, 6) AS iou, round(accuracy, 6) AS accuracy FROM m")
def confusion_metrics(t):
    return M.confusion_metrics(t.v_pred).withColumns({c: F.round(c, 6) for c in ("iou", "accuracy")})


@query(_CONF + """SELECT round(avg(CASE WHEN gt_pixels > 0 THEN iou END), 6) AS miou,
 round(sum(hit) / sum(gt_pixels), 6) AS pixel_accuracy FROM m""")
def segmentation_summary(t):
    return M.segmentation_summary(t.v_pred).withColumns({c: F.round(c, 6) for c in ("miou", "pixel_accuracy")})


_JOINT = """
WITH j AS (SELECT gt AS joint, pow(p - w / 100.0, 2) + pow(q - 0.05, 2) AS err, l_linenumber <= 4 AS visible, mod(l_suppkey, 2) = 0 AS present FROM v_pred),
g AS (SELECT joint, coalesce(avg(CASE WHEN visible THEN err END), 0) AS mse, CAST(sum(CAST(visible AS INT)) AS BIGINT) AS n_visible,
  CAST(sum(CASE WHEN visible = present THEN 1 ELSE 0 END) AS BIGINT) AS presence_correct, count(*) AS n FROM j GROUP BY 1)
"""


def _joint_rows(t):
    return t.v_pred.selectExpr(
        "gt AS joint", "p AS pred_x", "q AS pred_y", "w / 100 AS gt_x", "0.05D AS gt_y",
        "l_linenumber <= 4 AS visible", "l_suppkey % 2 = 0 AS pred_present",
    )


@query(_JOINT + "SELECT joint, round(mse, 6) AS mse, n_visible, presence_correct, n FROM g")
def joint_metrics(t):
    return M.joint_metrics(_joint_rows(t)).withColumn("mse", F.round("mse", 6))


@query(_JOINT + """SELECT round(avg(CASE WHEN n_visible > 0 THEN mse END), 6) AS mean_offset_error,
 round(sum(presence_correct) / sum(n), 6) AS presence_accuracy FROM g""")
def joint_summary(t):
    out = M.joint_summary(M.joint_metrics(_joint_rows(t)))
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


_WEIGHT = """
WITH r AS (SELECT gt AS bone, abs(p - q) AS err, mod(l_orderkey, 3) <> 0 AS has_gt, l_linenumber < 6 AS conf FROM v_pred),
g AS (SELECT bone, avg(CASE WHEN has_gt THEN err END) AS mae, sum(CASE WHEN has_gt THEN err ELSE 0 END) AS abs_error,
 CAST(sum(CAST(has_gt AS INT)) AS BIGINT) AS n_gt, CAST(sum(CASE WHEN has_gt = conf THEN 1 ELSE 0 END) AS BIGINT) AS confidence_correct, count(*) AS n FROM r GROUP BY 1)
"""


def _weight_rows(t):
    return t.v_pred.selectExpr(
        "gt AS bone", "p AS pred_w", "q AS gt_w", "l_orderkey % 3 <> 0 AS has_gt", "l_linenumber < 6 AS pred_confident"
    )


@query(_WEIGHT + "SELECT bone, round(mae, 6) AS mae, round(abs_error, 6) AS abs_error, n_gt, confidence_correct, n FROM g")
def weight_metrics(t):
    return M.weight_metrics(_weight_rows(t)).withColumns({c: F.round(c, 6) for c in ("mae", "abs_error")})


@query(_WEIGHT + """SELECT round(sum(abs_error) / sum(n_gt), 6) AS mae, round(sum(confidence_correct) / sum(n), 6) AS confidence_accuracy FROM g""")
def weight_summary(t):
    out = M.weight_summary(M.weight_metrics(_weight_rows(t)))
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


@query("""SELECT r.dataset, r.example_id, r.y, r.len, 64 - r.x0 - r.len AS x0, c.pair_id AS class_id
FROM v_runs r JOIN v_classes c ON c.class_id = r.class_id""")
def mirror_mask(t):
    return M.mirror_mask(t.v_runs, 64)


@query("""
WITH px AS (SELECT example_id, len, c.r, c.g, CASE WHEN v.len > 45 THEN c.b + 1 ELSE c.b END AS b FROM v_cells v JOIN v_classes c ON c.class_id = v.class_id)
SELECT px.example_id, coalesce(c.class_id, 0) AS class_id, CAST(sum(px.len) AS BIGINT) AS pixels
FROM px LEFT JOIN v_classes c ON c.r = px.r AND c.g = px.g AND c.b = px.b GROUP BY ALL""")
def colour_to_class(t):
    px = t.sql("SELECT example_id, len, c.r, c.g, CASE WHEN v.len > 45 THEN c.b + 1 ELSE c.b END AS b FROM v_cells v JOIN v_classes c ON c.class_id = v.class_id")
    return M.colour_to_class(px).groupBy("example_id", "class_id").agg(F.sum("len").cast("long").alias("pixels"))
