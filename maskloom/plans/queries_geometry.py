"""Queries over joints, projections, measurements and run layers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions import geometry as G
from maskloom.operators import layers as L
from maskloom.operators import masks as M
from maskloom.operators import measurements as X
from maskloom.plans.catalog import query
from maskloom.plans.tables import VIEW_ANGLES
from maskloom.session import cut

_R6 = lambda df, *cols: df.withColumns({c: F.round(c, 6) for c in cols})


@query("""SELECT example_id, CASE WHEN joint LIKE '%\\_l' ESCAPE '\\' THEN regexp_replace(joint, '_l$', '_r') WHEN joint LIKE '%\\_r' ESCAPE '\\' THEN regexp_replace(joint, '_r$', '_l') ELSE joint END AS joint,
 63 - x AS x, y, visible FROM v_joints""")
def mirror_joints(t):
    return G.mirror_joints(t.v_joints.select("example_id", "joint", "x", "y", "visible"), 64)


_KP = """SELECT CAST(floor(l_orderkey / 32) AS BIGINT) AS example_id, CAST(mod(l_partkey, 17) AS INT) AS kp, CAST(mod(min(l_partkey) * 3, 530) AS DOUBLE) AS x,
 CAST(mod(min(l_suppkey) * 7, 530) AS DOUBLE) AS y, max(l_discount) * 9 AS conf FROM lineitem GROUP BY 1, 2"""


def _kp_sql():
    k = {p: f"max(CASE WHEN kp = {i} THEN {{}} END)" for p, i in G.KEYPOINTS.items()}
    cols = ", ".join(f"{k[p].format(c)} AS {p}_{c}" for p in k for c in ("x", "y", "conf"))
    rows = [(j, f"{p}_x", f"{p}_y", f"{p}_conf") for j, p in G.DIRECT.items()]
    sh = {c: f"(shoulder_l_{c} + shoulder_r_{c}) / 2" for c in "xy"}
    hp = {c: f"(hip_l_{c} + hip_r_{c}) / 2" for c in "xy"}
    torso = "least(shoulder_l_conf, shoulder_r_conf, hip_l_conf, hip_r_conf) * 8e-1"
    rows += [
        ("hips", hp["x"], hp["y"], "least(hip_l_conf, hip_r_conf)"),
        ("neck", f"(nose_x + {sh['x']}) / 2", f"(nose_y + {sh['y']}) / 2", "least(nose_conf, shoulder_l_conf, shoulder_r_conf) * 8e-1"),
        ("chest", f"{sh['x']} + ({hp['x']} - {sh['x']}) * (1e0 / 3e0)", f"{sh['y']} + ({hp['y']} - {sh['y']}) * (1e0 / 3e0)", torso),
        ("spine", f"{sh['x']} + ({hp['x']} - {sh['x']}) * (2e0 / 3e0)", f"{sh['y']} + ({hp['y']} - {sh['y']}) * (2e0 / 3e0)", torso),
    ]
    for s in "lr":
        for j, a, b, f in (("hand", "elbow", "wrist", "13e-1"), ("foot", "knee", "ankle", "125e-2")):
            rows.append((f"{j}_{s}", *[f"{a}_{s}_{c} + ({b}_{s}_{c} - {a}_{s}_{c}) * {f}" for c in "xy"], f"least({a}_{s}_conf, {b}_{s}_conf) * 8e-1"))
    union = " UNION ALL ".join(f"SELECT example_id, '{j}' AS joint, {x} AS x, {y} AS y, {c} AS conf FROM w" for j, x, y, c in rows)
    return f"""WITH kp AS ({_KP}), w AS (SELECT example_id, {cols} FROM kp GROUP BY 1 HAVING count(DISTINCT kp) = 17), r AS ({union})
SELECT example_id, joint, CAST(greatest(0, least(round_even(x, 0), 511)) AS INT) AS x, CAST(greatest(0, least(round_even(y, 0), 511)) AS INT) AS y, round_even(conf, 4) AS confidence, conf >= 3e-1 AS visible FROM r"""


@query(_kp_sql())
def derive_joints_17_to_19(t):
    return G.derive_joints_17_to_19(t.sql(_KP), 512, 512)


@query(f"""WITH kp AS ({_KP}), e AS (SELECT example_id, CAST(count(DISTINCT kp) AS INT) AS n_keypoints, list(DISTINCT kp) AS have FROM kp GROUP BY 1 HAVING count(DISTINCT kp) <> 17)
SELECT example_id, n_keypoints, array_to_string(list_filter(range(17), lambda i: NOT list_contains(have, i)), '|') AS missing FROM e""")
def incomplete_keypoints(t):
    return G.incomplete_keypoints(t.sql(_KP)).withColumn("missing", F.array_join(F.transform("missing", lambda k: k.cast("string")), "|"))


@query("""
WITH b AS (SELECT example_id, min(x) FILTER (ok) AS a, max(x) FILTER (ok) AS b, min(y) FILTER (ok) AS c, max(y) FILTER (ok) AS d FROM (SELECT *, visible AND NOT (x = -1 AND y = -1) AND mod(example_id, 6) <> 0 AS ok FROM v_joints) GROUP BY 1),
p AS (SELECT *, greatest(CAST(trunc((b - a) * 5e-2) AS INT), 5) AS px, greatest(CAST(trunc((d - c) * 5e-2) AS INT), 5) AS py FROM b)
SELECT example_id, CAST(coalesce(greatest(0, a - px), 0) AS INT) AS x_min, CAST(coalesce(greatest(0, c - py), 0) AS INT) AS y_min, CAST(CASE WHEN a IS NULL THEN 64 ELSE least(64, b + px) END AS INT) AS x_max, CAST(CASE WHEN c IS NULL THEN 64 ELSE least(64, d + py) END AS INT) AS y_max FROM p""")
def joint_bbox(t):
    return G.joint_bbox(t.v_joints.withColumn("visible", F.col("visible") & (F.col("example_id") % 6 != 0)))


_PTS = "SELECT CAST(floor(l_orderkey / 32) AS BIGINT) AS example_id, l_orderkey * 8 + l_linenumber AS point, min(l_quantity) AS x, min(l_discount) * 100 AS y, min(l_tax) * 100 AS z FROM lineitem GROUP BY 1, 2"
_EXT = [[0.9, 0.1, 0.0, -5.0], [-0.1, 0.8, 0.2, 1.5], [0.05, -0.2, 0.9, -40.0]]
_INT = [[1100.0, 0.0, 512.0], [0.0, 1100.0, 500.0], [0.0, 0.0, 1.0]]


def _pin_sql(az):
    c, s = repr(math.cos(math.radians(az))), repr(math.sin(math.radians(az)))
    cam = [f"(x * {c}::DOUBLE - y * {s}::DOUBLE) * {r[0]}::DOUBLE + (x * {s}::DOUBLE + y * {c}::DOUBLE) * {r[1]}::DOUBLE + z * {r[2]}::DOUBLE + {r[3]}::DOUBLE" for r in _EXT]
    return f"""WITH p AS ({_PTS}), c AS (SELECT point, {cam[0]} AS a, {cam[1]} AS b, {cam[2]} AS d FROM p)
SELECT point, round(CASE WHEN abs(d) < 1e-6 THEN 0 ELSE (a / d * 1100 + 512) * 0.5 END, 2) AS px, round(CASE WHEN abs(d) < 1e-6 THEN 0 ELSE (b / d * 1100 + 500) * 0.5 END, 2) AS py FROM c"""


@query(_pin_sql(45))
def project_pinhole(t):
    out = G.project_pinhole(t.sql(_PTS), _EXT, _INT, azimuth=45.0)
    return out.select("point", "px", "py")


@query(f"""WITH p AS ({_PTS}), m AS (SELECT example_id, min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d, min(z) AS e, max(z) AS f FROM p GROUP BY 1),
s AS (SELECT *, CASE WHEN greatest(b - a, d - c, f - e) * 11e-1 < 1e-6 THEN 1 ELSE greatest(b - a, d - c, f - e) * 11e-1 END AS sc FROM m),
q AS (SELECT p.example_id, point, CAST(round_even(((x - (a + b) / 2) / sc + 5e-1) * 512, 0) AS INT) AS px, CAST(round_even((-(z - (e + f) / 2) / sc + 5e-1) * 512, 0) AS INT) AS py FROM p JOIN s ON s.example_id = p.example_id)
SELECT example_id, point, px, py FROM q WHERE px BETWEEN 0 AND 511 AND py BETWEEN 0 AND 511""")
def project_ortho(t):
    return G.project_ortho(t.sql(_PTS)).select("example_id", "point", "px", "py")


@query("""WITH r AS (SELECT dataset, example_id, class_id, avg(z) AS z FROM v_cells WHERE class_id > 0 GROUP BY ALL), g AS (SELECT *, min(z) OVER w AS lo, max(z) OVER w AS hi FROM r WINDOW w AS (PARTITION BY dataset, example_id))
SELECT dataset, example_id, class_id, CAST(CASE WHEN hi > lo THEN round_even((1 - (z - lo) / (hi - lo)) * 255, 0) ELSE 127 END AS INT) AS depth_rank FROM g""")
def minmax_rank_depth(t):
    depth = M.region_mean_depth(t.v_cells.where("class_id > 0"))
    return G.minmax_rank_depth(depth, M.EXAMPLE, "mean_depth").select(*M.EXAMPLE, "class_id", "depth_rank")


_BONES = [f"bone_{i}" for i in range(26)]


@query(f"""
WITH b AS (SELECT unnest([{", ".join(f"'{x}'" for x in _BONES)}]) AS bone),
v AS (SELECT example_id, vertex, min(x) AS x, min(y) AS y, sum(w) AS s FROM v_weights GROUP BY 1, 2),
m AS (SELECT example_id, min(x) AS a, min(y) AS c, greatest(max(x) - min(x), 1) AS rx, greatest(max(y) - min(y), 1) AS ry FROM v GROUP BY 1),
j AS (SELECT example_id, bone, sum(w * x) / sum(w) AS jx, sum(w * y) / sum(w) AS jy FROM v_weights GROUP BY 1, 2)
SELECT v.example_id, v.vertex, b.bone, round((v.x - a) / rx, 6) AS u, round((v.y - c) / ry, 6) AS v, round(sqrt(pow(v.x - coalesce(jx, 0), 2) + pow(v.y - coalesce(jy, 0), 2)) / greatest(sqrt(rx * rx + ry * ry), 1), 6) AS distance,
 round(coalesce(w.w, 0) / s, 6) AS weight, 1.0::DOUBLE AS confidence
FROM v CROSS JOIN b JOIN m ON m.example_id = v.example_id LEFT JOIN j ON j.example_id = v.example_id AND j.bone = b.bone LEFT JOIN v_weights w ON w.example_id = v.example_id AND w.vertex = v.vertex AND w.bone = b.bone""")
def vertex_features(t):
    from maskloom.operators.weights import weighted_joint_centroids

    w = t.v_weights.withColumn("w", F.col("w").cast("double"))
    return _R6(G.vertex_features(w, weighted_joint_centroids(w, _BONES), _BONES), "u", "v", "distance", "weight")


# --- measurements ---
_V3 = """SELECT concat('c', CAST(CAST(floor(l_orderkey / 96) AS BIGINT) AS STRING)) AS char_id, c.class_name AS region, l_quantity AS x, l_discount * 100 AS y, l_tax * 400 + l_linenumber AS z
FROM lineitem JOIN v_classes c ON c.class_id = 1 + mod(l_partkey, 19)"""
_M3 = f"""v3 AS ({_V3}), m3 AS (SELECT char_id, region, round_even(max(x) - min(x), 6) AS width, round_even(max(y) - min(y), 6) AS depth, round_even(max(z) - min(z), 6) AS height, round_even((max(x) + min(x)) / 2, 6) AS cx,
 round_even((max(y) + min(y)) / 2, 6) AS cy, round_even((max(z) + min(z)) / 2, 6) AS cz, count(*) AS vertex_count FROM v3 GROUP BY 1, 2)"""


def _m3(t):
    return X.region_geometry_3d(t.sql(_V3))


@query(f"WITH {_M3} SELECT * FROM m3")
def region_geometry_3d(t):
    return _m3(t)


_VIEWS = f"""SELECT concat('c', CAST(CAST(floor(example_id / 3) AS BIGINT) AS STRING)) AS char_id, 0 AS pose, CASE WHEN mod(floor(example_id / 3), 5) < 4 THEN CASE mod(example_id, 3) WHEN 0 THEN 'front' WHEN 1 THEN 'side' ELSE 'back' END ELSE split_part('{VIEW_ANGLES}', ',', CAST(1 + mod(example_id + floor(example_id / 15), 32) AS INT)) END AS angle, y, x0, len, class_id FROM v_runs"""
_M2 = f"""vw AS ({_VIEWS}), s2 AS (SELECT char_id, pose, angle, class_id, CAST(sum(len) AS BIGINT) AS pixel_count, CAST(max(x0 + len) - min(x0) AS INT) AS apparent_width, CAST(max(y) - min(y) + 1 AS INT) AS apparent_height FROM vw GROUP BY 1, 2, 3, 4),
m2 AS (SELECT e.char_id, e.pose, e.angle, c.class_name AS region, coalesce(pixel_count, 0) AS pixel_count, coalesce(apparent_width, 0) AS apparent_width, coalesce(apparent_height, 0) AS apparent_height, pixel_count IS NOT NULL AS visible
 FROM (SELECT DISTINCT char_id, pose, angle FROM s2) e CROSS JOIN v_classes c LEFT JOIN s2 ON s2.char_id = e.char_id AND s2.angle = e.angle AND s2.class_id = c.class_id WHERE c.class_id > 0)"""


def _m2(t):
    return M.region_geometry_2d(t.sql(_VIEWS), ["char_id", "pose", "angle"])


#: angle, azimuth, elevation for the check SQL, independent of ``dims``
_DEGREES = """
('front', 0, 0), ('front_22', 22, 0), ('three_quarter', 45, 0), ('three_quarter_67', 67, 0), ('side', 90, 0), ('side_112', 112, 0),
('three_quarter_back', 135, 0), ('three_quarter_back_157', 157, 0), ('back', 180, 0), ('three_quarter_back_left', 225, 0), ('side_left', 270, 0),
('three_quarter_left', 315, 0), ('front_high', 0, 25), ('three_quarter_high', 45, 25), ('side_high', 90, 25), ('back_high', 180, 25), ('front_low', 0,
-15), ('three_quarter_low', 45, -15), ('side_low', 90, -15), ('iso_front', 0, 35), ('iso_front_right', 45, 35), ('iso_right', 90, 35),
('iso_back_right', 135, 35), ('iso_back', 180, 35), ('iso_back_left', 225, 35), ('iso_left', 270, 35), ('iso_front_left', 315, 35), ('topdown_front',
0, 60), ('topdown_right', 90, 60), ('topdown_back', 180, 60), ('topdown_left', 270, 60)
"""


@query(f"""WITH {_M2}, {_M3}, dg AS (SELECT * FROM (VALUES {_DEGREES}) AS v(angle, azimuth, elevation))
SELECT m2.char_id, pose, m2.angle, m2.region, apparent_width, apparent_height, pixel_count, width AS true_width, depth AS true_depth, height AS true_height,
 azimuth, elevation FROM m2 JOIN m3 ON m3.char_id = m2.char_id AND m3.region = m2.region LEFT JOIN dg ON dg.angle = m2.angle WHERE visible""")
def apparent_vs_true_pairs(t):
    return X.apparent_vs_true_pairs(_m2(t), _m3(t))


_PAIRS = f"""{_M2}, ap AS (SELECT a.char_id, a.pose, a.region, a.angle AS angle_a, b.angle AS angle_b, a.pixel_count AS pixels_a, b.pixel_count AS pixels_b FROM m2 a JOIN m2 b
  ON b.char_id = a.char_id AND b.pose = a.pose AND b.region = a.region AND a.angle < b.angle WHERE a.visible AND b.visible AND a.pixel_count >= 5 AND b.pixel_count >= 5)"""


@query(f"WITH {_PAIRS} SELECT * FROM ap")
def angle_pair_self_join(t):
    return X.angle_pairs(_m2(t), 5)


_CHECKS = f"""{_PAIRS}, {_M3}, ok AS (SELECT char_id, pose FROM m2 GROUP BY 1, 2 HAVING count(DISTINCT angle) >= 2),
ck AS (SELECT 'region_presence' AS "check", m2.char_id, m2.pose, region, min(angle) FILTER (visible) AS angle_a, min(angle) FILTER (NOT visible) AS angle_b, bool_or(visible) AND bool_or(NOT visible) AS failed
  FROM m2 JOIN ok ON ok.char_id = m2.char_id WHERE region IN ('head', 'neck', 'chest', 'spine', 'hips') GROUP BY ALL
 UNION ALL SELECT 'pixel_area_consistency', char_id, pose, region, angle_a, angle_b, abs(pixels_a - pixels_b) / ((pixels_a + pixels_b) / 2) > 1e-1 FROM ap
 UNION ALL SELECT 'measurement_ratio', f.char_id, f.pose, f.region, 'front', 'side', abs(f.apparent_width / s.apparent_width - width / depth) / (width / depth) > 1e-1 FROM m2 f JOIN m2 s ON s.char_id = f.char_id AND s.region = f.region
   JOIN m3 ON m3.char_id = f.char_id AND m3.region = f.region WHERE f.angle = 'front' AND s.angle = 'side' AND f.visible AND s.visible AND width > 0 AND depth > 0)"""


def _checks(t):
    return X.multiview_checks(cut(_m2(t)), _m3(t), min_pixels=5)


@query(f"WITH {_CHECKS} SELECT * FROM ck")
def multiview_checks(t):
    return _checks(t)


@query(f'WITH {_CHECKS} SELECT "check", count(*) FILTER (NOT failed) AS passed, count(*) FILTER (failed) AS failed FROM ck GROUP BY 1')
def multiview_consistency(t):
    return X.check_report(_checks(t))


@query(f"WITH {_CHECKS} SELECT region, count(*) AS failures FROM ck WHERE failed GROUP BY 1 ORDER BY failures DESC, region LIMIT 5")
def worst_regions(t):
    return X.worst_regions(_checks(t))


@query(f"WITH {_CHECKS} SELECT angle_a || ' vs ' || angle_b AS angles, count(*) AS failures FROM ck WHERE failed GROUP BY 1 ORDER BY failures DESC, angles LIMIT 5")
def worst_angle_pairs(t):
    return X.worst_angle_pairs(_checks(t))


def _feat_sql():
    regs = [r for r in dims.CLASS_NAMES[1:20]]
    cols = ", ".join(f"max(width) FILTER (region = '{r}' AND width > 0) AS w_{r}, max(height) FILTER (region = '{r}' AND height > 0) AS h_{r}" for r in regs)
    pair = lambda d, p: f"list_avg([{d}_{p}_l, {d}_{p}_r])"
    arm, leg = f"({pair('h', 'upper_arm')} + {pair('h', 'forearm')})", f"({pair('h', 'upper_leg')} + {pair('h', 'lower_leg')})"
    torso, sh = "(h_chest + h_spine + h_hips)", "(w_shoulder_l + w_shoulder_r + w_chest)"
    at, lt = f"list_avg([{pair('w', 'upper_arm')}, {pair('w', 'forearm')}])", f"list_avg([{pair('w', 'upper_leg')}, {pair('w', 'lower_leg')}])"
    exprs = [f"h_head / {torso}", f"({arm} + {pair('h', 'hand')}) / {torso}", f"({leg} + {pair('h', 'foot')}) / {torso}", f"{sh} / w_hips", f"{at} / w_chest", f"{lt} / w_hips", f"w_head / {sh}", f"{pair('h', 'hand')} / {arm}", f"{pair('h', 'foot')} / {leg}"]
    return f"{_M3}, wd AS (SELECT char_id, {cols} FROM m3 GROUP BY 1), ft AS (SELECT char_id, " + ", ".join(f"{e} AS {n}" for n, e in zip(X.FEATURES, exprs)) + " FROM wd)"


@query(f"WITH {_feat_sql()} SELECT char_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in X.FEATURES) + " FROM ft")
def proportion_features(t):
    return _R6(X.proportion_features(_m3(t)), *X.FEATURES)


@query(f"""WITH {_feat_sql()} SELECT archetype, count(*) AS n FROM (SELECT CASE WHEN coalesce(head_to_body_height, 0) > 0.5 THEN 'chibi' WHEN coalesce(shoulder_to_hip_width, 0) > 3.5 AND (coalesce(arm_thickness_ratio, 0) > 0.35 OR coalesce(leg_thickness_ratio, 0) > 0.35) THEN 'muscular'
 WHEN coalesce(leg_length_to_torso, 0) > 1.6 AND coalesce(arm_thickness_ratio, 0) < 0.25 AND coalesce(leg_thickness_ratio, 0) < 0.25 THEN 'tall_thin' WHEN coalesce(head_to_body_height, 0) > 0.35 THEN 'stylized' ELSE 'realistic' END AS archetype FROM ft) GROUP BY 1""")
def classify_proportions(t):
    return X.proportion_archetypes(X.proportion_features(_m3(t))).groupBy("archetype").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_M3} SELECT char_id, count(*) AS measured_regions, CAST(sum(vertex_count) AS BIGINT) AS total_vertices, string_agg(region || '=' || printf('%.2f/%.2f/%.2f', width, depth, height), '|' ORDER BY region) AS sizes, 'unknown' AS source
FROM m3 GROUP BY 1 HAVING count(*) >= 10""")
def profile_summary(t):
    from maskloom.functions.names import infer_source

    out = X.profile_summary(_m3(t), infer_source(F.col("char_id"), strict_underscore=True))
    sizes = F.array_sort(F.transform(F.map_keys("measurements"), lambda k: F.struct(k.alias("k"), F.element_at("measurements", k).alias("v"))))
    text = F.transform(sizes, lambda e: F.format_string("%s=%.2f/%.2f/%.2f", e.k, e.v["width"], e.v["depth"], e.v["height"]))
    return out.withColumn("sizes", F.array_join(text, "|")).drop("measurements")


_F = [f"f{i}" for i in range(9)]


@query("WITH m AS (SELECT " + ", ".join(f"quantile_cont({f}, 0.5) AS m_{f}" for f in _F) + " FROM v_vectors), i AS (SELECT vec_id, " + ", ".join(f"coalesce({f}, m_{f}) AS {f}" for f in _F)
       + " FROM v_vectors, m), s AS (SELECT " + ", ".join(f"avg({f}) AS a_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}" for f in _F)
       + " FROM i) SELECT vec_id, " + ", ".join(f"round({f}, 5) AS {f}, round(({f} - a_{f}) / s_{f}, 5) AS z_{f}" for f in _F) + " FROM i, s")
def impute_scale(t):
    out = X.impute_scale(t.v_vectors, _F, ["vec_id"])
    return out.withColumns({c: F.round(c, 5) for c in out.columns if c != "vec_id"})


@query()
def kmeans_select_k(t):
    """Rows only: the check engine has no clustering."""
    names = dict(zip(_F, X.FEATURES))
    return X.label_clusters(X.kmeans_select_k(t.v_vectors.withColumnsRenamed(names), "vec_id", X.FEATURES))


# --- layers ---
_OV = """ov AS (SELECT m.example_id, CAST(sum(least(m.x0 + m.len, a.x0 + a.len) - greatest(m.x0, a.x0)) AS BIGINT) AS covered_px FROM v_runs m JOIN v_alpha a ON a.example_id = m.example_id AND a.y = m.y AND a.x0 < m.x0 + m.len AND m.x0 < a.x0 + a.len GROUP BY 1),
al AS (SELECT example_id, CAST(sum(len) AS BIGINT) AS alpha_px FROM v_alpha GROUP BY 1), mk AS (SELECT example_id, CAST(sum(len) AS BIGINT) AS fg_px FROM v_runs GROUP BY 1)"""


@query(f"WITH {_OV} SELECT mk.example_id, fg_px, alpha_px, coalesce(covered_px, 0) AS covered_px FROM mk JOIN al ON al.example_id = mk.example_id LEFT JOIN ov ON ov.example_id = mk.example_id")
def silhouette_overlap(t):
    return L.silhouette_overlap(t.v_runs, t.v_alpha)


@query("""SELECT a.example_id, a.class_id, b.class_id AS other, CAST(sum(least(a.x0 + a.len, b.x0 + b.len) - greatest(a.x0, b.x0)) AS BIGINT) AS pixels FROM v_runs a JOIN (SELECT example_id, y, 64 - x0 - len AS x0, len, class_id FROM v_runs) b
 ON b.example_id = a.example_id AND b.y = a.y AND b.x0 < a.x0 + a.len AND a.x0 < b.x0 + b.len GROUP BY 1, 2, 3""")
def mask_overlap(t):
    """Label by label overlap of a mask with its own mirror image."""
    a = t.v_runs
    b = a.withColumn("x0", F.lit(64) - F.col("x0") - F.col("len")).withColumnRenamed("class_id", "other")
    return L.mask_overlap(a, b, ["example_id"], ["class_id"], ["other"], bucket=16)


@query(f"WITH {_OV} SELECT al.example_id, alpha_px - coalesce(covered_px, 0) AS unmapped, round_even((alpha_px - coalesce(covered_px, 0)) / alpha_px * 100, 1) AS percent, alpha_px = coalesce(covered_px, 0) AS passed FROM al LEFT JOIN ov ON ov.example_id = al.example_id")
def mask_completeness(t):
    return L.mask_completeness(t.v_runs, t.v_alpha)


@query("""SELECT j.example_id, count(*) FILTER (r.class_id = j.class_id) AS matched, count(*) AS total, round_even(count(*) FILTER (r.class_id = j.class_id) / count(*), 4) AS match_rate
FROM v_joints j LEFT JOIN v_runs r ON r.example_id = j.example_id AND r.y = j.y AND j.x >= r.x0 AND j.x < r.x0 + r.len GROUP BY 1""")
def joint_in_label_rate(t):
    return L.joint_in_label_rate(t.v_joints, t.v_runs)


@query("""
WITH sg AS (SELECT example_id, class_id AS segment, sum(len) AS px, sum(len * (2 * x0 + len - 1) / 2) / sum(len) AS cx, sum(y * len) / sum(len) AS cy FROM v_runs GROUP BY 1, 2 HAVING sum(len) >= 10),
jt AS (SELECT * FROM v_joints WHERE visible),
cd AS (SELECT sg.example_id, segment, j.class_id, round(pow(j.x - cx, 2) + pow(j.y - cy, 2), 6) AS d, EXISTS (SELECT 1 FROM v_runs r WHERE r.example_id = sg.example_id AND r.class_id = sg.segment AND r.y = j.y AND j.x >= r.x0 AND j.x < r.x0 + r.len) AS ins FROM sg JOIN jt j ON j.example_id = sg.example_id),
bs AS (SELECT example_id, segment, class_id FROM cd QUALIFY row_number() OVER (PARTITION BY example_id, segment ORDER BY ins DESC, d, class_id) = 1),
bx AS (SELECT example_id, min(x0) AS l, min(y) AS u, greatest(max(x0 + len - 1) - min(x0), 1) AS w, greatest(max(y) - min(y), 1) AS h FROM v_alpha GROUP BY 1),
gr AS (SELECT sg.*, (cx - (coalesce(l, 0) + coalesce(w, 63) / 2)) / (coalesce(w, 63) / 2) AS rx, (cy - coalesce(u, 0)) / coalesce(h, 63) AS ry FROM sg LEFT JOIN bx ON bx.example_id = sg.example_id)
SELECT gr.example_id, gr.segment, CAST(coalesce(bs.class_id, CASE WHEN ry < 0.15 THEN 1 WHEN ry < 0.2 THEN 2 WHEN ry < 0.4 THEN CASE WHEN rx < -0.15 THEN 7 WHEN rx > 0.15 THEN 11 ELSE 3 END WHEN ry < 0.5 THEN CASE WHEN rx < -0.15 THEN 8 WHEN rx > 0.15 THEN 12 ELSE 4 END
 WHEN ry < 0.55 THEN CASE WHEN rx < -0.15 THEN 9 WHEN rx > 0.15 THEN 13 ELSE 5 END WHEN ry < 0.75 THEN CASE WHEN rx < 0 THEN 14 ELSE 17 END WHEN ry < 0.9 THEN CASE WHEN rx < 0 THEN 15 ELSE 18 END ELSE CASE WHEN rx < 0 THEN 16 ELSE 19 END END) AS INT) AS region
FROM gr LEFT JOIN bs ON bs.example_id = gr.example_id AND bs.segment = gr.segment""")
def assign_nearest(t):
    segments = t.v_runs.withColumnRenamed("class_id", "segment")
    return L.assign_nearest(segments, t.v_joints.where("visible"), 64, 64, silhouette=t.v_alpha)


@query("""
WITH p AS (SELECT example_id, joint, x + 0.5 AS px, y * 1.25 AS py FROM v_joints WHERE visible),
e AS (SELECT j.example_id AS sample, round_even(sqrt(pow(p.px - j.x, 2) + pow(p.py - j.y, 2)) * 100, 0) AS err FROM v_joints j LEFT JOIN p ON p.example_id = j.example_id AND p.joint = j.joint)
SELECT sample, coalesce(round_even(sum(err) / count(err), 0) / 100, 'inf'::DOUBLE) AS mean_error_px, coalesce(max(err) / 100, 'inf'::DOUBLE) AS max_error_px, count(err) AS num_joints FROM e GROUP BY 1""")
def reprojection_error(t):
    j = t.v_joints.withColumnRenamed("example_id", "sample")
    p = j.where("visible").selectExpr("sample", "joint", "x + 0.5D AS px", "y * 1.25D AS py")
    return L.reprojection_error(j, p)


@query("""
WITH a AS (SELECT example_id, y, x0, len FROM v_runs UNION ALL SELECT example_id, y, x0, len FROM v_alpha), c AS (SELECT DISTINCT example_id, y, x0 + unnest(range(len)) AS x FROM a),
g AS (SELECT *, x - row_number() OVER (PARTITION BY example_id, y ORDER BY x) AS k FROM c) SELECT example_id, y, CAST(min(x) AS INT) AS x0, CAST(count(*) AS INT) AS len FROM g GROUP BY example_id, y, k""")
def union_masks(t):
    cols = ["example_id", "y", "x0", "len"]
    return L.union_masks(t.v_runs.select(*cols).unionByName(t.v_alpha.select(*cols)))


def _h(text, word, lo, hi):
    return f"({lo} + ('0x' || substr(md5({text}), {1 + 8 * word}, 8))::BIGINT % (({hi}) - {lo} + 1))"


_BASE = "'42:' || example_id || ':' || m || ':' || t"


def _rect(i):
    text = f"{_BASE} || ':{i}'"
    rh, rw = _h(text, 0, 8, 21), _h(text, 1, 8, 21)
    return f"{rh} AS h{i}, {rw} AS w{i}, {_h(text, 2, 0, '64 - ' + rh)} AS y{i}, {_h(text, 3, 0, '64 - ' + rw)} AS x{i}"


_IN = " OR ".join(f"({i} < n AND y >= y{i} AND y < y{i} + h{i} AND x >= x{i} AND x < x{i} + w{i})" for i in range(3))


@query(f"""
WITH e AS (SELECT example_id, m, t, {_h(_BASE, 0, 1, 3)} AS n, {_rect(0)}, {_rect(1)}, {_rect(2)} FROM (SELECT DISTINCT example_id FROM v_runs), (SELECT unnest(range(2)) AS m), (SELECT unnest(range(5)) AS t)),
c AS (SELECT example_id, y, x0 + unnest(range(len)) AS x FROM v_runs),
g AS (SELECT e.example_id, m, t, count(*) AS fg, count(*) FILTER ({_IN}) AS hid FROM c JOIN e ON e.example_id = c.example_id GROUP BY 1, 2, 3)
SELECT example_id, CAST(m AS INT) AS mask, CAST(t AS INT) AS try, hid AS hidden_px, fg AS fg_px FROM g WHERE fg / 4096 >= 0.05 AND hid / fg BETWEEN 0.05 AND 0.5 QUALIFY row_number() OVER (PARTITION BY example_id, m ORDER BY t) = 1""")
def occlusion_rect_pairs(t):
    return L.occlusion_rect_pairs(t.v_runs, 64, 64)


_GRID = """gd AS (SELECT e.example_id, CAST(x.x AS INT) AS x, CAST(y.y AS INT) AS y, coalesce(g.class_id, 0) AS class_id FROM (SELECT DISTINCT example_id FROM v_grid) e CROSS JOIN (SELECT unnest(range(32)) AS x) x CROSS JOIN (SELECT unnest(range(32)) AS y) y
  LEFT JOIN v_grid g ON g.example_id = e.example_id AND g.x = x.x AND g.y = y.y)"""


@query(f"""WITH {_GRID} SELECT a.example_id, a.x, a.y, a.class_id FROM gd a JOIN gd b ON b.example_id = a.example_id AND b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1
WHERE a.class_id > 0 AND a.class_id <> 7 GROUP BY ALL HAVING max(b.class_id) <> min(b.class_id)""")
def boundary_cells(t):
    return L.boundary_cells(L.densify(t.v_grid, 32, 32), radius=1, exclude=[7])


# the kernel is separable: weights are summed along x first, then along y
_MIRROR = "CASE WHEN {0} < 0 THEN -({0}) - 1 WHEN {0} > 31 THEN 63 - ({0}) ELSE {0} END"


@query(f"""
WITH {_GRID.replace("gd AS (", "gd AS MATERIALIZED (")},
r1 AS MATERIALIZED (SELECT *, min(class_id) OVER w AS a, max(class_id) OVER w AS b FROM gd WINDOW w AS (PARTITION BY example_id, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
r2 AS MATERIALIZED (SELECT *, min(a) OVER w AS lo, max(b) OVER w AS hi FROM r1 WINDOW w AS (PARTITION BY example_id, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
bd AS MATERIALIZED (SELECT example_id, x, y, class_id, class_id > 0 AND lo <> hi AS soft FROM r2),
k AS (SELECT d, exp(-d * d / 2) AS w FROM (SELECT unnest(range(-4, 5)) AS d)),
kk AS MATERIALIZED (SELECT x, {_MIRROR.format("x + d")} AS nx, sum(w) AS w FROM k, (SELECT unnest(range(32)) AS x) GROUP BY 1, 2),
hx AS MATERIALIZED (SELECT gd.example_id, kk.x, gd.y, gd.class_id, sum(w) AS g FROM gd JOIN kk ON kk.nx = gd.x GROUP BY ALL),
mx AS MATERIALIZED (SELECT bd.example_id, bd.x, bd.y, hx.class_id, sum(hx.g * kk.w) AS g FROM bd JOIN kk ON kk.x = bd.y JOIN hx ON hx.example_id = bd.example_id AND hx.x = bd.x AND hx.y = kk.nx WHERE soft GROUP BY ALL)
SELECT example_id, x, y, class_id, round(g / sum(g) OVER (PARTITION BY example_id, x, y), 6) AS p FROM mx
UNION ALL SELECT example_id, x, y, class_id, 1.0 FROM bd WHERE NOT soft""")
def soften_labels(t):
    return _R6(L.soften_labels(t.v_grid, 32, 32, radius=1, absent=0), "p")
