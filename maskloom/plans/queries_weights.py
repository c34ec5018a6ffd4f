"""Queries over vertex weights, faces and votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom.functions.bone_tables import ACCESSORY_WORDS, PRIMARY_WORDS
from maskloom.operators import weights as W
from maskloom.plans.catalog import query

_R6 = lambda df, *cols: df.withColumns({c: F.round(c, 6) for c in cols})
_MAP = "SELECT DISTINCT bone, CAST(mod(bone_order * 7, 20) AS INT) AS region FROM v_weights"
_WT = "SELECT example_id, vertex, x, y, bone, bone_order, CASE WHEN w < 4 THEN 0 ELSE w / 50e0 END AS w FROM v_weights"
_BASE = f"mp AS ({_MAP}), wt AS ({_WT})"


@query(f"WITH {_BASE} SELECT example_id, vertex, region, round_even(sum(w), 6) AS w FROM wt JOIN mp ON mp.bone = wt.bone WHERE w >= 1e-6 GROUP BY 1, 2, 3 HAVING sum(w) > 1e-6")
def collapse_weights(t):
    return W.collapse_weights(t.sql(_WT), t.sql(_MAP))


@query(f"WITH {_BASE} SELECT example_id, bone, round(sum(w * x) / sum(w), 6) AS jx, round(sum(w * y) / sum(w), 6) AS jy FROM wt GROUP BY 1, 2 HAVING sum(w) > 1e-6")
def weighted_joint_centroids(t):
    return _R6(W.weighted_joint_centroids(t.sql(_WT), [f"bone_{i}" for i in range(26)]), "jx", "jy")


_DOM = f"{_BASE}, db AS (SELECT example_id, vertex, bone, w FROM wt QUALIFY row_number() OVER (PARTITION BY example_id, vertex ORDER BY w DESC, bone_order) = 1), dr AS (SELECT db.example_id, vertex, db.bone, coalesce(region, 0) AS region FROM db LEFT JOIN mp ON mp.bone = db.bone)"


def _dominant(t):
    return W.dominant_region(t.sql(_WT), t.sql(_MAP))


@query(f"WITH {_DOM} SELECT * FROM dr")
def dominant_region(t):
    return _dominant(t)


@query(f"WITH {_DOM}, g AS (SELECT example_id, avg(CASE WHEN region > 0 THEN 1 ELSE 0 END) AS coverage, bool_or(region BETWEEN 6 AND 9) AND bool_or(region BETWEEN 10 AND 13) AND bool_or(region BETWEEN 14 AND 16) AND bool_or(region BETWEEN 17 AND 19) AS has_limbs FROM dr GROUP BY 1) SELECT example_id, round(coverage, 6) AS coverage, has_limbs, coverage >= 0.7 AND has_limbs AS humanoid FROM g")
def humanoid_test(t):
    return _R6(W.humanoid_test(_dominant(t), 0.7), "coverage")


_FACES = "SELECT l_orderkey AS example_id, CAST(mod(l_linenumber, 2) AS INT) AS face, l_partkey AS corner, CAST(min(mod(l_suppkey, 3)) AS INT) AS region, min(l_discount) AS dist FROM lineitem GROUP BY 1, 2, 3"


@query(f"""WITH f AS ({_FACES}), v AS (SELECT example_id, face, region, count(*) AS votes, min(dist) AS d, arg_min(corner, (dist, corner)) AS c FROM f GROUP BY 1, 2, 3)
SELECT example_id, face, region FROM v QUALIFY row_number() OVER (PARTITION BY example_id, face ORDER BY votes DESC, d, c) = 1""")
def face_majority_vote(t):
    return W.face_majority_vote(t.sql(_FACES))


@query(f"WITH {_DOM}, p AS (SELECT dr.*, wt.x, wt.y FROM dr JOIN (SELECT DISTINCT example_id, vertex, x, y FROM wt) wt ON wt.example_id = dr.example_id AND wt.vertex = dr.vertex) SELECT example_id, x, y, region FROM p WHERE x BETWEEN 0 AND 49 AND y BETWEEN 0 AND 39 QUALIFY row_number() OVER (PARTITION BY example_id, x, y ORDER BY vertex DESC) = 1")
def splat_vertex_labels(t):
    pos = t.v_weights.select("example_id", "vertex", "x", "y").distinct()
    return W.splat_vertex_labels(_dominant(t).join(pos, ["example_id", "vertex"]), 50, 40)


_PARTS = "SELECT rig AS model, k AS part, name, CAST(mod(vertices, 7) AS INT) AS n_groups, mod(k, 17) <> 3 AS has_armature FROM v_names"
_VERTS = "SELECT rig AS model, k AS part, CASE WHEN mod(l_linenumber + k, 9) < 8 AND mod(k, 3) = 0 THEN 1 ELSE 2 END AS bones FROM v_names JOIN lineitem ON l_partkey = k"
_WORDS = " OR ".join(f"contains(lower(name), '{w}')" for w in ACCESSORY_WORDS)


@query(f"""WITH p AS ({_PARTS}), v AS ({_VERTS}), s AS (SELECT model, part, avg(CASE WHEN bones <= 1 THEN 1 ELSE 0 END) AS single FROM v GROUP BY 1, 2),
r AS (SELECT p.*, NOT has_armature OR n_groups = 0 AS a, {_WORDS} AS b, n_groups <= 5 AND coalesce(single >= 0.8, FALSE) AS c FROM p LEFT JOIN s ON s.model = p.model AND s.part = p.part)
SELECT model, part, name, array_to_string(list_filter([CASE WHEN a THEN 'no_skinning' END, CASE WHEN b THEN 'name_match' END, CASE WHEN NOT a AND NOT b AND c THEN 'weak_skinning' END], lambda x: x IS NOT NULL), '|') AS reasons, a OR b OR c AS is_accessory FROM r""")
def companion_mesh_detect(t):
    out = W.companion_mesh_detect(t.sql(_PARTS), t.sql(_VERTS), ACCESSORY_WORDS)
    return out.withColumn("reasons", F.array_join("reasons", "|"))


def _primary_sql():
    cases = " ".join(
        f"WHEN region = {r} THEN CASE " + " ".join(f"WHEN contains(lower(name), '{w.lower()}') THEN {i}" for i, w in enumerate(words)) + " ELSE 99 END"
        for r, words in PRIMARY_WORDS.items()
    )
    return f"CASE {cases} ELSE 99 END"


_PB = "SELECT k, rig, name, CAST(1 + mod(k * 3, 20) AS INT) AS region FROM v_names UNION ALL SELECT k + 1000000, rig, concat('x', CASE mod(k, 4) WHEN 0 THEN 'LeftHand' WHEN 1 THEN 'shin.R' WHEN 2 THEN 'L_thigh' ELSE 'hips' END), CAST(CASE mod(k, 4) WHEN 0 THEN 9 WHEN 1 THEN 18 WHEN 2 THEN 14 ELSE 5 END AS INT) FROM v_names"


@query(f"WITH b AS ({_PB}) SELECT rig, region, name FROM b WHERE region BETWEEN 1 AND 19 QUALIFY row_number() OVER (PARTITION BY rig, region ORDER BY {_primary_sql()}, k) = 1")
def select_primary(t):
    return W.select_primary(t.sql(_PB))


_VIEWS = "SELECT l_orderkey AS example_id, CAST(mod(l_partkey, 3) AS INT) AS pixel, CAST(mod(l_linenumber, 4) AS INT) AS view, CAST(mod(l_suppkey, 12) AS INT) AS class_id, max(l_discount) AS p FROM lineitem GROUP BY 1, 2, 3, 4"
_FGR = "SELECT DISTINCT example_id, pixel FROM ({v}) AS x WHERE mod(example_id + pixel, 7) <> 0"
_ENS = f"""vw AS ({_VIEWS}), sw AS (SELECT example_id, pixel, view, CASE WHEN view = 1 THEN c.pair_id ELSE vw.class_id END AS class_id, p FROM vw JOIN v_classes c ON c.class_id = vw.class_id),
av AS (SELECT example_id, pixel, class_id, sum(p) / 4 AS p FROM sw GROUP BY 1, 2, 3), bs AS (SELECT example_id, pixel, class_id, p AS confidence FROM av QUALIFY row_number() OVER (PARTITION BY example_id, pixel ORDER BY round(p, 9) DESC, class_id) = 1)"""


def _views(t):
    v = t.sql(_VIEWS)
    return v.where("view <> 1").unionByName(W.swap_classes(v.where("view = 1")).select(*v.columns)).withColumn("p", F.col("p").cast("decimal(10,4)").cast("double"))


@query(f"WITH {_ENS} SELECT example_id, pixel, CASE WHEN mod(example_id + pixel, 7) <> 0 THEN class_id ELSE 0 END AS class_id, round(CASE WHEN mod(example_id + pixel, 7) <> 0 THEN confidence ELSE 1 END, 6) AS confidence FROM bs")
def probability_ensemble(t):
    v = _views(t)
    fg = v.where("(example_id + pixel) % 7 <> 0").select("example_id", "pixel").distinct()
    rounded = v.groupBy("example_id", "pixel", "view", "class_id").agg(F.max("p").alias("p"))
    return _R6(W.probability_ensemble(_exact(rounded), fg), "confidence")


def _exact(v):
    """Sums of hundredths in decimal, so equal means compare equal."""
    return v.withColumn("p", F.col("p").cast("decimal(10,4)"))


_SEG = "SELECT DISTINCT l_orderkey AS example_id, CAST(mod(l_partkey, 5) AS INT) AS segment, CAST(mod(l_suppkey, 3) AS INT) AS pixel FROM lineitem"
_PRB = "SELECT l_orderkey AS example_id, CAST(mod(l_suppkey, 3) AS INT) AS pixel, CAST(mod(l_linenumber, 4) AS INT) AS class_id, CAST(round(max(l_discount) * 100) AS BIGINT) AS p FROM lineitem GROUP BY 1, 2, 3"
_FBK = "SELECT DISTINCT l_orderkey AS example_id, CAST(mod(l_suppkey, 3) AS INT) AS pixel, CAST(1 + mod(l_orderkey, 9) AS INT) AS class_id FROM lineitem"


@query(f"""WITH sg AS ({_SEG}), pr AS ({_PRB}), fb AS ({_FBK}), sz AS (SELECT example_id, segment, count(*) AS size FROM sg GROUP BY 1, 2),
m AS (SELECT sg.example_id, sg.segment, pr.class_id, sum(p) / first(size) AS m, first(size) AS size FROM sg JOIN pr ON pr.example_id = sg.example_id AND pr.pixel = sg.pixel JOIN sz ON sz.example_id = sg.example_id AND sz.segment = sg.segment GROUP BY 1, 2, 3),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY example_id, segment ORDER BY m DESC, class_id) = 1),
w AS (SELECT sg.example_id, sg.pixel, b.class_id FROM sg JOIN b ON b.example_id = sg.example_id AND b.segment = sg.segment WHERE b.class_id > 0 AND m > 4 QUALIFY row_number() OVER (PARTITION BY sg.example_id, sg.pixel ORDER BY size, sg.segment DESC) = 1)
SELECT fb.example_id, fb.pixel, coalesce(w.class_id, fb.class_id) AS class_id FROM fb LEFT JOIN w ON w.example_id = fb.example_id AND w.pixel = fb.pixel""")
def segment_vote(t):
    return W.segment_vote(t.sql(_SEG), t.sql(_PRB), t.sql(_FBK), min_p=4)
