"""Queries that score masks and renders."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom import dims
from maskloom.operators import components as C
from maskloom.operators import masks as M
from maskloom.operators import quality as Q
from maskloom.plans.catalog import query
from maskloom.session import cut

_IDS = range(1, 22)
_N = ", ".join(f"sum(CASE WHEN class_id = {i} THEN len ELSE 0 END) AS n_{i}" for i in _IDS)
_FG = " + ".join(f"n_{i}" for i in _IDS)
_REG = " + ".join(f"CAST(n_{i} > 0 AS INT)" for i in _IDS)
_MAX = "greatest(" + ", ".join(f"n_{i}" for i in _IDS) + ")"
_PROFILE = f"""
p0 AS (SELECT dataset, example_id, {_N}, sum(len) AS total, sum(CASE WHEN class_id = 1 THEN y * len END) / sum(CASE WHEN class_id = 1 THEN len END) AS head_y,
  sum(CASE WHEN class_id > 0 THEN conf * len END) / sum(CASE WHEN class_id > 0 THEN len END) / 255.0::DOUBLE AS mean_conf FROM v_cells GROUP BY 1, 2),
tm AS (SELECT dataset, example_id, quantile_cont(y, 0.5) AS torso_y FROM (SELECT dataset, example_id, y, unnest(range(len)) FROM v_cells WHERE class_id IN (3, 4, 5)) GROUP BY 1, 2),
p AS (SELECT p0.*, {_FG} AS fg, {_REG} AS n_regions, {_MAX} AS largest, ({_FG}) / total AS fg_ratio, torso_y FROM p0 LEFT JOIN tm ON tm.dataset = p0.dataset AND tm.example_id = p0.example_id)"""
_PAIRS = dims.LR_PAIRS


def _any(ids):
    return "(" + " OR ".join(f"n_{i} > 0" for i in ids) + ")"


def _why(rules):
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in rules) + "], lambda x: x IS NOT NULL), '|')"


_K5 = [
    ("low_foreground", "fg_ratio < 0.95"), ("no_foreground", "fg = 0"), ("too_few_regions", "fg > 0 AND n_regions < 9"),
    ("missing_head", "fg > 0 AND n_1 = 0"), ("missing_torso", "fg > 0 AND NOT " + _any((3, 4, 5))),
    *[(f"single_region_dominates({dims.CLASS_NAMES[i]})", f"fg > 0 AND n_{i} / fg > 0.25") for i in _IDS],
    ("head_below_torso", "fg > 0 AND head_y >= torso_y"),
    ("lr_asymmetry", "fg > 0 AND (" + " OR ".join(f"(n_{a} > 0 AND n_{b} > 0 AND abs(n_{a} - n_{b}) / greatest(n_{a}, n_{b}) > 0.8)" for a, b in _PAIRS) + ")"),
    ("class_size_outlier", "fg > 0 AND (" + " OR ".join(f"coalesce(n_{i} > 0 AND abs(n_{i} / fg - (SELECT mean FROM ref WHERE class_id = {i})) / (SELECT nullif(std, 0) FROM ref WHERE class_id = {i}) > 2.5, FALSE)" for i in _IDS) + ")"),
]
_REF = """
fr AS (SELECT dataset, example_id, class_id, sum(len) AS n FROM v_cells WHERE class_id > 0 GROUP BY ALL),
fr2 AS (SELECT class_id, n / sum(n) OVER (PARTITION BY dataset, example_id) AS frac FROM fr),
ref AS (SELECT class_id, round_even(avg(frac), 5) AS mean, round_even(stddev_pop(frac), 5) AS std FROM fr2 GROUP BY 1)"""
_K5_SQL = f"WITH {_PROFILE}, {_REF}, k AS (SELECT dataset, example_id, round(fg_ratio, 6) AS fg_ratio, n_regions, {_why(_K5)} AS reasons FROM p)"


def _judged(t):
    rules = Q.MaskRules(min_regions=9, max_single_region=0.25, min_foreground=0.95, drop_head_below_torso=True, max_lr_asymmetry=0.8, class_size_sigma=2.5)
    return Q.mask_quality_reasons(t.v_cells, rules, reference=M.class_size_reference(t.v_cells))


@query(_K5_SQL + "SELECT * FROM k")
def mask_quality_reasons(t):
    return _judged(t).withColumns({"fg_ratio": F.round("fg_ratio", 6), "reasons": F.array_join("reasons", "|")})


@query(_K5_SQL + """SELECT dataset, count(*) AS total, count(*) FILTER (reasons = '') AS passed, count(*) FILTER (reasons <> '') AS rejected,
 round_even(count(*) FILTER (reasons <> '') / count(*), 4) AS reject_rate FROM k GROUP BY 1""")
def mask_quality_summary(t):
    return Q.quality_summary(_judged(t))


_ASYM = "coalesce(greatest(" + ", ".join(f"CASE WHEN greatest(n_{a}, n_{b}) > 0 THEN abs(n_{a} - n_{b}) / greatest(n_{a}, n_{b}) END" for a, b in _PAIRS) + "), 0)"
_AUDIT = f"""WITH {_PROFILE}, a AS (SELECT dataset, example_id, coalesce(mean_conf, -1) AS mean_conf, CASE WHEN fg > 0 THEN largest / fg ELSE 0 END AS largest_frac, n_regions AS n_classes,
  CAST(CASE WHEN n_1 > 0 AND {_any((3, 4, 5))} THEN CASE WHEN head_y < torso_y THEN 1 ELSE 0 END ELSE 0 END AS INT) AS head_above_torso, {_ASYM} AS lr_asymmetry, n_1 > 0 AND {_any((3, 4, 5))} AS both_parts, fg FROM p),
b AS (SELECT *, CASE WHEN fg = 0 THEN 1 ELSE CASE WHEN mean_conf >= 0 THEN (1 - mean_conf) * 6e-1 ELSE 0 END + greatest(0, largest_frac - 5e-1) + greatest(0, 6 - n_classes) * 15e-2
  + CASE WHEN both_parts THEN (1 - head_above_torso) * 6e-1 ELSE 0 END + greatest(0, lr_asymmetry - 7e-1) * 5e-1 END AS badness FROM a)"""


def _audit(t):
    out = Q.audit_badness(t.v_cells, confidence="conf")
    return out.drop("disconn_count").withColumns({c: F.round(c, 6) for c in ("mean_conf", "largest_frac", "lr_asymmetry", "badness")})


_AUDIT_COLS = "dataset, example_id, round(mean_conf, 6) AS mean_conf, round(largest_frac, 6) AS largest_frac, n_classes, head_above_torso, round(lr_asymmetry, 6) AS lr_asymmetry, round(badness, 6) AS badness"


@query(_AUDIT + f"SELECT {_AUDIT_COLS} FROM b")
def audit_badness(t):
    return _audit(t)


@query(_AUDIT + f"SELECT {_AUDIT_COLS} FROM b ORDER BY round(badness, 6) DESC, example_id LIMIT 30")
def worst_n(t):
    return Q.worst_n(_audit(t), "badness", 30)


_ARMS, _LEGS = (*dims.ARM_L, *dims.ARM_R), (*dims.LEG_L, *dims.LEG_R)
_TRI = [
    ("very_small_foreground", "fg_ratio < 0.05", 0.5), ("small_foreground", "fg_ratio >= 0.05 AND fg_ratio < 0.1", 0.2), ("foreground_fills_image", "fg_ratio > 0.9", 0.3),
    ("too_few_regions", "n_regions < 3", 0.6), ("few_regions", "n_regions >= 3 AND n_regions < 5", 0.2), ("missing_head", "n_1 = 0", 0.3), ("missing_chest", "n_3 = 0", 0.3),
    ("missing_arms", "NOT " + _any(_ARMS), 0.2), ("missing_legs", "NOT " + _any(_LEGS), 0.15),
    *[(f"too_large({dims.CLASS_NAMES[i]})", f"fg > 0 AND n_{i} / fg > 0.5", 0.25) for i in _IDS if i not in (20, 21)],
    ("head_extremely_small", "n_1 > 0 AND n_1 / fg < 0.01", 0.15),
    ("asymmetric_arms", f"{_any(dims.ARM_L)} <> {_any(dims.ARM_R)}", 0.05), ("asymmetric_legs", f"{_any(dims.LEG_L)} <> {_any(dims.LEG_R)}", 0.05),
]
_PEN = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for _, c, w in _TRI)
_TRI_WHY = [(k, c) for k, c, _ in _TRI] + [("low_confidence", "fg > 0 AND mean_conf < 0.3"), ("moderate_confidence", "fg > 0 AND mean_conf >= 0.3 AND mean_conf < 0.5")]


@query(f"""WITH {_PROFILE}, s AS (SELECT *, greatest(0, 1 - ({_PEN})) AS s0 FROM p WHERE NOT (dataset = 'ds1' AND mod(example_id, 7) = 0)),
d AS (SELECT dataset, example_id, round(CAST(CASE WHEN fg > 0 AND mean_conf < 0.3 THEN greatest(0, s0 - 0.3) WHEN fg > 0 AND mean_conf < 0.5 THEN greatest(0, s0 - 0.1) WHEN fg > 0 AND mean_conf > 0.8 THEN least(1, s0 + 0.1) ELSE s0 END AS DOUBLE), 6) AS score,
 {_why(_TRI_WHY)} AS reasons FROM s)
SELECT *, CASE WHEN score >= 0.7 THEN 'accept' WHEN score <= 0.3 THEN 'reject' ELSE 'review' END AS decision FROM d""")
def triage(t):
    cells = t.v_cells
    reviewed = cells.where("dataset = 'ds1' AND example_id % 7 = 0")
    out = Q.triage(cells, confidence="conf", reviewed=reviewed)
    return out.withColumn("reasons", F.array_join("reasons", "|"))


_ANAT = f"""WITH {_PROFILE}, a AS (SELECT dataset, example_id, {_any((3, 4, 5))} AS has_torso, {_any((1, 2))} AS has_head, {_any(_ARMS)} AS has_arms, {_any(_LEGS)} AS has_legs, n_regions AS num_regions, fg_ratio FROM p),
s AS (SELECT *, CASE WHEN has_torso THEN 1e0 ELSE 0 END + CASE WHEN has_head THEN 5e-1 ELSE 0 END + CASE WHEN has_arms THEN 3e-1 ELSE 0 END + CASE WHEN has_legs THEN 3e-1 ELSE 0 END
  + least(num_regions / 20.0::DOUBLE, 5e-1) + least(fg_ratio / 3e-1, 4e-1) AS score FROM a)
SELECT * REPLACE (round_even(fg_ratio, 3) AS fg_ratio, round_even(score, 3) AS score), CASE WHEN NOT has_torso THEN 'no_torso' WHEN score < 2.95 THEN 'low_score' END AS reason FROM s"""


@query(_ANAT)
def anatomy_score(t):
    return Q.anatomy_score(t.v_cells, 2.95)


@query(_ANAT + " ORDER BY reason IS NOT NULL, score, example_id")
def mapping_review_order(t):
    return Q.mapping_review_order(Q.anatomy_score(t.v_cells, 2.95))


_CRIT = " + ".join(f"CAST({_any(g)} AS INT)" for g in [(1,), (3,), (5,), (7, 8, 9), (11, 12, 13), dims.LEG_L, dims.LEG_R])
_SYM = "[" + ", ".join(f"CASE WHEN greatest(n_{a}, n_{b}) > 0 THEN least(n_{a}, n_{b}) / greatest(n_{a}, n_{b}) END" for a, b in _PAIRS) + "]"


@query(f"""WITH {_PROFILE}, c AS (SELECT dataset, example_id, n_regions AS num_regions, fg_ratio, ({_CRIT}) / 7.0::DOUBLE AS critical_score, coalesce(list_avg({_SYM}), 0) AS symmetry,
  CASE WHEN fg > 0 THEN 1 - largest / fg ELSE 0 END AS balance FROM p)
SELECT dataset, example_id, num_regions, round_even(fg_ratio, 4) AS fg_ratio, round_even(critical_score, 3) AS critical_score, round_even(symmetry, 3) AS symmetry, round_even(balance, 3) AS balance,
 round_even(3e-1 * critical_score + 25e-2 * least(num_regions / 15.0::DOUBLE, 1) + 2e-1 * symmetry + 15e-2 * balance + 1e-1 * CASE WHEN fg_ratio < 0.1 THEN fg_ratio / 1e-1 WHEN fg_ratio > 0.7 THEN (1 - fg_ratio) / 3e-1 ELSE 1 END, 4) AS composite FROM c""")
def composite_score(t):
    return Q.composite_score(t.v_cells)


_DOM = "CASE " + " ".join(f"WHEN fg > 0 AND n_{i} / fg > 0.2 THEN {i}" for i in _IDS) + " END"


@query(f"WITH {_PROFILE} SELECT dataset, example_id, fg = 0 OR n_regions >= 2 AS unique_ok, {_DOM} IS NULL AS dominance_ok, CAST({_DOM} AS INT) AS dominant_class FROM p")
def mask_checks(t):
    return Q.mask_checks(t.v_cells, 0.2)


@query("""
WITH g AS (SELECT example_id, CAST(sum(len) AS BIGINT) AS fg, max(x0 + len - 1) - min(x0) + 1 AS bw, max(y) - min(y) + 1 AS bh FROM v_runs GROUP BY 1)
SELECT example_id, fg AS fg_pixels, round_even(100.0::DOUBLE * fg / 4096, 2) AS fg_percent, CASE WHEN fg >= 440 THEN round_even(fg / (bw * bh), 3) END AS fill_ratio,
 CASE WHEN fg >= 440 THEN round_even(bh / bw, 2) END AS aspect_ratio,
 array_to_string(list_filter([CASE WHEN fg < 440 THEN 'fg_pixels' END, CASE WHEN fg >= 440 AND 100.0 * fg / 4096 < 12 THEN 'fg_percent' END, CASE WHEN fg >= 440 AND fg / (bw * bh) < 0.15 THEN 'fill_ratio' END,
   CASE WHEN fg >= 440 AND bh / bw > 1 THEN 'aspect_ratio' END], lambda x: x IS NOT NULL), '|') AS reasons,
 fg < 440 OR 100.0 * fg / 4096 < 12 OR fg / (bw * bh) < 0.15 OR bh / bw > 1 AS is_bad FROM g""")
def render_sanity(t):
    out = Q.render_sanity(t.v_runs, 64, 64, min_fg=440, min_percent=12.0, max_aspect=1.0)
    return out.withColumn("reasons", F.array_join("reasons", "|"))


_PX = "SELECT example_id, CASE WHEN mod(example_id, 5) = 0 THEN 7 ELSE mod(y * 7, 256) END AS r, CASE WHEN mod(example_id, 5) = 0 THEN 12 ELSE mod(x0, 256) END AS g, CASE WHEN mod(example_id, 5) = 0 THEN 200 ELSE mod(y + x0, 256) END AS b, len FROM v_cells WHERE class_id > 0"


@query(f"""
WITH px AS ({_PX}), e AS (SELECT example_id, sum(len) AS fg, sum(len * r) AS sr, sum(len * g) AS sg, sum(len * b) AS sb, sum(len * r * r) AS qr, sum(len * g * g) AS qg, sum(len * b * b) AS qb, sum(CASE WHEN b / 255 > 0.6 THEN len ELSE 0 END) AS front FROM px GROUP BY 1),
tp AS (SELECT example_id, max(k) AS top FROM (SELECT example_id, r // 16 AS a, g // 16 AS c, b // 16 AS d, sum(len) AS k FROM px GROUP BY ALL) GROUP BY 1),
m AS (SELECT e.*, top / fg AS dom, (sqrt(greatest(0, qr / fg - pow(sr / fg, 2))) + sqrt(greatest(0, qg / fg - pow(sg / fg, 2))) + sqrt(greatest(0, qb / fg - pow(sb / fg, 2)))) / 3 AS sd FROM e JOIN tp ON tp.example_id = e.example_id),
r AS (SELECT *, CASE WHEN fg < 300 THEN 'too_few_fg_pixels' WHEN dom > 0.8 AND sd < 15 THEN 'dominant_color;low_std' WHEN dom > 0.8 THEN 'dominant_color' WHEN sd < 15 THEN 'low_std' ELSE '' END AS reject_reason FROM m)
SELECT example_id, CAST(fg AS BIGINT) AS fg_pixels, reject_reason = '' AS passed, reject_reason, CASE WHEN fg >= 300 THEN round_even(dom, 4) END AS dominant_color_ratio, CASE WHEN fg >= 300 THEN round_even(sd, 2) END AS mean_std,
 CASE WHEN fg >= 300 THEN round_even(sr / fg / 127.5::DOUBLE - 1, 4) END AS mean_normal_r, CASE WHEN fg >= 300 THEN round_even(sg / fg / 127.5::DOUBLE - 1, 4) END AS mean_normal_g, CASE WHEN fg >= 300 THEN round_even(sb / fg / 127.5::DOUBLE - 1, 4) END AS mean_normal_b,
 CASE WHEN fg >= 300 THEN round_even(front / fg, 4) END AS front_facing_ratio FROM r""")
def normal_map_quality(t):
    return Q.normal_map_quality(t.sql(_PX), min_fg=300)


_WANT = "SELECT DISTINCT example_id FROM v_cells UNION ALL SELECT DISTINCT example_id + 1000000000 FROM v_cells WHERE dataset = 'ds2'"
_RAST = "SELECT example_id, len, CASE WHEN mod(example_id, 4) = 0 THEN 0 WHEN mod(example_id, 4) = 1 THEN 200 ELSE z END AS v0 FROM v_cells"


def _degenerate_sql(flat):
    return f"""WITH want AS ({_WANT}), r AS ({_RAST}), g AS (SELECT example_id, max(v0) AS top, stddev_pop(v0) AS sd FROM (SELECT example_id, v0, unnest(range(len)) FROM r) GROUP BY 1)
SELECT want.example_id, CASE WHEN g.example_id IS NULL THEN 'missing' WHEN {flat} THEN 'degenerate' ELSE 'ok' END AS state FROM want LEFT JOIN g ON g.example_id = want.example_id"""


@query(_degenerate_sql("top = 0 OR sd < 1"))
def degenerate_raster(t):
    return Q.degenerate_raster(t.sql(_WANT), t.sql(_RAST))


@query(_degenerate_sql("top < 10 OR sd < 5"))
def degenerate_raster_strict(t):
    return Q.degenerate_raster(t.sql(_WANT), t.sql(_RAST), strict=True)


@query("""
SELECT dataset, example_id, CAST(10 * max(CAST(class_id = 9 AS INT)) + 10 * max(CAST(class_id = 16 AS INT)) + CASE WHEN count(DISTINCT CASE WHEN class_id > 0 THEN class_id END) < 6 THEN 5 ELSE 0 END
 + CAST(floor(20 * (1 - sum(conf * len) / sum(len) / 255.0::DOUBLE)) AS BIGINT) AS BIGINT) AS priority FROM v_cells GROUP BY 1, 2""")
def annotation_priority(t):
    return Q.annotation_priority(t.v_cells, [9, 16], "conf")


_JOINTS = "SELECT example_id, CASE WHEN class_id = 21 THEN 'tail' ELSE class_name END AS joint FROM (SELECT v.example_id, v.class_id, c.class_name FROM v_cells v JOIN v_classes c ON c.class_id = v.class_id) j"


@query(f"""
WITH j AS ({_JOINTS}), x(joint) AS (VALUES {", ".join(f"('{j}')" for j in dims.JOINT_NAMES)}),
e AS (SELECT example_id, count(DISTINCT joint) AS n_joints, count(DISTINCT CASE WHEN joint NOT IN (SELECT joint FROM x) THEN joint END) AS n_unexpected FROM j GROUP BY 1),
m AS (SELECT e.example_id, string_agg(x.joint, '|' ORDER BY x.joint) AS missing FROM e CROSS JOIN x WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.example_id = e.example_id AND j.joint = x.joint) GROUP BY 1)
SELECT e.example_id, n_joints, coalesce(missing, '') AS missing, n_unexpected, n_joints = 19 AND missing IS NULL AS passed FROM e LEFT JOIN m ON m.example_id = e.example_id""")
def joint_set_check(t):
    return Q.joint_set_check(t.sql(_JOINTS), dims.JOINT_NAMES).withColumn("missing", F.array_join("missing", "|"))


@query("SELECT example_id, joint, x, y FROM v_joints WHERE visible AND (x < 0 OR x >= img_w OR y < 0 OR y >= img_h)")
def joint_bounds_check(t):
    return Q.joint_bounds_check(t.v_joints)


# --- components ---
_COMP = """
ids AS (SELECT *, y * 1000 + x0 AS id FROM v_runs),
adj AS (SELECT a.example_id, a.id AS a, b.id AS b FROM ids a JOIN ids b ON a.example_id = b.example_id AND a.class_id = b.class_id AND a.id <> b.id AND
  ((b.y = a.y AND (b.x0 = a.x0 + a.len OR a.x0 = b.x0 + b.len)) OR (abs(b.y - a.y) = 1 AND b.x0 < a.x0 + a.len AND a.x0 < b.x0 + b.len))),
reach AS (SELECT example_id, id, id AS root FROM ids UNION SELECT r.example_id, adj.b, r.root FROM reach r JOIN adj ON adj.example_id = r.example_id AND adj.a = r.id WHERE adj.b > r.root),
lab AS (SELECT example_id, id, min(root) AS root FROM reach GROUP BY 1, 2),
lr AS (SELECT ids.*, lab.root FROM ids JOIN lab ON lab.example_id = ids.example_id AND lab.id = ids.id)"""


@query(f"""WITH RECURSIVE {_COMP} SELECT dataset, example_id, class_id, CAST(root // 1000 AS INT) AS root_y, CAST(root % 1000 AS INT) AS root_x, CAST(sum(len) AS BIGINT) AS area,
 min(x0) AS x_min, min(y) AS y_min, CAST(max(x0 + len - 1) AS INT) AS x_max, max(y) AS y_max FROM lr GROUP BY 1, 2, 3, 4, 5""")
def connected_components(t):
    return C.component_table(C.label_runs(t.v_runs))


@query(f"""WITH RECURSIVE {_COMP} SELECT dataset, example_id, class_id, CAST(root // 1000 AS INT) AS root_y, CAST(root % 1000 AS INT) AS root_x, CAST(sum(len) AS BIGINT) AS area,
 min(x0) AS x_min, min(y) AS y_min, CAST(max(x0 + len - 1) AS INT) AS x_max, max(y) AS y_max FROM lr GROUP BY 1, 2, 3, 4, 5""")
def connected_components_tiled(t):
    """The same components from tiles of 16 x 16, merged across their borders."""
    return C.component_table(C.label_runs(t.v_runs, 16))


@query(f"WITH RECURSIVE {_COMP} SELECT dataset, example_id, class_id, count(DISTINCT root) AS components FROM lr GROUP BY 1, 2, 3")
def component_counts(t):
    return C.component_counts(C.label_runs(t.v_runs))


@query(f"""WITH RECURSIVE {_COMP}, ar AS (SELECT example_id, root, sum(len) AS area FROM lr GROUP BY 1, 2),
cells AS (SELECT lr.example_id, root, y, CAST(x0 + unnest(range(len)) AS INT) AS x FROM lr),
sm AS (SELECT cells.* FROM cells JOIN ar ON ar.example_id = cells.example_id AND ar.root = cells.root WHERE area < 12),
nb AS (SELECT DISTINCT sm.example_id, sm.root, sm.y + dy AS y, sm.x + dx AS x FROM sm, (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) AS s(dy, dx) WHERE sm.y + dy BETWEEN 0 AND 63 AND sm.x + dx BETWEEN 0 AND 63),
ou AS (SELECT nb.* FROM nb LEFT JOIN sm ON sm.example_id = nb.example_id AND sm.root = nb.root AND sm.y = nb.y AND sm.x = nb.x WHERE sm.x IS NULL),
cc AS (SELECT lr.example_id, class_id, y, CAST(x0 + unnest(range(len)) AS INT) AS x FROM lr),
vt AS (SELECT ou.example_id, ou.root, coalesce(class_id, 0) AS c, count(*) AS v FROM ou LEFT JOIN cc ON cc.example_id = ou.example_id AND cc.y = ou.y AND cc.x = ou.x GROUP BY 1, 2, 3),
wn AS (SELECT example_id, root, c FROM vt QUALIFY row_number() OVER (PARTITION BY example_id, root ORDER BY v DESC, c) = 1)
SELECT lr.dataset, lr.example_id, lr.y, lr.x0, lr.len, CAST(coalesce(wn.c, lr.class_id) AS INT) AS class_id FROM lr LEFT JOIN wn ON wn.example_id = lr.example_id AND wn.root = lr.root""")
def absorb_small_components(t):
    return C.absorb_small_components(t.v_runs, 64, 64, min_area=12)


_OVL = """ov AS (SELECT m.example_id, sum(least(m.x0 + m.len, a.x0 + a.len) - greatest(m.x0, a.x0)) AS covered FROM v_runs m JOIN v_alpha a ON a.example_id = m.example_id AND a.y = m.y AND a.x0 < m.x0 + m.len AND m.x0 < a.x0 + a.len GROUP BY 1),
al AS (SELECT example_id, sum(len) AS alpha FROM v_alpha GROUP BY 1)"""
_RN = ", ".join(f"sum(CASE WHEN class_id = {i} THEN len ELSE 0 END) AS n_{i}" for i in _IDS)
_K5R = [
    ("low_foreground", "fg / 4096 < 0.12"), ("too_few_regions", "n_regions < 17"), ("missing_head", "n_1 = 0"), ("missing_torso", "NOT " + _any((3, 4, 5))),
    *[(f"single_region_dominates({dims.CLASS_NAMES[i]})", f"n_{i} / fg > 0.2") for i in _IDS],
    ("disconn_blobs", "worst > 14"), ("bg_bleed", "(fg - covered) / fg > 0.55"), ("low_coverage", "alpha > 0 AND covered / alpha < 0.25"),
]


@query(f"""WITH RECURSIVE {_COMP}, cw AS (SELECT example_id, max(k) AS worst FROM (SELECT example_id, class_id, count(DISTINCT root) AS k FROM lr GROUP BY 1, 2) AS z GROUP BY 1), {_OVL},
pf AS (SELECT dataset, example_id, {_RN}, sum(len) AS fg FROM v_runs GROUP BY 1, 2), pr AS (SELECT pf.*, {_REG} AS n_regions, worst, coalesce(covered, 0) AS covered, coalesce(alpha, 0) AS alpha FROM pf LEFT JOIN cw ON cw.example_id = pf.example_id LEFT JOIN ov ON ov.example_id = pf.example_id LEFT JOIN al ON al.example_id = pf.example_id)
SELECT dataset, example_id, round(fg / 4096, 6) AS fg_ratio, n_regions, {_why(_K5R)} AS reasons FROM pr""")
def mask_silhouette_reasons(t):
    """The fragment, bleed and coverage rules on run masks with their silhouettes."""
    from maskloom.operators.layers import silhouette_overlap

    runs, alpha = cut(t.v_runs), cut(t.v_alpha)  # read by several rules
    overlap = silhouette_overlap(runs, alpha).withColumn("dataset", F.concat(F.lit("ds"), (F.col("example_id") % 4).cast("string")))
    rules = Q.MaskRules(min_regions=17, max_single_region=0.2, min_foreground=0.12, max_disconn_per_class=14, max_bg_bleed=0.55, min_silhouette_coverage=0.25)
    out = Q.mask_quality_reasons(runs, rules, C.component_counts(C.label_runs(runs)), overlap, total_pixels=4096)
    return out.withColumns({"fg_ratio": F.round("fg_ratio", 6), "reasons": F.array_join("reasons", "|")})
