"""Queries over motion clips."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom.operators import series as S
from maskloom.plans.catalog import query

_R6 = lambda df, *cols: df.withColumns({c: F.round(c, 6) for c in cols})

_VEL = """
v AS (SELECT clip, frame, frame_time, CASE WHEN frame = 0 THEN 0 ELSE sqrt(pow(px - lag(px) OVER w, 2) + pow(py - lag(py) OVER w, 2) + pow(pz - lag(pz) OVER w, 2)) / frame_time END AS speed,
   count(*) OVER (PARTITION BY clip) AS n FROM v_root WINDOW w AS (PARTITION BY clip ORDER BY frame)),
vel AS (SELECT clip, frame, frame_time, speed, lag(speed) OVER (PARTITION BY clip ORDER BY frame) AS prev_speed FROM v WHERE n >= 2)"""
_SUM = _VEL + """,
cs AS (SELECT clip, round_even(count(*) * first(frame_time), 4) AS duration_seconds, count(*) AS frame_count, round_even(1.0 / first(frame_time), 2) AS frame_rate,
  round_even(avg(speed), 4) AS root_velocity_mean, round_even(max(speed), 4) AS root_velocity_max, round_even(min(speed), 4) AS root_velocity_min,
  round_even(count(*) FILTER (speed >= 0.1 AND speed > prev_speed) / count(*), 4) AS acceleration_ratio,
  round_even(count(*) FILTER (speed >= 0.1 AND speed < prev_speed) / count(*), 4) AS deceleration_ratio,
  round_even(count(*) FILTER (speed < 0.1) / count(*), 4) AS hold_ratio FROM vel GROUP BY clip)"""


@query(f"WITH {_VEL} SELECT clip, frame, round(speed, 6) AS speed, round(prev_speed, 6) AS prev_speed FROM vel")
def root_velocity(t):
    return _R6(S.root_velocity(t.v_root), "speed", "prev_speed").drop("frame_time")


@query(f"""WITH {_VEL} SELECT clip, count(*) FILTER (speed < 30) AS hold_frames, count(*) FILTER (speed >= 30 AND speed > prev_speed) AS accel_frames, count(*) FILTER (speed >= 30 AND speed < prev_speed) AS decel_frames,
 round_even(count(*) FILTER (speed < 30) / count(*), 4) AS hold_ratio, round_even(count(*) FILTER (speed >= 30 AND speed > prev_speed) / count(*), 4) AS accel_ratio,
 round_even(count(*) FILTER (speed >= 30 AND speed < prev_speed) / count(*), 4) AS decel_ratio FROM vel GROUP BY clip""")
def timing_phases(t):
    return S.timing_phases(S.root_velocity(t.v_root), hold=30.0)


@query(f"WITH {_SUM} SELECT * FROM cs")
def clip_summary(t):
    return S.clip_summary(t.v_root)


@query(f"""WITH {_SUM}, l AS (SELECT l.action, cs.* FROM v_clip_labels l JOIN cs ON cs.clip = l.clip),
u AS (UNPIVOT (SELECT action, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in S.NORM_COLUMNS)} FROM l) ON {", ".join(S.NORM_COLUMNS)} INTO NAME statistic VALUE value)
SELECT action, statistic, count(*) AS clips, round_even(avg(value), 4) AS mean, round_even(stddev_pop(value), 4) AS std, round_even(min(value), 4) AS min, round_even(max(value), 4) AS max FROM u GROUP BY 1, 2""")
def action_norms(t):
    return S.action_norms(S.label_clips(S.clip_summary(t.v_root), t.v_clip_labels))


@query(f"WITH {_SUM} SELECT l.clip, l.action, l.quality, cs.frame_count, cs.root_velocity_mean FROM v_clip_labels l JOIN cs ON cs.clip = l.clip")
def clip_label_join(t):
    return S.label_clips(S.clip_summary(t.v_root), t.v_clip_labels).select("clip", "action", "quality", "frame_count", "root_velocity_mean")


@query("""SELECT action, count(*) AS skipped FROM v_clip_labels WHERE clip NOT IN (SELECT clip FROM v_root WHERE frame = 1) GROUP BY 1""")
def missing_clips(t):
    return S.missing_clips(t.v_clip_labels, t.v_root)


@query("""
WITH a AS (SELECT clip, bone, frame, CASE WHEN frame = 0 THEN 0 ELSE sqrt(pow(rx - lag(rx) OVER w, 2) + pow(ry - lag(ry) OVER w, 2) + pow(rz - lag(rz) OVER w, 2)) / (1.0::DOUBLE / 30) END AS s,
  count(*) OVER (PARTITION BY clip, bone) AS n FROM v_frames WINDOW w AS (PARTITION BY clip, bone ORDER BY frame))
SELECT clip, bone, round_even(avg(s), 4) AS mean, round_even(max(s), 4) AS max, round_even(min(s), 4) AS min FROM a WHERE n >= 2 GROUP BY 1, 2""")
def joint_angular_velocity(t):
    return S.joint_angular_velocity(t.v_frames)


_F = "f AS MATERIALIZED (SELECT clip, frame, bone, rx, ry, rz FROM v_frames), n AS (SELECT clip, max(frame) + 1 AS n FROM f GROUP BY 1)"
_W = "WINDOW w AS (PARTITION BY clip, bone ORDER BY frame)"
_LONG_OK = "clip IN (SELECT clip FROM n WHERE n >= 4)"
_RNG = "r AS (SELECT clip, bone, max(rx) - min(rx) AS gx, max(ry) - min(ry) AS gy, max(rz) - min(rz) AS gz FROM f GROUP BY 1, 2)"


def _ext(c, g):
    return f"({g} > 1 AND (({c} >= lag({c}) OVER w AND {c} >= lead({c}) OVER w) OR ({c} <= lag({c}) OVER w AND {c} <= lead({c}) OVER w)))"


_EXT = f"""
{_RNG}, x AS (SELECT f.clip, f.frame, coalesce({_ext('rx', 'gx')}, FALSE) OR coalesce({_ext('ry', 'gy')}, FALSE) OR coalesce({_ext('rz', 'gz')}, FALSE) AS hit
  FROM f JOIN r ON r.clip = f.clip AND r.bone = f.bone WINDOW w AS (PARTITION BY f.clip, f.bone ORDER BY f.frame)),
k1 AS (SELECT clip, frame FROM x WHERE hit UNION SELECT clip, 0 FROM n UNION SELECT clip, n - 1 FROM n),
kc AS (SELECT k1.clip, count(*) AS k, first(n.n) AS n FROM k1 JOIN n ON n.clip = k1.clip GROUP BY 1),
kept AS (SELECT * FROM k1 UNION SELECT clip, unnest(range(0, n, greatest(1, n // 20))) FROM kc WHERE k < 20)"""


@query(f"WITH {_F}, {_EXT} SELECT clip, CAST(frame AS INT) AS frame FROM kept")
def extreme_frames(t):
    return S.extreme_frames(t.v_frames, min_keyframes=20)


def _lin(k):
    return f"""
s AS (SELECT f.clip, f.frame, f.bone, CAST(CASE WHEN f.frame = n - 1 THEN n - 1 ELSE f.frame // {k} * {k} END AS INT) AS a, least(CAST(f.frame // {k} * {k} + {k} AS INT), n - 1) AS b FROM f JOIN n ON n.clip = f.clip),
lin AS (SELECT s.clip, s.frame, s.bone, p.rx + (q.rx - p.rx) * tt AS rx, p.ry + (q.ry - p.ry) * tt AS ry, p.rz + (q.rz - p.rz) * tt AS rz
  FROM (SELECT *, CASE WHEN b > a THEN (frame - a) / (b - a) ELSE 0 END AS tt FROM s) s
  JOIN f p ON p.clip = s.clip AND p.bone = s.bone AND p.frame = s.a JOIN f q ON q.clip = s.clip AND q.bone = s.bone AND q.frame = s.b)"""


@query(f"WITH {_F}, {_lin(8)} SELECT clip, frame, bone, round(rx, 6) AS rx, round(ry, 6) AS ry, round(rz, 6) AS rz FROM lin")
def linearize_segments(t):
    return _R6(S.linearize_segments(t.v_frames, 8), *S.AXES)


# by windows: the frames of a clip side by side with the next one, then one row per sample of each interval
_ARC = """
nx AS MATERIALIZED (SELECT *, lag(rx) OVER w AS ax, lag(ry) OVER w AS ay, lag(rz) OVER w AS az, lead(rx) OVER w AS bx, lead(ry) OVER w AS b_y, lead(rz) OVER w AS bz FROM f WINDOW w AS (PARTITION BY clip, bone ORDER BY frame)),
pf AS MATERIALIZED (SELECT clip, frame, sum(coalesce(sqrt(pow(rx - ax, 2) + pow(ry - ay, 2) + pow(rz - az, 2)), 0)) AS d FROM nx GROUP BY 1, 2),
cu AS MATERIALIZED (SELECT clip, frame, sum(d) OVER (PARTITION BY clip ORDER BY frame) AS c, sum(d) OVER (PARTITION BY clip) AS total, max(frame) OVER (PARTITION BY clip) AS last FROM pf),
iv AS MATERIALIZED (SELECT *, lead(c) OVER (PARTITION BY clip ORDER BY frame) AS c1 FROM cu),
sm AS MATERIALIZED (SELECT *, CASE WHEN total < 1e-6 THEN [frame] WHEN frame = last THEN [last]
   ELSE range(CAST(ceil(round(c * last / total, 9)) AS INT), least(CAST(ceil(round(c1 * last / total, 9)) AS INT), last)) END AS samples FROM iv),
pk AS MATERIALIZED (SELECT clip, frame, CAST(unnest(samples) AS INT) AS i, c, c1, total, last FROM sm),
tt AS MATERIALIZED (SELECT clip, frame, i, CASE WHEN c1 IS NULL OR total < 1e-6 THEN 0 ELSE (total * i / last - c) / (c1 - c) END AS tt FROM pk),
arc AS (SELECT nx.clip, tt.i AS frame, bone, rx + (coalesce(bx, rx) - rx) * tt AS rx, ry + (coalesce(b_y, ry) - ry) * tt AS ry, rz + (coalesce(bz, rz) - rz) * tt AS rz FROM nx JOIN tt USING (clip, frame))"""


@query(f"WITH {_F}, {_ARC} SELECT clip, frame, bone, round(rx, 4) AS rx, round(ry, 4) AS ry, round(rz, 4) AS rz FROM arc")
def uniform_arc_resample(t):
    return S.uniform_arc_resample(t.v_frames).withColumns({c: F.round(c, 4) for c in S.AXES})


_HIPS = "max(CASE WHEN bone = 'hips' THEN {} END) OVER (PARTITION BY clip, frame)"
_LOCK = "lock AS MATERIALIZED (SELECT clip, frame, bone, " + ", ".join(f"coalesce(CASE WHEN bone IN ('spine', 'chest') THEN {_HIPS.format(c)} END, {c}) AS {c}" for c in S.AXES) + " FROM f)"


@query(f"WITH {_F}, {_LOCK} SELECT * FROM lock")
def lock_to_parent(t):
    """The spine takes the hips' rotation, then the chest takes the spine's."""
    return S.lock_to_parent(t.v_frames, ["spine", "chest"])


_DEC = "dec AS (SELECT f.clip, CAST(row_number() OVER (PARTITION BY f.clip, bone ORDER BY frame) - 1 AS INT) AS frame, bone, rx, ry, rz FROM f JOIN n ON n.clip = f.clip WHERE mod(frame, 3) = 0 OR frame = n - 1)"


@query(f"WITH {_F}, {_DEC} SELECT * FROM dec")
def decimate_frames(t):
    return S.decimate_frames(t.v_frames, 3)


def _stop(threshold):
    return f"""{_RNG},
m AS (SELECT clip, bone, frame, sqrt(pow(rx - lag(rx) OVER w, 2) + pow(ry - lag(ry) OVER w, 2) + pow(rz - lag(rz) OVER w, 2)) AS d FROM f WINDOW w AS (PARTITION BY clip, bone ORDER BY frame)),
lm AS (SELECT clip, bone, coalesce(max(frame) FILTER (d > {threshold}), 0) AS last FROM m GROUP BY 1, 2),
st AS (SELECT lm.clip, greatest(1, min(last)) AS stop FROM lm JOIN r ON r.clip = lm.clip AND r.bone = lm.bone WHERE greatest(gx, gy, gz) >= 1 GROUP BY 1),
stp AS (SELECT f.clip, f.frame, f.bone, CASE WHEN f.frame > stop THEN z.rx ELSE f.rx END AS rx, CASE WHEN f.frame > stop THEN z.ry ELSE f.ry END AS ry, CASE WHEN f.frame > stop THEN z.rz ELSE f.rz END AS rz
  FROM f LEFT JOIN st ON st.clip = f.clip LEFT JOIN f z ON z.clip = f.clip AND z.bone = f.bone AND z.frame = st.stop)"""


@query(f"WITH {_F}, {_stop(9.5)} SELECT * FROM stp")
def simultaneous_stop(t):
    return S.simultaneous_stop(t.v_frames, 9.5)


# starts of runs alternate in direction, so a run ends at the next start and the one after it at the start after that
_ANT = f"""
vx AS MATERIALIZED (SELECT clip, bone, frame, lead(rx) OVER w - rx AS x, lead(ry) OVER w - ry AS y, lead(rz) OVER w - rz AS z, max(frame) OVER (PARTITION BY clip, bone) AS n,
   max(rx) OVER (PARTITION BY clip, bone) - min(rx) OVER (PARTITION BY clip, bone) AS gx, max(ry) OVER (PARTITION BY clip, bone) - min(ry) OVER (PARTITION BY clip, bone) AS gy,
   max(rz) OVER (PARTITION BY clip, bone) - min(rz) OVER (PARTITION BY clip, bone) AS gz FROM f {_W}),
sg AS MATERIALIZED (SELECT clip, bone, 'x' AS ax, frame, sign(x) AS d, n FROM vx WHERE abs(x) >= 2 AND gx >= 2 UNION ALL SELECT clip, bone, 'y', frame, sign(y), n FROM vx WHERE abs(y) >= 2 AND gy >= 2
   UNION ALL SELECT clip, bone, 'z', frame, sign(z), n FROM vx WHERE abs(z) >= 2 AND gz >= 2),
ss AS MATERIALIZED (SELECT *, lag(d) OVER (PARTITION BY clip, bone, ax ORDER BY frame) AS pd FROM sg),
e2 AS MATERIALIZED (SELECT *, lead(frame) OVER r AS end1, coalesce(lead(frame, 2) OVER r, n) AS end2 FROM (SELECT * FROM ss WHERE pd IS NULL OR pd <> d) WINDOW r AS (PARTITION BY clip, bone, ax ORDER BY frame)),
an AS MATERIALIZED (SELECT DISTINCT clip, n, CAST(unnest(range(frame + 1, end1 + 1)) AS INT) AS frame FROM e2 WHERE end1 IS NOT NULL AND end1 - frame <= 10 AND end2 - end1 > end1 - frame),
dr AS MATERIALIZED (SELECT DISTINCT clip, frame, true AS gone FROM an WHERE frame < n),
ant AS (SELECT f.* FROM f LEFT JOIN dr USING (clip, frame) WHERE gone IS NULL)"""


@query(f"WITH {_F}, {_ANT} SELECT clip, frame, bone, rx, ry, rz FROM ant")
def drop_anticipation(t):
    return S.drop_anticipation(t.v_frames).select("clip", "frame", "bone", *S.AXES)


@query(f"""WITH {_F}, d2 AS (SELECT f.clip, CAST(ceil(frame / 2) AS INT) AS frame, bone, rx, ry, rz FROM f JOIN n ON n.clip = f.clip WHERE mod(frame, 2) = 0 OR frame = n - 1), {_lin(8)}, {_LOCK}, {_ANT}, {_ARC}, {_stop(0.5)},
x AS (SELECT f.clip, f.frame, coalesce({_ext('rx', 'gx')}, FALSE) OR coalesce({_ext('ry', 'gy')}, FALSE) OR coalesce({_ext('rz', 'gz')}, FALSE) AS hit FROM f JOIN r ON r.clip = f.clip AND r.bone = f.bone WINDOW w AS (PARTITION BY f.clip, f.bone ORDER BY f.frame)),
k1 AS MATERIALIZED (SELECT clip, frame FROM x WHERE hit UNION SELECT clip, 0 FROM n UNION SELECT clip, n - 1 FROM n),
kc AS (SELECT k1.clip, count(*) AS k, first(n.n) AS n FROM k1 JOIN n ON n.clip = k1.clip GROUP BY 1),
kept AS MATERIALIZED (SELECT * FROM k1 UNION SELECT clip, unnest(range(0, n, greatest(1, n // 3))) FROM kc WHERE k < 3), q AS (
 SELECT 'reduce_framerate' AS degradation, clip, frame, rx, ry, rz FROM d2 UNION ALL SELECT 'linearize_arcs', clip, frame, rx, ry, rz FROM lin
 UNION ALL SELECT 'remove_secondary', clip, frame, rx, ry, rz FROM lock UNION ALL SELECT 'remove_anticipation', clip, frame, rx, ry, rz FROM ant
 UNION ALL SELECT 'remove_easing', clip, frame, rx, ry, rz FROM arc UNION ALL SELECT 'simultaneous_stop', clip, frame, rx, ry, rz FROM stp
 UNION ALL SELECT 'strip_to_extremes', f.clip, f.frame, rx, ry, rz FROM f JOIN kept ON kept.clip = f.clip AND kept.frame = f.frame)
SELECT degradation, clip, count(*) AS n, CAST(max(frame) AS INT) AS last_frame, round(sum(rx + ry + rz), 3) AS checksum FROM q WHERE {_LONG_OK} GROUP BY 1, 2""")
def degradation_pairs(t):
    """All seven types; the rigs have a spine and a chest only, so these are the locked bones."""
    pairs = S.degradation_pairs(t.v_frames, remove_secondary=lambda f: S.lock_to_parent(f, ["spine", "chest"]))
    return pairs.groupBy("degradation", "clip").agg(
        F.count(F.lit(1)).alias("n"), F.max("frame").cast("int").alias("last_frame"), F.round(F.sum(F.col("rx") + F.col("ry") + F.col("rz")), 3).alias("checksum")
    )


_ROOT = "o AS MATERIALIZED (SELECT clip, frame, px, py, pz, lead(px) OVER w AS qx, lead(py) OVER w AS qy, lead(pz) OVER w AS qz FROM v_root WINDOW w AS (PARTITION BY clip ORDER BY frame))"
_R5 = lambda df: df.withColumns({c: F.round(c, 5) for c in S.PLACES})


@query("""
WITH n AS (SELECT clip, max(frame) AS last FROM v_root GROUP BY 1),
s AS (SELECT clip, frame, last, CASE WHEN frame = last THEN last ELSE frame // 8 * 8 END AS a, least(frame // 8 * 8 + 8, last) AS b FROM v_root JOIN n USING (clip)),
t AS (SELECT *, CASE WHEN b > a THEN (frame - a) / (b - a) ELSE 0 END AS t FROM s)
SELECT t.clip, t.frame, round(p.px + (q.px - p.px) * t, 5) AS px, round(p.py + (q.py - p.py) * t, 5) AS py, round(p.pz + (q.pz - p.pz) * t, 5) AS pz
FROM t JOIN v_root p ON p.clip = t.clip AND p.frame = t.a JOIN v_root q ON q.clip = t.clip AND q.frame = t.b""")
def linearize_root(t):
    return _R5(S.degrade_root(t.v_root, t.v_frames, "linearize_arcs"))


@query(f"""WITH {_F}, {_ARC}, {_ROOT}
SELECT o.clip, tt.i AS frame, round(px + (coalesce(qx, px) - px) * tt, 5) AS px, round(py + (coalesce(qy, py) - py) * tt, 5) AS py, round(pz + (coalesce(qz, pz) - pz) * tt, 5) AS pz FROM o JOIN tt USING (clip, frame)""")
def resample_root(t):
    return _R5(S.degrade_root(t.v_root, t.v_frames, "remove_easing"))


@query(f"""WITH {_F}, {_stop(0.5)}, w AS (SELECT o.*, stop, max(CASE WHEN o.frame = stop THEN px END) OVER c AS zx, max(CASE WHEN o.frame = stop THEN py END) OVER c AS zy, max(CASE WHEN o.frame = stop THEN pz END) OVER c AS zz
  FROM v_root o LEFT JOIN st ON st.clip = o.clip WINDOW c AS (PARTITION BY o.clip))
SELECT clip, frame, CASE WHEN frame > stop THEN zx ELSE px END AS px, CASE WHEN frame > stop THEN zy ELSE py END AS py, CASE WHEN frame > stop THEN zz ELSE pz END AS pz FROM w""")
def stop_root(t):
    return S.degrade_root(t.v_root, t.v_frames, "simultaneous_stop")


@query(f"""WITH {_F}, {_ANT}, {_EXT.replace("20", "3")}, rt AS (SELECT clip, frame, px, py, pz FROM v_root WHERE {_LONG_OK}), q AS (
 SELECT 'strip_to_extremes' AS degradation, rt.* FROM rt JOIN kept USING (clip, frame) UNION ALL SELECT 'remove_secondary', rt.* FROM rt
 UNION ALL SELECT 'reduce_framerate', clip, CAST(ceil(frame / 2) AS INT), px, py, pz FROM rt JOIN n USING (clip) WHERE mod(frame, 2) = 0 OR frame = n - 1
 UNION ALL SELECT 'remove_anticipation', rt.* FROM rt LEFT JOIN dr USING (clip, frame) WHERE gone IS NULL)
SELECT degradation, clip, count(*) AS n, CAST(max(frame) AS INT) AS last_frame, round(sum(px + 2 * py + 3 * pz), 3) AS checksum FROM q GROUP BY 1, 2""")
def root_pairs(t):
    """The degradations that choose frames; the other three have queries of their own."""
    pairs = S.root_pairs(t.v_root, t.v_frames, ["strip_to_extremes", "remove_secondary", "reduce_framerate", "remove_anticipation"])
    total = F.col("px") + 2 * F.col("py") + 3 * F.col("pz")
    return pairs.groupBy("degradation", "clip").agg(F.count(F.lit(1)).alias("n"), F.max("frame").cast("int").alias("last_frame"), F.round(F.sum(total), 3).alias("checksum"))


@query("""
WITH d AS (SELECT clip, bone, max(greatest(abs(rx - bx), abs(ry - b_y), abs(rz - bz))) > 1 AS active FROM (SELECT *, first_value(rx) OVER w AS bx, first_value(ry) OVER w AS b_y, first_value(rz) OVER w AS bz
  FROM v_frames WINDOW w AS (PARTITION BY clip, bone ORDER BY frame)) GROUP BY 1, 2)
SELECT clip, count(*) FILTER (bone = 'hips') AS mapped, count(*) FILTER (bone <> 'hips') AS unmapped,
 coalesce(string_agg(bone, '|' ORDER BY bone) FILTER (active AND bone <> 'hips'), '') AS active_unmapped, count(*) FILTER (active AND bone <> 'hips') = 0 AS compatible FROM d GROUP BY 1""")
def motion_compatibility(t):
    out = S.motion_compatibility(t.v_frames, ["hips"])
    return out.withColumn("active_unmapped", F.array_join("active_unmapped", "|"))


@query("""
WITH p AS (SELECT clip, frame, bone, rx AS x, ry AS y, rz AS z FROM v_frames),
sp AS (SELECT clip, min(frame) AS f0, max(frame) AS f1 FROM p GROUP BY 1),
s AS (SELECT p.*, f0 FROM p JOIN sp ON sp.clip = p.clip WHERE mod(frame - f0, 4) = 0 OR frame = f1),
t AS (SELECT s.*, sqrt(pow(s.x - q.x, 2) + pow(s.y - q.y, 2) + pow(s.z - q.z, 2)) AS mv FROM s JOIN p q ON q.clip = s.clip AND q.bone = s.bone AND q.frame = s.f0),
g AS (SELECT clip, frame, f0, max(z) - min(z) AS h, max(x) - min(x) AS w, max(mv) AS tr FROM t GROUP BY 1, 2, 3),
b AS (SELECT g.*, g0.h AS h0, g0.w AS w0 FROM g JOIN g g0 ON g0.clip = g.clip AND g0.frame = g.f0),
r AS (SELECT clip, frame, CASE WHEN h0 < 1e-6 THEN 'near_zero_rest_height' WHEN frame = f0 THEN NULL WHEN abs(h - h0) / h0 > 0.2 THEN 'height_changed'
  WHEN w0 > 1e-6 AND abs(w - w0) / w0 > 1 THEN 'width_changed' WHEN tr > h0 * 3 THEN 'vertex_travelled' END AS reason FROM b)
SELECT clip, arg_min(reason, frame) FILTER (reason IS NOT NULL) AS reason, min(frame) FILTER (reason IS NOT NULL) AS bad_frame, count(reason) = 0 AS ok FROM r GROUP BY 1""")
def shape_drift_check(t):
    return S.shape_drift_check(t.v_frames.selectExpr("clip", "frame", "bone AS vertex", "rx AS x", "ry AS y", "rz AS z"))


@query("""
WITH a AS (SELECT clip, frame, event_id, lead(event_id) OVER (PARTITION BY clip ORDER BY frame) AS next_event_id FROM v_root)
SELECT clip, frame, event_id, next_event_id, event_type_f AS has_forward, event_type_b AS has_backward FROM (SELECT a.*, e.event_type = 'view' AS event_type_f, e.value > 8 AS event_type_b FROM a JOIN events e ON e.event_id = a.event_id)
WHERE next_event_id IS NOT NULL AND (event_type_f OR event_type_b)""")
def next_frame_pairs(t):
    root = t.v_root
    return S.next_frame_pairs(root, root.where("event_type = 'view'"), root.where("px > 8"), "event_id")


_CUTS = "SELECT clip, CASE WHEN mod(clip, 7) = 0 THEN 30 ELSE CAST(mod(clip, 5) - 1 AS INT) END AS start, CASE WHEN mod(clip, 7) = 0 THEN 10 ELSE CAST(20 + mod(clip, 40) AS INT) END AS stop FROM v_clip_labels"


@query(f"""
WITH cuts AS ({_CUTS}), n AS (SELECT clip, max(frame) + 1 AS n FROM v_root GROUP BY 1),
j AS (SELECT r.clip, r.frame, r.px, greatest(start, 0) AS a, least(stop, n.n) AS b FROM v_root r JOIN n ON n.clip = r.clip LEFT JOIN cuts ON cuts.clip = r.clip)
SELECT clip, CAST(row_number() OVER (PARTITION BY clip ORDER BY frame) - 1 AS INT) AS frame, px FROM j WHERE NOT coalesce(a < b, FALSE) OR (frame >= a AND frame < b)""")
def trim_by_interval(t):
    return S.trim_by_interval(t.v_root.select("clip", "frame", "px"), t.sql(_CUTS))


@query("""
WITH n AS (SELECT clip, max(frame) + 1 AS n FROM v_root GROUP BY 1),
i AS (SELECT DISTINCT clip, CAST(round_even(i * ((n - 1) / 6.0::DOUBLE), 0) AS INT) AS frame FROM n, (SELECT unnest(range(7)) AS i) WHERE n > 7)
SELECT r.clip, r.frame, r.px FROM v_root r JOIN n ON n.clip = r.clip LEFT JOIN i ON i.clip = r.clip AND i.frame = r.frame WHERE n <= 7 OR i.frame IS NOT NULL""")
def sample_frames_even(t):
    return S.sample_frames_even(t.v_root.select("clip", "frame", "px"), 7)


_OFF = """SELECT t.rig_id, c.class_name AS bone, t.x AS ox, t.y AS oy, CAST(0 AS DOUBLE) AS oz FROM v_tree t JOIN v_classes c ON c.class_id = 1 + mod(t.bone, 19)"""
_LEN = f"o AS ({_OFF}), len AS (SELECT rig_id, bone, max(sqrt(ox * ox + oy * oy)) AS length FROM o GROUP BY 1, 2)"


@query(f"WITH {_LEN} SELECT rig_id, bone, round(length, 6) AS length FROM len")
def bone_lengths(t):
    return _R6(S.bone_lengths(t.sql(_OFF)), "length")


@query(f"""WITH {_LEN}, h AS (SELECT rig_id, sum(CASE WHEN bone IN ('hips', 'spine', 'chest', 'neck', 'head') THEN length ELSE 0 END) AS height FROM len GROUP BY 1)
SELECT r.clip, r.frame, round(px * s, 4) AS px, round(py * s, 4) AS py, round(pz * s, 4) AS pz FROM (SELECT r.*, CASE WHEN height > 0 THEN 100.0::DOUBLE / height ELSE 1 END AS s FROM v_root r LEFT JOIN h ON h.rig_id = r.clip) r""")
def normalize_proportions(t):
    heights = S.rig_heights(S.bone_lengths(t.sql(_OFF)))
    out = S.normalize_proportions(t.v_root.withColumn("rig_id", F.col("clip")), heights, 100.0)
    return out.withColumns({c: F.round(c, 4) for c in ("px", "py", "pz")})
