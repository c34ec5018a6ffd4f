"""Motion clips: velocities, timing statistics and degradations.

``root`` rows are ``clip, frame, px, py, pz, frame_time``; ``frames`` rows are
``clip, frame, bone, rx, ry, rz``; frames are dense from 0. Neighbouring frames come from
:func:`maskloom.functions.ranking.neighbours`, so a very long clip is still many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.ranking import after, earlier, neighbours, scan_chunks, whole
from maskloom.session import cut

AXES = ("rx", "ry", "rz")
MIN_FRAMES = 4
# Parent of every bone below the hips.
PARENT = {
    "spine": "hips", "chest": "spine", "neck": "chest", "head": "neck",
    "shoulder_l": "chest", "upper_arm_l": "shoulder_l", "forearm_l": "upper_arm_l", "hand_l": "forearm_l",
    "shoulder_r": "chest", "upper_arm_r": "shoulder_r", "forearm_r": "upper_arm_r", "hand_r": "forearm_r",
    "upper_leg_l": "hips", "lower_leg_l": "upper_leg_l", "foot_l": "lower_leg_l",
    "upper_leg_r": "hips", "lower_leg_r": "upper_leg_r", "foot_r": "lower_leg_r",
}
SECONDARY = ("hand_l", "hand_r", "foot_l", "foot_r", "head")
HEIGHT_CHAIN = ("hips", "spine", "chest", "neck", "head")


def _norm(pairs: Sequence[tuple[str, str]]) -> Column:
    return F.sqrt(sum((F.pow(F.col(a) - F.col(b), 2) for a, b in pairs[1:]), F.pow(F.col(pairs[0][0]) - F.col(pairs[0][1]), 2)))


def _step_seconds() -> Column:
    return F.when(F.col("frame_time") > 0, F.col("frame_time")).otherwise(F.lit(1.0 / 30))


def root_velocity(root: DataFrame, chunk: int = 16384) -> DataFrame:
    """Speed of every frame and of the frame before it; clips of one frame give no rows."""
    wanted = {f"_{c}{k}": (c, -k) for c in ("px", "py", "pz") for k in (1, 2)}
    df = neighbours(root, ["clip"], "frame", {**wanted, "_next": ("frame", 1)}, chunk)
    now = _norm([("px", "_px1"), ("py", "_py1"), ("pz", "_pz1")]) / _step_seconds()
    before = _norm([("_px1", "_px2"), ("_py1", "_py2"), ("_pz1", "_pz2")]) / _step_seconds()
    df = df.where((F.col("frame") > 0) | F.col("_next").isNotNull())
    return df.select(
        "clip", "frame", "frame_time",
        F.when(F.col("frame") > 0, now).otherwise(0.0).alias("speed"),
        F.when(F.col("frame") == 1, F.lit(0.0)).when(F.col("frame") > 1, before).alias("prev_speed"),
    )


def timing_flags(hold: float = 0.1) -> dict[str, Column]:
    held = F.col("speed") < hold
    accel = F.coalesce(F.col("speed") - F.col("prev_speed"), F.lit(0.0))
    return {"hold": held, "accel": ~held & (accel > 0), "decel": ~held & (accel < 0)}


def timing_phases(velocity: DataFrame, hold: float = 0.1) -> DataFrame:
    flags = timing_flags(hold)
    n = F.count(F.lit(1))
    return velocity.groupBy("clip").agg(
        *[F.count_if(c).alias(f"{k}_frames") for k, c in flags.items()],
        *[F.bround(F.count_if(c) / n, 4).alias(f"{k}_ratio") for k, c in flags.items()],
    )


def clip_summary(root: DataFrame, hold: float = 0.1) -> DataFrame:
    """Duration, rate, velocity statistics and phases, one aggregation over the speeds."""
    n, flags = F.count(F.lit(1)), timing_flags(hold)
    return root_velocity(root).groupBy("clip").agg(
        F.bround(n * F.first(_step_seconds()), 4).alias("duration_seconds"), n.alias("frame_count"),
        F.bround(1.0 / F.first(_step_seconds()), 2).alias("frame_rate"),
        F.bround(F.avg("speed"), 4).alias("root_velocity_mean"), F.bround(F.max("speed"), 4).alias("root_velocity_max"),
        F.bround(F.min("speed"), 4).alias("root_velocity_min"),
        F.bround(F.count_if(flags["accel"]) / n, 4).alias("acceleration_ratio"),
        F.bround(F.count_if(flags["decel"]) / n, 4).alias("deceleration_ratio"),
        F.bround(F.count_if(flags["hold"]) / n, 4).alias("hold_ratio"),
    )


NORM_COLUMNS = [
    "duration_seconds", "root_velocity_mean", "root_velocity_max", "acceleration_ratio", "deceleration_ratio", "hold_ratio",
]


def label_clips(summary: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.join(summary, "clip")


def action_norms(labelled: DataFrame) -> DataFrame:
    """Mean, population sigma, min and max of six clip statistics per action."""
    long = labelled.select("action", *NORM_COLUMNS).unpivot("action", NORM_COLUMNS, "statistic", "value")
    return long.groupBy("action", "statistic").agg(
        F.count(F.lit(1)).alias("clips"), F.bround(F.avg("value"), 4).alias("mean"),
        F.bround(F.stddev_pop("value"), 4).alias("std"), F.bround(F.min("value"), 4).alias("min"), F.bround(F.max("value"), 4).alias("max"),
    )


def missing_clips(labels: DataFrame, root: DataFrame) -> DataFrame:
    """Labels without a clip of at least two frames, counted per action."""
    usable = root.where("frame = 1").select("clip")
    gone = labels.join(usable, "clip", "left_anti")
    return gone.groupBy("action").agg(F.count(F.lit(1)).alias("skipped"))


def angular_velocity(frames: DataFrame, frame_time: float = 1.0 / 30, chunk: int = 16384) -> DataFrame:
    wanted = {f"_{c}1": (c, -1) for c in AXES} | {"_next": ("frame", 1)}
    df = neighbours(frames, ["clip", "bone"], "frame", wanted, chunk)
    df = df.where((F.col("frame") > 0) | F.col("_next").isNotNull())
    speed = _norm([(c, f"_{c}1") for c in AXES]) / frame_time
    return df.select("clip", "bone", "frame", F.when(F.col("frame") > 0, speed).otherwise(0.0).alias("speed"))


def joint_angular_velocity(frames: DataFrame, frame_time: float = 1.0 / 30) -> DataFrame:
    return angular_velocity(frames, frame_time).groupBy("clip", "bone").agg(
        *[F.bround(f("speed"), 4).alias(n) for n, f in (("mean", F.avg), ("max", F.max), ("min", F.min))]
    )


# --- degradations ---


def clip_lengths(frames: DataFrame) -> DataFrame:
    return frames.groupBy("clip").agg((F.max("frame") + 1).alias("n_frames"))


def with_length(frames: DataFrame) -> DataFrame:
    """Frames with the ``n_frames`` of their clip; rows that already have it stay as they are."""
    return frames if "n_frames" in frames.columns else frames.join(clip_lengths(frames), "clip")


def long_enough(frames: DataFrame) -> DataFrame:
    return with_length(frames).where(F.col("n_frames") >= MIN_FRAMES)


CHUNK = 16384
SPOT = ("clip", "bone", "_chunk")


def extreme_frames(frames: DataFrame, min_keyframes: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Kept frame numbers: local extremes of any bone axis whose range exceeds 1, and both ends."""
    wanted = {f"_{c}{n}": (c, s) for c in AXES for n, s in (("p", -1), ("n", 1))}
    df = neighbours(frames, ["clip", "bone"], "frame", wanted, chunk, keep_chunk=True)
    ranges = {f"_r{c}": F.max(f"_hi{c}").over(whole("clip", "bone")) - F.min(f"_lo{c}").over(whole("clip", "bone")) for c in AXES}
    states = {f"_lo{c}": F.min(c) for c in AXES} | {f"_hi{c}": F.max(c) for c in AXES} | {"_top": F.max("frame")}
    df = scan_chunks(df, ["clip", "bone"], states, ranges | {"_last": F.max("_top").over(whole("clip"))})
    hit = (F.col("frame") == 0) | (F.col("frame") == F.col("_last"))
    for c in AXES:
        v, p, n = F.col(c), F.col(f"_{c}p"), F.col(f"_{c}n")
        hit = hit | ((F.col(f"_r{c}") > 1.0) & (((v >= p) & (v >= n)) | ((v <= p) & (v <= n))))
    kept = df.where(hit).select("clip", "frame", "_last").distinct()
    few = kept.groupBy("clip").agg(F.count(F.lit(1)).alias("k"), (F.max("_last") + 1).alias("n")).where(F.col("k") < min_keyframes)
    step = F.greatest(F.lit(1), F.floor(F.col("n") / min_keyframes)).cast("int")
    extra = few.select("clip", F.explode(F.sequence(F.lit(0), F.col("n") - 1, step)).alias("frame"))
    return kept.select("clip", "frame").unionByName(extra).distinct()


def take_frames(frames: DataFrame, kept: DataFrame) -> DataFrame:
    return frames.join(kept, ["clip", "frame"], "left_semi")


def _lerp(a: Column, b: Column, t: Column) -> Column:
    return a + (b - a) * t


def linearize_segments(frames: DataFrame, every: int = 8) -> DataFrame:
    """Linear interpolation between key frames; a key frame serves at most ``every`` rows."""
    every = max(2, every)
    df = with_length(frames)
    last = F.col("n_frames") - 1
    keys = df.where((F.col("frame") % every == 0) | (F.col("frame") == last))
    keys = keys.withColumn("_i", F.ceil(F.col("frame") / every))
    keys = neighbours(keys, ["clip", "bone"], "_i", {"_end": ("frame", 1)} | {f"_{c}n": (c, 1) for c in AXES})
    spans = keys.select(
        "clip", "bone", F.col("frame").alias("_start"), *[F.col(c).alias(f"_{c}0") for c in AXES],
        F.coalesce("_end", "frame").alias("_end"), *[F.coalesce(f"_{c}n", c).alias(f"_{c}n") for c in AXES],
    )
    start = F.when(F.col("frame") == last, last).otherwise(F.floor(F.col("frame") / every) * every).cast("int")
    rows = df.select("clip", "bone", "frame", start.alias("_start"))
    out = rows.join(spans, ["clip", "bone", "_start"])
    t = F.when(F.col("_end") > F.col("_start"), (F.col("frame") - F.col("_start")) / (F.col("_end") - F.col("_start"))).otherwise(0.0)
    return out.select("clip", "frame", "bone", *[_lerp(F.col(f"_{c}0"), F.col(f"_{c}n"), t).alias(c) for c in AXES])


def arc_samples(frames: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(clip, frame, sample, t): where each sample at equal arc length of all bones' rotations lies; each frame interval emits those that fall into it."""
    deltas = neighbours(frames, ["clip", "bone"], "frame", {f"_{c}1": (c, -1) for c in AXES}, chunk)
    step = F.coalesce(_norm([(c, f"_{c}1") for c in AXES]), F.lit(0.0))
    per_frame = deltas.groupBy("clip", "frame").agg(F.sum(F.bround(step, 9).cast("decimal(20,9)")).cast("decimal(26,9)").alias("d"))
    cum = per_frame.withColumn("_chunk", F.floor(F.col("frame") / chunk)).repartition("clip", "_chunk")
    inside = Window.partitionBy("clip", "_chunk").orderBy("frame")
    cum = cum.withColumns({"_own": F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "_nd": F.lead("d").over(inside)})
    at = whole("clip")
    cum = scan_chunks(cum, ["clip"], {"_sum": F.sum("d"), "_first": F.min_by("d", "frame"), "_top": F.max("frame")}, {
        "_base": F.coalesce(F.sum("_sum").over(earlier("clip")), F.lit(0)), "_total": F.sum("_sum").over(at).cast("double"), "_last": F.max("_top").over(at),
        "_later": F.last("_first").over(after("clip").rowsBetween(-1, -1)),
    })
    c = F.col("_base").cast("decimal(28,9)") + F.col("_own").cast("decimal(28,9)")  # so narrow that sums keep all nine places
    cum = cum.withColumns({"_c": c.cast("double"), "_c1": (c + F.coalesce("_nd", "_later")).cast("double")})
    place = lambda c: F.ceil(F.bround(F.col(c) * F.col("_last") / F.col("_total"), 9)).cast("int")
    final = F.col("frame") == F.col("_last")
    lo, hi = place("_c"), F.when(final, F.col("_last")).otherwise(place("_c1") - 1)
    still = F.col("_total") < 1e-6
    none = F.array().cast("array<int>")
    samples = F.when(still, F.array("frame")).when(final, F.array(F.col("_last"))).when(hi >= lo, F.sequence(lo, hi)).otherwise(none)
    cum = cum.select("clip", "frame", "_c", "_c1", "_total", "_last", F.explode(samples).alias("sample"))
    cum = cum.where(still | final | (F.col("sample") < F.col("_last")))
    u = F.col("_total") * F.col("sample") / F.col("_last")
    t = F.when(still | final, 0.0).otherwise((u - F.col("_c")) / (F.col("_c1") - F.col("_c")))
    return cum.select("clip", "frame", "sample", t.alias("t"))


def at_samples(frames: DataFrame, samples: DataFrame) -> DataFrame:
    """Rows of the tracks of ``frames`` at the samples, between a frame and the next."""
    values = neighbours(frames, ["clip", "bone"], "frame", {f"_{c}n": (c, 1) for c in AXES})
    out = samples.join(values, ["clip", "frame"])
    return out.select(
        "clip", F.col("sample").alias("frame"), "bone", *[_lerp(F.col(c), F.coalesce(f"_{c}n", c), F.col("t")).alias(c) for c in AXES]
    )


def uniform_arc_resample(frames: DataFrame) -> DataFrame:
    """Resample at equal arc length."""
    return at_samples(frames, arc_samples(frames))


def lock_to_parent(frames: DataFrame, secondary: Sequence[str] = SECONDARY, parent: dict[str, str] | None = None) -> DataFrame:
    """Selected bones take the rotation of their parent; a locked parent passes its own source on."""
    parent = parent or PARENT
    source: dict[str, str] = {}
    for bone in secondary:
        if bone in parent:
            source[bone] = source.get(parent[bone], parent[bone])
    if not source:
        return frames
    which = F.coalesce(*[F.when(F.col("bone") == b, F.lit(s)) for b, s in source.items()], F.col("bone"))
    donors = frames.where(F.col("bone").isin(sorted(set(source.values())))).select("clip", "frame", F.col("bone").alias("_src"), *[F.col(c).alias(f"_{c}") for c in AXES])
    locked = F.col("bone").isin(list(source))
    moved = frames.where(locked).withColumn("_src", which).join(donors, ["clip", "frame", "_src"], "left")
    moved = moved.select("clip", "frame", "bone", *[F.coalesce(f"_{c}", c).alias(c) for c in AXES])
    return frames.where(~locked).select("clip", "frame", "bone", *AXES).unionByName(moved)


def decimate_frames(frames: DataFrame, factor: int = 2) -> DataFrame:
    """Every n-th frame and the last one, renumbered without a window."""
    factor = max(2, factor)
    df = with_length(frames).where((F.col("frame") % factor == 0) | (F.col("frame") == F.col("n_frames") - 1))
    return df.select("clip", F.ceil(F.col("frame") / factor).cast("int").alias("frame"), "bone", *AXES)


def stop_frames(frames: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(clip, stop): the earliest of the last moving frames of all bones that move at all."""
    df = neighbours(frames, ["clip", "bone"], "frame", {f"_{c}1": (c, -1) for c in AXES})
    moving = F.when(_norm([(c, f"_{c}1") for c in AXES]) > threshold, F.col("frame"))
    per_bone = df.groupBy("clip", "bone").agg(
        F.greatest(*[F.max(c) - F.min(c) for c in AXES]).alias("range"), F.coalesce(F.max(moving), F.lit(0)).alias("last")
    )
    return per_bone.where("range >= 1.0").groupBy("clip").agg(F.greatest(F.lit(1), F.min("last")).alias("stop"))


def freeze(frames: DataFrame, stops: DataFrame) -> DataFrame:
    """All tracks of a clip keep the values of its stop frame afterwards."""
    rows = frames.join(stops, "clip", "left")
    frozen = rows.where("frame = stop").select("clip", "bone", *[F.col(c).alias(f"_{c}") for c in AXES])
    out = rows.join(frozen, ["clip", "bone"], "left")
    late = F.col("frame") > F.col("stop")
    return out.select("clip", "frame", "bone", *[F.when(late, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in AXES])


def simultaneous_stop(frames: DataFrame, threshold: float = 0.5) -> DataFrame:
    """All bones freeze at the earliest of the last moving frames."""
    return freeze(frames, stop_frames(frames, threshold))


def anticipation_frames(frames: DataFrame, threshold: float = 2.0, max_run: int = 10, chunk: int = CHUNK) -> DataFrame:
    """Frames of a short counter-motion followed by a longer opposite motion, on any bone axis.

    Only steps of at least ``threshold`` carry a direction. A run starts where the direction
    differs from the last one seen; it ends at the next start, and the run after it ends at
    the start after that, so the whole rule needs two later run starts and no row loop.

    A segmented scan in two steps: a chunk's last direction tells the next chunk where a run goes on, then its first two starts tell the chunks before where theirs end.
    """
    series = ["clip", "bone"]
    df = neighbours(frames, series, "frame", {f"_{c}n": (c, 1) for c in AXES}, chunk, keep_chunk=True)
    move = {c: F.col(f"_{c}n") - F.col(c) for c in AXES}
    df = df.withColumns({f"_d{c}": F.when(F.abs(v) >= threshold, F.signum(v)) for c, v in move.items()})
    last = {f"_e{c}": F.max_by(f"_d{c}", F.when(F.col(f"_d{c}").isNotNull(), F.col("frame"))) for c in AXES}
    at = whole(*series)
    df = scan_chunks(
        df, series, last | {f"_lo{c}": F.min(c) for c in AXES} | {f"_hi{c}": F.max(c) for c in AXES} | {"_top": F.max("frame")},
        {f"_b{c}": F.last(f"_e{c}", True).over(earlier(*series)) for c in AXES} | {f"_on{c}": F.max(f"_hi{c}").over(at) - F.min(f"_lo{c}").over(at) >= threshold for c in AXES}
        | {"n_steps": F.max("_top").over(at)})
    up = Window.partitionBy(*SPOT).orderBy("frame")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    prev = {c: F.coalesce(F.last(f"_d{c}", True).over(before), F.col(f"_b{c}")) for c in AXES}
    df = df.withColumns({f"_s{c}": F.when(F.col(f"_on{c}") & F.col(f"_d{c}").isNotNull() & (prev[c].isNull() | (F.col(f"_d{c}") != prev[c])), F.col("frame")) for c in AXES})
    df = df.withColumns({f"_k{c}": F.count(f"_s{c}").over(up.rowsBetween(Window.unboundedPreceding, 0)) for c in AXES})
    second = {f"_v{c}": F.min(F.when(F.col(f"_k{c}") == 2, F.col(f"_s{c}"))) for c in AXES}
    df = scan_chunks(
        df, series, {f"_u{c}": F.min(f"_s{c}") for c in AXES} | second,
        {f"_x{c}": F.last(f"_u{c}", True).over(after(*series)) for c in AXES},
        {f"_y{c}": F.last(F.when(F.col(f"_u{c}").isNotNull(), F.coalesce(f"_v{c}", f"_x{c}")), True).over(after(*series)) for c in AXES})
    down = Window.partitionBy(*SPOT).orderBy(F.desc("frame")).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_p{c}": F.coalesce(F.last(f"_s{c}", True).over(down), F.col(f"_x{c}")) for c in AXES})
    ends = {f"_q{c}": F.coalesce(F.last(F.when(F.col(f"_s{c}").isNotNull(), F.col(f"_p{c}")), True).over(down), F.col(f"_y{c}"), F.col("n_steps")) for c in AXES}
    df = df.withColumns(ends)
    runs = F.array(*[F.struct(F.col(f"_s{c}").alias("start"), F.col(f"_p{c}").alias("end1"), F.col(f"_q{c}").alias("end2")) for c in AXES])
    starts = df.where(F.coalesce(*[f"_s{c}" for c in AXES]).isNotNull()).select("clip", "n_steps", F.explode(runs).alias("_run")).select("clip", "n_steps", "_run.*")
    run = F.col("end1") - F.col("start")
    hits = starts.where(F.col("start").isNotNull() & F.col("end1").isNotNull() & (run <= max_run) & (F.col("end2") - F.col("end1") > run))
    marked = hits.select("clip", "n_steps", F.explode(F.sequence(F.col("start") + 1, F.col("end1"))).alias("frame"))
    return marked.where((F.col("frame") > 0) & (F.col("frame") < F.col("n_steps"))).select("clip", "frame").distinct()


def drop_anticipation(frames: DataFrame, threshold: float = 2.0, max_run: int = 10) -> DataFrame:
    return frames.join(anticipation_frames(frames, threshold, max_run), ["clip", "frame"], "left_anti")


DEGRADATIONS = {
    "strip_to_extremes": lambda f: take_frames(f, extreme_frames(f)),
    "linearize_arcs": linearize_segments,
    "remove_easing": uniform_arc_resample,
    "remove_secondary": lock_to_parent,
    "reduce_framerate": decimate_frames,
    "simultaneous_stop": simultaneous_stop,
    "remove_anticipation": drop_anticipation,
}


PLACES = ("px", "py", "pz")


def _as_track(root: DataFrame) -> DataFrame:
    """The root's places as a track like a bone's."""
    return root.select("clip", "frame", F.lit("root").alias("bone"), *[F.col(p).alias(c) for p, c in zip(PLACES, AXES, strict=True)])


# what each degradation does to the root track, which the bones' rotations decide; rotations locked to a parent leave it as it is
ROOT_DEGRADATIONS = {
    "strip_to_extremes": lambda track, frames: take_frames(track, extreme_frames(frames)),
    "linearize_arcs": lambda track, frames: linearize_segments(track),
    "remove_easing": lambda track, frames: at_samples(track, arc_samples(frames)),
    "remove_secondary": lambda track, frames: track,
    "reduce_framerate": lambda track, frames: decimate_frames(track),
    "simultaneous_stop": lambda track, frames: freeze(track, stop_frames(frames)),
    "remove_anticipation": lambda track, frames: track.join(anticipation_frames(frames), ["clip", "frame"], "left_anti"),
}


def degrade_root(root: DataFrame, frames: DataFrame, name: str) -> DataFrame:
    """The root track (clip, frame, px, py, pz) under one degradation, in step with the bones of ``frames``."""
    out = ROOT_DEGRADATIONS[name](_as_track(root), frames)
    return out.select("clip", "frame", *[F.col(c).alias(p) for p, c in zip(PLACES, AXES, strict=True)])


def root_pairs(root: DataFrame, frames: DataFrame, types: Sequence[str] = tuple(ROOT_DEGRADATIONS)) -> DataFrame:
    """Degraded root tracks per type, for clips of at least four frames."""
    usable = cut(long_enough(frames).drop("n_frames"))  # read by every type
    track = cut(root.select("clip", "frame", *PLACES).join(usable.select("clip").distinct(), "clip", "left_semi"))
    out = None
    for name in types:
        part = degrade_root(track, usable, name).withColumn("degradation", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def degradation_pairs(frames: DataFrame, types: Sequence[str] = tuple(DEGRADATIONS), **override) -> DataFrame:
    """Degraded frames per type, for clips of at least four frames; the original is the input itself."""
    usable = cut(long_enough(frames.select("clip", "frame", "bone", *AXES)))  # read by every type, with the length of the clip
    out = None
    for name in types:
        part = override.get(name, DEGRADATIONS[name])(usable).select("clip", "frame", "bone", *AXES)
        part = part.withColumn("degradation", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# --- clip rules ---


def motion_compatibility(frames: DataFrame, mapped: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Unmapped bones that leave their first pose by more than ``threshold`` degrees."""
    base = frames.where("frame = 0").select("clip", "bone", *[F.col(c).alias(f"_{c}") for c in AXES])
    df = frames.join(base, ["clip", "bone"], "left")
    drift = F.greatest(*[F.abs(F.col(c) - F.col(f"_{c}")) for c in AXES])
    known = F.col("bone").isin(list(mapped))
    per = df.groupBy("clip", "bone").agg((F.max(drift) > threshold).alias("active")).withColumn("known", known)
    # one row per bone of the clip's skeleton from here on
    active = F.array_sort(F.collect_set(F.when(~F.col("known") & F.col("active"), F.col("bone"))))
    out = per.groupBy("clip").agg(
        F.count_if("known").alias("mapped"), F.count_if(~F.col("known")).alias("unmapped"), active.alias("active_unmapped")
    )
    return out.withColumn("compatible", F.size("active_unmapped") == 0)


def shape_drift_check(
    points: DataFrame, height: float = 0.2, width: float = 1.0, travel: float = 3.0, every: int = 4
) -> DataFrame:
    """First sampled frame whose shape leaves the rest pose, and why.

    ``points(clip, frame, vertex, x, y, z)``; the rest pose is the first frame.
    """
    span = points.groupBy("clip").agg(F.min("frame").alias("f0"), F.max("frame").alias("f1"))
    df = points.join(span, "clip")
    sampled = ((F.col("frame") - F.col("f0")) % every == 0) | (F.col("frame") == F.col("f1"))
    df = df.where(sampled)
    rest = df.where("frame = f0").select("clip", "vertex", *[F.col(c).alias(f"_{c}") for c in "xyz"])
    df = df.join(rest, ["clip", "vertex"], "left")
    move = F.sqrt(sum((F.pow(F.col(c) - F.col(f"_{c}"), 2) for c in "yz"), F.pow(F.col("x") - F.col("_x"), 2)))
    shape = df.groupBy("clip", "frame").agg(
        (F.max("z") - F.min("z")).alias("h"), (F.max("x") - F.min("x")).alias("w"), F.max(move).alias("travel"), F.first("f0").alias("f0")
    )
    base = shape.where("frame = f0").select("clip", F.col("h").alias("h0"), F.col("w").alias("w0"))
    shape = shape.join(base, "clip")
    reason = (
        F.when(F.col("h0") < 1e-6, "near_zero_rest_height")
        .when(F.col("frame") == F.col("f0"), None)
        .when(F.abs(F.col("h") - F.col("h0")) / F.col("h0") > height, "height_changed")
        .when((F.col("w0") > 1e-6) & (F.abs(F.col("w") - F.col("w0")) / F.nullif(F.col("w0"), F.lit(0.0)) > width), "width_changed")
        .when(F.col("travel") > F.col("h0") * travel, "vertex_travelled")
    )
    bad = F.when(F.col("reason").isNotNull(), F.col("frame"))
    out = shape.withColumn("reason", reason).groupBy("clip").agg(F.min_by("reason", bad).alias("reason"), F.min(bad).alias("bad_frame"))
    return out.withColumn("ok", F.col("reason").isNull())


def next_frame_pairs(frames: DataFrame, forward: DataFrame, backward: DataFrame, extra: str = "path") -> DataFrame:
    """Frame t with t+1 where a forward or a backward companion of t exists."""
    df = neighbours(frames, ["clip"], "frame", {f"next_{extra}": (extra, 1)}).where(F.col(f"next_{extra}").isNotNull())
    f = forward.select("clip", "frame", F.lit(True).alias("_f"))
    b = backward.select("clip", "frame", F.lit(True).alias("_b"))
    both = f.join(b, ["clip", "frame"], "full_outer")
    out = df.join(both, ["clip", "frame"])
    return out.select(
        "clip", "frame", extra, f"next_{extra}",
        F.coalesce("_f", F.lit(False)).alias("has_forward"), F.coalesce("_b", F.lit(False)).alias("has_backward"),
    )


def trim_by_interval(frames: DataFrame, cuts: DataFrame) -> DataFrame:
    """``start <= frame < stop`` per clip, renumbered; an empty cut keeps the clip whole."""
    df = with_length(frames).join(cuts.select("clip", "start", "stop"), "clip", "left")
    start, stop = F.greatest(F.col("start"), F.lit(0)), F.least("stop", "n_frames")
    usable = F.coalesce(start < stop, F.lit(False))
    kept = df.where(~usable | ((F.col("frame") >= start) & (F.col("frame") < stop)))
    number = F.col("frame") - F.when(usable, start).otherwise(0)
    return kept.select(*[c for c in frames.columns if c != "frame"], number.cast("int").alias("frame"))


def sample_frames_even(frames: DataFrame, n: int) -> DataFrame:
    """Frames at round(i * (N - 1) / (n - 1)); short clips keep every frame."""
    total = clip_lengths(frames)
    if n <= 0:
        return frames.where("false")
    spread = F.array(*[F.bround(F.lit(i) * (F.col("n_frames") - 1) / max(n - 1, 1), 0).cast("int") for i in range(n)])
    wanted = total.where(F.col("n_frames") > n).select("clip", F.explode(F.array_distinct(spread)).alias("frame"))
    whole = total.where(F.col("n_frames") <= n).select("clip")
    picked = frames.join(wanted, ["clip", "frame"], "left_semi")
    return picked.unionByName(frames.join(whole, "clip", "left_semi"))


def bone_lengths(offsets: DataFrame, keys: Sequence[str] = ("rig_id",)) -> DataFrame:
    """Longest offset of every target bone."""
    length = F.sqrt(F.pow("ox", 2) + F.pow("oy", 2) + F.pow("oz", 2))
    return offsets.groupBy(*keys, "bone").agg(F.max(length).alias("length"))


def rig_heights(lengths: DataFrame, keys: Sequence[str] = ("rig_id",)) -> DataFrame:
    in_chain = F.when(F.col("bone").isin(list(HEIGHT_CHAIN)), F.col("length")).otherwise(0.0)
    return lengths.groupBy(*keys).agg(F.sum(in_chain).alias("height"))


def normalize_proportions(root: DataFrame, heights: DataFrame, target_height: float, rig: str = "rig_id") -> DataFrame:
    """Scale root positions by target height over source height; zero heights leave them."""
    df = root.join(heights, rig, "left")
    scale = F.when((F.col("height") > 0) & F.lit(target_height > 0), F.lit(float(target_height)) / F.col("height")).otherwise(1.0)
    return df.select("clip", "frame", *[(F.col(c) * scale).alias(c) for c in ("px", "py", "pz")])
