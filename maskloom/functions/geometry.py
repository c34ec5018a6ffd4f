"""Projection and joint arithmetic as columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.names import swap_side
from maskloom.functions.ranking import with_group_stats
from maskloom.session import dealt


def clamp(c: Column, lo: int, hi: Column | int) -> Column:
    return F.greatest(F.lit(lo), F.least(c, hi if isinstance(hi, Column) else F.lit(hi)))


def mirror_joints(joints: DataFrame, width: int) -> DataFrame:
    return joints.withColumns({"x": F.lit(width - 1) - F.col("x"), "joint": swap_side(F.col("joint"))})


# Keypoint index by body part in the 17-point layout.
KEYPOINTS = {
    "nose": 0, "shoulder_l": 5, "shoulder_r": 6, "elbow_l": 7, "elbow_r": 8, "wrist_l": 9, "wrist_r": 10,
    "hip_l": 11, "hip_r": 12, "knee_l": 13, "knee_r": 14, "ankle_l": 15, "ankle_r": 16,
}
# Joints placed on a keypoint as it is.
DIRECT = {
    "head": "nose", "shoulder_l": "shoulder_l", "shoulder_r": "shoulder_r", "upper_arm_l": "elbow_l", "upper_arm_r": "elbow_r",
    "forearm_l": "wrist_l", "forearm_r": "wrist_r", "upper_leg_l": "knee_l", "upper_leg_r": "knee_r",
    "lower_leg_l": "ankle_l", "lower_leg_r": "ankle_r",
}
INFERRED_FACTOR, HAND_PAST_WRIST, FOOT_PAST_ANKLE = 0.8, 0.3, 0.25


def derive_joints_17_to_19(keypoints: DataFrame, width: int, height: int, threshold: float = 0.3) -> DataFrame:
    """19 named joints from complete sets of 17 keypoints ``(example_id, kp, x, y, conf)``."""
    used = {part: i for part, i in KEYPOINTS.items()}
    aggs = [F.count_distinct("kp").alias("_k")]
    for part, i in used.items():
        aggs += [F.max(F.when(F.col("kp") == i, F.col(c))).alias(f"{part}_{c}") for c in ("x", "y", "conf")]
    wide = keypoints.groupBy("example_id").agg(*aggs).where("_k = 17")

    def at(part: str, c: str) -> Column:
        return F.col(f"{part}_{c}")

    def conf(*parts: str) -> Column:
        cs = [at(p, "conf") for p in parts]
        return cs[0] if len(cs) == 1 else F.least(*cs)

    def lerp(a: Column, b: Column, t: float) -> Column:
        return a + (b - a) * t

    mid = lambda a, b: (a + b) / 2.0
    pos = {joint: {c: at(part, c) for c in "xy"} for joint, part in DIRECT.items()}
    confs = {joint: conf(part) for joint, part in DIRECT.items()}
    shoulder = {c: mid(at("shoulder_l", c), at("shoulder_r", c)) for c in "xy"}
    hip = {c: mid(at("hip_l", c), at("hip_r", c)) for c in "xy"}
    pos |= {"hips": hip, "neck": {c: mid(at("nose", c), shoulder[c]) for c in "xy"}}
    pos |= {"chest": {c: lerp(shoulder[c], hip[c], 1.0 / 3.0) for c in "xy"}, "spine": {c: lerp(shoulder[c], hip[c], 2.0 / 3.0) for c in "xy"}}
    torso = conf("shoulder_l", "shoulder_r", "hip_l", "hip_r")
    confs |= {"hips": conf("hip_l", "hip_r"), "neck": conf("nose", "shoulder_l", "shoulder_r") * INFERRED_FACTOR}
    confs |= {"chest": torso * INFERRED_FACTOR, "spine": torso * INFERRED_FACTOR}
    for s in ("l", "r"):
        for joint, a, b, past in (("hand", "elbow", "wrist", HAND_PAST_WRIST), ("foot", "knee", "ankle", FOOT_PAST_ANKLE)):
            pos[f"{joint}_{s}"] = {c: lerp(at(f"{a}_{s}", c), at(f"{b}_{s}", c), 1.0 + past) for c in "xy"}
            confs[f"{joint}_{s}"] = conf(f"{a}_{s}", f"{b}_{s}") * INFERRED_FACTOR
    rows = [
        F.struct(
            F.lit(j).alias("joint"), clamp(F.bround(p["x"], 0).cast("int"), 0, width - 1).alias("x"),
            clamp(F.bround(p["y"], 0).cast("int"), 0, height - 1).alias("y"),
            F.bround(confs[j].cast("double"), 4).alias("confidence"), (confs[j] >= threshold).alias("visible"),
        )
        for j, p in pos.items()
    ]
    return wide.select("example_id", F.explode(F.array(*rows)).alias("j")).select("example_id", "j.*")


def incomplete_keypoints(keypoints: DataFrame) -> DataFrame:
    """Side table of the derivation: examples without all 17 keypoints, with those that are missing."""
    have = keypoints.groupBy("example_id").agg(F.collect_set("kp").alias("_have"))  # at most the different numbers of keypoints
    missing = F.array_except(F.array(*[F.lit(i) for i in range(17)]), F.transform("_have", lambda k: k.cast("int")))
    return have.select("example_id", F.size("_have").alias("n_keypoints"), missing.alias("missing")).where("n_keypoints <> 17")


def joint_bbox(joints: DataFrame) -> DataFrame:
    """Padded box of the visible joints; without any, the whole image."""
    ok = F.col("visible") & ~((F.col("x") == -1) & (F.col("y") == -1))
    v = lambda c: F.when(ok, F.col(c))
    df = joints.groupBy("example_id").agg(
        F.min(v("x")).alias("x0"), F.max(v("x")).alias("x1"), F.min(v("y")).alias("y0"), F.max(v("y")).alias("y1"),
        F.max("img_w").alias("w"), F.max("img_h").alias("h"),
    )
    pad = lambda a, b: F.greatest(F.floor((F.col(b) - F.col(a)) * 0.05), F.lit(5))
    seen = F.col("x0").isNotNull()
    box = {
        "x_min": F.when(seen, F.greatest(F.lit(0), F.col("x0") - pad("x0", "x1"))).otherwise(0),
        "y_min": F.when(seen, F.greatest(F.lit(0), F.col("y0") - pad("y0", "y1"))).otherwise(0),
        "x_max": F.when(seen, F.least(F.col("w"), F.col("x1") + pad("x0", "x1"))).otherwise(F.col("w")),
        "y_max": F.when(seen, F.least(F.col("h"), F.col("y1") + pad("y0", "y1"))).otherwise(F.col("h")),
    }
    return df.select("example_id", *[c.cast("int").alias(k) for k, c in box.items()])


def project_pinhole(
    points: DataFrame, extrinsic: Sequence[Sequence[float]], intrinsic: Sequence[Sequence[float]], azimuth: float = 0.0,
    size: int = 512, source_size: int = 1024,
) -> DataFrame:
    """Rotate about z, world to camera, camera to image; points on the camera plane map to 0, 0."""
    c, s = math.cos(math.radians(azimuth)), math.sin(math.radians(azimuth))
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    rx, ry = x * c - y * s, x * s + y * c
    cam = [rx * float(r[0]) + ry * float(r[1]) + z * float(r[2]) + float(r[3]) for r in extrinsic[:3]]
    scale = size / source_size
    flat = F.abs(cam[2]) < 1e-6
    px = (cam[0] / cam[2] * float(intrinsic[0][0]) + float(intrinsic[0][2])) * scale
    py = (cam[1] / cam[2] * float(intrinsic[1][1]) + float(intrinsic[1][2])) * scale
    return points.withColumns({
        "px": F.when(flat, 0.0).otherwise(F.bround(px, 2)), "py": F.when(flat, 0.0).otherwise(F.bround(py, 2)),
    })


def project_ortho(points: DataFrame, key: str = "example_id", size: int = 512) -> DataFrame:
    """Front view scaled by the largest extent x 1.1; points outside the frame are dropped."""
    stats = [f(c).alias(f"_{n}{c}") for c in "xyz" for n, f in (("lo", F.min), ("hi", F.max))]
    df = with_group_stats(points, [key], *stats)
    ext = F.greatest(*[F.col(f"_hi{c}") - F.col(f"_lo{c}") for c in "xyz"]) * 1.1
    scale = F.when(ext < 1e-6, 1.0).otherwise(ext)
    mid = lambda c: (F.col(f"_lo{c}") + F.col(f"_hi{c}")) / 2
    px = F.bround(((F.col("x") - mid("x")) / scale + 0.5) * size, 0).cast("int")
    py = F.bround((-(F.col("z") - mid("z")) / scale + 0.5) * size, 0).cast("int")
    df = df.withColumns({"px": px, "py": py}).drop(*[f"_{n}{c}" for c in "xyz" for n in ("lo", "hi")])
    return df.where(F.col("px").between(0, size - 1) & F.col("py").between(0, size - 1))


def minmax_rank_depth(depths: DataFrame, keys: Sequence[str], value: str = "z") -> DataFrame:
    """Nearest 255, farthest 0; a constant group sits at 127."""
    df = with_group_stats(depths, keys, F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    rank = F.when(span > 0, F.bround((1.0 - (F.col(value) - F.col("_lo")) / span) * 255, 0)).otherwise(127)
    return df.withColumn("depth_rank", rank.cast("int")).drop("_lo", "_hi")


def vertex_features(weights: DataFrame, joints: DataFrame, bones: Sequence[str]) -> DataFrame:
    """Normalised position, target weight and distance to every bone, one row per vertex and bone.

    ``weights(example_id, vertex, x, y, bone, w)`` may hold several rows per vertex;
    ``joints(example_id, bone, jx, jy)``; an absent joint sits at 0, 0. A vertex travels once, with its weights as a map;
    the fan-out is the fixed bone list and comes last.
    """
    key = ["example_id", "vertex"]
    listed = F.col("bone").isin(list(bones))
    per = dealt(weights.select(*key, "x", "y", "bone", "w"), *key).groupBy(*key, "bone").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.sum("w").alias("w"))
    vertices = per.groupBy(*key).agg(
        F.first("x").alias("x"), F.first("y").alias("y"), F.sum(F.coalesce("w", F.lit(0.0))).alias("_sum"), F.count("bone").alias("_n"),
        F.map_from_entries(F.collect_list(F.when(listed, F.struct("bone", "w")))).alias("_ws"),
    )
    ranges = [f(c).alias(f"_{n}{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))]
    v = with_group_stats(vertices, ["example_id"], *ranges)
    places = joints.where(listed).groupBy("example_id", "bone").agg(F.min(F.struct("jx", "jy")).alias("_j"))
    v = v.join(places.groupBy("example_id").agg(F.map_from_entries(F.collect_list(F.struct("bone", "_j"))).alias("_js")), "example_id", "left")
    rx, ry = (F.greatest(F.col(f"_hi{c}") - F.col(f"_lo{c}"), F.lit(1)) for c in "xy")
    diag = F.greatest(F.sqrt(F.pow(rx, 2) + F.pow(ry, 2)), F.lit(1.0))
    v = v.select(
        *key, "x", "y", ((F.col("x") - F.col("_lox")) / rx).alias("u"), ((F.col("y") - F.col("_loy")) / ry).alias("v"), diag.alias("_diag"),
        "_sum", (F.col("_n") > 0).cast("double").alias("confidence"), "_ws", "_js", F.explode(F.array(*[F.lit(b) for b in bones])).alias("bone"),
    )
    v = v.withColumns({"w": F.try_element_at("_ws", F.col("bone")), "_j": F.try_element_at("_js", F.col("bone"))})
    dist = F.sqrt(F.pow(F.col("x") - F.coalesce("_j.jx", F.lit(0)), 2) + F.pow(F.col("y") - F.coalesce("_j.jy", F.lit(0)), 2)) / F.col("_diag")
    target = F.when(F.col("_sum") > 0, F.coalesce("w", F.lit(0.0)) / F.col("_sum")).otherwise(0.0)
    return v.select(*key, "bone", "u", "v", dist.alias("distance"), target.alias("weight"), "confidence")


def classify_proportions(
    head: Column, leg: Column, shoulder: Column, arm_thick: Column, leg_thick: Column
) -> Column:
    return (
        F.when(head > 0.5, "chibi")
        .when((shoulder > 3.5) & ((arm_thick > 0.35) | (leg_thick > 0.35)), "muscular")
        .when((leg > 1.6) & (arm_thick < 0.25) & (leg_thick < 0.25), "tall_thin")
        .when(head > 0.35, "stylized").otherwise("realistic")
    )
