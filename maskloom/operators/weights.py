"""Vertex weights, faces and label votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.bone_tables import PRIMARY_WORDS
from maskloom.functions.names import reasons
from maskloom.session import dealt

VERTEX = ["example_id", "vertex"]


def collapse_weights(weights: DataFrame, mapping: DataFrame, floor: float = 1e-6, digits: int = 6) -> DataFrame:
    """Sum source-bone weights into target regions; tiny inputs and sums are dropped."""
    df = weights.where(F.col("w") >= floor).join(mapping, "bone")
    out = df.groupBy(*VERTEX, "region").agg(F.sum("w").alias("w")).where(F.col("w") > floor)
    return out.withColumn("w", F.bround("w", digits))


def weighted_joint_centroids(weights: DataFrame, bones: Sequence[str] | None = None) -> DataFrame:
    if bones is not None:
        weights = weights.where(F.col("bone").isin(list(bones)))
    df = weights.groupBy("example_id", "bone").agg(
        F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("x")).alias("sx"), F.sum(F.col("w") * F.col("y")).alias("sy")
    )
    df = df.where(F.col("sw") > 1e-6)
    return df.select("example_id", "bone", (F.col("sx") / F.col("sw")).alias("jx"), (F.col("sy") / F.col("sw")).alias("jy"))


def dominant_bone(weights: DataFrame, order: str = "bone_order", threshold: float | None = None) -> DataFrame:
    """Heaviest bone per vertex; the first listed bone wins a tie."""
    if threshold is not None:
        weights = weights.where(F.col("w") >= threshold)
    best = F.max_by(F.struct("bone", "w"), F.struct("w", -F.col(order))).alias("b")
    return weights.groupBy(*VERTEX).agg(best).select(*VERTEX, "b.bone", "b.w")


def dominant_region(weights: DataFrame, mapping: DataFrame, order: str = "bone_order", skip_unmapped: bool = False) -> DataFrame:
    df = dominant_bone(weights, order).join(mapping, "bone", "left")
    if skip_unmapped:
        df = df.where(F.col("region").isNotNull())
    return df.select(*VERTEX, "bone", F.coalesce("region", F.lit(0)).alias("region"))


def face_majority_vote(corners: DataFrame, keys: Sequence[str] = ("example_id", "face")) -> DataFrame:
    """Most common vertex region of a face; ties go to the tied corner nearest the centre.

    ``corners(example_id, face, corner, region, dist)``: two aggregations, no window.
    """
    per = corners.groupBy(*keys, "region").agg(
        F.count(F.lit(1)).alias("votes"), F.min(F.struct("dist", "corner")).alias("near")
    )
    win = F.max_by("region", F.struct("votes", -F.col("near.dist"), -F.col("near.corner"))).alias("region")
    return per.groupBy(*keys).agg(win)


def splat_vertex_labels(vertices: DataFrame, width: int, height: int) -> DataFrame:
    """Region written at the pixel of a vertex; the later vertex wins."""
    inside = F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)
    return vertices.where(inside).groupBy("example_id", "x", "y").agg(F.max_by("region", "vertex").alias("region"))


def humanoid_test(vertex_regions: DataFrame, min_coverage: float = 0.60) -> DataFrame:
    """Mapped coverage, and both arms and both legs present."""
    r = F.col("region")
    df = vertex_regions.groupBy("example_id").agg(
        F.avg((r > 0).cast("double")).alias("coverage"),
        *[F.bool_or(r.isin(*ids)).alias(name) for name, ids in (("arm_l", dims.ARM_L), ("arm_r", dims.ARM_R), ("leg_l", dims.LEG_L), ("leg_r", dims.LEG_R))],
    )
    limbs = F.col("arm_l") & F.col("arm_r") & F.col("leg_l") & F.col("leg_r")
    return df.select("example_id", "coverage", limbs.alias("has_limbs"), ((F.col("coverage") >= min_coverage) & limbs).alias("humanoid"))


def companion_mesh_detect(parts: DataFrame, vertices: DataFrame, words: Sequence[str], max_groups: int = 5, share: float = 0.8) -> DataFrame:
    """Accessory parts of a model and why.

    ``parts(model, part, name, n_groups, has_armature)``; ``vertices(model, part, bones)`` holds
    the number of bones above the weight floor. Weak skinning counts only without another reason.
    """
    weak = vertices.groupBy("model", "part").agg(F.avg((F.col("bones") <= 1).cast("double")).alias("single"))
    df = parts.join(weak, ["model", "part"], "left")
    none = ~F.col("has_armature") | (F.col("n_groups") == 0)
    named: Column = F.lit(False)
    for w in words:
        named = named | F.contains(F.lower("name"), F.lit(w))
    feeble = ~none & ~named & (F.col("n_groups") <= max_groups) & F.coalesce(F.col("single") >= share, F.lit(False))
    why = reasons({"no_skinning": none, "name_match": named, "weak_skinning": feeble})
    return df.select("model", "part", "name", why.alias("reasons"), (F.size(why) > 0).alias("is_accessory"))


def select_primary(bones: DataFrame, order: str = "k", keys: Sequence[str] = ("rig",)) -> DataFrame:
    """One bone per region: the first keyword hit in preference order, else the first listed."""
    rank = F.lit(99)
    for region, words in PRIMARY_WORDS.items():
        hits = F.coalesce(*[F.when(F.contains(F.lower("name"), F.lit(w.lower())), F.lit(i)) for i, w in enumerate(words)], F.lit(99))
        rank = F.when(F.col("region") == region, hits).otherwise(rank)
    df = bones.where(F.col("region").between(1, 19)).withColumn("_rank", rank)
    return df.groupBy(*keys, "region").agg(F.min_by("name", F.struct("_rank", order)).alias("name"))


def probability_ensemble(views: DataFrame, foreground: DataFrame | None = None, keys: Sequence[str] = ("example_id", "pixel"), n_views: int = 4) -> DataFrame:
    """Mean class probability over the views, best class and confidence.

    ``views(keys, view, class_id, p)`` come in image orientation; a mirrored view has its paired
    classes swapped first by :func:`swap_classes`. Outside ``foreground`` the class is 0.
    """
    avg = dealt(views.select(*keys, "class_id", "p"), *keys).groupBy(*keys, "class_id").agg((F.sum("p") / n_views).alias("p"))
    best = avg.groupBy(*keys).agg(F.max("p").alias("confidence"), F.max_by("class_id", F.struct("p", -F.col("class_id"))).alias("class_id"))
    if foreground is None:
        return best
    fg = foreground.select(*keys, F.lit(True).alias("_fg"))
    out = best.join(fg, list(keys), "left")
    return out.select(
        *keys, F.when(F.col("_fg"), F.col("class_id")).otherwise(0).alias("class_id"), F.when(F.col("_fg"), F.col("confidence")).otherwise(1.0).alias("confidence")
    )


def swap_classes(views: DataFrame) -> DataFrame:
    pairs = dims.classes(views.sparkSession).select("class_id", "pair_id")
    out = views.join(F.broadcast(pairs), "class_id", "left")
    return out.withColumn("class_id", F.coalesce("pair_id", "class_id")).drop("pair_id")


def segment_vote(pixels: DataFrame, probs: DataFrame, fallback: DataFrame, min_p: float = 0.3, keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """Relabel segments by their mean class probability; the smallest segment on a pixel wins.

    ``pixels(keys, segment, pixel)``, ``probs(keys, pixel, class_id, p)``, ``fallback(keys, pixel, class_id)``.
    """
    ks = list(keys)
    size = pixels.groupBy(*ks, "segment").agg(F.count(F.lit(1)).alias("size"))
    sums = pixels.join(probs, [*ks, "pixel"]).groupBy(*ks, "segment", "class_id").agg(F.sum("p").alias("s"))
    mean = sums.join(size, [*ks, "segment"]).withColumn("m", F.col("s") / F.col("size"))
    best = mean.groupBy(*ks, "segment").agg(
        F.max_by(F.struct("class_id", "m"), F.struct("m", -F.col("class_id"))).alias("b"), F.first("size").alias("size")
    )
    good = best.where((F.col("b.class_id") > 0) & (F.col("b.m") > min_p)).select(*ks, "segment", F.col("b.class_id").alias("_cls"), "size")
    won = pixels.join(good, [*ks, "segment"]).groupBy(*ks, "pixel").agg(F.min_by("_cls", F.struct("size", -F.col("segment"))).alias("_cls"))
    out = fallback.join(won, [*ks, "pixel"], "left")
    return out.select(*ks, "pixel", F.coalesce("_cls", "class_id").alias("class_id"))
