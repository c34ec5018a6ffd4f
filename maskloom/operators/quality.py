"""Rule-based quality scores over one wide row per mask.

:func:`mask_profile` needs one shuffle by example; every score is column arithmetic on it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.names import reasons
from maskloom.operators.masks import EXAMPLE

IDS = range(1, dims.NUM_CLASSES)


def n(i: int) -> Column:
    return F.col(f"n_{i}")


def present(ids: Iterable[int]) -> Column:
    """At least one of the classes has pixels; ``seen`` has one bit per class."""
    return F.col("seen").bitwiseAND(F.lit(sum(1 << i for i in ids))) != 0


def _sum(cols: Iterable[Column], zero: float = 0.0) -> Column:
    return sum(cols, F.lit(zero))


def mask_profile(runs: DataFrame, total_pixels: int | None = None, confidence: str | None = None) -> DataFrame:
    """Pixels per class, foreground, class count, head position and mean confidence of a mask.

    Without ``total_pixels`` the background rows must be in ``runs``.
    """
    cls, size = F.col("class_id"), F.col("len")
    aggs = [F.sum(F.when(cls == i, size).otherwise(0)).cast("long").alias(f"n_{i}") for i in IDS]
    aggs.append((F.lit(total_pixels) if total_pixels else F.sum(size)).cast("long").alias("total"))
    head = F.when(cls == dims.HEAD, size)
    aggs.append((F.sum(head * F.col("y")) / F.sum(head)).alias("head_y"))
    if confidence:
        fg_len = F.when(cls > 0, size)
        aggs.append((F.sum(F.col(confidence) * fg_len) / F.sum(fg_len) / 255.0).alias("mean_conf"))
    bit = F.when(cls > 0, F.expr("shiftleft(1L, class_id)"))
    aggs.append(F.coalesce(F.sum(F.when(cls > 0, size)), F.lit(0)).cast("long").alias("fg"))
    aggs.append(F.coalesce(F.bit_or(bit), F.lit(0)).alias("seen"))
    aggs.append(F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("int").alias("n_regions"))
    df = runs.groupBy(*EXAMPLE).agg(*aggs)
    return df.withColumns({
        "largest": F.greatest(*[n(i) for i in IDS]),
        "fg_ratio": F.when(F.col("total") > 0, F.col("fg") / F.col("total")).otherwise(0.0),
    })


def torso_median(runs: DataFrame) -> DataFrame:
    """Median row of the torso pixels, from a per-row histogram of the mask."""
    rows = runs.where(F.col("class_id").isin(*dims.TORSO)).groupBy(*EXAMPLE, "y").agg(F.sum("len").alias("k"))
    return rows.groupBy(*EXAMPLE).agg(F.percentile("y", F.lit(0.5), F.col("k")).alias("torso_y"))


def with_torso(runs: DataFrame, profile: DataFrame) -> DataFrame:
    return profile.join(torso_median(runs), EXAMPLE, "left")


def _share(i: int) -> Column:
    return F.when(F.col("fg") > 0, n(i) / F.col("fg")).otherwise(0.0)


def lr_asymmetry() -> list[Column]:
    """Relative area difference per pair; NULL when neither side is labelled."""
    return [F.when(F.greatest(n(a), n(b)) > 0, F.abs(n(a) - n(b)) / F.greatest(n(a), n(b))) for a, b in dims.LR_PAIRS]


@dataclass(frozen=True)
class MaskRules:
    """Thresholds; a rule whose threshold is None is off."""

    min_regions: int = 4
    max_single_region: float = 0.70
    min_foreground: float = 0.05
    skip_anatomy: bool = False
    drop_head_below_torso: bool = False
    max_lr_asymmetry: float | None = None
    max_disconn_per_class: int | None = None
    max_bg_bleed: float | None = None
    min_silhouette_coverage: float | None = None
    class_size_sigma: float = 3.0


def size_outlier(reference: DataFrame, sigma: float) -> Column:
    """Name of the first class whose share is too far from the reference.

    The reference has one row per class (at most 21), so it is read as constants.
    """
    rows = reference.select("class_id", "mean", "std").where(F.col("class_id").isin(list(IDS)) & (F.col("std") > 0)).collect()
    hits = [
        F.when((n(r.class_id) > 0) & (F.abs(_share(r.class_id) - r["mean"]) / r["std"] > sigma), F.lit(dims.CLASS_NAMES[r.class_id]))
        for r in sorted(rows, key=lambda r: r.class_id)
    ]
    return F.coalesce(*hits, F.lit(None).cast("string"))


def mask_quality_reasons(
    runs: DataFrame,
    rules: MaskRules = MaskRules(),
    components: DataFrame | None = None,
    overlap: DataFrame | None = None,
    reference: DataFrame | None = None,
    total_pixels: int | None = None,
) -> DataFrame:
    """Reasons to reject a mask, in rule order; an empty array passes.

    ``components(dataset, example_id, class_id, components)`` serves the fragment rule,
    ``overlap(dataset, example_id, alpha_px, covered_px)`` the silhouette rules.
    """
    df = mask_profile(runs, total_pixels)
    has_head, has_torso = present([dims.HEAD]), present(dims.TORSO)
    fg = F.col("fg") > 0
    rule = {
        "low_foreground": F.col("fg_ratio") < rules.min_foreground,
        "no_foreground": ~fg,
        "too_few_regions": fg & (F.col("n_regions") < rules.min_regions),
    }
    if not rules.skip_anatomy:
        rule |= {"missing_head": fg & ~has_head, "missing_torso": fg & ~has_torso}
    for i in IDS:
        rule[f"single_region_dominates({dims.CLASS_NAMES[i]})"] = fg & (_share(i) > rules.max_single_region)
    if rules.drop_head_below_torso:
        df = with_torso(runs, df)
        rule["head_below_torso"] = fg & (F.col("head_y") >= F.col("torso_y"))
    if rules.max_lr_asymmetry is not None:
        uneven = F.lit(False)
        for (a, b), asym in zip(dims.LR_PAIRS, lr_asymmetry()):
            uneven = uneven | ((n(a) > 0) & (n(b) > 0) & (asym > rules.max_lr_asymmetry))
        rule["lr_asymmetry"] = fg & uneven
    if rules.max_disconn_per_class is not None and components is not None:
        worst = components.groupBy(*EXAMPLE).agg(F.max("components").alias("worst_components"))
        df = df.join(worst, EXAMPLE, "left")
        rule["disconn_blobs"] = F.col("worst_components") > rules.max_disconn_per_class
    if overlap is not None:
        df = df.join(overlap.select(*EXAMPLE, "alpha_px", "covered_px"), EXAMPLE, "left")
        if rules.max_bg_bleed is not None:
            rule["bg_bleed"] = fg & ((F.col("fg") - F.col("covered_px")) / F.col("fg") > rules.max_bg_bleed)
        if rules.min_silhouette_coverage is not None:
            rule["low_coverage"] = fg & (F.col("alpha_px") > 0) & (F.col("covered_px") / F.col("alpha_px") < rules.min_silhouette_coverage)
    if reference is not None:
        df = df.withColumn("_outlier", size_outlier(reference, rules.class_size_sigma))
        rule["class_size_outlier"] = fg & F.col("_outlier").isNotNull()
    rule = {k: F.coalesce(v, F.lit(False)) for k, v in rule.items()}
    return df.select(*EXAMPLE, "fg_ratio", "n_regions", reasons(rule).alias("reasons"))


def quality_summary(judged: DataFrame) -> DataFrame:
    ok = F.size("reasons") == 0
    return judged.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("rejected"),
        F.bround(F.count_if(~ok) / F.count(F.lit(1)), 4).alias("reject_rate"),
    )


def audit_badness(runs: DataFrame, components: DataFrame | None = None, confidence: str | None = None) -> DataFrame:
    """Six metrics and their weighted badness; an empty mask scores 1."""
    df = with_torso(runs, mask_profile(runs, confidence=confidence))
    conf = F.col("mean_conf") if confidence else F.lit(None).cast("double")
    blobs = F.col("n_regions").cast("long")
    if components is not None:
        per = components.groupBy(*EXAMPLE).agg(F.sum("components").alias("blobs"))
        df, blobs = df.join(per, EXAMPLE, "left"), F.coalesce("blobs", F.lit(0))
    largest = F.when(F.col("fg") > 0, F.col("largest") / F.col("fg")).otherwise(0.0)
    asym = F.coalesce(F.greatest(*lr_asymmetry()), F.lit(0.0))
    above = F.when(F.col("head_y") < F.col("torso_y"), 1).otherwise(0)
    both = present([dims.HEAD]) & present(dims.TORSO)
    bad = (
        F.coalesce((1.0 - conf) * 0.6, F.lit(0.0)) + F.greatest(F.lit(0.0), largest - 0.5)
        + F.greatest(F.lit(0), 6 - F.col("n_regions")) * 0.15 + F.greatest(F.lit(0), blobs - F.col("n_regions") - 2) * 0.05
        + F.when(both, (1 - above) * 0.6).otherwise(0.0) + F.greatest(F.lit(0.0), asym - 0.7) * 0.5
    )
    return df.select(
        *EXAMPLE, F.coalesce(conf, F.lit(-1.0)).alias("mean_conf"), largest.alias("largest_frac"), F.col("n_regions").alias("n_classes"),
        blobs.alias("disconn_count"), F.when(both, above).otherwise(0).alias("head_above_torso"), asym.alias("lr_asymmetry"),
        F.when(F.col("fg") == 0, 1.0).otherwise(bad).alias("badness"),
    )


def triage(
    runs: DataFrame,
    accept: float = 0.7,
    reject: float = 0.3,
    confidence: str | None = None,
    overlap: DataFrame | None = None,
    reviewed: DataFrame | None = None,
) -> DataFrame:
    """Penalty sum to a score, then accept / review / reject; reviewed masks are skipped."""
    if reviewed is not None:
        runs = runs.join(reviewed.select(*EXAMPLE).distinct(), EXAMPLE, "left_anti")
    df = mask_profile(runs, confidence=confidence)
    if overlap is not None:
        df = df.join(overlap.select(*EXAMPLE, "alpha_px", "covered_px"), EXAMPLE, "left")
    ratio, regions, fg = F.col("fg_ratio"), F.col("n_regions"), F.col("fg")
    arm_l, arm_r, leg_l, leg_r = (present(g) for g in (dims.ARM_L, dims.ARM_R, dims.LEG_L, dims.LEG_R))
    large = {i: (fg > 0) & (_share(i) > 0.5) for i in IDS if i not in (20, 21)}
    rules: list[tuple[str, Column, float]] = [
        ("very_small_foreground", ratio < 0.05, 0.5), ("small_foreground", (ratio >= 0.05) & (ratio < 0.1), 0.2),
        ("foreground_fills_image", ratio > 0.9, 0.3), ("too_few_regions", regions < 3, 0.6),
        ("few_regions", (regions >= 3) & (regions < 5), 0.2), ("missing_head", n(1) == 0, 0.3), ("missing_chest", n(3) == 0, 0.3),
        ("missing_arms", ~(arm_l | arm_r), 0.2), ("missing_legs", ~(leg_l | leg_r), 0.15),
        *[(f"too_large({dims.CLASS_NAMES[i]})", c, 0.25) for i, c in large.items()],
        ("head_extremely_small", (n(1) > 0) & (_share(1) < 0.01), 0.15),
        ("asymmetric_arms", arm_l != arm_r, 0.05), ("asymmetric_legs", leg_l != leg_r, 0.05),
    ]
    if overlap is not None:
        open_share = (F.col("alpha_px") - F.col("covered_px")) / F.nullif(F.col("alpha_px"), F.lit(0))
        rules += [("large_unlabelled_foreground", open_share > 0.3, 0.25), ("some_unlabelled_foreground", (open_share > 0.15) & (open_share <= 0.3), 0.1)]
    rules = [(name, F.coalesce(c, F.lit(False)), p) for name, c, p in rules]
    penalty = _sum(F.when(c, p).otherwise(0.0) for _, c, p in rules)
    score = F.greatest(F.lit(0.0), 1.0 - F.round(penalty, 6))
    why = {name: c for name, c, _ in rules}
    if confidence:
        conf = F.when(fg > 0, F.col("mean_conf"))
        why |= {"low_confidence": F.coalesce(conf < 0.3, F.lit(False)), "moderate_confidence": F.coalesce((conf >= 0.3) & (conf < 0.5), F.lit(False))}
        score = (
            F.when(conf < 0.3, F.greatest(F.lit(0.0), score - 0.3)).when(conf < 0.5, F.greatest(F.lit(0.0), score - 0.1))
            .when(conf > 0.8, F.least(F.lit(1.0), score + 0.1)).otherwise(score)
        )
    score = F.round(score, 6)
    decision = F.when(score >= accept, "accept").when(score <= reject, "reject").otherwise("review")
    return df.select(*EXAMPLE, score.alias("score"), reasons(why).alias("reasons"), decision.alias("decision"))


def anatomy_score(runs: DataFrame, min_score: float = 1.0) -> DataFrame:
    df = mask_profile(runs)
    torso, head = present(dims.TORSO), present((1, 2))
    arms, legs = present((*dims.ARM_L, *dims.ARM_R)), present((*dims.LEG_L, *dims.LEG_R))
    one = lambda c, w: F.when(c, w).otherwise(0.0)
    score = (
        one(torso, 1.0) + one(head, 0.5) + one(arms, 0.3) + one(legs, 0.3)
        + F.least(F.col("n_regions") / 20.0, F.lit(0.5)) + F.least(F.col("fg_ratio") / 0.3, F.lit(0.4))
    )
    reason = F.when(~torso, "no_torso").when(score < min_score, "low_score")
    return df.select(
        *EXAMPLE, torso.alias("has_torso"), head.alias("has_head"), arms.alias("has_arms"), legs.alias("has_legs"),
        F.col("n_regions").alias("num_regions"), F.bround("fg_ratio", 3).alias("fg_ratio"), F.bround(score, 3).alias("score"), reason.alias("reason"),
    )


def mapping_review_order(scored: DataFrame) -> DataFrame:
    """Kept masks worst first, rejected ones after them."""
    return scored.orderBy(F.col("reason").isNotNull(), "score", "example_id")


def composite_score(runs: DataFrame) -> DataFrame:
    """Critical parts .30, class count .25, symmetry .20, balance .15, foreground .10."""
    df = mask_profile(runs)
    groups = [(1,), (3,), (5,), (7, 8, 9), (11, 12, 13), dims.LEG_L, dims.LEG_R]
    critical = _sum(F.when(present(g), 1).otherwise(0) for g in groups) / 7.0
    pairs = [F.when(F.greatest(n(a), n(b)) > 0, F.least(n(a), n(b)) / F.greatest(n(a), n(b))) for a, b in dims.LR_PAIRS]
    known = _sum((F.when(p.isNotNull(), 1).otherwise(0) for p in pairs), 0)
    symmetry = F.when(known > 0, _sum(F.coalesce(p, F.lit(0.0)) for p in pairs) / known).otherwise(0.0)
    balance = F.when(F.col("fg") > 0, 1.0 - F.col("largest") / F.col("fg")).otherwise(0.0)
    ratio = F.col("fg_ratio")
    fg_score = F.when(ratio < 0.1, ratio / 0.1).when(ratio > 0.7, (1.0 - ratio) / 0.3).otherwise(1.0)
    total = 0.30 * critical + 0.25 * F.least(F.col("n_regions") / 15.0, F.lit(1.0)) + 0.20 * symmetry + 0.15 * balance + 0.10 * fg_score
    return df.select(
        *EXAMPLE, F.col("n_regions").alias("num_regions"), F.bround(ratio, 4).alias("fg_ratio"), F.bround(critical, 3).alias("critical_score"),
        F.bround(symmetry, 3).alias("symmetry"), F.bround(balance, 3).alias("balance"), F.bround(total, 4).alias("composite"),
    )


def mask_checks(runs: DataFrame, max_fraction: float = 0.6) -> DataFrame:
    """Uniqueness and dominance; the first class above the limit is reported."""
    df = mask_profile(runs)
    over = F.coalesce(*[F.when(_share(i) > max_fraction, F.lit(i)) for i in IDS])
    return df.select(
        *EXAMPLE, ((F.col("fg") == 0) | (F.col("n_regions") >= 2)).alias("unique_ok"),
        over.isNull().alias("dominance_ok"), over.cast("int").alias("dominant_class"),
    )


def render_sanity(
    alpha: DataFrame, width: int, height: int, min_fg: int = 5000, min_percent: float = 3.0, min_fill: float = 0.15, max_aspect: float = 3.5,
    keys: list[str] | None = None,
) -> DataFrame:
    """Corruption signs of a rendered silhouette; too few pixels end the check."""
    keys = keys or ["example_id"]
    df = alpha.groupBy(*keys).agg(
        F.sum("len").cast("long").alias("fg_pixels"), F.min("x0").alias("_x0"), F.max(F.col("x0") + F.col("len") - 1).alias("_x1"),
        F.min("y").alias("_y0"), F.max("y").alias("_y1"),
    )
    bw, bh = F.col("_x1") - F.col("_x0") + 1, F.col("_y1") - F.col("_y0") + 1
    percent, fill, aspect = 100.0 * F.col("fg_pixels") / (width * height), F.col("fg_pixels") / (bw * bh), bh / bw
    enough = F.col("fg_pixels") >= min_fg
    why = reasons({
        "fg_pixels": ~enough, "fg_percent": enough & (percent < min_percent), "fill_ratio": enough & (fill < min_fill), "aspect_ratio": enough & (aspect > max_aspect),
    })
    return df.select(
        *keys, "fg_pixels", F.bround(percent, 2).alias("fg_percent"), F.when(enough, F.bround(fill, 3)).alias("fill_ratio"),
        F.when(enough, F.bround(aspect, 2)).alias("aspect_ratio"), why.alias("reasons"), (F.size(why) > 0).alias("is_bad"),
    )


def normal_map_quality(pixels: DataFrame, min_fg: int = 500, max_dominant: float = 0.8, min_std: float = 15.0) -> DataFrame:
    """Dominant 4-bit colour share, mean channel sigma, front-facing share of foreground normals.

    ``pixels(example_id, r, g, b, len)``; sums per colour bucket come first, so the second
    aggregation sees at most 4096 rows per map.
    """
    bucket = F.floor(F.col("r") / 16) * 256 + F.floor(F.col("g") / 16) * 16 + F.floor(F.col("b") / 16)
    w = F.col("len")
    sums = [F.sum(w * F.col(c)).alias(f"s_{c}") for c in "rgb"] + [F.sum(w * F.col(c) * F.col(c)).alias(f"q_{c}") for c in "rgb"]
    per = pixels.groupBy("example_id", bucket.alias("bucket")).agg(
        F.sum(w).alias("k"), F.sum(F.when(F.col("b") / 255.0 > 0.6, w).otherwise(0)).alias("front"), *sums
    )
    df = per.groupBy("example_id").agg(
        F.sum("k").cast("long").alias("fg_pixels"), F.max("k").alias("top"), F.sum("front").alias("front"),
        *[F.sum(f"{p}_{c}").alias(f"{p}_{c}") for p in "sq" for c in "rgb"],
    )
    fg = F.col("fg_pixels")
    std = {c: F.sqrt(F.greatest(F.lit(0.0), (F.col(f"q_{c}") * fg - F.col(f"s_{c}") * F.col(f"s_{c}")) / (fg * fg))) for c in "rgb"}
    mean_std = (std["r"] + std["g"] + std["b"]) / 3.0
    dominant = F.col("top") / fg
    few = fg < min_fg
    reason = (
        F.when(few, "too_few_fg_pixels").when((dominant > max_dominant) & (mean_std < min_std), "dominant_color;low_std")
        .when(dominant > max_dominant, "dominant_color").when(mean_std < min_std, "low_std").otherwise("")
    )
    return df.select(
        "example_id", "fg_pixels", (reason == "").alias("passed"), reason.alias("reject_reason"),
        F.when(~few, F.bround(dominant, 4)).alias("dominant_color_ratio"), F.when(~few, F.bround(mean_std, 2)).alias("mean_std"),
        *[F.when(~few, F.bround(F.col(f"s_{c}") / fg / 127.5 - 1.0, 4)).alias(f"mean_normal_{c}") for c in "rgb"],
        F.when(~few, F.bround(F.col("front") / fg, 4)).alias("front_facing_ratio"),
    )


def degenerate_raster(wanted: DataFrame, runs: DataFrame, key: str = "example_id", value: str = "v0", strict: bool = False) -> DataFrame:
    """Maps to regenerate: missing, all zero or near constant (stricter limits for training)."""
    w, v = F.col("len"), F.col(value)
    df = runs.groupBy(key).agg(F.sum(w).alias("k"), F.sum(w * v).alias("s"), F.sum(w * v * v).alias("q"), F.max(v).alias("top"))
    std = F.sqrt(F.greatest(F.lit(0.0), (F.col("q") * F.col("k") - F.col("s") * F.col("s")) / (F.col("k") * F.col("k"))))
    flat = ((F.col("top") < 10) | (std < 5)) if strict else ((F.col("top") == 0) | (std < 1.0))
    out = wanted.select(key).join(df, key, "left")
    state = F.when(F.col("k").isNull(), "missing").when(flat, "degenerate").otherwise("ok")
    return out.select(key, state.alias("state"))


def annotation_priority(runs: DataFrame, boost: Iterable[int], confidence: str | None = None) -> DataFrame:
    """+10 per boosted class present, +5 below six classes, up to +20 for low confidence."""
    cls = F.col("class_id")
    aggs = [F.max(F.when(cls == i, 1).otherwise(0)).alias(f"b_{i}") for i in boost]
    aggs += [F.max(F.when(cls == i, 1).otherwise(0)).alias(f"p_{i}") for i in IDS]
    if confidence:
        aggs.append((F.sum(F.col(confidence) * F.col("len")) / F.sum("len")).alias("conf"))
    df = runs.groupBy(*EXAMPLE).agg(*aggs)
    score = _sum((F.col(f"b_{i}") * 10 for i in boost), 0) + F.when(_sum((F.col(f"p_{i}") for i in IDS), 0) < 6, 5).otherwise(0)
    if confidence:
        score = score + F.floor(20 * (1.0 - F.col("conf") / 255.0))
    return df.select(*EXAMPLE, score.cast("long").alias("priority"))


def worst_n(scored: DataFrame, score: str, k: int, ascending: bool = False) -> DataFrame:
    """The k worst rows, ties by id."""
    order = F.col(score).asc() if ascending else F.col(score).desc()
    return scored.orderBy(order, "example_id").limit(k)


def joint_set_check(joints: DataFrame, expected: list[str]) -> DataFrame:
    """Missing and unexpected joint names of an example."""
    known = F.col("joint").isin(expected)
    per = joints.groupBy("example_id", "joint").agg(F.count(F.lit(1)).alias("k"))
    df = per.groupBy("example_id").agg(F.count(F.lit(1)).alias("n_joints"), *[
        F.max(F.when(F.col("joint") == j, 1).otherwise(0)).alias(f"_j{i}") for i, j in enumerate(expected)
    ], F.count_if(~known).alias("n_unexpected"))
    missing = F.array_compact(F.array(*[F.when(F.col(f"_j{i}") == 0, F.lit(j)) for i, j in enumerate(expected)]))
    return df.select("example_id", "n_joints", F.array_sort(missing).alias("missing"), "n_unexpected").withColumn(
        "passed", (F.col("n_joints") == len(expected)) & (F.size("missing") == 0)
    )


def joint_bounds_check(joints: DataFrame) -> DataFrame:
    """Visible joints outside their image, one row each."""
    out = (F.col("x") < 0) | (F.col("x") >= F.col("img_w")) | (F.col("y") < 0) | (F.col("y") >= F.col("img_h"))
    return joints.where(F.col("visible") & out).select("example_id", "joint", "x", "y")
