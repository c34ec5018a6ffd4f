"""Class balance, region geometry and metrics over run-length mask rows.

Input rows carry ``dataset, example_id, class_id, y, x0, len``. Every operator is a plain
aggregation with partial (map-side) combine; nothing here windows over an example's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.ranking import exact_quantiles
from maskloom.session import cut

EXAMPLE = ["dataset", "example_id"]


def class_names_for(df: DataFrame) -> DataFrame:
    """Left join the fixed class dimension (22 rows)."""
    names = dims.classes(df.sparkSession).select("class_id", "class_name")
    return df.join(F.broadcast(names), "class_id", "left")


def remap_labels(runs: DataFrame, mapping: dict[int, int] | None = None, limit: int = dims.NUM_CLASSES) -> DataFrame:
    """Ids at or above ``limit`` become NULL (ignored); ``mapping`` merges classes."""
    out = F.when(F.col("class_id") < limit, F.col("class_id"))
    for old, new in (mapping or {}).items():
        out = F.when(F.col("class_id") == old, F.lit(new)).otherwise(out)
    return runs.withColumn("class_id", out.cast("int"))


def class_totals(runs: DataFrame) -> DataFrame:
    """Pixels per class for the whole fixed dimension, absent classes as 0."""
    counts = runs.where(F.col("class_id").isNotNull()).groupBy("class_id").agg(F.sum("len").alias("pixels"))
    names = dims.classes(runs.sparkSession).select("class_id", "class_name")
    joined = F.broadcast(names).join(counts, "class_id", "left")
    return joined.select("class_id", "class_name", F.coalesce("pixels", F.lit(0)).cast("long").alias("pixels"))


def _share(of: Column, total: Column) -> Column:
    return F.when(total > 0, of / total).otherwise(F.lit(0.0))


def class_distribution(runs: DataFrame, digits: int = 4) -> DataFrame:
    """Pooled share of each foreground class in all foreground pixels."""
    totals = class_totals(runs).where("class_id > 0")
    fg = F.sum("pixels").over(_everything())
    return totals.select("class_id", "class_name", F.bround(_share(F.col("pixels"), fg), digits).alias("share"))


def _everything():
    from pyspark.sql import Window

    # only used on the class dimension: at most 22 rows
    return Window.partitionBy(F.lit(0))


def coverage_gaps(distribution: DataFrame, floor: float = 0.01) -> DataFrame:
    gap = F.when(F.col("share") == 0, "missing").when(F.col("share") < floor, "under_represented")
    return distribution.select("class_id", "class_name", "share", gap.alias("gap")).where("gap IS NOT NULL")


def median_frequency_weights(runs: DataFrame) -> DataFrame:
    """median(non-zero class frequency) / frequency, 0 for absent classes."""
    w = _everything()
    freq = class_totals(runs).withColumn("freq", _share(F.col("pixels"), F.sum("pixels").over(w)))
    present = F.when(F.col("freq") > 0, F.col("freq"))
    median = F.percentile(present, F.lit(0.5)).over(w)
    weight = F.when(F.col("freq") > 0, median / F.col("freq")).otherwise(F.lit(0.0))
    return freq.select("class_id", "class_name", "freq", weight.alias("weight"))


def class_balance_report(runs: DataFrame) -> DataFrame:
    """Share, gap flag and balancing weight in one pass over the runs."""
    w = _everything()
    t = class_totals(runs)
    total, fg = F.sum("pixels").over(w), F.sum(F.when(F.col("class_id") > 0, F.col("pixels"))).over(w)
    t = t.withColumn("freq", _share(F.col("pixels"), total)).withColumn(
        "share", F.when(F.col("class_id") > 0, F.bround(_share(F.col("pixels"), fg), 4))
    )
    median = F.percentile(F.when(F.col("freq") > 0, F.col("freq")), F.lit(0.5)).over(w)
    gap = F.when(F.col("share") == 0, "missing").when(F.col("share") < 0.01, "under_represented").otherwise("ok")
    return t.select(
        "class_id", "class_name", "pixels", "share", gap.alias("gap"),
        F.when(F.col("freq") > 0, median / F.col("freq")).otherwise(F.lit(0.0)).alias("weight"),
    )


def region_stats(runs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pixels, bounding box and centroid of every class present in an example."""
    keys = keys or EXAMPLE
    x_sum = F.col("len") * (2 * F.col("x0") + F.col("len") - 1) / 2.0
    return runs.where("class_id > 0").groupBy(*keys, "class_id").agg(
        F.sum("len").cast("long").alias("pixel_count"),
        F.min("x0").alias("x_min"), F.min("y").alias("y_min"),
        F.max(F.col("x0") + F.col("len") - 1).alias("x_max"), F.max("y").alias("y_max"),
        (F.sum(x_sum) / F.sum("len")).alias("cx"), (F.sum(F.col("y") * F.col("len")) / F.sum("len")).alias("cy"),
    )


def all_regions(stats: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per example and foreground class, absent classes included (22-row fan-out)."""
    keys = keys or EXAMPLE
    ids = F.array(*[F.lit(i) for i in range(1, dims.NUM_CLASSES)])
    frame = stats.select(*keys).distinct().withColumn("class_id", F.explode(ids))
    return frame.join(stats, [*keys, "class_id"], "left")


def region_geometry_2d(runs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or EXAMPLE
    full = class_names_for(all_regions(region_stats(runs, keys), keys))
    seen = F.col("pixel_count").isNotNull()
    size = lambda lo, hi: F.when(seen, F.col(hi) - F.col(lo) + 1).otherwise(0)
    return full.select(
        *keys, "class_id", F.col("class_name").alias("region"),
        size("x_min", "x_max").cast("int").alias("apparent_width"),
        size("y_min", "y_max").cast("int").alias("apparent_height"),
        *[F.col(c).cast("int").alias(c) for c in ("x_min", "y_min", "x_max", "y_max")],
        F.coalesce("pixel_count", F.lit(0)).cast("long").alias("pixel_count"), seen.alias("visible"),
    )


def region_centroid_joints(runs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Integer mean position per joint class; an absent class sits at -1 with confidence 0."""
    keys = keys or EXAMPLE
    full = all_regions(region_stats(runs, keys), keys).where(F.col("class_id") <= dims.NUM_JOINTS)
    seen = F.col("pixel_count").isNotNull()
    at = lambda c: F.when(seen, F.col(c).cast("int")).otherwise(-1)
    return class_names_for(full).select(
        *keys, F.col("class_name").alias("joint"), at("cx").alias("x"), at("cy").alias("y"),
        F.when(seen, 0.8).otherwise(F.lit(0.0)).alias("confidence"), seen.alias("visible"),
    )


def class_size_reference(runs: DataFrame) -> DataFrame:
    """Per class over the examples holding it: presence, mean, population sigma, quantiles."""
    known = F.col("class_id").between(1, dims.NUM_CLASSES - 1)
    per = runs.where(known).groupBy(*EXAMPLE, "class_id").agg(F.sum("len").alias("n"))
    fg = per.groupBy(*EXAMPLE).agg(F.sum("n").alias("fg"))
    frac = per.join(fg, EXAMPLE).select(*EXAMPLE, "class_id", (F.col("n") / F.col("fg")).alias("frac"))
    frac = cut(frac)  # at most 21 rows per mask, read by every statistic
    q = exact_quantiles(frac, ["class_id"], "frac", {"median": 0.5, "p10": 0.1, "p90": 0.9})
    n_examples = frac.select(*EXAMPLE).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    stats = frac.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("examples"), F.avg("frac").alias("mean"), F.stddev_pop("frac").alias("std")
    )
    out = stats.join(F.broadcast(q), "class_id")  # one row per class on both sides
    return class_names_for(out).select(
        "class_id", "class_name", "examples", F.bround(F.col("examples") / n_examples, 4).alias("presence_rate"),
        *[F.bround(c, 5).alias(c) for c in ("mean", "std", "median", "p10", "p90")],
    )


def region_mean_depth(points: DataFrame, region: str = "class_id", depth: str = "z") -> DataFrame:
    return points.groupBy(*EXAMPLE, region).agg(F.avg(depth).alias("mean_depth"), F.count(F.lit(1)).alias("n"))


def confusion(pred: DataFrame, num_classes: int = dims.NUM_CLASSES, ignore: int = -1) -> DataFrame:
    """Pixel counts per (gt, pred); additive, so it is also the state of the stream twin."""
    kept = (F.col("gt") != ignore) & (F.col("gt") < num_classes) & (F.col("pred") < num_classes)
    return pred.where(kept).groupBy("gt", "pred").agg(F.sum("w").cast("long").alias("n"))


def metrics_from_confusion(conf: DataFrame) -> DataFrame:
    """IoU and accuracy per class from the (at most 22 x 22) matrix."""
    hit = F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("gt").alias("c"), F.col("n").alias("row"), F.lit(0).cast("long").alias("col"), hit.cast("long").alias("hit")),
        F.struct(F.col("pred").alias("c"), F.lit(0).cast("long").alias("row"), F.col("n").alias("col"), F.lit(0).cast("long").alias("hit")),
    )
    s = conf.select(F.explode(sides).alias("s")).select("s.*")
    s = s.groupBy(F.col("c").alias("class_id")).agg(*[F.sum(c).alias(c) for c in ("row", "col", "hit")])
    union = F.col("row") + F.col("col") - F.col("hit")
    return class_names_for(s).select(
        "class_id", "class_name", F.col("row").alias("gt_pixels"), _share(F.col("hit"), union).alias("iou"),
        _share(F.col("hit"), F.col("row")).alias("accuracy"), F.col("hit").alias("correct"),
    )


def confusion_metrics(pred: DataFrame) -> DataFrame:
    return metrics_from_confusion(confusion(pred)).drop("correct")


def segmentation_summary(pred: DataFrame) -> DataFrame:
    """mIoU over classes with ground truth, and pixel accuracy."""
    m = metrics_from_confusion(confusion(pred))
    return m.agg(
        F.coalesce(F.avg(F.when(F.col("gt_pixels") > 0, F.col("iou"))), F.lit(0.0)).alias("miou"),
        _share(F.sum("correct"), F.sum("gt_pixels")).alias("pixel_accuracy"),
    )


def joint_metrics(rows: DataFrame) -> DataFrame:
    """Mean squared offset error per joint over visible joints, presence accuracy over all."""
    err = F.pow(F.col("pred_x") - F.col("gt_x"), 2) + F.pow(F.col("pred_y") - F.col("gt_y"), 2)
    return rows.groupBy("joint").agg(
        F.coalesce(F.avg(F.when(F.col("visible"), err)), F.lit(0.0)).alias("mse"),
        F.count_if(F.col("visible")).alias("n_visible"),
        F.count_if(F.col("visible") == F.col("pred_present")).alias("presence_correct"), F.count(F.lit(1)).alias("n"),
    )


def joint_summary(per_joint: DataFrame) -> DataFrame:
    return per_joint.agg(
        F.coalesce(F.avg(F.when(F.col("n_visible") > 0, F.col("mse"))), F.lit(0.0)).alias("mean_offset_error"),
        _share(F.sum("presence_correct"), F.sum("n")).alias("presence_accuracy"),
    )


def weight_metrics(rows: DataFrame) -> DataFrame:
    """Mean absolute weight error per bone over the vertices that have ground truth."""
    err = F.abs(F.col("pred_w") - F.col("gt_w"))
    return rows.groupBy("bone").agg(
        F.coalesce(F.avg(F.when(F.col("has_gt"), err)), F.lit(0.0)).alias("mae"),
        F.sum(F.when(F.col("has_gt"), err).otherwise(0.0)).alias("abs_error"), F.count_if(F.col("has_gt")).alias("n_gt"),
        F.count_if(F.col("has_gt") == F.col("pred_confident")).alias("confidence_correct"), F.count(F.lit(1)).alias("n"),
    )


def weight_summary(per_bone: DataFrame) -> DataFrame:
    return per_bone.agg(
        _share(F.sum("abs_error"), F.sum("n_gt")).alias("mae"),
        _share(F.sum("confidence_correct"), F.sum("n")).alias("confidence_accuracy"),
    )


def mirror_mask(runs: DataFrame, width: int) -> DataFrame:
    """Flip left to right and swap the paired classes."""
    pairs = dims.classes(runs.sparkSession).select("class_id", "pair_id")
    return runs.join(F.broadcast(pairs), "class_id", "left").select(
        *[c for c in runs.columns if c not in ("x0", "class_id")],
        (F.lit(width) - F.col("x0") - F.col("len")).alias("x0"), F.coalesce("pair_id", "class_id").alias("class_id"),
    )


def colour_to_class(pixels: DataFrame, labelmap: DataFrame | None = None) -> DataFrame:
    """Exact RGB match, unmatched colours become background."""
    if labelmap is not None:
        colours = labelmap.groupBy("r", "g", "b").agg(F.max("class_id").alias("class_id"))
    else:
        colours = F.broadcast(dims.classes(pixels.sparkSession).select("class_id", "r", "g", "b"))
    out = pixels.join(colours, ["r", "g", "b"], "left")
    return out.withColumn("class_id", F.coalesce("class_id", F.lit(0)))
