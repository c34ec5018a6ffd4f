"""3-D and 2-D measurements, multi-view consistency, proportion clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.geometry import classify_proportions
from maskloom.functions.ranking import exact_quantiles
from maskloom.session import cut

MIDLINE = ("head", "neck", "chest", "spine", "hips")
VIEW = ["char_id", "pose"]


def region_geometry_3d(vertices: DataFrame, keys: Sequence[str] = ("char_id",)) -> DataFrame:
    ext = lambda c: F.bround(F.max(c) - F.min(c), 6)
    mid = lambda c: F.bround((F.max(c) + F.min(c)) / 2.0, 6)
    return vertices.groupBy(*keys, "region").agg(
        ext("x").alias("width"), ext("y").alias("depth"), ext("z").alias("height"),
        mid("x").alias("cx"), mid("y").alias("cy"), mid("z").alias("cz"), F.count(F.lit(1)).alias("vertex_count"),
    )


def apparent_vs_true_pairs(apparent: DataFrame, truth: DataFrame) -> DataFrame:
    """Visible 2-D measurements with the 3-D truth of the same character and region."""
    seen = apparent.where("visible").select("char_id", "pose", "angle", "region", "apparent_width", "apparent_height", "pixel_count")
    t = truth.select("char_id", "region", F.col("width").alias("true_width"), F.col("depth").alias("true_depth"), F.col("height").alias("true_height"))
    degrees = F.create_map(*[x for name, (a, e) in dims.CAMERA_ANGLES.items() for x in (F.lit(name), F.struct(F.lit(a).alias("azimuth"), F.lit(e).alias("elevation")))])
    found = F.try_element_at(degrees, F.col("angle"))
    return seen.join(t, ["char_id", "region"]).withColumn("azimuth", found["azimuth"]).withColumn("elevation", found["elevation"])


def angle_pairs(measured: DataFrame, min_pixels: int = 50) -> DataFrame:
    """Views a < b of the same character, pose and region that both show it.

    Rows of one angle count once, so a region has a short array of views and its pairs are
    unfolded in place.
    """
    known = measured.where(F.col("visible") & (F.col("pixel_count") >= min_pixels) & F.col("angle").isNotNull())
    per = known.groupBy(*VIEW, "region", "angle").agg(F.max("pixel_count").alias("pixels"))
    views = F.array_sort(F.collect_list(F.struct("angle", "pixels"))).alias("v")
    g = per.groupBy(*VIEW, "region").agg(views).where(F.size("v") > 1)
    g = g.select(*VIEW, "region", "v", F.posexplode("v").alias("i", "a"))
    g = g.select(*VIEW, "region", "a", F.explode(F.slice("v", F.col("i") + 2, F.size("v"))).alias("b"))
    return g.select(*VIEW, "region", F.col("a.angle").alias("angle_a"), F.col("b.angle").alias("angle_b"), F.col("a.pixels").alias("pixels_a"), F.col("b.pixels").alias("pixels_b"))


def multiview_checks(measured: DataFrame, truth: DataFrame, threshold: float = 0.10, min_pixels: int = 50) -> DataFrame:
    """One row per comparison: check, region, angles and whether it failed."""
    n_views = measured.groupBy(*VIEW).agg(F.count_distinct("angle").alias("n")).where("n >= 2").select(*VIEW)
    m = measured.join(n_views, VIEW, "left_semi")
    mid = m.where(F.col("region").isin(*MIDLINE)).groupBy(*VIEW, "region").agg(
        F.min(F.when(F.col("visible"), F.col("angle"))).alias("angle_a"), F.min(F.when(~F.col("visible"), F.col("angle"))).alias("angle_b")
    )
    presence = mid.select(F.lit("region_presence").alias("check"), *VIEW, "region", "angle_a", "angle_b", (F.col("angle_a").isNotNull() & F.col("angle_b").isNotNull()).alias("failed"))
    p = angle_pairs(m, min_pixels)
    dev = F.abs(F.col("pixels_a") - F.col("pixels_b")) / ((F.col("pixels_a") + F.col("pixels_b")) / 2.0)
    area = p.select(F.lit("pixel_area_consistency").alias("check"), *VIEW, "region", "angle_a", "angle_b", (dev > threshold).alias("failed"))
    width = lambda a: F.max(F.when((F.col("angle") == a) & F.col("visible"), F.col("apparent_width")))
    fs = m.where(F.col("angle").isin("front", "side")).groupBy(*VIEW, "region").agg(width("front").alias("fw"), width("side").alias("sw"))
    fs = fs.where((F.col("fw") >= 1) & (F.col("sw") >= 1)).join(truth.where("width > 0 AND depth > 0").select("char_id", "region", "width", "depth"), ["char_id", "region"])
    true = F.col("width") / F.col("depth")
    off = F.abs(F.col("fw") / F.col("sw") - true) / true
    ratio = fs.select(F.lit("measurement_ratio").alias("check"), *VIEW, "region", F.lit("front").alias("angle_a"), F.lit("side").alias("angle_b"), (off > threshold).alias("failed"))
    return presence.unionByName(area).unionByName(ratio)


def check_report(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check").agg(F.count_if(~F.col("failed")).alias("passed"), F.count_if("failed").alias("failed"))


def worst_regions(checks: DataFrame, top: int = 5) -> DataFrame:
    bad = checks.where("failed").groupBy("region").agg(F.count(F.lit(1)).alias("failures"))
    return bad.orderBy(F.desc("failures"), "region").limit(top)


def worst_angle_pairs(checks: DataFrame, top: int = 5) -> DataFrame:
    pair = F.concat_ws(" vs ", "angle_a", "angle_b").alias("angles")
    bad = checks.where("failed").groupBy(pair).agg(F.count(F.lit(1)).alias("failures"))
    return bad.orderBy(F.desc("failures"), "angles").limit(top)


# --- proportions ---

FEATURES = [
    "head_to_body_height", "arm_length_to_torso", "leg_length_to_torso", "shoulder_to_hip_width", "arm_thickness_ratio",
    "leg_thickness_ratio", "head_width_to_shoulder", "hand_to_arm_ratio", "foot_to_leg_ratio",
]


def proportion_features(measured: DataFrame, key: str = "char_id") -> DataFrame:
    """Nine ratios from one pivoted row per character; a missing or zero part makes them NULL."""
    width_of = ["head", "chest", "hips", "shoulder_l", "shoulder_r", *[f"{p}_{s}" for p in ("upper_arm", "forearm", "upper_leg", "lower_leg") for s in "lr"]]
    height_of = ["head", "chest", "spine", "hips", *[f"{p}_{s}" for p in ("upper_arm", "forearm", "hand", "upper_leg", "lower_leg", "foot") for s in "lr"]]
    pick = lambda r, d: F.max(F.when((F.col("region") == r) & (F.col(d) > 0), F.col(d)))
    wide = measured.groupBy(key).agg(*[pick(r, "width").alias(f"w_{r}") for r in width_of], *[pick(r, "height").alias(f"h_{r}") for r in height_of])
    c = F.col

    def avg(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), (a + b) / 2).otherwise(F.coalesce(a, b))

    pair = lambda d, p: avg(c(f"{d}_{p}_l"), c(f"{d}_{p}_r"))
    over = lambda a, b: F.when(b > 0, a / b)
    torso = c("h_chest") + c("h_spine") + c("h_hips")
    arm, leg = pair("h", "upper_arm") + pair("h", "forearm"), pair("h", "upper_leg") + pair("h", "lower_leg")
    shoulder = c("w_shoulder_l") + c("w_shoulder_r") + c("w_chest")
    f = {
        "head_to_body_height": over(c("h_head"), torso), "arm_length_to_torso": over(arm + pair("h", "hand"), torso),
        "leg_length_to_torso": over(leg + pair("h", "foot"), torso), "shoulder_to_hip_width": over(shoulder, c("w_hips")),
        "arm_thickness_ratio": over(avg(pair("w", "upper_arm"), pair("w", "forearm")), c("w_chest")),
        "leg_thickness_ratio": over(avg(pair("w", "upper_leg"), pair("w", "lower_leg")), c("w_hips")),
        "head_width_to_shoulder": over(c("w_head"), shoulder), "hand_to_arm_ratio": over(pair("h", "hand"), arm), "foot_to_leg_ratio": over(pair("h", "foot"), leg),
    }
    return wide.select(key, *[col.alias(n) for n, col in f.items()])


def proportion_archetypes(features: DataFrame) -> DataFrame:
    args = [F.coalesce(c, F.lit(0.0)) for c in ("head_to_body_height", "leg_length_to_torso", "shoulder_to_hip_width", "arm_thickness_ratio", "leg_thickness_ratio")]
    return features.withColumn("archetype", classify_proportions(*args))


def profile_summary(measured: DataFrame, source: Column, min_regions: int = 10) -> DataFrame:
    """Per character: source, measured regions, vertices, and width, depth and height of each region as a map (fixed keys)."""
    size = F.struct(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("width", "depth", "height")])
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("region", size.alias("size")))))
    df = measured.where(F.col("region").isin(dims.CLASS_NAMES)).groupBy("char_id").agg(
        F.count(F.lit(1)).alias("measured_regions"), F.sum("vertex_count").cast("long").alias("total_vertices"), entries.alias("measurements")
    )
    return df.where(F.col("measured_regions") >= min_regions).withColumn("source", source)


def feature_medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median per feature; one number per feature column reaches the driver."""
    long = df.select(*features).unpivot([], list(features), "feature", "value")
    rows = exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect()
    return {r.feature: r.median for r in rows}


def impute_scale(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Median imputation and z-score with population sigma (0 becomes 1).

    The medians, means and sigmas are constants of the final projection, so the table itself
    is not shuffled.
    """
    med = feature_medians(df, features)
    filled = df.select(*keep, *[F.coalesce(f, F.lit(med.get(f))).alias(f) for f in features])
    stats: Row = filled.agg(*[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_pop(f).alias(f"s_{f}") for f in features]).first()
    z = [((F.col(f) - F.lit(stats[f"m_{f}"])) / F.lit(stats[f"s_{f}"] or 1.0)).alias(f"z_{f}") for f in features]
    return filled.select(*keep, *features, *z)


def kmeans_select_k(df: DataFrame, key: str, features: Sequence[str], min_k: int = 2, max_k: int = 10, seed: int = 42) -> DataFrame:
    """Clusters for the k of the best silhouette: size, label and centroid in original units."""
    scaled = cut(impute_scale(df, features, [key]).withColumn("_v", array_to_vector(F.array(*[f"z_{f}" for f in features]).cast("array<double>"))))
    rows = scaled.count()
    best = (None, 1, None)
    if rows >= 5:
        judge = ClusteringEvaluator(featuresCol="_v", predictionCol="cluster")
        for k in range(min_k, min(max_k, rows - 1) + 1):
            out = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(scaled).transform(scaled)
            if out.select("cluster").distinct().limit(2).count() < 2:
                continue
            score = judge.evaluate(out)
            if best[0] is None or score > best[0]:
                best = (score, k, out)
    score, k, out = best
    if out is None:
        out = scaled.withColumn("cluster", F.lit(0))
    sizes = out.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.bround(F.avg(f), 4).alias(f) for f in features])
    return sizes.withColumns({"k": F.lit(k), "silhouette": F.lit(None if score is None else round(score, 4)).cast("double")}).orderBy(F.desc("n"), "cluster")


def label_clusters(clusters: DataFrame) -> DataFrame:
    """Archetype per cluster; a repeated label gets the cluster number (at most ``k`` rows)."""
    from pyspark.sql import Window

    named = proportion_archetypes(clusters)
    nth = F.row_number().over(Window.partitionBy("archetype").orderBy("cluster"))
    return named.withColumn("label", F.when(nth == 1, F.col("archetype")).otherwise(F.concat_ws("_", "archetype", F.col("cluster").cast("string")))).drop("archetype")
