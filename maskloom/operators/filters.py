"""Row filters and first-match rejection rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.names import first_reason


def mentions(text: Column, words: Sequence[str]) -> Column:
    """Any word occurs anywhere in the whole lower-cased text."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(w)) for w in words], F.lit(False)), F.lit(False))


def first_reject_reason(items: DataFrame, keywords: Mapping[str, Sequence[str]], min_aspect: float = 1.1) -> DataFrame:
    """Keyword groups in order, then orientation, then type; NULL keeps the item.

    ``items`` needs ``prompt, width, height, type``.
    """
    rules = {name: mentions(F.col("prompt"), words) for name, words in keywords.items()}
    sized = (F.col("width") > 0) & (F.col("height") > 0)
    rules["landscape"] = sized & (F.col("height") / F.nullif(F.col("width"), F.lit(0)) < min_aspect)
    rules["not_image"] = ~F.col("type").eqNullSafe("image")
    return items.withColumn("reason", first_reason({k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}))


def reason_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def post_filter(
    posts: DataFrame, required_tag: str, reject_tags: Sequence[str], min_score: int = 30, ratings: Sequence[str] = ("g", "s"),
    extensions: Sequence[str] = ("png", "jpg", "jpeg", "webp"), min_dim: int = 512, max_aspect: float = 2.0,
) -> DataFrame:
    """Score, rating, type, required and rejected tags, size and aspect; ``tags`` is an array."""
    small, large = F.least("width", "height"), F.greatest("width", "height")
    return posts.where(
        (F.col("score") >= min_score) & F.col("rating").isin(list(ratings)) & F.col("file_ext").isin(list(extensions))
        & F.array_contains("tags", required_tag) & ~F.arrays_overlap("tags", F.array(*[F.lit(x) for x in reject_tags]))
        & (small >= min_dim) & (large / F.greatest(small, F.lit(1)) <= max_aspect)
    )


# Licences by their identifier.
ACCEPTED_LICENSES = ["MIT", "Apache-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-3.0", "CC-BY-SA-3.0", "0BSD", "Unlicense", "ISC"]
REJECTED_LICENSES = [
    "GPL-2.0", "GPL-3.0", "AGPL-3.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-3.0", "CC-BY-NC-SA-3.0",
    "CC-BY-NC-ND-4.0", "CC-BY-NC-ND-3.0", "CC-BY-ND-4.0", "CC-BY-ND-3.0",
]


def license_state(key: Column) -> Column:
    return F.when(key.isin(REJECTED_LICENSES), "rejected").when(key.isin(ACCEPTED_LICENSES), "accepted").otherwise("unknown")


def license_gate(items: DataFrame, key: str = "license", strict: bool = False) -> DataFrame:
    """Rejected licences never pass; unknown ones pass only when not strict."""
    state = license_state(F.coalesce(key, F.lit("")))
    return items.withColumn("license_state", state).where((state == "accepted") | ((state == "unknown") & F.lit(not strict)))


# Child folders that may hold the textures of a model.
TEXTURE_DIRS = ("textures", "parts", "images")


def dirs_with_companion(paths: DataFrame, model_suffixes: Sequence[str] = (".moc3", ".model3.json"), companion: str = ".png", children: Sequence[str] = TEXTURE_DIRS) -> DataFrame:
    """Model directories with a companion file in themselves, a named child, or their parent."""
    low = F.lower("path")
    parent = F.regexp_replace("path", "/[^/]*$", "")
    is_model = reduce(lambda a, b: a | b, [F.endswith(low, F.lit(s)) for s in model_suffixes])
    models = paths.where(is_model).select(parent.alias("dir")).distinct()
    art = paths.where(F.endswith(low, F.lit(companion))).select(parent.alias("_near")).distinct()
    up = F.when(F.contains("dir", F.lit("/")), F.regexp_replace("dir", "/[^/]*$", ""))
    near = F.array_compact(F.array(F.col("dir"), *[F.concat_ws("/", "dir", F.lit(c)) for c in children], up))
    return models.withColumn("_near", F.explode(near)).join(art, "_near", "left_semi").select("dir").distinct()


def tag_overlap_exclude(models: DataFrame, deny: Sequence[str], tags: str = "tags") -> DataFrame:
    low = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda x: F.lower(x))
    return models.where(~F.arrays_overlap(low, F.array(*[F.lit(d) for d in deny])))


def status_filter(examples: DataFrame, status: DataFrame, wanted: str, key: str = "example_id") -> DataFrame:
    return examples.join(status.where(F.col("status") == wanted).select(key), key, "left_semi")


def drop_rejected(examples: DataFrame, rejected: DataFrame, keys: Sequence[str] = ("dataset", "example_id")) -> DataFrame:
    return examples.join(rejected.select(*keys), list(keys), "left_anti")


def status_counts(status: DataFrame, names: Sequence[str] = ("reviewed", "rejected", "needs_review")) -> DataFrame:
    return status.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == n).alias(n) for n in names])


def confidence_summary(scores: DataFrame, score: str = "score") -> DataFrame:
    """Mean, exact median, extremes and band sizes."""
    from maskloom.functions.ranking import exact_quantiles

    median = exact_quantiles(scores, [], score, {"median": 0.5}).scalar()
    s = F.col(score)
    return scores.agg(
        F.count(F.lit(1)).alias("total"), F.bround(F.avg(s), 4).alias("mean"), F.bround(F.max(median), 4).alias("median"), F.min(s).alias("min"), F.max(s).alias("max"),
        F.count_if(s >= 0.5).alias("good"), F.count_if((s < 0.5) & (s >= 0.3)).alias("review"), F.count_if(s < 0.3).alias("likely_bad"),
    )


def low_confidence(scores: DataFrame, key: str, score: str = "score", limit: float = 0.5, very_low: float = 0.3) -> DataFrame:
    """Rows below the limit, worst first, with their band."""
    band = F.when(F.col(score) < very_low, "very_low").otherwise("low")
    return scores.where(F.col(score) < limit).select(key, score, band.alias("band")).orderBy(score, key)
