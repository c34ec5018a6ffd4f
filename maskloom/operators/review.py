"""Review database: queue, export, leaderboard, streaks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.ranking import rank_in_buckets
from maskloom.session import cut


def effective_reviews(reviews: DataFrame) -> DataFrame:
    """The first review of an annotation counts; later ones are ignored."""
    first = F.min(F.struct("reviewed_at", "review_id", "status")).alias("_r")
    r = reviews.groupBy("annotation_id").agg(first)
    return r.select("annotation_id", "_r.reviewed_at", "_r.review_id", "_r.status")


def approved_export(reviews: DataFrame, annotations: DataFrame, images: DataFrame, users: DataFrame, dataset: str | None = None) -> DataFrame:
    ok = effective_reviews(reviews).where("status = 'approved'").select("annotation_id", "reviewed_at")
    imgs = images.select("image_id", "dataset", "filename")
    if dataset is not None:
        imgs = imgs.where(F.col("dataset") == dataset)
    out = ok.join(annotations, "annotation_id").join(imgs, "image_id").join(users.select("user_id", F.col("name").alias("annotator")), "user_id")
    return out.select("dataset", "filename", "annotation_id", "seconds", "created_at", "annotator", "reviewed_at").orderBy("dataset", "filename", "annotation_id")


def review_queue(reviews: DataFrame, annotations: DataFrame, images: DataFrame, users: DataFrame) -> DataFrame:
    """Annotations without a review, newest first."""
    waiting = annotations.join(reviews.select("annotation_id"), "annotation_id", "left_anti")
    out = waiting.join(images.select("image_id", "dataset", "filename"), "image_id")
    out = out.join(users.select("user_id", F.col("name").alias("annotator")), "user_id")
    cols = ["annotation_id", "image_id", "user_id", "seconds", "created_at", "dataset", "filename", "annotator"]
    return out.select(*cols).orderBy(F.desc("created_at"), "annotation_id")


def queue_filters(queue: DataFrame) -> DataFrame:
    """Distinct datasets and annotators of the queue."""
    pairs = F.explode(F.array(
        F.struct(F.lit("dataset").alias("filter"), F.col("dataset").alias("value")),
        F.struct(F.lit("annotator").alias("filter"), F.col("annotator").alias("value")),
    ))
    return queue.select(pairs.alias("p")).select("p.filter", "p.value").distinct()


def leaderboard(users: DataFrame, annotations: DataFrame, reviews: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Rank, annotated, approved and mean seconds per user with at least one annotation."""
    a = annotations if since is None else annotations.where(F.col("created_at") >= F.lit(since))
    r = effective_reviews(reviews).select("annotation_id", (F.col("status") == "approved").cast("int").alias("ok"))
    a = a.join(r, "annotation_id", "left")
    per = a.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("annotated"), F.coalesce(F.sum("ok"), F.lit(0)).cast("long").alias("approved"),
        (F.sum(F.coalesce("seconds", F.lit(0))) / F.count(F.lit(1))).alias("_avg"),
    )
    out = cut(per.join(users.select("user_id", "name"), "user_id"))  # one row per annotator
    ranked = rank_in_buckets(out, [F.col("user_id")], -F.col("annotated"))
    return ranked.select("rank", "user_id", "name", "annotated", "approved", F.floor(F.col("_avg") + 0.5).alias("avg_time"))


def annotator_stats(users: DataFrame, annotations: DataFrame, reviews: DataFrame, today: dt.date) -> DataFrame:
    r = effective_reviews(reviews).select("annotation_id", "status")
    a = annotations.join(r, "annotation_id", "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("annotated"), F.count_if(F.col("status") == "approved").alias("approved"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.count_if(F.to_date("created_at") == F.lit(today)).alias("today"),
    )
    out = users.join(a, "user_id", "left")
    n = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("annotated", "approved", "rejected", "today")}
    reviewed = n["approved"] + n["rejected"]
    return out.select(
        "user_id", *[c.alias(k) for k, c in n.items()], (n["annotated"] - reviewed).alias("pending_review"),
        F.when(reviewed > 0, F.floor(n["approved"] / reviewed * 100 + 0.5)).alias("approval_rate"),
    )


def image_totals(images: DataFrame) -> DataFrame:
    return images.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "pending").alias("pending"))


def daily_streaks(activity: DataFrame, user: str = "user_id", at: str = "created_at") -> DataFrame:
    """Longest run of active days and the run ending at the last active day.

    Windows run over distinct (user, day) rows, at most one per calendar day of a user.
    """
    days = activity.select(user, F.to_date(at).alias("day")).distinct()
    w = Window.partitionBy(user).orderBy("day")
    runs = days.withColumn("_grp", F.date_sub("day", F.row_number().over(w)))
    runs = runs.groupBy(user, "_grp").agg(F.count(F.lit(1)).alias("len"), F.max("day").alias("last"))
    return runs.groupBy(user).agg(
        F.max_by("len", "last").alias("current_streak"), F.max("len").alias("longest_streak"), F.max("last").alias("last_active")
    )


def next_task(images: DataFrame, status: str = "pending", seed: int = 42) -> DataFrame:
    tie = F.md5(F.concat(F.lit(f"{seed}:"), F.col("image_id").cast("string")))
    return images.where(F.col("status") == status).orderBy(F.desc("priority"), tie, "image_id").limit(1)


def status_transitions(images: DataFrame, annotations: DataFrame, reviews: DataFrame) -> DataFrame:
    """Status of every image after all events: pending, annotated, then the latest first-review."""
    made = annotations.select("image_id", F.struct("created_at", F.lit(0).alias("k"), F.col("annotation_id").alias("id"), F.lit("annotated").alias("status")).alias("e"))
    r = effective_reviews(reviews).join(annotations.select("annotation_id", "image_id"), "annotation_id")
    judged = r.select("image_id", F.struct(F.col("reviewed_at").alias("created_at"), F.lit(1).alias("k"), F.col("annotation_id").alias("id"), "status").alias("e"))
    last = made.unionByName(judged).groupBy("image_id").agg(F.max("e").alias("e"))
    out = images.select("image_id").join(last, "image_id", "left")
    return out.select("image_id", F.coalesce("e.status", F.lit("pending")).alias("status"))
