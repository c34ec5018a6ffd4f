"""Queries over the review database."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from maskloom.operators import review as R
from maskloom.plans.catalog import query
from maskloom.streaming import intake

_EFF = "eff AS (SELECT annotation_id, arg_min(status, (reviewed_at, review_id)) AS status, min(reviewed_at) AS reviewed_at FROM v_reviews GROUP BY 1)"


@query(f"""WITH {_EFF} SELECT i.dataset, i.filename, a.annotation_id, a.seconds, a.created_at, u.name AS annotator, e.reviewed_at
FROM eff e JOIN v_annotations a ON a.annotation_id = e.annotation_id JOIN v_images i ON i.image_id = a.image_id JOIN v_users u ON u.user_id = a.user_id
WHERE e.status = 'approved'""")
def approved_export(t):
    return R.approved_export(t.v_reviews, t.v_annotations, t.v_images, t.v_users)


_QUEUE = """SELECT a.annotation_id, a.image_id, a.user_id, a.seconds, a.created_at, i.dataset, i.filename, u.name AS annotator
FROM v_annotations a JOIN v_images i ON i.image_id = a.image_id JOIN v_users u ON u.user_id = a.user_id
WHERE NOT EXISTS (SELECT 1 FROM v_reviews r WHERE r.annotation_id = a.annotation_id)"""


def _queue(t):
    return R.review_queue(t.v_reviews, t.v_annotations, t.v_images, t.v_users)


@query(_QUEUE)
def review_queue(t):
    return _queue(t)


@query(f"WITH q AS ({_QUEUE}) SELECT DISTINCT 'dataset' AS filter, dataset AS value FROM q UNION ALL SELECT DISTINCT 'annotator', annotator FROM q")
def review_queue_filters(t):
    return R.queue_filters(_queue(t))


def _board(extra):
    return f"""WITH {_EFF}, g AS (SELECT u.user_id, u.name, count(a.annotation_id) AS annotated, CAST(sum(CASE WHEN e.status = 'approved' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
 CAST(floor(sum(a.seconds) / count(*) + 0.5) AS BIGINT) AS avg_time FROM v_users u LEFT JOIN v_annotations a ON a.user_id = u.user_id {extra}
 LEFT JOIN eff e ON e.annotation_id = a.annotation_id GROUP BY 1, 2 HAVING count(a.annotation_id) > 0)
SELECT row_number() OVER (ORDER BY annotated DESC, user_id) AS rank, * FROM g"""


@query(_board(""))
def leaderboard(t):
    return R.leaderboard(t.v_users, t.v_annotations, t.v_reviews)


@query(_board("AND a.created_at >= TIMESTAMP '2000-06-15 00:00:00' - INTERVAL 7 DAY"))
def leaderboard_week(t):
    since = dt.datetime(2000, 6, 15, tzinfo=dt.timezone.utc) - dt.timedelta(days=7)
    return R.leaderboard(t.v_users, t.v_annotations, t.v_reviews, since)


@query(f"""WITH {_EFF}, g AS (SELECT u.user_id, count(a.annotation_id) AS annotated, CAST(coalesce(sum(CAST(e.status = 'approved' AS INT)), 0) AS BIGINT) AS approved,
 CAST(coalesce(sum(CAST(e.status = 'rejected' AS INT)), 0) AS BIGINT) AS rejected, CAST(coalesce(sum(CAST(CAST(a.created_at AS DATE) = DATE '2000-06-15' AS INT)), 0) AS BIGINT) AS today
 FROM v_users u LEFT JOIN v_annotations a ON a.user_id = u.user_id LEFT JOIN eff e ON e.annotation_id = a.annotation_id GROUP BY 1)
SELECT *, annotated - approved - rejected AS pending_review, CASE WHEN approved + rejected > 0 THEN CAST(floor(approved / (approved + rejected) * 100 + 0.5) AS BIGINT) END AS approval_rate FROM g""")
def annotator_stats(t):
    return R.annotator_stats(t.v_users, t.v_annotations, t.v_reviews, dt.date(2000, 6, 15))


@query("SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending FROM v_images")
def image_totals(t):
    return R.image_totals(t.v_images)


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(created_at AS DATE) AS day FROM v_annotations),
g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS grp FROM d),
r AS (SELECT user_id, count(*) AS len, max(day) AS last FROM g GROUP BY user_id, grp)
SELECT user_id, arg_max(len, last) AS current_streak, max(len) AS longest_streak, CAST(max(last) AS DATE) AS last_active FROM r GROUP BY 1""")
def daily_streaks(t):
    return R.daily_streaks(t.v_annotations)


@query("""SELECT image_id, dataset, filename, priority, status FROM v_images WHERE status = 'pending' ORDER BY priority DESC, md5('42:' || image_id), image_id LIMIT 1""")
def next_task(t):
    return R.next_task(t.v_images)


_STATUS = f"""WITH {_EFF}, e AS (SELECT image_id, created_at AS made, 0 AS k, annotation_id, 'annotated' AS status FROM v_annotations UNION ALL
 SELECT a.image_id, eff.reviewed_at, 1, eff.annotation_id, eff.status FROM eff JOIN v_annotations a ON a.annotation_id = eff.annotation_id),
l AS (SELECT image_id, status FROM e QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY made DESC, k DESC, annotation_id DESC) = 1)
SELECT i.image_id, coalesce(l.status, 'pending') AS status FROM v_images i LEFT JOIN l ON l.image_id = i.image_id"""


@query(_STATUS)
def status_transitions(t):
    return R.status_transitions(t.v_images, t.v_annotations, t.v_reviews)


def _late_first(t, rows, at, run, parts=4):
    """Rows arrive in spans of time, the latest span first; ``run`` continues the stream after each. The rows are made once, not once for each span."""
    spark = rows.sparkSession
    folder = intake.state_folder(spark, "arrivals")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    low, high = rows.agg(F.min(F.unix_timestamp(at)), F.max(F.unix_timestamp(at))).first()
    step = (high - low) // parts + 1 if low is not None else 1
    out = None
    for i in reversed(range(parts if low is not None else 1)):
        span = rows.where(F.floor((F.unix_timestamp(at) - F.lit(low)) / step) == i) if low is not None else rows
        span.write.mode("append").parquet(f"{folder}/in")
        out = run(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), f"{folder}/stream")
    return out


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(created_at AS DATE) AS day FROM v_annotations),
g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS grp FROM d),
r AS (SELECT user_id, count(*) AS len, max(day) AS last FROM g GROUP BY user_id, grp)
SELECT user_id, arg_max(len, last) AS current_streak, max(len) AS longest_streak, CAST(max(last) AS DATE) AS last_active FROM r GROUP BY 1""")
def streak_late(t):
    rows = t.v_annotations.select("user_id", F.col("created_at").cast("timestamp").alias("created_at"))
    return _late_first(t, rows, "created_at", intake.streak_state)


@query("SELECT annotation_id, min(reviewed_at) AS reviewed_at, arg_min(review_id, (reviewed_at, review_id)) AS review_id, arg_min(status, (reviewed_at, review_id)) AS status FROM v_reviews GROUP BY 1")
def first_reviews(t):
    rows = t.v_reviews.select("annotation_id", "reviewed_at", "review_id", "status")
    return _late_first(t, rows, "reviewed_at", intake.first_reviews)


@query("SELECT DISTINCT user_id FROM v_annotations")
def intake_late(t):
    rows = t.v_annotations.select("user_id", F.col("created_at").cast("timestamp").alias("created_at"))
    return _late_first(t, rows, "created_at", lambda stream, folder: intake.incremental_intake(stream, "user_id", folder)).select("user_id")


@query(_STATUS)
def status_late(t):
    """Both streams in spans of time, the latest span first."""
    made = t.v_annotations.select("annotation_id", "image_id", "created_at")
    reviews = t.v_reviews.select("annotation_id", "reviewed_at", "review_id", "status")
    made_late = _late_first(t, made, "created_at", intake.made_state)
    return R.status_transitions(t.v_images, made_late, _late_first(t, reviews, "reviewed_at", intake.first_reviews))


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(created_at AS DATE) AS day FROM v_annotations),
g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS grp FROM d)
SELECT user_id, CAST(min(day) AS DATE) AS first_day, CAST(max(day) AS DATE) AS last_day FROM g GROUP BY user_id, grp""")
def activity_runs(t):
    """Batches by month through the delta table: runs of days that touch across batches become one."""
    return intake.activity_runs(t.v_annotations.select("user_id", "created_at"), intake.state_folder(t.spark, "runs"))
