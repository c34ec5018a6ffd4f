"""Ranks, running sums, neighbours and exact quantiles without hot groups.

A plain ``row_number() over (partition by g order by k)`` sorts all rows of one
group in one task. These helpers split each group into ordered buckets, count per
bucket (partial aggregation), take the prefix sum over the small bucket table and
number the rows inside a bucket only. The result is the same for every group size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.session import cut, dealt


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys of ``left`` are kept."""
    if not keys:
        raise ValueError("keys are needed")
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def rank_in_buckets(
    df: DataFrame,
    order: Sequence[Column],
    bucket: Column,
    group: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """1-based rank by ``order`` inside ``group``.

    ``bucket`` must not decrease along ``order``. It bounds the rows one task sorts.
    """
    keys = list(group)
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_base", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_cnt").over(Window.partitionBy(*keys)))
    offsets = offsets.drop("_cnt")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = rows.withColumn("_pos", F.row_number().over(inside))
    out = null_safe_join(ranked, offsets, [*keys, "_bucket"])
    return out.withColumn(rank, (F.col("_base") + F.col("_pos")).cast("long")).drop("_bucket", "_base", "_pos")


def rank_by_hash(
    df: DataFrame,
    key: str,
    seed: int | str,
    group: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
    digits: int = 3,
) -> DataFrame:
    """Seeded shuffle: rank by md5(``seed:key``). The leading hex digits are the buckets."""
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    out = rank_in_buckets(
        hashed, [F.col("_hash"), F.col(key)], F.substring("_hash", 1, digits), group, rank, total
    )
    return out.drop("_hash")


def rank_sorted(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Rank by arbitrary sort keys: range partitioning gives the buckets.

    The bucket of a row must not change between its two uses, so the range-partitioned
    rows are written to the checkpoint folder once.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [*group, *order]
    pinned = cut(df.repartitionByRange(n, *cols).withColumn("_part", F.spark_partition_id()))
    out = rank_in_buckets(pinned, [F.col(c) for c in order], F.col("_part"), group, rank, total)
    return out.drop("_part")


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    frame: str,
    wanted: Mapping[str, tuple[str, int]],
    chunk: int = 16384,
    keep_chunk: bool = False,
) -> DataFrame:
    """Values of earlier (negative step) and later (positive step) frames of a dense integer series.

    A long series is cut into chunks of ``chunk`` frames; the edge frames are copied into
    the adjacent chunk, so one shuffle serves ``lag`` and ``lead`` for any series length. With ``keep_chunk`` the rows stay dealt by (keys, ``_chunk``), for
    :func:`scan_chunks`.
    """
    back = max([0, *(-step for _, step in wanted.values())])
    ahead = max([0, *(step for _, step in wanted.values())])
    at, inside = F.floor(F.col(frame) / chunk), F.pmod(F.col(frame), F.lit(chunk))
    places = [F.struct(at.alias("c"), F.lit(False).alias("copy"))]
    if back:
        places.append(F.when(inside >= chunk - back, F.struct((at + 1).alias("c"), F.lit(True).alias("copy"))))
    if ahead:
        first = (inside < ahead) & (at > 0)
        places.append(F.when(first, F.struct((at - 1).alias("c"), F.lit(True).alias("copy"))))
    spread = df.withColumn("_at", F.explode(F.array_compact(F.array(*places))))
    spread = dealt(spread.select("*", F.col("_at.c").alias("_chunk"), F.col("_at.copy").alias("_copy")).drop("_at"), *keys, "_chunk")
    w = Window.partitionBy(*keys, "_chunk").orderBy(frame)
    for name, (source, step) in wanted.items():
        value = F.lag(source, -step).over(w) if step < 0 else F.lead(source, step).over(w)
        spread = spread.withColumn(name, value)
    return spread.where(~F.col("_copy")).drop("_copy", *([] if keep_chunk else ["_chunk"]))


def last_before(
    df: DataFrame, keys: Sequence[str], frame: str, value: str, out: str, chunk: int = 16384
) -> DataFrame:
    """Last non-null ``value`` at an earlier frame, chunk carries first."""
    rows = df.withColumn("_chunk", F.floor(F.col(frame) / chunk))
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(frame)))
    carry = rows.groupBy(*keys, "_chunk").agg(last.alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(*keys, "_chunk", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(frame).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    joined = null_safe_join(local, carry, [*keys, "_chunk"])
    return joined.withColumn(out, F.coalesce("_local", "_carry")).drop("_chunk", "_local", "_carry")


def running_sum(
    df: DataFrame, keys: Sequence[str], frame: str, value: str, out: str, chunk: int = 16384
) -> DataFrame:
    """Inclusive running sum along ``frame``, chunk totals first."""
    rows = df.withColumn("_chunk", F.floor(F.col(frame) / chunk))
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*keys, "_chunk", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(frame).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.sum(value).over(inside))
    joined = null_safe_join(local, base, [*keys, "_chunk"])
    return joined.withColumn(out, F.col("_base") + F.col("_local")).drop("_chunk", "_base", "_local")


def with_group_stats(df: DataFrame, keys: Sequence[str], *stats: Column) -> DataFrame:
    """Attach group aggregates by a join: partial aggregation, and AQE can split a hot key."""
    return null_safe_join(df, df.groupBy(*keys).agg(*stats), list(keys))


def _attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group statistics beside the rows; without keys they are scalar subqueries.

    ``stats`` has one row per group. The join carries no hint: AQE broadcasts it when its
    measured size allows and otherwise splits the hot keys of a sort-merge join.
    """
    if keys:
        return null_safe_join(df, stats, keys)
    return df.withColumns({c: stats.select(c).scalar() for c in stats.columns})


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    weight: str | None = None,
    bins: int = 16384,
) -> DataFrame:
    """Exact, linearly interpolated quantiles for groups of any size.

    Equal values collapse first; then a histogram finds the bins that hold the wanted
    ranks and only those bins are sorted. ``percentile`` would buffer a whole group.
    """
    keys = list(group)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(n.cast("long").alias("_n"))
    counts = cut(counts)  # read three times below; the input itself is read once
    span = counts.groupBy(*keys).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_total")
    )
    place = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)
    binned = _attach(counts, span, keys).withColumn(
        "_bin", F.when(F.col("_hi") > F.col("_lo"), F.least(place, F.lit(bins - 1))).otherwise(F.lit(0))
    )
    # the histogram has at most `bins` rows per group
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    hist = binned.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_in"), F.first("_total").alias("_total"))
    hist = hist.withColumn("_base", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    position = {name: (F.col("_total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    touched = F.lit(False)
    for pos in position.values():
        for rank in (F.floor(pos), F.ceil(pos)):
            touched = touched | ((F.col("_base") <= rank) & (rank < F.col("_base") + F.col("_in")))
    wanted = hist.where(touched).select(*keys, "_bin", "_base")
    inside = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = null_safe_join(binned, wanted, [*keys, "_bin"]).withColumn(
        "_end", F.col("_base") + F.sum("_n").over(inside)
    )

    def at(rank: Column) -> Column:
        hit = (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_n"))
        return F.max(F.when(hit, F.col("_v")))

    aggs = [F.max("_total").alias("_total")]
    for name, pos in position.items():
        aggs += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}")]
    out = rows.groupBy(*keys).agg(*aggs)
    picked = [
        (
            F.col(f"_lo_{name}")
            + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (pos - F.floor(pos))
        ).alias(name)
        for name, pos in position.items()
    ]
    return out.select(*keys, *picked)


def lookup_spread(df: DataFrame, keys: Sequence[str], by: Column, table: DataFrame, how: str = "inner", salts: int = 256) -> DataFrame:
    """Join ``df`` with ``table``, which has one row per value of ``keys``, where a value may have any share of the rows of ``df``.

    The rows of ``table`` are copied to the (value, salt) pairs that exist in ``df``, at most ``salts`` of a value, and rows meet them there. ``by`` tells the
    rows of a value apart.
    """
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    dealt = null_safe_join(rows.select(*keys, "_salt").distinct(), table, keys)
    return null_safe_join(rows, dealt, [*keys, "_salt"], how).drop("_salt")


def attach_spread(df: DataFrame, keys: Sequence[str], by: Column, partial: Mapping[str, Column], total: Mapping[str, Column], wanted: Column | None = None, salts: int = 256) -> DataFrame:
    """Group aggregates beside the rows of groups of any size: aggregated per (group, salt) by ``partial``, these by ``total``, then looked up.

    With ``wanted``, a condition on the totals, other groups' rows get nulls.
    """
    parts = df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts))).groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in partial.items()])
    totals = parts.groupBy(*keys).agg(*[c.alias(n) for n, c in total.items()])
    if wanted is None:
        return lookup_spread(df, keys, by, totals, "inner", salts)
    return lookup_spread(df, keys, by, totals.where(wanted), "left", salts)


def scan_chunks(rows: DataFrame, keys: Sequence[str], states: Mapping[str, Column], carried: Mapping[str, Column], later: Mapping[str, Column] | None = None) -> DataFrame:
    """One step of a segmented scan over rows that are dealt by (keys, ``_chunk``).

    ``states`` aggregates the rows of a chunk to its state; ``carried``, and after it ``later``, are window expressions over the states of a series (:func:`earlier`, :func:`after`, :func:`whole`). They come
    back to the rows of each chunk. The rows themselves are not shuffled: only the states travel, one row per chunk, to the first key and back.
    """
    spot = [*keys, "_chunk"]
    table = rows.groupBy(*spot).agg(*[c.alias(n) for n, c in states.items()]).repartition(keys[0]).withColumns(dict(carried))
    if later:
        table = table.withColumns(dict(later))
    back = table.select(*[F.col(k).alias(f"_at_{k}") for k in spot], *carried, *(later or {}))
    same = F.lit(True)
    for k in spot:
        same = same & (F.col(k) == F.col(f"_at_{k}"))
    return rows.join(back, same).drop(*[f"_at_{k}" for k in spot])


def whole(*keys: str):
    return Window.partitionBy(*keys)


def earlier(*keys: str):
    """The chunks before."""
    return Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)


def after(*keys: str):
    """The chunks after, the nearest last."""
    return Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
