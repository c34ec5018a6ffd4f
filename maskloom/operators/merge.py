"""Corpus merging, upserts and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.ranking import rank_sorted


def merge_characters(chars: DataFrame, valid: Column | None = None, rank: str = "source_rank") -> DataFrame:
    """Collision rules over sources in rank order.

    The first valid row of an id keeps it; a later row of the same source is a duplicate;
    a later row of another source becomes ``{source}_{id}`` (``_2``, ``_3`` if taken).
    The owner of an id and the first row of each (id, source) come from aggregates, so an
    id that occurs in very many rows is combined map-side.
    """
    rows = chars.withColumn("_reject", valid if valid is not None else F.lit(None).cast("string"))
    good = rows.where("_reject IS NULL")
    per_source = good.groupBy("char_id", "source").agg(F.min(rank).alias("_first"))
    owner = good.groupBy("char_id").agg(F.min_by("source", F.struct(rank, "source")).alias("_owner"))
    named = per_source.join(owner, "char_id").withColumn(
        "_wish", F.when(F.col("source") == F.col("_owner"), F.col("char_id")).otherwise(F.concat_ws("_", "source", "char_id"))
    )
    # at most one row per (id, source): a clash needs an id that already looks like source_id
    clash = Window.partitionBy("_wish").orderBy((F.col("_wish") != F.col("char_id")).cast("int"), "_first", "char_id")
    named = named.withColumn("_k", F.row_number().over(clash)).withColumn(
        "_target", F.when(F.col("_k") == 1, F.col("_wish")).otherwise(F.concat_ws("_", "_wish", F.col("_k").cast("string")))
    )
    out = rows.join(named.select("char_id", "source", "_first", "_owner", "_target"), ["char_id", "source"], "left")
    status = (
        F.when(F.col("_reject").isNotNull(), F.col("_reject"))
        .when(F.col(rank) != F.col("_first"), "duplicate")
        .when(F.col("_target") != F.col("char_id"), "renamed").otherwise("kept")
    )
    return out.select(
        "char_id", "source", rank, status.alias("status"),
        F.when(status.isin("kept", "renamed"), F.col("_target")).alias("merged_id"),
    )


def merge_report(merged: DataFrame) -> DataFrame:
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old rows of the same key; every row says which case it was."""
    values = [c for c in old.columns if c != key]
    o = old.select(key, F.struct(*values).alias("_old"))
    n = new.select(key, F.struct(*values).alias("_new"))
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "kept").otherwise("updated")
    joined = o.join(n, key, "full_outer").withColumn("_v", F.coalesce("_new", "_old"))
    return joined.select(key, *[F.col(f"_v.{c}").alias(c) for c in values], change.alias("change"))


def first_seen(hits: DataFrame, key: str, rank: str) -> DataFrame:
    """Union of search results: the earliest source of a key wins."""
    others = [c for c in hits.columns if c not in (key, rank)]
    best = F.min(F.struct(rank, *others)).alias("_b")
    agg = hits.groupBy(key).agg(best, F.count(F.lit(1)).alias("hits"))
    return agg.select(key, F.col(f"_b.{rank}").alias(rank), *[F.col(f"_b.{c}").alias(c) for c in others], "hits")


def next_surrogate_ids(existing: DataFrame, new: DataFrame, key: str, prefix: str, order: Sequence[str]) -> DataFrame:
    """Dense numbers after the highest used suffix, in sort order of the new rows."""
    used = existing.select(F.regexp_extract(key, rf"^{prefix}_(\d+)$", 1).try_cast("long").alias("n"))
    top = F.coalesce(used.groupBy().agg(F.max("n")).scalar(), F.lit(0))
    ranked = rank_sorted(new, order)
    return ranked.withColumn("number", F.col("rank") + top).withColumn(
        key, F.format_string(f"{prefix}_%03d", F.col("number"))
    ).drop("rank")


def insert_or_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not there yet, one per key."""
    fresh = new.join(existing.select(*keys), list(keys), "left_anti")
    rest = [c for c in new.columns if c not in keys]
    one = fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
    return one.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
