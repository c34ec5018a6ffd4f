"""Leakage-safe train/val/test assignment.

Members are ordered by md5(``seed:id``); ranks come from :mod:`maskloom.functions.ranking`,
so a source holding most of the ids is still numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.ranking import rank_by_hash

RATIOS = dims.SPLIT_RATIOS


def _cut(rank: Column, n: Column, ratios: Mapping[str, float], rounding) -> Column:
    names, cum, out = list(ratios), 0.0, None
    for name in names[:-1]:
        cum += ratios[name]
        cond = rank <= rounding(F.lit(cum) * n)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(names[-1])


def stratified_split(chars: DataFrame, seed: int = 42, ratios: Mapping[str, float] = RATIOS) -> DataFrame:
    """Per source: shuffled, cut at round(cumulative ratio x n), the last split takes the rest."""
    ranked = rank_by_hash(chars.select("char_id", "source"), "char_id", seed, ["source"], total="_n")
    return ranked.select("char_id", "source", _cut(F.col("rank"), F.col("_n"), ratios, F.bround).alias("split"))


def shuffle_ratio_split(
    items: DataFrame, key: str, seed: int = 42, ratios: Mapping[str, float] = RATIOS, truncate: bool = True
) -> DataFrame:
    """Global shuffle; sizes by truncation or by half-even rounding of each ratio."""
    ranked = rank_by_hash(items.select(key), key, seed, total="_n")
    size = (lambda r: F.floor(F.lit(r) * F.col("_n"))) if truncate else (lambda r: F.bround(F.lit(r) * F.col("_n")))
    names = list(ratios)
    first, second = size(ratios[names[0]]), size(ratios[names[0]]) + size(ratios[names[1]])
    split = F.when(F.col("rank") <= first, names[0]).when(F.col("rank") <= second, names[1]).otherwise(names[2])
    return ranked.select(key, split.alias("split"))


def _quotas(have: DataFrame, new: DataFrame, ratios: Mapping[str, float]) -> DataFrame:
    """One row: how many of the new ids each split receives.

    A loop that always feeds the split furthest below its ratio fills like water: every
    split below the level rises to it. With three splits the level is solved directly.
    """
    names = list(ratios)
    counts = have.groupBy().agg(*[F.count_if(F.col("split") == n).alias(f"c_{n}") for n in names])
    row = counts.withColumn("_m", new.groupBy().agg(F.count(F.lit(1))).scalar())
    total = sum((F.col(f"c_{n}") for n in names), F.col("_m"))
    row = row.withColumns({f"d_{n}": F.lit(ratios[n]) * total - F.col(f"c_{n}") for n in names})
    d = F.sort_array(F.array(*[F.col(f"d_{n}") for n in names]), asc=False)
    level = None
    for k in range(len(names), 0, -1):
        mu = (sum((d[i] for i in range(k)), F.lit(0.0)) - F.col("_m")) / k
        level = F.when(d[k - 1] >= mu, mu) if level is None else level.when(d[k - 1] >= mu, mu)
    row = row.withColumn("_level", level)
    share = F.lit(0.0)
    cums = {}
    for n in names:
        share = share + F.greatest(F.col(f"d_{n}") - F.col("_level"), F.lit(0.0))
        cums[f"cum_{n}"] = F.bround(share).cast("long")
    return row.select(*[c.alias(n) for n, c in cums.items()])


def incremental_split(
    chars: DataFrame, existing: DataFrame, seed: int = 42, ratios: Mapping[str, float] = RATIOS
) -> DataFrame:
    """Existing ids keep their split; new ids fill the most under-represented splits."""
    names = list(ratios)
    kept = existing.select("char_id", "split")
    new = chars.select("char_id").distinct().join(kept, "char_id", "left_anti")
    quotas = _quotas(kept, new, ratios)
    cum = {n: quotas.select(f"cum_{n}").scalar() for n in names[:-1]}
    split = None
    for n in names[:-1]:
        cond = F.col("rank") <= cum[n]
        split = F.when(cond, n) if split is None else split.when(cond, n)
    ranked = rank_by_hash(new, "char_id", seed)
    added = ranked.select("char_id", split.otherwise(names[-1]).alias("split"), F.lit(True).alias("is_new"))
    return kept.withColumn("is_new", F.lit(False)).unionByName(added)


def frozen_split(chars: DataFrame, frozen: DataFrame, train_only: Sequence[str] = (), dataset: str = "source") -> DataFrame:
    """Validation and test are fixed; everything else, and every train-only dataset, trains."""
    fixed = frozen.where(F.col("split") != "train").select("char_id", F.col("split").alias("_fixed"))
    out = chars.join(fixed, "char_id", "left")
    forced = F.col(dataset).isin(list(train_only)) if train_only else F.lit(False)
    split = F.when(forced, "train").otherwise(F.coalesce("_fixed", F.lit("train")))
    return out.select(*chars.columns, split.alias("split"))


def split_report(splits: DataFrame, names: Sequence[str] = tuple(RATIOS)) -> DataFrame:
    """Counts and percents of every split per source."""
    counts = splits.groupBy("source").pivot("split", list(names)).agg(F.count(F.lit(1)))
    total = sum((F.coalesce(F.col(n), F.lit(0)) for n in names), F.lit(0))
    return counts.select(
        "source", *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names], total.cast("long").alias("total"),
        *[F.bround(100.0 * F.coalesce(F.col(n), F.lit(0)) / total, 1).alias(f"{n}_pct") for n in names],
    )


def split_leaks(splits: DataFrame) -> DataFrame:
    """Ids assigned to more than one split."""
    lo, hi = F.min("split"), F.max("split")
    return splits.groupBy("char_id").agg(lo.alias("first_split"), hi.alias("last_split")).where("first_split <> last_split")


def merge_splits(parts: DataFrame, rank: str = "file_rank") -> DataFrame:
    """First assignment of an id wins; the number of ignored repeats is reported."""
    return parts.groupBy("char_id").agg(
        F.min_by("split", F.struct(rank, "split")).alias("split"), (F.count(F.lit(1)) - 1).alias("duplicates")
    )
