"""Mixing sources to target weights (operator 5): capped water-filling and seeded repetition.

Sources get shares of a total by weight. A source stops at ``max_epochs`` times its own size; the excess is
shared again by weight among the others until no source is above its stop. The level ``l`` with
``target = min(cap, l * weight)`` is found by rounds over the source table; only two sums reach the driver.

Every text of a source is taken ``floor(target / size)`` times as a whole. What is missing to the target is
taken in the order of a seeded hash: whole texts up to the cut, and at the cut a fraction of one text. The
hash's leading digits are buckets; bucket sums locate the cut, so only the rows of one bucket of a source are
ever sorted together.

Defined cases: a null text or a text without words has size 0 and is taken 0 times; a null source is a source of its own, last in order;
equal rows are separate rows with equal hashes, cut in any order (the taken amounts are the same); an empty table gives no
rows; a null id hashes as the word null. The added ``mix_*`` columns replace those of the input; others are kept, but for
the working names ``m_*``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.ranking import null_safe_join, rank_sorted
from maskloom.session import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: hex digits of the hash that name a bucket
DIGITS = 4
#: a source table of more rows is joined by shuffle
BROADCAST_SOURCES = 10_000
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_copies", "mix_fraction")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` has ``source_size`` and ``weight``; adds ``target`` (double). The rows should be pinned: they are read in each round."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = cap < F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)).alias("clamped"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if not row.free:
            break
        above = (float(total) - row.clamped) / row.free
        if above <= level:
            break
        level = above
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def source_plan(cells: DataFrame, max_epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """One row per source: target, whole copies, and the bucket where the rest of the target is cut."""
    sizes = cells.groupBy("m_source").agg(F.sum("m_size").alias("source_size")).withColumn("m_null", F.col("m_source").isNull())
    ranked = rank_sorted(sizes, ["m_null", "m_source"], rank="m_rank")
    pattern = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn("weight", F.element_at(pattern, (F.pmod(F.col("m_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    filled = water_fill(cut(weighed), max_epochs)
    goal = filled.withColumn("m_goal", F.floor(F.col("target") + 0.5)).withColumn(
        "m_copies", F.when(F.col("source_size") > 0, F.floor(F.col("m_goal") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("m_extra", (F.col("m_goal") - F.col("m_copies") * F.col("source_size")).cast("long"))
    order = Window.partitionBy("m_source").orderBy("m_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.withColumn("m_before", F.coalesce(F.sum("m_size").over(order), F.lit(0)))
    found = null_safe_join(before, goal.select("m_source", "m_extra"), ["m_source"]).where(
        (F.col("m_before") < F.col("m_extra")) & (F.col("m_before") + F.col("m_size") >= F.col("m_extra")))
    cuts = found.groupBy("m_source").agg(F.min("m_bucket").alias("m_cut"), F.min("m_before").alias("m_before"))
    one = goal.select("m_source", F.col("source_size").alias("m_source_size"), F.col("target").alias("m_target"), "m_copies", "m_extra")
    return null_safe_join(one, cuts, ["m_source"], "left")


def mix(docs: DataFrame, seed: int = 0, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, source, ...) with what the mix takes of each.

    Added: ``mix_size`` words of the text, ``mix_source_size``, ``mix_target`` of its source, ``mix_copies`` whole
    copies, ``mix_fraction`` words of one further, partial copy, ``mix_taken`` words in all. A whole number for
    ``max_epochs`` keeps every text at or below that many times its size.
    """
    own = docs.drop(*ADDED, *[c for c in docs.columns if c.startswith("m_")])
    keyed = own.withColumns({
        "m_size": word_count(F.col("text")), "m_source": F.col("source").cast("string"),
        "m_key": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))),
    }).withColumn("m_bucket", F.substring("m_key", 1, DIGITS))
    cells = cut(keyed.groupBy("m_source", "m_bucket").agg(F.sum("m_size").alias("m_size")))
    plan = cut(source_plan(cells, max_epochs, weights))
    joined = null_safe_join(keyed, F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan, ["m_source"])
    at_cut = F.coalesce(F.col("m_bucket") == F.col("m_cut"), F.lit(False))
    running = F.sum("m_size").over(Window.partitionBy("m_source", "m_bucket").orderBy("m_key", "doc_id", "m_size", "text").rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("m_before") + F.col("m_running")
    left = F.greatest(F.lit(0), F.least(F.col("m_size"), F.col("m_extra") - (upto - F.col("m_size"))))
    inside = joined.where(at_cut).withColumn("m_running", running).withColumn("m_more", left.cast("long")).drop("m_running")
    whole = F.when(F.col("m_bucket") < F.col("m_cut"), F.col("m_size")).otherwise(0).cast("long")
    rows = joined.where(~at_cut).withColumn("m_more", whole).unionByName(inside)
    size, more = F.col("m_size"), F.col("m_more")
    return rows.select(
        *[F.col(f"`{c}`") for c in own.columns],
        size.alias("mix_size"), F.col("m_source_size").alias("mix_source_size"), F.col("m_target").alias("mix_target"),
        (F.col("m_copies") * size + more).alias("mix_taken"),
        F.when(size == 0, 0).otherwise(F.col("m_copies") + (more == size).cast("long")).alias("mix_copies"),
        F.when(more < size, more).otherwise(0).cast("long").alias("mix_fraction"),
    )


def repeated(mixed: DataFrame, columns: list[str], max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself, one row per copy, of whole texts only.

    The one text of a source at which its target cuts is taken once more if at least half of it is wanted and ``max_epochs`` is not reached, else not; so
    a source's words are as near to its target as whole texts in this order allow, within half of that text.
    """
    more = (F.col("mix_fraction") > 0) & (2 * F.col("mix_fraction") >= F.col("mix_size")) & (F.col("mix_copies") < max_epochs)
    copies = F.col("mix_copies").cast("int") + more.cast("int")
    rows = mixed.withColumn("m_copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return rows.select(*[F.col(f"`{c}`") for c in columns])
