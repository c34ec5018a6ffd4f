"""Merkle manifest of a dataset (operator 12): a tree per group, and one over the groups' roots.

Rows of a group are ordered by a key and numbered; these are the leaves. Every ``fanout`` consecutive nodes have a parent, the SHA-256 of their digests
(as lowercase hex text, put together); the last run of a level may be shorter. Levels are built until a group has one node, its subroot.
Subroots, in the order of the groups (null first, then by UTF-8 bytes), are the leaves of a second tree of the same kind; its last node is the root.

A level is one self-join by sibling index. Each node of slot zero computes the indices of its siblings (``index XOR 1`` in a binary
tree, its own index plus the offsets 1 to ``fanout - 1`` otherwise), meets them in an equijoin on (group, index), and emits the parent with its run of at
most ``fanout`` members. No key of such a join has more than one row on a side, so a group that holds a third of all rows spreads like any
other. Levels shrink by ``fanout`` and each is written to the checkpoint folder; their number follows from the largest group's size, the only value the driver reads.

A proof is a list of steps from a leaf to the root: what stands left of the node in its run, and what right. Steps above the first level are joined once per
run, not per row. Folding a leaf through its steps gives the root if nothing was changed.

Defined cases: a null field enters the leaf as ``-``, an empty one as ``0:``; a null group is a group of its own, the first; equal keys, and null keys (first), are ordered by
the leaf, so repeated rows are leaves next to each other; a lone leaf is its group's subroot, a lone subroot the root; texts of any length are hashed whole;
an empty table has no rows and no root; columns that are not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.ranking import rank_sorted
from maskloom.session import cut

FANOUT = 16
STEP = "struct<left:string,right:string>"


def framed(value: Column) -> Column:
    """A field with its length, so that neighbouring fields cannot run into each other."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def group_key(value: Column) -> Column:
    """A text that is never null, with null before all values; strings compare by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("+"), value.cast("string")), F.lit(""))


def joined(members: Column) -> Column:
    return F.array_join(F.transform(members, lambda m: m["digest"]), "")


@dataclass
class Tree:
    """Levels from the leaves up: (g, run, n, members, parent), and how many children a node has. ``n`` is the number of a group's nodes on the level."""

    levels: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        """(g, root) of all groups."""
        out = [level.where(F.col("n") <= self.fanout).select("g", F.col("parent").alias("root")) for level in self.levels]
        all_roots = out[0]
        for more in out[1:]:
            all_roots = all_roots.unionByName(more)
        return all_roots


def siblings(index: Column, fanout: int) -> Column:
    """Indices of the siblings of a slot-zero node."""
    if fanout == 2:
        return F.array(index.bitwiseXOR(F.lit(1).cast("long")))
    return F.transform(F.sequence(F.lit(1), F.lit(fanout - 1)), lambda offset: index + offset)


def level(nodes: DataFrame, fanout: int, carried: Sequence[str] = ()) -> DataFrame:
    """Runs of ``nodes`` (g, idx, n, digest): slot-zero nodes meet their siblings and emit the parent. Members keep ``carried`` columns."""
    run = F.floor(F.col("idx") / fanout)
    member = F.struct((F.col("idx") - run * fanout).alias("slot"), "digest", *carried)
    own = nodes.select("g", run.alias("run"), "n", "idx", member.alias("member"))
    first = own.where(F.col("member.slot") == 0)
    wanted = first.select(F.col("g").alias("z_g"), F.col("n").alias("z_n"), F.col("run").alias("z_run"), F.explode(siblings(F.col("idx"), fanout)).alias("z_idx"))
    met = own.join(wanted.where(F.col("z_idx") < F.col("z_n")), (F.col("g") == F.col("z_g")) & (F.col("idx") == F.col("z_idx")))
    rows = first.select("g", "run", "n", "member").unionByName(met.select("g", F.col("z_run").alias("run"), "n", "member"))
    runs = rows.groupBy("g", "run", "n").agg(F.sort_array(F.collect_list("member")).alias("members"))
    parent = F.when(F.col("n") == 1, F.col("members")[0]["digest"]).otherwise(F.sha2(joined(F.col("members")), 256))
    return runs.withColumn("parent", parent)


def build(leaves: DataFrame, largest: int, fanout: int = FANOUT, carried: Sequence[str] = ()) -> Tree:
    """The tree of ``leaves`` (g, idx from 0, n, digest, carried columns); ``largest`` is the greatest ``n``."""
    if fanout < 2:
        raise ValueError("a node needs room for two children")
    levels = [cut(level(leaves, fanout, carried))]
    while largest > fanout:
        largest = -(-largest // fanout)
        more = levels[-1].where(F.col("n") > fanout)
        nodes = more.select("g", F.col("run").alias("idx"), F.ceil(F.col("n") / fanout).alias("n"), F.col("parent").alias("digest"))
        levels.append(cut(level(nodes, fanout)))
    return Tree(levels, fanout)


def numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Add ``idx`` from 0 and ``n`` inside ``g``; and the greatest ``n``."""
    ranked = cut(rank_sorted(rows, order, ["g"], rank="idx", total="n").withColumn("idx", F.col("idx") - 1))
    return ranked, ranked.agg(F.max("n")).first()[0] or 0


def step(members: Column, slot: Column) -> Column:
    """What stands beside a member of a run."""
    own = slot.cast("int")
    return F.struct(
        joined(F.slice(members, F.lit(1), own)).alias("left"), joined(F.slice(members, own + 2, F.greatest(F.size(members) - own - 1, F.lit(0)))).alias("right"))


def with_paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """The lowest runs with ``path``, the steps from the run's parent to the root. ``tops`` has (g, top_path, ...), the steps above a group's root; its other columns are kept."""
    extra = [c for c in tops.columns if c not in ("g", "top_path")]
    above: DataFrame | None = None
    for runs in reversed(tree.levels):
        whole = runs.where(F.col("n") <= tree.fanout).join(tops, "g").withColumnRenamed("top_path", "path")
        if above is None:
            above = whole
            continue
        parents = above.select(F.col("g").alias("p_g"), F.col("run").alias("p_run"), F.col("members").alias("p_members"), F.col("path").alias("p_path"), *extra)
        up = F.floor(F.col("run") / tree.fanout)
        more = runs.where(F.col("n") > tree.fanout).join(parents, (F.col("g") == F.col("p_g")) & (up == F.col("p_run")))
        path = F.concat(F.array(step(F.col("p_members"), F.col("run") - up * tree.fanout)), F.col("p_path"))
        above = whole.unionByName(more.withColumn("path", path).drop("p_g", "p_run", "p_members", "p_path"))
    return above


def member_paths(runs: DataFrame) -> DataFrame:
    """One row per member of the lowest runs, with the whole path from it to the root; a lone leaf has no step of its own."""
    rows = runs.select("*", F.explode("members").alias("member"))
    own = F.when(F.col("n") > 1, F.array(step(F.col("members"), F.col("member.slot")))).otherwise(F.array().cast(f"array<{STEP}>"))
    return rows.withColumn("path", F.concat(own, F.col("path"))).drop("members")


def proof(path: Column) -> Column:
    """Digest of all siblings on a path, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the steps beside its path."""
    return F.aggregate(path, start, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def manifest(rows: DataFrame, group: str, key: str, fields: Sequence[Column], changed: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``rows``: ``key``, ``group``, ``leaf``, ``idx``, ``subroot``, ``root``, ``path``, and ``changed``.

    ``changed`` is the leaf that someone presents instead of the recorded one (null: the recorded one); fold it through ``path`` and compare with ``root``.
    """
    other = F.lit(None).cast("string") if changed is None else changed
    plain = rows.select(F.col(key).alias("k"), F.col(group).alias("v"), group_key(F.col(group)).alias("g"), leaf(fields).alias("digest"), other.alias("changed"))
    leaves, largest = numbered(cut(plain), ["k", "digest"])
    tree = build(leaves, largest, fanout, ["k", "v", "changed", "idx"])
    heads, groups = numbered(tree.roots().select(F.lit("").alias("g"), F.col("g").alias("k"), F.col("root").alias("digest")), ["k"])
    top = build(heads, groups, fanout, ["k"])
    root = top.roots().select(F.col("g").alias("r_g"), "root")
    none = root.select(F.col("r_g").alias("g"), F.array().cast(f"array<{STEP}>").alias("top_path"), "root")
    tops = member_paths(with_paths(top, none)).select(
        F.col("member.k").alias("g"), F.col("path").alias("top_path"), F.col("member.digest").alias("subroot"), "root")
    found = member_paths(with_paths(tree, cut(tops)))
    return found.select(
        F.col("member.k").alias(key), F.col("member.v").alias(group), F.col("member.digest").alias("leaf"), F.col("member.idx").alias("idx"), "subroot", "root", "path",
        F.col("member.changed").alias("changed"))
