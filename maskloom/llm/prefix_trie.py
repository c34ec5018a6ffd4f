"""Conversation prefix trie (operator 13): a node for each distinct sequence of first turns, with totals of its subtree.

The trie is built by halving depths, in the manner of a van Emde Boas layout. A block of ``2^k`` depths is cut at half its depth; the sequence of turns above the
cut gets a name, and the upper trie and the forests below all cut nodes are problems of half the depth, which are named the same way. All problems of one size
are worked on together, so a trie of depth ``D`` takes ``log2 D`` rounds, not ``D``:

1. up: turns are named by a digest, then blocks of 2, 4, 8, ... turns by the digest of their halves' names;
2. down: the first block of a sequence begins at the root. The lower half of a block begins at the node that the block's own beginning and the name of its upper half
   make. Blocks of one turn leave the name of the prefix before every turn, and with that turn the name of the node itself;
3. graft: each depth is the cut of one size of block (its lowest set bit). What lies in the forest below a cut node is summed onto it (a node meets one cut node
   for each bit of its depth less one), and what a cut node has collected is added to the nodes of the upper trie above it. A node is counted once at each of its
   ancestors, along at most ``log2 D`` grafts.

Rows are turns, not conversations: a conversation is never assembled, and all joins are on (conversation, place), which is unique on both sides. Names are SHA-256 digests.
Sums by node combine before the shuffle; parents are looked up by (name, salt), so a first turn that a third of all conversations share, or the children of one node, spread.
Each round's table shrinks or grows by two and is written to the checkpoint folder. The driver reads the greatest depth only.

A node's ``conv_id`` is its smallest member, and ``ends_sha256`` hashes the ids of the members that end there, ascending: ids are sorted by ranges, put together in pieces
of at most ``PIECE`` ids, and the pieces of a node are streamed through the hash in order.

Defined cases: turns are ordered by turn (null first), equal ones by role, the first ``TIE`` characters of the text and its digest, and equal rows are turns after each other; null roles and texts are empty; rows of a null
conversation id belong to no conversation; a conversation without turns is a member of the root only; texts of any length are one turn; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.ranking import lookup_spread, rank_in_buckets
from maskloom.session import cut

GROUP, SHARED = 100, 6
TIE = 64
PIECE = 16_384
#: turn numbers of one conversation that are sorted together
BUCKETS = 64


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_name(role: Column, text: Column) -> Column:
    return digest(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, name, chars) of the original turns; a long conversation is ranked by buckets of its turn numbers."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.substring(text, 1, TIE).alias("lead"),
        digest(text.cast("binary")).alias("tie"), turn_name(role, text).alias("name"), F.length(text).cast("long").alias("chars"))
    bucket = F.coalesce(F.floor(F.col("turn") / BUCKETS), F.lit(-(1 << 62)))
    order = [F.col(c) for c in ("turn", "role", "lead", "tie")]
    return rank_in_buckets(named, order, bucket, ["conv_id"], rank="pos").select("conv_id", "pos", "name", "chars")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its group."""
    return (F.crc32(conv.cast("string").cast("binary")) % SHARED).cast("long")


def rebuild(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, name, chars) of the rebuilt conversations, and a row of a null name after the last turn of each.

    First turns come from the first conversation of each group of ``GROUP``, which has at most ``SHARED`` less one to give.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = shared_turns(F.col("conv_id"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    wanted = convs.where(h > 0).select(F.col("conv_id").alias("to_conv"), base.alias("b_conv"), F.explode(F.sequence(F.lit(1).cast("long"), h)).alias("b_pos"))
    source = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < SHARED))
    first = wanted.join(source, (F.col("b_conv") == F.col("conv_id")) & (F.col("b_pos") == F.col("pos"))).select(F.col("to_conv").alias("conv_id"), "pos", "name", "chars")
    # own turns move up if the base has fewer turns than are taken from it
    have = first.groupBy(F.col("conv_id").alias("h_conv")).agg(F.count(F.lit(1)).alias("have"))
    taken = convs.join(have, F.col("conv_id") == F.col("h_conv"), "left").select("conv_id", "n", F.coalesce("have", F.lit(0)).alias("have"))
    end = taken.select("conv_id", (F.col("have") + F.greatest(F.col("n") - h, F.lit(0)) + 1).alias("pos"), F.lit(None).cast("binary").alias("name"), F.lit(0).cast("long").alias("chars"))
    late = turns.where(F.col("pos") > h)
    moved = late.join(taken.where("have < n").select(F.col("conv_id").alias("t_conv"), "have"), F.col("conv_id") == F.col("t_conv"))
    own = moved.select("conv_id", (F.col("have") + F.col("pos") - h).alias("pos"), "name", "chars")
    return first.unionByName(own).unionByName(end)


def node_name(parent: Column, block: Column) -> Column:
    return digest(F.coalesce(parent, F.lit(b"")), block)


def name_prefixes(turns: DataFrame, rounds: int) -> DataFrame:
    """Rows (conv_id, pos, ...) with ``before``, the name of the prefix that ends before each; null is the root."""
    spot = F.lit(b"end")
    blocks = [turns.select("conv_id", (F.col("pos") - 1).alias("block"), F.coalesce("name", spot).alias("name"))]
    for _ in range(rounds):
        half = F.col("block") % 2
        pair = blocks[-1].groupBy("conv_id", F.floor(F.col("block") / 2).alias("block")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("upper"), F.max(F.when(half == 1, F.col("name"))).alias("lower"))
        # a block that ends in its upper half has that half's name; nothing follows it that could use the name
        name = F.when(F.col("lower").isNull(), F.col("upper")).otherwise(digest(F.col("upper"), F.col("lower")))
        blocks.append(cut(pair.select("conv_id", "block", "upper", F.col("lower").isNotNull().alias("both"), name.alias("name"))))
    begin = blocks[-1].select("conv_id", "block", F.lit(None).cast("binary").alias("before"))
    for k in range(rounds, 0, -1):
        whole = begin.join(blocks[k].drop("name"), ["conv_id", "block"])
        upper = F.struct((F.col("block") * 2).alias("block"), F.col("before").alias("before"))
        lower = F.struct((F.col("block") * 2 + 1).alias("block"), node_name(F.col("before"), F.col("upper")).alias("before"))
        begin = whole.select("conv_id", F.explode(F.array_compact(F.array(upper, F.when(F.col("both"), lower)))).alias("half")).select("conv_id", "half.block", "half.before")
        if k % 3 == 1:
            begin = cut(begin)
    return turns.withColumn("block", F.col("pos") - 1).join(begin, ["conv_id", "block"]).drop("block")


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, name, parent, chars, ends): the node of each depth of each rebuilt conversation; the root has a null name."""
    deepest = turns.agg(F.max("pos")).first()[0] or 0
    named = cut(name_prefixes(turns, max(deepest - 1, 0).bit_length()))
    # a row's prefix is the node one depth up, and the parent of the node at its own depth
    node = named.select("conv_id", (F.col("pos") - 1).alias("depth"), F.col("before").alias("name"), F.col("name").isNull().alias("ends"))
    above = named.where(F.col("name").isNotNull()).select("conv_id", F.col("pos").alias("depth"), F.col("before").alias("parent"), "chars")
    return cut(node.join(above, ["conv_id", "depth"], "left"))


def ends(path: DataFrame) -> DataFrame:
    """(depth, e_name, ends_sha256) of the nodes where conversations end."""
    n = int(path.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = path.where("ends").select("depth", F.coalesce("name", F.lit(b"")).alias("e_name"), "conv_id")
    dealt = own.repartitionByRange(n, "depth", "e_name", "conv_id").sortWithinPartitions("depth", "e_name", "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = list(zip(batch.column("depth").to_pylist(), batch.column("e_name").to_pylist(), strict=True))
            ids = batch.column("conv_id").to_pylist()
            cuts = [0, *[i for i in range(1, len(ids)) if node[i] != node[i - 1]], len(ids)] if ids else [0]
            spans = [(a, min(a + PIECE, hi)) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) for a in range(lo, hi, PIECE)]
            yield pa.RecordBatch.from_pydict({
                "depth": pa.array([node[a][0] for a, _ in spans], pa.int64()), "e_name": pa.array([node[a][1] for a, _ in spans], pa.binary()),
                "first": pa.array([ids[a] for a, _ in spans], pa.int64()), "said": pa.array([",".join(map(str, ids[a:b])) for a, b in spans], pa.string())})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_node, state = None, None
        for batch in batches:
            done = []
            for depth, name, said in zip(*(batch.column(c).to_pylist() for c in ("depth", "e_name", "said")), strict=True):
                if (depth, name) == open_node:
                    state.update(b"," + said.encode())
                    continue
                if open_node:
                    done.append((*open_node, state.hexdigest()))
                open_node, state = (depth, name), hashlib.sha256(said.encode())
            yield result(done)
        if open_node:
            yield result([(*open_node, state.hexdigest())])

    def result(done: list[tuple[int, bytes, str]]) -> pa.RecordBatch:
        depth, name, text = zip(*done, strict=True) if done else ((), (), ())
        return pa.RecordBatch.from_pydict({"depth": pa.array(depth, pa.int64()), "e_name": pa.array(name, pa.binary()), "ends_sha256": pa.array(text, pa.string())})

    parts = dealt.mapInArrow(pieces, "depth long, e_name binary, first long, said string")
    return parts.repartition("depth", "e_name").sortWithinPartitions("depth", "e_name", "first").mapInArrow(hashed, "depth long, e_name binary, ends_sha256 string")


def at_paths(path: DataFrame, sums: DataFrame) -> DataFrame:
    """Sums (conv, at, leaves, saved) at places of conversations, added up by node: (depth, name, leaves, saved)."""
    places = sums.groupBy("conv", "at").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    met = places.join(path.select("conv_id", "depth", "name"), (F.col("conv") == F.col("conv_id")) & (F.col("at") == F.col("depth")))
    return met.groupBy("depth", "name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def graft(nodes: DataFrame, path: DataFrame, rounds: int) -> DataFrame:
    """(depth, name, leaves, saved) summed over the subtrees of ``nodes`` (depth, name, conv_id, leaves, saved), which are all but the root."""
    below = F.col("depth") - 1
    cuts = [F.when(below.bitwiseAND(F.lit(1 << b)) != 0, F.shiftleft(F.shiftright(below, b), b)) for b in range(rounds)]
    value = ("leaves", "saved")
    lower = nodes.select(F.col("conv_id").alias("conv"), F.explode(F.array_compact(F.array(*cuts))).alias("at"), *value) if cuts else None
    if lower is None:
        return nodes.select("depth", "name", *value)
    forests = at_paths(path, lower)
    collected = cut(forests.join(nodes.select("depth", "name", F.col("conv_id").alias("conv")), ["depth", "name"]))
    # the upper trie above a cut reaches as far up as the cut's lowest bit; long stretches unfold in pieces
    first = F.col("depth") - F.col("depth").bitwiseAND(-F.col("depth")) + 1
    spread = collected.select("conv", "depth", *value, F.explode(F.sequence(first, F.col("depth"), F.lit(PIECE).cast("long"))).alias("lo"))
    upper = spread.select("conv", F.explode(F.sequence(F.col("lo"), F.least(F.col("lo") + PIECE - 1, F.col("depth")))).alias("at"), *value)
    grafted = at_paths(path, upper).unionByName(nodes.select("depth", "name", *value))
    return grafted.groupBy("depth", "name").agg(*[F.sum(v).alias(v) for v in value])


def trie(rows: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``rows`` (conv_id, turn, role, text)."""
    path = paths(cut(rebuild(cut(ordered_turns(rows)))))
    plain = path.where("depth > 0").groupBy("depth", "name", "parent").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"))
    plain = cut(plain)
    kids = plain.groupBy((F.col("depth") - 1).alias("k_depth"), F.col("parent").alias("k_name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(plain.join(kids, (F.col("depth") == F.col("k_depth")) & (F.col("name") == F.col("k_name")), "left").select(
        "depth", "name", "parent", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = graft(nodes, path, deepest.bit_length())
    inner = nodes.drop("leaves", "saved").join(totals, ["depth", "name"])
    root = path.where("depth = 0").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    sums = nodes.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    top = root.withColumns({c: sums.select(c).scalar() for c in sums.columns}).select(F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("name"), F.lit(None).cast("binary").alias("parent"), "conv_id", "n_convs", "n_children", "leaves", "saved")
    named = inner.withColumn("parent", F.coalesce("parent", F.lit(b""))).unionByName(top)
    heads = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id")).unionByName(
        top.select((F.col("depth") + 1).alias("depth"), F.lit(b"").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
    placed = lookup_spread(named, ["depth", "parent"], F.col("name"), heads, "left")
    last = ends(path)
    return placed.join(last.withColumnRenamed("depth", "e_depth"), (F.col("depth") == F.col("e_depth")) & (F.col("name") == F.col("e_name")), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
