"""N-gram Jaccard join (operator 2) with PartEnum signatures.

A document's set holds its distinct word shingles. Two sets of sizes a <= b with Jaccard similarity of at least s differ in at most
``(1-s)/(1+s) * (a+b)`` shingles. Sizes are cut into bands whose limits grow by the factor ``1/s``; similar sets lie in the same or in adjacent bands, so a set
has signatures for its own band and for the next. Pairs within a band meet in the next, so a band must serve only pairs of a set from the band below and one of its own. For a band with the
resulting bound k on the difference, the shingle domain is hashed to ``n1`` groups of ``n2``
partitions. Two sets that differ in at most k shingles differ in at most ``k2`` partitions of at least ``need = n1 - k // (k2 + 1)`` groups. For every group each subset of
``n2 - k2`` partitions gives a signature of the set's shingles in it; in such a group one subset holds the same shingles of both. So similar sets share a signature.

A subset in which a set has no shingle says nothing. A group with such a subset is blocked. ``n1`` is chosen with room, so that most sets have fewer than ``need`` blocked groups;
then a group without a blocked subset agrees too, and the empty signatures are left out. Other sets emit them: nothing is lost.

The room has a second use. Similar sets agree in at least ``need`` groups, so in more than ``spare = need - 1 - blocked`` groups they share a signature. Every set leaves the
``spare`` largest buckets of a band, by size and signature. Of the buckets that two similar sets share, each leaves the largest first, so at least one is left to both. A set that shares signatures
with anything in at most ``spare`` groups leaves altogether. This removes texts that only share passages, without a comparison, and empties the hottest buckets. (Where a
group has several signatures its buckets have no common order; there a set leaves only altogether.)

Work is linear in the signatures, whatever the size of a group of copies. Sorted by signature, a stream compares every member of a bucket with the bucket's smallest only (star). Each
different pair is verified exactly, once, on the full sets. Components of the verified pairs follow by star contraction. Members of one component need no further comparison. Where
members of a bucket are still apart, a bucket of at most ``FEW`` members is compared across components. In a larger one, as of many copies just below the threshold, all members are compared with
the one that has most signatures in common with others, the hub; two of them are compared only if their differences from the hub have enough in common (see ``_deltas``). This closes the join exactly and never pairs a group with itself. Copies within a batch of texts
are linked before they are sent, so a hot group of equal texts never arrives as a whole.

These comparisons are as many as the components need. The number of links of a document is counted afterwards, over all pairs: every link lies inside a component, so the different sets of a
component are compared with each other, one representative for each set and its copies. A large component is cut into blocks by size band and hash; only blocks of the same or adjacent bands meet,
one pair of blocks in a task, and only counts leave it. This is quadratic in the different sets of a component, as the links of a group of near copies are, but not in its equal sets.

Defined cases: a text that is null, empty or without words has an empty set, links with nothing and is its own component; ids that are
null take no part and have a null component; rows with the same id are one node with the links of each; equal rows stay separate result rows;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskloom.llm import text as scan
from maskloom.operators.components import contract
from maskloom.session import ensure_checkpoint_dir

SHINGLE = 5
#: similarity as a fraction of whole numbers
SIMILAR = (80, 100)
#: sets of a band up to this limit use subsets of 2 of 3 partitions; for larger sets many groups of one partition are as selective, with fewer signatures
SMALL = 50
ROOM = 0.25
#: a larger bucket counts as one of so many members, so that its rows need not wait for its end
LARGE = 10_000
#: shingles of a set for each count of its sketch
COUNTED = 2
#: steps in which a distance from the hub is told apart
STEPS = 4
#: a bucket of more members that are still apart is compared by differences from its hub
FEW = 16
#: shingles and sets of a block, of which two are compared at a time
BLOCK_SHINGLES, BLOCK_SETS = 1 << 16, 512
#: shingles that at most so many sets of two blocks hold are counted by pairs, others by a product of matrices
RARE = 8
U64 = np.uint64
#: bits of the table that tells ids apart: of one group, for each id, and at most
BITS, BITS_OF_ID, MOST_BITS = 1 << 15, 16, 1 << 27
#: in a slot: not one of several signatures of a group
ALONE = 255


@dataclass(frozen=True)
class Band:
    """One band of set sizes: its limit, groups, partitions of a group, partitions that may differ, and groups that must agree."""

    limit: int
    n1: int
    n2: int
    k2: int
    need: int


@cache
def bands(largest: int) -> tuple[Band, ...]:
    num, den = SIMILAR
    limits, out = [num // (den - num)], []
    while len(out) < 2 or out[-1].limit <= largest * den // num:
        u, below = limits[-1], out[-1].limit if out else limits[-1]
        k = (below + u) * (den - num) // (den + num)
        k2, n2 = (0, 1) if k == 0 else (1, 3) if u <= SMALL else (0, 1)
        base = k // (k2 + 1) + 1
        n1 = base + (0 if base < 2 else 1 + int(ROOM * base))
        out.append(Band(u, n1, n2, k2, n1 - k // (k2 + 1)))
        limits.append(max(u + 1, u * den // num))
    return tuple(out)


def sets(texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of a chunk, distinct and sorted."""
    return scan.distinct(*scan.shingles(scan.words(texts, scan.SPACES, lower=True), SHINGLE, whole_if_short=True))


def fingerprints(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """128 bits of each set, as two numbers."""
    out = np.zeros((rows, 2), U64)
    for j in range(2):
        np.add.at(out[:, j], row, scan.mix(value + U64(77 + j)))
    return out


def signatures(row: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, slot) for the own and the next band of each set. A slot holds spare groups, group (``ALONE``: each signature is one) and band."""
    table = bands(1 << int(sizes.max(initial=1)).bit_length())
    limits = np.array([b.limit for b in table])
    own = np.searchsorted(limits, sizes)
    found = [(np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64))]
    kinds = np.array([b.n2 for b in table])
    for step in (0, 1):
        level = own + step
        level[sizes == 0] = -1
        for n2 in np.unique(kinds[level[level >= 0]]):
            chosen = (level >= 0) & (kinds[level] == n2)
            found.append(_of_kind(row, value, chosen, level, table, int(n2), 1 if n2 > 1 else 0))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _of_kind(row, value, chosen, level, table, n2, k2):
    mine = np.flatnonzero(chosen)
    n1 = np.array([b.n1 for b in table])[level[mine]]
    need = np.array([b.need for b in table])[level[mine]]
    base = np.concatenate([[0], np.cumsum(n1)])
    local = np.full(len(chosen), -1)
    local[mine] = np.arange(len(mine))
    use = chosen[row]
    r, v = local[row[use]], value[use]
    spread = scan.mix(v + U64(0x5851F42D4C957F2D) * (level[mine][r] + 1).astype(U64))
    group = ((spread >> U64(32)) * n1[r].astype(U64) >> U64(32)).astype(np.int64)
    cell = (base[r] + group) * n2 + ((spread & U64(0xFFFF)) % U64(n2)).astype(np.int64)
    sums = np.zeros(base[-1] * n2, U64)
    np.add.at(sums, cell, scan.mix(v ^ U64(0xA0761D6478BD642F)))
    filled = np.bincount(cell, minlength=base[-1] * n2).reshape(-1, n2) > 0
    sums = sums.reshape(-1, n2)
    subsets = list(itertools.combinations(range(n2), n2 - k2))
    has = np.stack([filled[:, list(c)].any(axis=1) for c in subsets], axis=1)
    owner = np.repeat(np.arange(len(mine)), n1)
    blocked = np.bincount(owner[~has.all(axis=1)], minlength=len(mine))
    emit = has | (blocked >= need)[owner][:, None]
    spare = np.clip(need - 1 - blocked, 0, 0xFFFF)
    nth = (np.arange(base[-1]) - base[owner]).astype(U64) + level[mine][owner].astype(U64) * U64(1 << 40)
    inner = np.arange(base[-1]) - base[owner] if n2 > 1 else np.full(base[-1], ALONE)
    slot = spare[owner] << 9 | inner << 1 | level[mine][owner] & 1
    out_rows, out, slots = [], [], []
    for j, c in enumerate(subsets):
        total = sums[:, list(c)].sum(axis=1, dtype=U64)
        at = np.flatnonzero(emit[:, j])
        out_rows.append(mine[owner[at]])
        out.append(scan.mix(scan.mix(total[at] + U64(j)) + nth[at] * U64(0x9E3779B97F4A7C15)))
        slots.append(slot[at])
    return np.concatenate(out_rows), np.concatenate(out), np.concatenate(slots)


@scan.frees_memory
def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature rows (sig, doc, slot), and for every document a plain row (no sig, doc, size of its set, first copy in the chunk if it is a copy)."""
    for batch in batches:
        column = batch.column("doc_id")
        ids, named = column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
        for part in scan.chunks(batch.column("text")):
            mine = slice(part.first, part.first + part.rows)
            own, known = ids[mine], named[mine]
            row, value = sets(part)
            sizes = np.bincount(row, minlength=part.rows)
            keys = np.column_stack([fingerprints(row, value, part.rows), known.astype(U64)])
            _, first, which = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            head = first[which.ravel()]
            copy = (head != np.arange(part.rows)) & (sizes > 0) & known
            send = ~copy & known
            r, sig, slot = signatures(row[send[row]], value[send[row]], np.where(send, sizes, 0))
            n, m = part.rows, len(sig)
            plain = np.arange(m + n) >= m
            yield pa.RecordBatch.from_pydict({
                "sig": pa.array(np.concatenate([sig.view(np.int64), np.zeros(n, np.int64)]), mask=plain),
                "doc": pa.array(np.concatenate([own[r], own]), mask=plain & ~np.concatenate([np.ones(m, bool), known])),
                "slot": np.concatenate([slot, sizes]).astype(np.int32),
                "rep": pa.array(np.concatenate([np.zeros(m, np.int64), own[head]]), mask=~np.concatenate([np.zeros(m, bool), copy])),
            })


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by sig, a sort by one number: those of buckets with several documents, once for each, with the smallest of the bucket and its size, at most ``LARGE``.

    A bucket of that size leaves in pieces, and has some document of the first piece for the smallest; a document may be in several pieces.
    """
    kept: list[tuple[np.ndarray, ...]] = []  # the open bucket, as long as it has less than LARGE rows
    known = 0
    last: tuple[int, int] | None = None  # signature and a document of the open bucket, once its size is settled

    def closed(settled: tuple[int, int] | None, sig, doc, *more):
        """Rows of whole buckets, but the first may go on from a settled one."""

        def sizes() -> np.ndarray:
            begin = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])[: len(sig)])
            return np.diff(np.append(begin, len(sig)))

        on = settled is not None and len(sig) > 0 and sig[0] == settled[0]
        size = sizes()
        several = size > 1
        several[:1] |= on
        several = np.repeat(several, size)  # most rows are alone, so only the others are sorted by document
        sig, doc, *more = (x[several] for x in (sig, doc, *more))
        order = np.lexsort((doc, sig))
        sig, doc, *more = (x[order] for x in (sig, doc, *more))
        again = np.zeros(len(sig), bool)
        again[1:] = (sig[1:] == sig[:-1]) & (doc[1:] == doc[:-1])
        sig, doc, *more = (x[~again] for x in (sig, doc, *more))
        size = sizes()
        rep = doc[np.cumsum(size) - size]
        n = np.minimum(size, LARGE)
        if on:
            n[0], rep[0] = LARGE, settled[1]
        n, rep = np.repeat(n, size), np.repeat(rep, size)
        several = n > 1
        found = dict(zip(("sig", "doc", "slot"), (sig, doc, *more))) | {"rep": rep, "n": n.astype(np.int32)}  # noqa: B905
        return pa.RecordBatch.from_pydict({c: x[several] for c, x in found.items()})

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in ("sig", "doc", "slot") if c in batch.schema.names]
        sig = columns[0]
        cut = int(np.searchsorted(sig, sig[-1]))  # the last bucket may go on
        if cut or (kept and kept[0][0][0] != sig[-1]):
            yield closed(last, *[np.concatenate(x) for x in zip(*kept, [c[:cut] for c in columns], strict=True)])
            kept, known = [], 0
        last = last if last is not None and last[0] == sig[-1] else None
        kept.append(tuple(c[cut:] for c in columns))
        known += len(sig) - cut
        if known >= LARGE or last is not None:
            rows = [np.concatenate(x) for x in zip(*kept, strict=True)]
            last = last or (int(rows[0][0]), int(rows[1].min()))
            yield closed(last, *rows)
            kept, known = [], 0
    if kept:
        yield closed(last, *[np.concatenate(x) for x in zip(*kept, strict=True)])


@scan.frees_memory
def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, doc) of rows sorted by document, without the largest buckets that the spare groups of each document and band allow to leave."""
    carry: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        rows = pa.Table.from_batches([batch]) if batch is not None else None
        if carry is not None:
            rows = pa.concat_tables([carry, rows]) if rows is not None else carry
        if rows is None or not rows.num_rows:
            continue
        doc = rows["doc"].to_numpy()
        end = len(doc) if batch is None else int(np.searchsorted(doc, doc[-1]))  # the last document may go on
        carry, rows = rows.slice(end), rows.slice(0, end)
        if not end:
            continue
        doc, slot = doc[:end], rows["slot"].to_numpy().astype(np.int64)
        band = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) * 2 + (slot & 1)
        several = slot >> 1 & 0xFF
        alone = several == ALONE
        groups = np.unique(band[~alone] << 8 | several[~alone]) >> 8
        count = np.bincount(band)
        shared = (np.bincount(band[alone], minlength=len(count)) + np.bincount(groups, minlength=len(count)))[band]
        order = np.lexsort((rows["sig"].to_numpy(), -rows["n"].to_numpy().astype(np.int64), band))
        place = np.empty(end, np.int64)
        place[order] = np.arange(end) - np.repeat(np.cumsum(count) - count, count)  # 0 for the largest bucket of a band
        spare = slot >> 9
        yield from rows.select(["sig", "doc"]).filter(pa.array((shared > spare) & ~(alone & (place < spare)))).to_batches()


@scan.frees_memory
def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each document, and a sketch: how many of its shingles fall into each of a power of two of hash ranges, 255 at most."""
    for batch in batches:
        for part in scan.chunks(batch.column("text")):
            row, value = sets(part)
            n = np.bincount(row, minlength=part.rows)
            edge = np.concatenate([[0], np.cumsum(n)])
            raw = value.astype("<u8").tobytes()
            held = [raw[a * 8 : b * 8] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            bits = np.array([max(0, int(x) // COUNTED).bit_length() for x in n])
            sketch = [
                np.minimum(255, np.bincount((value[a:b] >> U64(64 - k)).astype(np.int64) if k else np.zeros(b - a, np.int64), minlength=1 << k)).astype(np.uint8).tobytes()
                for a, b, k in zip(edge[:-1].tolist(), edge[1:].tolist(), bits.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc_id").slice(part.first, part.rows), "n": n, "sketch": pa.array(sketch, pa.binary()), "held": pa.array(held, pa.binary())})


@scan.frees_memory
def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches do not already differ by more than similar sets can: counts differ by at most what the sets differ."""
    num, den = SIMILAR
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        for i, (x, y) in enumerate(zip(batch.column("sketch_a"), batch.column("sketch_b"), strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint8).astype(np.int32) for v in (x, y))
            if max(x.max(), y.max()) == 255:
                keep[i] = True
                continue
            m = min(len(x), len(y))  # ranges nest, so the finer sketch is summed
            keep[i] = (den + num) * np.abs(x.reshape(m, -1).sum(axis=1) - y.reshape(m, -1).sum(axis=1)).sum() <= (den - num) * sizes[i]
        kept = batch.select(["a", "b"]).filter(pa.array(keep))
        yield kept


@scan.frees_memory
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    num, den = SIMILAR
    for batch in batches:
        linked = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("held_a"), batch.column("held_b"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            if len(x) > len(y):
                x, y = y, x
            if len(x) and den * len(x) >= num * len(y):
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int((y[at] == x).sum())
                linked[i] = den * common >= num * (len(x) + len(y) - common)
        yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"), "linked": linked})


SENT, SHARED, MEMBERS = "sig long, doc long, slot int, rep long", "sig long, doc long, slot int, rep long, n int", "sig long, doc long, rep long, n int"


class Stored:
    """Intermediate tables in the shared folder, removed when no longer read."""

    def __init__(self, spark):
        ensure_checkpoint_dir(spark)
        self.spark, self.folder = spark, f"{spark.sparkContext.getCheckpointDir()}/join-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.spark._jvm.System.gc()  # lets Spark remove the shuffle files of finished steps
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is among ``ids``, and a few others: those whose hash meets that of such an id.

    Texts are chosen where they are read and never travel. What does is one bit for each hash, in a broadcast table of 16 bits for each id, at most 16 MB;
    with many more ids more of the other rows stay. Joins by doc_id that follow leave them out.
    """
    bits = min(MOST_BITS, BITS * (1 + ids.count() * BITS_OF_ID // BITS))

    def place(rows: DataFrame) -> DataFrame:
        at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
        return rows.where("doc_id IS NOT NULL").withColumns({"group": F.shiftright(at, 15), "bit": (at % BITS).cast("int")})

    # dealt by group first, so that no task has a map of every group
    known = place(ids.select("doc_id")).select("group", F.col("bit").cast("long").alias("bit")).repartition("group").groupBy("group").agg(F.bitmap_construct_agg("bit").alias("map"))
    byte = F.conv(F.hex(F.expr("substring(map, bit div 8 + 1, 1)")), 16, 10).cast("int")
    return place(docs).join(F.broadcast(known), "group").where(F.getbit(byte, F.col("bit") % 8) == 1).select(*docs.columns)


SETS = "doc long, n long, sketch binary, held binary"


def _verify(store: Stored, pairs: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """Exact comparison of the pairs (a, b): those that may be links by their sketches, with ``linked``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    held = store.put(texts_of(docs, ids).mapInArrow(_set_rows, SETS), f"{name}-sets")

    def sides(rows: DataFrame, *columns: str) -> DataFrame:
        one, two = (held.select(F.col("doc").alias(d), *[F.col(c).alias(f"{c}_{d}") for c in columns]) for d in "ab")
        return rows.join(two, "b").join(one, "a").select("a", "b", *[f"{c}_{d}" for c in columns for d in "ab"])

    likely = store.put(sides(pairs, "n", "sketch").mapInArrow(_may_link, "a long, b long").distinct(), f"{name}-likely")
    checked = sides(likely, "held").mapInArrow(_compare, "a long, b long, linked boolean").groupBy("a", "b").agg(F.max("linked").alias("linked"))
    out = store.put(checked, f"{name}-checked")
    store.drop(f"{name}-sets", f"{name}-likely")
    return out


def links_and_components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(set size of every row: doc, n_shingles; verified pairs (a, b) that connect all similar documents; component of every document that has a link: node, label)."""
    store = Stored(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = own.mapInArrow(_signature_rows, SENT)
    # plain rows, without a signature, are spread by document; rows are sorted by one number, which needs no comparisons
    dealt = rows.repartition(F.coalesce("sig", F.xxhash64("doc"))).sortWithinPartitions("sig")
    shared = store.put(dealt.mapInArrow(_bucket_rows, SHARED), "shared")
    plain = store.put(shared.where("sig IS NULL"), "plain")
    sieved = shared.where("sig IS NOT NULL").select("sig", "doc", "slot", "n").repartition("doc").sortWithinPartitions("doc").mapInArrow(_sieve, "sig long, doc long")
    members = store.put(sieved.repartition("sig").sortWithinPartitions("sig").mapInArrow(_member_rows, MEMBERS), "members")
    store.drop("shared")
    left = members.select("sig", "doc")
    # a large bucket left in pieces: its smallest document is that of all rows. There are at most as many as LARGE fits into the rows
    large = members.where(F.col("n") >= LARGE)
    lowest = F.broadcast(large.groupBy("sig").agg(F.min("doc").alias("rep")))
    star = members.where(F.col("n") < LARGE).select("doc", "rep").unionByName(large.select("sig", "doc").join(lowest, "sig").select("doc", "rep"))
    pair = (F.least("doc", "rep").alias("a"), F.greatest("doc", "rep").alias("b"))
    pairs = star.unionByName(plain.where("rep IS NOT NULL").select("doc", "rep")).where("doc <> rep").select(*pair).distinct()
    first = store.put(pairs, "pairs-1")
    checked = _verify(store, first, own, "round-1")
    links = checked.where("linked").select("a", "b")
    # a group's original has most of its signatures in common with others; an edit takes some away
    degree = left.groupBy("doc").agg(F.count(F.lit(1)).alias("degree"))
    node = store.put(degree.join(contract(links, []), degree["doc"] == F.col("node"), "left").select(
        F.col("doc").alias("node"), F.coalesce("label", "doc").alias("part"), "degree"), "nodes")
    lead = node.groupBy("part").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("lead"))
    placed = left.join(node.join(lead, "part"), left["doc"] == node["node"]).select("sig", "doc", "part", "degree", "lead")
    # buckets whose members are still apart; the hub leads the component of the member that has most in common
    hub = F.max_by(F.struct(F.col("lead").alias("doc"), "part"), F.struct("degree", -F.col("doc"))).alias("hub")
    apart = placed.groupBy("sig").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("n"), hub).where("low <> high").select("sig", "n", "hub")
    left = store.put(placed.join(apart, "sig").select("sig", "doc", "part", "n", "hub"), "left")
    x, y = (left.where(F.col("n") <= FEW).select("sig", F.col("doc").alias(c), F.col("part").alias(f"part_{c}")) for c in "ab")
    few = x.join(y, "sig").where("a < b AND part_a <> part_b").select("a", "b")
    around = store.put(left.where(F.col("n") > FEW).select(
        F.col("hub.doc").alias("hub"), "doc", "part", (F.col("part") != F.col("hub.part")).alias("alone")).distinct(), "around")
    deltas = _deltas(store, around, own)
    head, whole = (deltas.where(F.col("kind") == k).select("hub", "item", "far", F.col("doc").alias(d), F.col("part").alias(f"part_{d}")) for k, d in ((HEAD, "x"), (WHOLE, "y")))
    shared = head.join(whole, ["hub", "item", "far"]).where("part_x <> part_y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    near = deltas.where(F.col("kind") == LINK).select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b"))
    second = store.put(few.unionByName(shared).unionByName(near).distinct().join(first, ["a", "b"], "left_anti"), "pairs-2")
    links = checked.unionByName(_verify(store, second, own, "round-2")).where("linked").select("a", "b")
    store.drop("members", "nodes", "left", "around", "deltas", "pairs-1", "pairs-2")
    return plain.select("doc", F.col("slot").cast("long").alias("n_shingles")), links, contract(links, [])


def _deltas(store: Stored, around: DataFrame, docs: DataFrame) -> DataFrame:
    """What sets differ in from the hub of a large bucket: rows (hub, doc, its component, item, kind).

    Let r be the hub, E(x) the items in which x and r differ. Sets x and y differ in |E(x)| + |E(y)| - 2 |E(x) & E(y)| items. If x is not similar to r, then
    9 |E(x)| >= far / STEPS * (|x| + |r|) for a whole number ``far`` of at least STEPS; similar x and y must then share ``need`` items of E(y), about half or more. Of the first
    ``|E(y)| - need + 1`` items of E(y), its head for that distance, one is in E(x): heads meet whole differences in an equi-join. Rare items come first.
    """
    ids = around.select(F.explode(F.array("hub", "doc")).alias("doc_id")).distinct()
    held = store.put(texts_of(docs, ids).mapInArrow(_set_rows, SETS), "delta-sets")
    of_hub = held.select(F.col("doc").alias("hub"), F.col("held").alias("held_hub"))
    rows = around.join(held.select("doc", "held"), "doc").join(of_hub, "hub").select("hub", "doc", "part", "alone", "held", "held_hub")
    out = store.put(rows.mapInArrow(_delta_rows, "hub long, doc long, part long, far int, item long, kind int"), "deltas")
    store.drop("delta-sets")
    return out


LINK, HEAD, WHOLE = 0, 1, 2


@scan.frees_memory
def _delta_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    num, den = SIMILAR
    up, down = den + num, den - num  # similar: up * difference <= down * (sum of sizes)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            rows, found = batch.slice(at, 1024), []
            for x, r in zip(rows.column("held"), rows.column("held_hub"), strict=True):
                x, r = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(r.as_buffer(), "<u8")
                found.append((np.setxor1d(x, r, assume_unique=True), len(x), len(r)))
            hubs, docs, alone, parts = (rows.column(c).to_pylist() for c in ("hub", "doc", "alone", "part"))
            sizes = [len(f[0]) for f in found]
            # any order of items is right for a head; those that few sets near the hub have make few pairs
            keys = scan.mix(np.concatenate([f[0] for f in found]) + np.repeat(np.array(hubs, np.int64).view(U64), sizes) * U64(0x9E3779B97F4A7C15))
            _, which, often = np.unique(keys, return_inverse=True, return_counts=True)
            often = np.split(often[which.ravel()], np.cumsum(sizes)[:-1])
            out: list[tuple[int, int, int, int, int, np.ndarray]] = []
            for hub, doc, lone, part, (items, n, m), count in zip(hubs, docs, alone, parts, found, often, strict=True):
                e, first = len(items), items[np.argsort(count, kind="stable")]
                for far in range(STEPS, STEPS * up // down + 1):
                    # the set x: at least far / STEPS of the threshold away from the hub, at least 4/5 and at most 5/4 of this one's size
                    if STEPS * (up * e - down * (n + n * den // num + 1)) > (far + 1) * down * (m + n * den // num + 1):
                        continue  # too near to the hub to be similar
                    other = down * (far * m + (far - STEPS) * (n * num // den)) + STEPS * (far == STEPS)
                    need = -(-(STEPS * (up * e - down * n) + other) // (2 * STEPS * up))
                    if need > e:
                        break
                    out.append((hub, doc, part, far, HEAD, first[: e - max(1, need) + 1]))
                if lone and up * e > down * (n + m):
                    out.append((hub, doc, part, STEPS * up * e // (down * (n + m)), WHOLE, items))
                elif lone:
                    out.append((hub, doc, part, 0, LINK, np.zeros(1, U64)))
            if out:
                n = [len(o[5]) for o in out]
                columns = {c: np.repeat([o[i] for o in out], n).astype(t) for i, (c, t) in enumerate(
                    (("hub", np.int64), ("doc", np.int64), ("part", np.int64), ("far", np.int32), ("kind", np.int32)))}
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in ("hub", "doc", "part", "far")} | {
                    "item": np.concatenate([o[5] for o in out]).view(np.int64), "kind": columns["kind"]})


@scan.frees_memory
def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plain rows as they are, and the buckets of the signature rows."""
    links: list[pa.RecordBatch] = []

    def signature_rows() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = batch.column("sig")
            if sig.null_count:
                plain = batch.filter(sig.is_null())
                links.append(plain.append_column("n", pa.array(np.zeros(plain.num_rows, np.int32))))
                batch = batch.filter(sig.is_valid())
            yield batch

    for out in _buckets(signature_rows()):
        yield from links
        links.clear()
        yield out.set_column(3, "rep", pa.nulls(out.num_rows, pa.int64()))
    yield from links


@scan.frees_memory
def _member_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of the rows that the sieve leaves."""
    yield from _buckets(batches)


@scan.frees_memory
def _print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, band and fingerprint of each set that is not empty."""
    for batch in batches:
        for part in scan.chunks(batch.column("text")):
            row, value = sets(part)
            n = np.bincount(row, minlength=part.rows)
            limits = np.array([b.limit for b in bands(1 << int(n.max(initial=1)).bit_length())])
            prints = np.ascontiguousarray(fingerprints(row, value, part.rows).T).view(np.int64)
            rows = batch.slice(part.first, part.rows)
            found = pa.RecordBatch.from_pydict({
                "doc": rows.column("doc_id"), "n": n, "band": np.searchsorted(limits, n), "f1": prints[0], "f2": prints[1]})
            yield found.filter(pa.array(n > 0))


@scan.frees_memory
def _held_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint and set of each document."""
    for batch in batches:
        for part in scan.chunks(batch.column("text")):
            row, value = sets(part)
            edge = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.rows))]).tolist()
            raw = value.astype("<u8").tobytes()
            prints = np.ascontiguousarray(fingerprints(row, value, part.rows).T).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc_id").slice(part.first, part.rows), "f1": prints[0], "f2": prints[1],
                "held": pa.array([raw[a * 8 : b * 8] for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())})


def _similar(held: list[np.ndarray]) -> np.ndarray:
    """Which of some sets are similar, as a matrix."""
    num, den = SIMILAR
    m, sizes = len(held), np.array([len(x) for x in held], np.int64)
    owner = np.repeat(np.arange(m), sizes)
    _, item, often = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    order = np.argsort(item, kind="stable")
    item, owner = item[order], owner[order]
    rare, frequent = (often[item] > 1) & (often[item] <= RARE), often[item] > RARE
    common = np.zeros((m, m), np.float32)
    i, o = item[rare], owner[rare]
    for d in range(1, RARE):
        same = np.flatnonzero(i[d:] == i[:-d])
        np.add.at(common, (o[same], o[same + d]), 1)
    common += common.T
    _, i = np.unique(item[frequent], return_inverse=True)
    o = owner[frequent]
    for lo in range(0, int(i.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(i, [lo, lo + 4096])
        cells = np.zeros((m, 4096), np.float32)
        cells[o[a:b], i[a:b] - lo] = 1
        common += cells @ cells.T
    common = common.astype(np.int64)
    return (common > 0) & (den * common >= num * (sizes[:, None] + sizes[None, :] - common))


@scan.frees_memory
def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task: for each set the documents of one set in the other block that are similar (no ``other``); pairs with a document of several sets are listed."""
    keys = ("label", "band_a", "block_a", "band_b", "block_b")
    carry: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        rows = pa.Table.from_batches([batch]) if batch is not None else None
        if carry is not None:
            rows = pa.concat_tables([carry, rows]) if rows is not None else carry
        if rows is None or not rows.num_rows:
            continue
        task = np.stack([rows[k].to_numpy() for k in keys])
        begin = np.flatnonzero(np.concatenate([[True], (task[:, 1:] != task[:, :-1]).any(axis=0)]))
        done = len(rows) if batch is None else int(begin[-1])  # the last task may go on
        out: list[tuple[np.ndarray, ...]] = []
        for lo, hi in zip(begin, np.append(begin[1:], len(rows)), strict=True):
            if hi > done:
                break
            one = rows.slice(lo, hi - lo)
            doc, f1, f2 = (one[c].to_numpy() for c in ("doc", "f1", "f2"))
            first = np.unique(np.stack([doc, f1, f2]), axis=1, return_index=True)[1]  # equal rows of a document are one
            one, doc = one.take(first), doc[first]
            side, several, copies = (one[c].to_numpy() for c in ("side", "several", "copies"))
            linked = _similar([np.frombuffer(x.as_buffer(), "<u8") for x in one["held"]]) & (doc[:, None] != doc[None, :])
            if task[1, lo] != task[3, lo] or task[2, lo] != task[4, lo]:
                linked &= side[:, None] != side[None, :]
            total = (linked * np.where(several, 0, copies)[None, :]).sum(axis=1)
            at = np.flatnonzero((total > 0) & ~several)
            x, y = np.nonzero(linked & (several[:, None] | several[None, :]))
            out.append((doc[at], doc[at], total[at], np.ones(len(at), bool)))
            out.append((doc[x], doc[y], np.where(several, 1, copies)[y], np.zeros(len(x), bool)))
        if out:
            own, other, n, summed = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_pydict({"doc": own, "other": pa.array(other, mask=summed), "n": n})
        carry = rows.slice(done)


def link_counts(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Number of all similar documents of every document with a link: node, n_links. ``parts`` are the components of ``links_and_components``."""
    store = Stored(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    member = parts.unionByName(parts.select(F.col("label").alias("node"), "label").distinct())
    found = texts_of(own, member.select(F.col("node").alias("doc_id"))).mapInArrow(_print_rows, "doc long, n long, band long, f1 long, f2 long")
    prints = store.put(found.join(member, F.col("doc") == F.col("node")).select("doc", "label", "n", "band", "f1", "f2").distinct(), "prints")
    several = prints.groupBy("doc").count().where("count > 1").select(F.col("doc").alias("own"))
    marked = prints.join(several, F.col("doc") == F.col("own"), "left")
    # a representative for the documents that have this set only; each document of several sets stands for itself
    entries = store.put(marked.groupBy("label", "n", "band", "f1", "f2", "own").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies")), "entries")
    whole = entries.groupBy("label").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("all_sets")).where("all_sets > 1")
    small = (F.col("all_n") <= BLOCK_SHINGLES) & (F.col("all_sets") <= BLOCK_SETS)
    apart = store.put(entries.join(whole, "label").withColumn("band", F.when(small, -1).otherwise(F.col("band"))).select(
        "label", "band", "n", "f1", "f2", "doc", "copies", F.col("own").isNotNull().alias("several")), "apart")
    cells = apart.groupBy("label", "band").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("long").alias("blocks"))
    cells = store.put(cells, "cells")
    below, above = (cells.select("label", (F.col("band") + d).alias("band"), F.col("blocks").alias(c)) for d, c in ((1, "blocks_below"), (-1, "blocks_above")))
    around = cells.join(below, ["label", "band"], "left").join(above, ["label", "band"], "left")
    placed = apart.join(around, ["label", "band"]).withColumn("block", F.pmod("f1", "blocks"))

    def tasks(blocks: str, task) -> F.Column:
        every = F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)
        return F.when(F.col(blocks) > 0, F.transform(every, task)).otherwise(F.array().cast("array<struct<band_a:long,block_a:long,band_b:long,block_b:long,side:int>>"))

    def task(band_a, block_a, band_b, block_b, side):
        return F.struct(band_a.alias("band_a"), block_a.alias("block_a"), band_b.alias("band_b"), block_b.alias("block_b"), side.cast("int").alias("side"))

    band, block = F.col("band"), F.col("block")
    met = F.concat(
        tasks("blocks", lambda j: task(band, F.least(block, j), band, F.greatest(block, j), block > j)),
        tasks("blocks_above", lambda j: task(band, block, band + 1, j, F.lit(0))),
        tasks("blocks_below", lambda j: task(band - 1, j, band, block, F.lit(1))))
    held = texts_of(own, apart.select(F.col("doc").alias("doc_id"))).mapInArrow(_held_rows, "doc long, f1 long, f2 long, held binary")
    rows = placed.withColumn("met", met).join(held, ["doc", "f1", "f2"]).select("label", F.explode("met").alias("t"), "doc", "f1", "f2", "copies", "several", "held")
    key = ["label", "band_a", "block_a", "band_b", "block_b"]
    rows = rows.select("label", "t.*", "doc", "f1", "f2", "copies", "several", "held").repartition(*key).sortWithinPartitions(*key)
    found = store.put(rows.mapInArrow(_count_rows, "doc long, other long, n long"), "found")
    listed = found.where("other IS NOT NULL").distinct()
    sums = found.where("other IS NULL").unionByName(listed).groupBy(F.col("doc").alias("rep")).agg(F.sum("n").alias("n"))
    alone = entries.where("own IS NULL").select("label", "f1", "f2", F.col("doc").alias("rep"), (F.col("copies") - 1).alias("equal"))
    nodes = prints.join(several, F.col("doc") == F.col("own"), "left_anti").join(alone, ["label", "f1", "f2"]).select("doc", "rep", "equal")
    nodes = nodes.unionByName(several.select(F.col("own").alias("doc"), F.col("own").alias("rep"), F.lit(0).cast("long").alias("equal")))
    out = store.put(nodes.join(sums, "rep", "left").select(F.col("doc").alias("node"), (F.col("equal") + F.coalesce("n", F.lit(0))).alias("n_links")), "counts")
    store.drop("prints", "entries", "apart", "cells", "found")
    return out


def components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links (all other documents that are similar to it)."""
    sizes, _, parts = links_and_components(docs)
    known = parts.join(link_counts(docs, parts), "node", "full").select("node", "label", "n_links")
    return sizes.join(known, sizes["doc"] == known["node"], "left").select(
        F.col("doc").alias("doc_id"), "n_shingles", F.coalesce("label", "doc").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows of documents that have a similar one of smaller id; rows without words or id stay. Of rows with one id the first by text and other columns stays."""
    _, _, parts = links_and_components(docs)
    dropped = parts.where("node <> label").select(F.col("node").alias("j_id"))
    kept = docs.join(dropped, F.col("doc_id") == F.col("j_id"), "left_anti")
    twice = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("j_id"))
    if twice.isEmpty():
        return kept
    order = Window.partitionBy("doc_id").orderBy("text", *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
    again = kept.join(twice, F.col("doc_id") == F.col("j_id"), "left_semi").withColumn("j_nth", F.row_number().over(order)).where("j_nth = 1").drop("j_nth")
    return kept.join(twice, F.col("doc_id") == F.col("j_id"), "left_anti").unionByName(again)

