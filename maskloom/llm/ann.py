"""Approximate nearest neighbours (operator 3): a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of the id; each shard builds its own graph in one task, bounded by the shard's size. An index row holds
the graph as flat arrays: the vectors, for every level the nodes and a fixed number of neighbour places for each (-1: none). Queries are
searched in blocks in every shard, and the shards' best are merged by distance and id. Both sides are bounded: a block, an index row. They meet in
pairs of partitions, so no copies of blocks, whose number is queries times shards, are shuffled or broadcast.

Equal vectors are one node, with its smallest ids (as many as can be in one answer), so a vector that a third of the rows share neither spoils a graph nor
fills an answer with more than it may.

Defined cases: vectors that are null or zero, hold a null or a value that is not finite, or have another length than most, take no part, nor do null
ids; a query finds neither its own id nor anything twice; ties go to the smaller id; with fewer candidates than asked for all of them that the
search reaches are returned; equal rows count once; an empty table has no index rows and no answers; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskloom.llm.text import mix
from maskloom.session import cut

SHARD_ROWS = 4096
#: neighbours of a node on upper levels and on the ground level, candidates kept while building and while searching
M, M0, EF_BUILD, EF_SEARCH = 12, 24, 80, 120
QUERY_BLOCK = 512
#: blocks that a task searches in the shards of one partition
BLOCKS = 16
#: ids kept for equal vectors: an answer of k and the query's own
IDS = 11
INDEX = "shard int, size int, dim int, entry int, vectors binary, ids binary, id_ends binary, nodes binary, level_ends binary, neighbours binary"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, as doubles."""
    e = F.col("embedding")
    fine = ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    lengths = own.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return own.where(F.size("embedding") == (lengths.dim if lengths else 0))


class Graph:
    """Flat neighbour arrays of one shard."""

    def __init__(self, vectors: np.ndarray, seed: int = 0):
        n = len(vectors)
        self.x = vectors
        self.norm = (vectors * vectors).sum(axis=1)
        luck = (mix(np.arange(n, dtype=np.uint64) + np.uint64(seed)) >> np.uint64(11)).astype(np.float64) / 2**53
        self.level = np.minimum(16, (-np.log(luck + 1e-18) / math.log(M)).astype(int))
        self.links = [np.full((n, M0 if i == 0 else M), -1, np.int32) for i in range(int(self.level.max(initial=0)) + 1)]
        self.count = [np.zeros(n, np.int32) for _ in self.links]
        self.seen = np.zeros(n, np.int64)
        self.turn = 0
        self.entry = 0
        for i in range(1, n):
            self._insert(i)

    def distances(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared distances less the square of q: good enough to order."""
        return self.norm[at] - 2 * (self.x[at] @ q)

    def near(self, q: np.ndarray, starts: list[tuple[float, int]], level: int, ef: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest nodes found on a level, nearest first."""
        links, count, seen = self.links[level], self.count[level], self.seen
        self.turn += 1
        turn = self.turn
        for _, i in starts:
            seen[i] = turn
        open_ = list(starts)
        heapq.heapify(open_)
        best = [(-d, i) for d, i in starts]
        heapq.heapify(best)
        while open_:
            d, i = heapq.heappop(open_)
            if len(best) >= ef and d > -best[0][0]:
                break
            at = links[i, : count[i]]
            at = at[seen[at] != turn]
            if not len(at):
                continue
            seen[at] = turn
            away = self.distances(q, at)
            if len(best) >= ef:
                ok = away < -best[0][0]
                at, away = at[ok], away[ok]
            for dist, j in zip(away.tolist(), at.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (-dist, j))
                elif dist < -best[0][0]:
                    heapq.heapreplace(best, (-dist, j))
                else:
                    continue
                heapq.heappush(open_, (dist, j))
        return sorted((-d, i) for d, i in best)

    def choose(self, i: int, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours of node i that are closer to it than to one another, then the nearest of the rest."""
        if len(near) <= most:
            return [j for _, j in near]
        at = np.array([j for _, j in near])
        own = np.array([d for d, _ in near]) + self.norm[i]
        x = self.x[at]
        between = self.norm[at][:, None] + self.norm[at][None, :] - 2 * (x @ x.T)
        apart, taken, rest = np.full(len(at), np.inf), [], []
        for n in range(len(at)):
            if len(taken) == most:
                break
            if own[n] < apart[n]:
                taken.append(n)
                np.minimum(apart, between[n], out=apart)
            else:
                rest.append(n)
        return at[(taken + rest)[:most]].tolist()

    def _insert(self, i: int) -> None:
        q, top = self.x[i], int(self.level[i])
        start = [(float(self.distances(q, np.array([self.entry]))[0]), self.entry)]
        highest = int(self.level[self.entry])
        for level in range(highest, top, -1):
            start = self.near(q, start, level, 1)[:1]
        for level in range(min(top, highest), -1, -1):
            near = self.near(q, start, level, EF_BUILD)
            most = M0 if level == 0 else M
            chosen = self.choose(i, near, M)
            self._set(level, i, chosen)
            for j in chosen:
                n = int(self.count[level][j])
                if n < most:
                    self.links[level][j, n] = i
                    self.count[level][j] = n + 1
                else:
                    at = np.append(self.links[level][j, :n], i)
                    away = self.distances(self.x[j], at)
                    order = np.argsort(away, kind="stable")
                    self._set(level, j, self.choose(j, list(zip(away[order].tolist(), at[order].tolist(), strict=True)), most))
            start = near
        if top > highest:
            self.entry = i

    def _set(self, level: int, i: int, chosen: list[int]) -> None:
        self.links[level][i, : len(chosen)] = chosen
        self.links[level][i, len(chosen) :] = -1
        self.count[level][i] = len(chosen)

    def search(self, q: np.ndarray, ef: int = EF_SEARCH) -> list[int]:
        start = [(float(self.distances(q, np.array([self.entry]))[0]), self.entry)]
        for level in range(len(self.links) - 1, 0, -1):
            start = self.near(q, start, level, 1)[:1]
        return [i for _, i in self.near(q, start, 0, ef)]


def _pack(shard: int, ids: np.ndarray, vectors: np.ndarray) -> dict:
    order = np.argsort(ids, kind="stable")
    distinct, which = np.unique(vectors[order] + 0.0, axis=0, return_inverse=True)
    which, ids = which.ravel(), ids[order]
    at = np.argsort(which, kind="stable")
    once = np.ones(len(at), bool)
    once[1:] = (which[at][1:] != which[at][:-1]) | (ids[at][1:] != ids[at][:-1])
    at = at[once]
    nth = np.arange(len(at)) - np.searchsorted(which[at], which[at])
    at = at[nth < IDS]
    ends = np.cumsum(np.bincount(which[at], minlength=len(distinct)))
    mixed = np.argsort(mix(np.arange(len(distinct), dtype=np.uint64)))  # sorted vectors would make a poor graph
    begin = ends - np.bincount(which[at], minlength=len(distinct))
    own = [ids[at][begin[i] : ends[i]] for i in mixed]
    graph = Graph(distinct[mixed])
    nodes = [np.flatnonzero(graph.level >= i).astype("<i4") for i in range(len(graph.links))]
    return {
        "shard": shard, "size": len(distinct), "dim": vectors.shape[1], "entry": graph.entry, "vectors": distinct[mixed].astype("<f8").tobytes(),
        "ids": np.concatenate(own).astype("<i8").tobytes(), "id_ends": np.cumsum([len(o) for o in own]).astype("<i4").tobytes(),
        "nodes": np.concatenate(nodes).tobytes(), "level_ends": np.cumsum([len(n) for n in nodes]).astype("<i4").tobytes(),
        "neighbours": np.concatenate([graph.links[i][n].ravel() for i, n in enumerate(nodes)]).astype("<i4").tobytes(),
    }


def _unpack(row: dict) -> tuple[Graph, np.ndarray, np.ndarray]:
    """(graph, ids, where the ids of each node end)."""
    g = Graph.__new__(Graph)
    n = row["size"]
    g.x = np.frombuffer(row["vectors"], "<f8").reshape(n, row["dim"])
    g.norm = (g.x * g.x).sum(axis=1)
    g.seen, g.turn, g.entry = np.zeros(n, np.int64), 0, row["entry"]
    nodes, flat = np.frombuffer(row["nodes"], "<i4"), np.frombuffer(row["neighbours"], "<i4")
    g.links, g.count, begin, used = [], [], 0, 0
    for level, end in enumerate(np.frombuffer(row["level_ends"], "<i4").tolist()):
        width = M0 if level == 0 else M
        links = np.full((n, width), -1, np.int32)
        links[nodes[begin:end]] = flat[used : used + (end - begin) * width].reshape(-1, width)
        used += (end - begin) * width
        begin = end
        g.links.append(links)
        g.count.append((links >= 0).sum(axis=1))
    return g, np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["id_ends"], "<i4")


def build(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Index rows, one for each shard, of usable vectors."""
    shards = max(1, -(-vectors.count() // shard_rows))
    told = max(shards, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # so AQE does not merge shards, which are small and slow, into a few tasks
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).repartition(told, "shard")

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        flat = rows["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        packed = _pack(key[0].as_py(), rows["vec_id"].to_numpy(), flat.reshape(rows.num_rows, -1))
        return pa.Table.from_pylist([packed], schema=pa.schema([(n, pa.int32() if t == "int" else pa.binary()) for n, t in (x.split() for x in INDEX.split(", "))]))

    return dealt.groupBy("shard").applyInArrow(one, INDEX)


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k nearest vectors of each query (vec_id, embedding): query_id, rank, vec_id, score. ``index`` should be pinned."""
    if k >= IDS:
        raise ValueError(f"an index keeps {IDS} ids of equal vectors; k must be less")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    one = queries.groupBy(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("asked"))
    found = index.crossJoin(one.select("asked").coalesce(-(-blocks // BLOCKS)).hint("shuffle_replicate_nl"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for i in range(batch.num_rows):
                if (now := batch["shard"][i].as_py()) != shard:  # the blocks of a shard follow each other
                    shard, (graph, ids, ends) = now, _unpack({c: batch[c][i].as_py() for c in batch.schema.names if c != "asked"})
                out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
                for asked in batch["asked"][i].as_py():
                    q = np.array(asked["embedding"])
                    nodes = np.array(graph.search(q))
                    far = np.sqrt(((graph.x[nodes] - q) ** 2).sum(axis=1))
                    best: list[tuple[float, int]] = []
                    for d, n in zip(far.tolist(), nodes.tolist(), strict=True):
                        best += [(d, int(v)) for v in ids[ends[n - 1] if n else 0 : ends[n]] if v != asked["vec_id"]]
                    for d, v in heapq.nsmallest(k, best):
                        out["query_id"].append(asked["vec_id"])
                        out["vec_id"].append(v)
                        out["score"].append(d)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    near = found.mapInArrow(run, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """Index all usable vectors and search those for which ``is_query`` holds."""
    own = cut(usable(vectors))
    return search(cut(build(own)), own.where(is_query).dropDuplicates(["vec_id", "embedding"]), k)
