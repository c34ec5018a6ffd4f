"""Neighbour search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskloom.llm import ann


def brute(rows, query_id, k):
    own = {}
    for i, v in rows:
        own.setdefault(i, v)
    q = np.array(own[query_id])
    far = sorted((float(np.sqrt(((np.array(v) - q) ** 2).sum())), i) for i, v in own.items() if i != query_id)
    return [(i, d) for d, i in far[:k]]


def make(spark, rows):
    return spark.createDataFrame([(i, v, "s", 1, "r") for i, v in rows], "vec_id long, embedding array<double>, score string, shard int, rank string")


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


@pytest.mark.parametrize("shard_rows", [4096, 150])
def test_recall_and_scores(spark, shard_rows):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * rnd.normal(size=16)).tolist()) for i in range(1500)]
    own = ann.usable(make(spark, rows)).cache()
    got = answers(ann.search(ann.build(own, shard_rows).cache(), own.where("vec_id % 50 = 0"), 10))
    assert set(got) == set(range(0, 1500, 50))
    hit = 0
    for i, found in got.items():
        want = brute(rows, i, 10)
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert found == sorted(found, key=lambda x: (x[2], x[1]))
        vectors = dict(rows)
        assert all(s == float(np.sqrt(((np.array(vectors[v]) - np.array(vectors[i])) ** 2).sum())) for _, v, s in found)
        hit += len({v for _, v, _ in found} & {v for v, _ in want})
    assert hit >= 0.95 * 10 * len(got)


def test_hot_vector_and_ties(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, [1.0, 0.0, -0.0] if i % 3 == 0 else rnd.normal(size=3).tolist()) for i in range(900)]
    got = answers(ann.nearest(make(spark, rows), F.col("vec_id") % 100 == 0))
    for i, found in got.items():
        if i % 3 == 0:
            assert found == [(r, v, 0.0) for r, v in enumerate([v for v in range(0, 900, 3) if v != i][:10], 1)]
    assert set(got) == set(range(0, 900, 100))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (200, [4.0, 6.0]), (300, None)]
    got = answers(ann.nearest(make(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == {100: [(1, 1, 0.0), (2, 200, 5.0)], 200: [(1, 1, 5.0), (2, 100, 5.0)]}
    assert ann.nearest(make(spark, []), F.lit(True)).count() == 0
    assert ann.nearest(make(spark, [(100, [1.0])]), F.lit(True)).count() == 0


def test_index_holds_every_vector(spark):
    rows = [(i, [float(i), 1.0]) for i in range(500)]
    index = ann.build(ann.usable(make(spark, rows)), 100).collect()
    assert sorted(i for r in index for i in np.frombuffer(r.ids, "<i8").tolist()) == list(range(500))
    assert sum(r["size"] for r in index) == 500 and len(index) == 5
    for r in index:
        graph, _, _ = ann._unpack(r.asDict())
        reached, todo = {graph.entry}, [graph.entry]
        while todo:
            i = todo.pop()
            for j in graph.links[0][i, : graph.count[0][i]].tolist():
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        assert len(reached) == r["size"]


def test_blocks_are_not_repeated_for_every_shard(spark):
    """Queries times shards outgrow the driver, and its broadcasts, long before either does."""
    rnd = np.random.default_rng(6)
    own = ann.usable(make(spark, [(i, rnd.normal(size=8).tolist()) for i in range(1200)])).cache()
    index = ann.build(own, 100).cache()
    assert index.count() == 12
    found = ann.search(index, own.where("vec_id % 2 = 0"), 10)
    assert len(found.collect()) == 6000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan, plan
