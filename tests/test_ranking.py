"""Ranks, neighbours, running sums and quantiles against pandas, with chunks far below the group size."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from maskloom.functions import ranking as R


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most rows; frames are dense per group."""
    rng = np.random.default_rng(3)
    rows = [(g, i, float(rng.integers(0, 50))) for g, n in (("hot", 400), ("b", 7), ("c", 1)) for i in range(n)]
    pdf = pd.DataFrame(rows, columns=["g", "i", "v"])
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def same(got, want, cols):
    got = got.sort_values(["g", "i"]).reset_index(drop=True)[cols]
    want = want.sort_values(["g", "i"]).reset_index(drop=True)[cols]
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


@pytest.mark.parametrize("chunk", [1, 3, 64, 1000])
def test_neighbours(hot, chunk):
    if chunk < 2:
        chunk = 2
    pdf, df = hot
    got = R.neighbours(df, ["g"], "i", {"p2": ("v", -2), "p1": ("v", -1), "n1": ("v", 1)}, chunk).toPandas()
    by = pdf.groupby("g").v
    same(got, pdf.assign(p2=by.shift(2), p1=by.shift(1), n1=by.shift(-1)), ["g", "i", "p2", "p1", "n1"])


@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_running_sum_and_last_before(hot, chunk):
    pdf, df = hot
    got = R.running_sum(df, ["g"], "i", "v", "s", chunk).toPandas()
    same(got, pdf.assign(s=pdf.groupby("g").v.cumsum()), ["g", "i", "s"])
    some = df.withColumn("w", F.when(F.col("v") < 10, F.col("v")))
    got = R.last_before(some, ["g"], "i", "w", "last", chunk).toPandas()
    w = pdf.v.where(pdf.v < 10)
    same(got, pdf.assign(last=w.groupby(pdf.g).ffill().groupby(pdf.g).shift(1)), ["g", "i", "last"])


def test_ranks(hot):
    pdf, df = hot
    got = R.rank_sorted(df, ["v", "i"], ["g"], partitions=7, total="n").toPandas()
    want = pdf.sort_values(["g", "v", "i"])
    want = want.assign(rank=want.groupby("g").cumcount() + 1, n=want.groupby("g").v.transform("size"))
    same(got, want, ["g", "i", "rank", "n"])
    by_hash = R.rank_by_hash(df.withColumn("k", F.concat("g", F.col("i").cast("string"))), "k", 7, ["g"], digits=1).toPandas()
    assert all(sorted(x) == list(range(1, len(x) + 1)) for _, x in by_hash.groupby("g")["rank"])


def test_null_group_is_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, i int")
    got = {(r.g, r.i): r["rank"] for r in R.rank_in_buckets(df, [F.col("i")], F.col("i"), ["g"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 5): 1}


@pytest.mark.parametrize("bins", [1, 4, 1024])
def test_exact_quantiles(hot, bins):
    pdf, df = hot
    got = R.exact_quantiles(df, ["g"], "v", {"m": 0.5, "p9": 0.9, "lo": 0.0, "hi": 1.0}, bins=bins).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g").v.quantile([0.5, 0.9, 0.0, 1.0]).unstack()
    assert np.allclose(got[["m", "p9", "lo", "hi"]].values, want.loc[got.index, [0.5, 0.9, 0.0, 1.0]].values)


def test_weighted_quantile(spark):
    df = spark.createDataFrame([(1.0, 3), (5.0, 1), (9.0, 4)], "v double, w int")
    got = R.exact_quantiles(df, [], "v", {"m": 0.5}, weight="w").first().m
    assert got == np.median([1, 1, 1, 5, 9, 9, 9, 9])


def test_chunks_are_dealt_over_all_partitions(spark):
    """AQE may not merge chunks of series into a few tasks that grow with the table."""
    df = spark.range(100).selectExpr("id % 5 AS k", "CAST(floor(id / 5) AS INT) AS frame", "id AS v")
    plan = R.neighbours(df, ["k"], "frame", {"before": ("v", -1)})._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
