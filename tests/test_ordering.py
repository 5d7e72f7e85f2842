"""Global order statistics must not depend on how the key range is cut."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import ordering as od
from plumbline.operators.relational import rank_in_group, rolling_mean


@pytest.fixture(scope="module")
def hot(spark):
    """1,000 rows, a third of them share one value, two groups."""
    rng = np.random.default_rng(3)
    v = np.where(rng.random(1000) < 0.34, 5.0, np.round(rng.normal(5, 3, 1000), 1))
    return spark.createDataFrame([(i, float(x), int(i % 2)) for i, x in enumerate(v)], "id long, v double, g int").repartition(5).cache()


@pytest.mark.parametrize("rows_per_bucket", [None, 37])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_rows(hot, rows_per_bucket, descending):
    got = {r["id"]: (r["rank"], r["s"]) for r in od.rank_rows(hot, "v", "id", by=["g"], descending=descending, running={"s": "g"}, rows_per_bucket=rows_per_bucket).collect()}
    rows = hot.collect()
    for g in (0, 1):
        part = sorted((r for r in rows if r["g"] == g), key=lambda r: ((-r["v"] if descending else r["v"]), r["id"]))
        for i, r in enumerate(part, 1):
            assert got[r["id"]] == (i, i * g)


def test_hot_value_is_spread_over_tasks(hot):
    cuts, values = od.cut_points(hot, "v", 37)
    assert values == [5.0]
    parts = od.with_bucket(hot, "v", cuts, values, "b")
    alone = parts.where("v = 5").select("b").distinct().collect()
    assert len(alone) == 1 and parts.where((F.col("b") == alone[0]["b"]) & (F.col("v") != 5)).count() == 0


@pytest.mark.parametrize("rows_per_bucket", [None, 37])
def test_running_totals(hot, rows_per_bucket):
    got = {(r["g"], r["v"]): r["cum_n"] for r in od.running_totals(hot, "v", {"n": F.lit(1)}, by=["g"], descending=True, rows_per_bucket=rows_per_bucket).collect()}
    rows = hot.collect()
    for (g, v), n in got.items():
        assert n == sum(1 for r in rows if r["g"] == g and r["v"] >= v)


@pytest.mark.parametrize("accuracy", [None, 5, 100])
def test_exact_quantiles(hot, accuracy):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = od.exact_quantiles(hot, ["v"], probs, by=["g"], accuracy=accuracy)
    rows = hot.collect()
    for g in (0, 1):
        assert np.allclose(got[(g, "v")], np.quantile([r["v"] for r in rows if r["g"] == g], probs))


def test_exact_quantiles_nulls_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert od.exact_quantiles(df, ["a", "b"], [0.5]) == {("a",): [2.0], ("b",): [None]}


def test_rank_in_group_shares_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 2)], "g string, v int")
    assert sorted((r["g"], r["v"], r["rank"]) for r in rank_in_group(df, ["g"], "v", rows_per_bucket=1).collect()) == [("a", 1, 3), ("a", 3, 1), ("a", 3, 1), ("b", 2, 1)]


def test_rolling_over_chunks(spark):
    df = spark.range(50).select(F.lit(1).alias("g"), F.col("id"), (F.col("id") * 1.0).alias("v"))
    w = od.rolling(df, ["g"], "id", "id", 4, lambda w: {"s": F.sum("v").over(w), "n": F.count("v").over(w)}, chunk=7)
    for r in w.collect():
        span = range(max(0, r["id"] - 3), r["id"] + 1)
        assert r["s"] == sum(span) and r["n"] == len(span)
    assert w.count() == 50
    first = [r["rolling_mean"] for r in rolling_mean(df, ["g"], "id", "id", "v", 3).orderBy("id").limit(4).collect()]
    assert first == [None, None, 1.0, 2.0]
