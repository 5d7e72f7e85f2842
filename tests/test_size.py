"""Work that must not be repeated or grow with the table: passes over the input, rows of one task, sketches."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from plumbline.operators import chat, models
from plumbline.operators import ordering as od


def test_quartile_brackets_use_light_sketches(spark):
    """Exact with frequent values, few values, one value and none, whatever the sketch."""
    rng = np.random.default_rng(1)
    v = np.concatenate([np.zeros(700), rng.integers(0, 5, 200), rng.normal(3, 50, 101)])
    df = spark.createDataFrame([(float(a), 7.0, None) for a in v], "a double, b double, c double").repartition(3)
    levels = [0.0, 0.25, 0.7, 0.75, 0.9, 1.0]
    got = od.exact_quantiles(df, ["a", "b", "c"], levels, accuracy=20)
    assert got[("a",)] == pytest.approx(np.quantile(v, levels).tolist())
    assert got[("b",)] == [7.0] * 6 and got[("c",)] == [None] * 6
    assert "percentile_approx" not in str(od.bracket_aggregates([F.col("a")], levels, 1000))


def test_confusion_active_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def guess(v):
        seen.add(1)
        return None if v == 3 else "z" if v == 4 else "ab"[v % 2]

    df = spark.createDataFrame([("ab"[i % 2] if i < 11 else None, i % 5) for i in range(12)], "y string, v int")
    got = {(r["y"], r["yhat"]): r["n"] for r in chat.confusion_active(df.select("y", F.udf(guess, "string")("v").alias("yhat"))).collect()}
    assert got == {("a", "a"): 3, ("a", "b"): 1, ("b", "a"): 2, ("b", "b"): 1}
    assert seen.value == 12


def test_permutation_importance_scores_rows_once(spark):
    scored = spark.sparkContext.accumulator(0)

    def score(a, b):
        scored.add(1)
        return Vectors.dense(1 - a, a)

    class Model:
        def transform(self, df):
            return df.withColumn("probability", F.udf(score, VectorUDT())("a", "b"))

    df = spark.range(40).select(F.col("id"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 * 0.5 + F.col("id") / 1000).alias("a"), F.rand(1).alias("b")).cache()
    got = {r["feature"]: r["importance"] for r in models.permutation_importance(Model(), df, ["a", "b"], "y", "id").collect()}
    assert set(got) == {"a", "b"} and got["a"] > 0.1 and got["b"] == 0.0
    assert scored.value == 3 * 40


def test_trees_get_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    assert models._fine(spark.range(0, 950, 1, 1).toDF("x")).rdd.getNumPartitions() == 10
    assert models._fine(spark.range(0, 950, 1, 12).toDF("x")).rdd.getNumPartitions() == 12


def test_running_stats_leaves_lines_in_place(spark, tmp_path):
    """The groups' few rows are sent to the lines; the lines are neither broadcast nor dealt by their few flags."""
    from plumbline.plans import registry

    registry.load_all()
    day = F.expr("timestamp'1995-01-01' + make_interval(0, 0, 0, cast(id % 700 as int))")
    lines = spark.range(4000).select(F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
                                     (F.col("id") * 37 % 2003).cast("double").alias("l_extendedprice"), day.alias("l_shipdate"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = registry.QUERIES["running_stats"](spark, str(tmp_path))
    assert "strategy=broadcast" in got._jdf.queryExecution().optimizedPlan().toString()
    rows = {r["l_returnflag"]: r for r in got.collect()}
    assert {k: r["n"] for k, r in rows.items()} == {"A": 1334, "N": 1333, "R": 1333}
    assert all(r["distinct_within"] and r["quartiles_within"] and r["parts_agree"] for r in rows.values())


def test_search_computes_rows_once(spark):
    """The table behind a search is computed once; a score is the mean of the areas that Spark's evaluator finds in one task."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    seen = spark.sparkContext.accumulator(0)

    def shifted(v):
        seen.add(1)
        return float(v)

    rng = np.random.default_rng(4)
    n = 7000
    y = rng.integers(0, 2, n)
    data = [(int(a), float(b), float(c), i % 2) for i, (a, b, c) in enumerate(zip(y, rng.normal(size=n) + 0.8 * y, rng.normal(size=n)))]
    base = spark.createDataFrame([*data, (0, None, 0.0, 1)], "y int, a double, b double, fold int").repartition(3).cache()
    df = base.select("y", "a", F.udf(shifted, "double")("b").alias("b"), "fold")
    got = models.grid_search(df, ["a", "b"], "y", "fold", 2, [0.01, 0.5], [0.0]).collect()
    assert seen.value == n + 1
    for r, reg in zip(got, [0.01, 0.5]):
        areas = []
        for i in range(2):
            fitted = models.logistic(["a", "b"], "y", maxIter=20, regParam=reg, elasticNetParam=0.0).fit(base.where(F.col("fold") != i))
            areas.append(BinaryClassificationEvaluator(labelCol="y").evaluate(fitted.transform(base.where(F.col("fold") == i).coalesce(1))))
        assert r["score"] == pytest.approx(np.mean(areas), abs=1e-9)
    assert [r["best"] for r in got] == [r["score"] == max(x["score"] for x in got) for r in got]


def test_random_search_on_odd_folds(spark):
    """Folds of one class have the areas Spark's evaluator gives them; folds out of range and empty folds are refused."""
    data = [(i % 2, float(i % 7 + 2 * (i % 2)), i % 3) for i in range(60)]
    one = spark.createDataFrame([*[r for r in data if r[2]], *[(1, 3.0, 0), (1, 4.0, 0)]], "y int, a double, fold int")
    none = spark.createDataFrame([*[r for r in data if r[2]], *[(0, 3.0, 0), (0, 4.0, 0)]], "y int, a double, fold int")
    high, low = (models.random_search(d, ["a"], "y", "fold", 3, 1).first()["score"] for d in (one, none))
    assert high - low == pytest.approx(1 / 3, abs=0.02)
    whole = spark.createDataFrame(data, "y int, a double, fold int")
    for bad in (whole.where("fold < 2"), whole.withColumn("fold", F.when(F.col("fold") > 0, F.col("fold")))):
        with pytest.raises(Exception, match="empty|Fold number"):
            models.random_search(bad, ["a"], "y", "fold", 3, 1)


def test_search_scores_a_fold_once(spark, monkeypatch):
    """A held row is written once with the scores of all candidates, not once for each of them."""
    kept = []
    monkeypatch.setattr(models, "remove_folder", lambda session, path: kept.append(session.read.parquet(path).count()))
    df = spark.createDataFrame([(i % 2, float(i % 7 + 2 * (i % 2)), i % 3) for i in range(90)], "y int, a double, fold int")
    got = models.random_search(df, ["a"], "y", "fold", 3, 5).collect()
    assert kept == [90] and [r["candidate"] for r in got] == list(range(5))


def test_areas_of_a_search_deal_arrays(spark):
    """Scores travel as arrays, a row for each fold, candidate and range; areas do not depend on the ranges and are those of the thresholds taken one by one."""
    rng = np.random.default_rng(6)
    n, wanted, rows = 1500, {}, []
    for fold in range(3):
        y = rng.integers(0, 2, n) if fold else np.ones(n, int)
        high = rng.normal(size=n) + y
        high[:400] = 0.25
        for candidate, s in enumerate((high, few := np.where(np.arange(n) < 9, -0.0, np.round(2 * high)))):
            ends = np.unique(s)[::-1]
            step = max(len(ends) // 50, 1)
            ends = [v for i, v in enumerate(ends, 1) if i % step == 0 or i == len(ends)]
            t, x = ([0.0, *[m[s >= v].sum() / max(m.sum(), 1) for v in ends], 1.0] for m in (y, 1 - y))
            wanted[fold, candidate] = np.trapezoid(t, x)
        rows += [(fold, int(a), [float(b), float(c)]) for a, b, c in zip(y, high, few)]
    df = spark.createDataFrame(rows, "fold int, y int, scores array<double>").repartition(5).cache()
    for per in (2_000_000, 900, 70):
        got = {(r["fold"], r["candidate"]): r["area"] for r in models._binned_areas(df, 50, per)}
        assert got == pytest.approx(wanted, abs=1e-9)
        assert models._score_curves(df, per).count() <= 6 * -(-len(rows) // per)
    assert models._binned_areas(df.where("false")) == []


def test_several_classes_are_boosted_to_the_end(spark, tmp_path):
    """Classes in many small steps of two columns: a few shallow rounds miss most of them."""
    from plumbline.plans import registry

    registry.load_all()
    step = F.floor(F.col("id") % 50 / 4) + F.col("id") % 7
    lines = spark.range(2800).select((F.col("id") % 50).cast("double").alias("l_quantity"), F.when(F.col("id") % 100 > 0, 0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
                                     (F.col("id") % 7).cast("int").alias("l_linenumber"), F.lit(100.0).alias("l_extendedprice"), F.substring(F.lit("ANR"), (step % 3 + 1).cast("int"), F.lit(1)).alias("l_returnflag"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r["flag"], r["prediction"]): r["n"] for r in registry.QUERIES["fit_boosted_multiclass"](spark, str(tmp_path)).collect()}
    assert sum(got.values()) == 2800 - 28  # without a discount a row has no prediction
    assert sum(n for (flag, guess), n in got.items() if flag == guess) > 0.97 * 2772


def test_boosted_classes_do_not_depend_on_parts(spark, monkeypatch):
    """Sums of the executors' parts grow the same trees as arrays in the driver, and copies of rows are weights."""
    rng = np.random.default_rng(8)
    x, z = rng.normal(0, 1, 600), rng.integers(0, 9, 600)
    rows = [(float(a), int(b), int(a > 0) + int(b > 4)) for a, b in zip(x, z)]
    odd = [(None, 1, 0), (float("nan"), 1, 0), (0.1, 1, None)]
    df = spark.createDataFrame([*rows, *rows[:50], *odd], "x double, z int, y int").repartition(5).cache()
    one = models.fit_boosted_multiclass(df, ["x", "z"], "y", rounds=4, depth=3, rate=0.5)
    monkeypatch.setattr(models, "ROWS_IN_DRIVER", 0)
    other = models.fit_boosted_multiclass(df, ["x", "z"], "y", rounds=4, depth=3, rate=0.5, keep_every=2)
    assert len(one.rounds) == len(other.rounds) == 4 and one.classes == [0, 1, 2] and len(one.cuts[1]) == 8
    for a, b in zip(one.rounds, other.rounds):
        assert (a[0] == b[0]).all() and (a[1] == b[1])[a[0] >= 0].all() and a[2] == pytest.approx(b[2])
    got = one.transform(df).toPandas()
    assert len(got) == 651 and (got.y == got.prediction).mean() > 0.95 and all(abs(sum(p) - 1) < 1e-9 for p in got.probability)
