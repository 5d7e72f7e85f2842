"""NULL, NaN, size and stream cases that the registered queries' tables do not hold."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import chat, clustering, prep, profile, relational
from plumbline.streaming import events as ev


@pytest.mark.parametrize("files", [1, 3, 100])
def test_stream_dedupe_keeps_every_session(spark, tmp_path, files):
    r = random.Random(1)
    rows = [(f"s{i % 40}", f"{(i * 37) % 24:02d}") for i in range(200)]
    r.shuffle(rows)
    line = '{{"type": "checkout.session.completed", "created": "2024-01-{d}T{h}:00:00Z", "data": {{"object": {{"id": "{s}", "amount_total": 5, "customer_details": {{"email": "e"}}, "metadata": {{"platform": "shop", "bundle": "b"}}}}}}}}'
    text = spark.createDataFrame([(line.format(s=s, h=h, d=f"{r.randint(1, 28):02d}"),) for s, h in rows], "value string")
    text.repartition(8).write.text(str(tmp_path / "in"))
    stream = ev.receipts(ev.route_events(ev.read_event_stream(spark, str(tmp_path / "in"), files), "shop"))
    ev.run_deduped(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = [x["session_id"] for x in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == 40 and set(got) == {f"s{i}" for i in range(40)}


def test_rank_keeps_null_groups_and_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 2.0), (None, 2.0)], "g string, v double")
    got = {(r["g"], r["v"]): r["rank"] for r in relational.rank_in_group(df, ["g"], "v").collect()}
    assert relational.rank_in_group(df, ["g"], "v").count() == 4 and got[(None, 2.0)] == 1 and got[("a", 1.0)] == 1


def test_near_constant_with_mostly_null_column(spark):
    df = spark.createDataFrame([(i, 1.0 if i % 10 < 3 else None) for i in range(200)], "id long, x double")
    assert [r["feature"] for r in profile.find_near_constant(df).collect()] == ["x"]


def test_mutual_information_without_values_or_targets(spark):
    rows = [(float(i % 7), None, i % 2 if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    got = {r["feature"]: r["mi"] for r in profile.mutual_information(df, "y").collect()}
    whole = {r["feature"]: r["mi"] for r in profile.mutual_information(df.where("y is not null"), "y").collect()}
    assert set(got) == {"a"} and got == whole


def test_nan_is_missing_in_preparation(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(float("nan"),), (None,)], "x double")
    for out in (prep.winsorize(df, ["x"]), prep.robust_scale(df, ["x"]), prep.transform_log(df, ["x"])):
        got = [r["x"] for r in out.collect()]
        assert sum(v is None for v in got) == 2 and all(v is None or math.isfinite(v) for v in got)


def test_long_conversation_is_one_row(spark):
    df = spark.range(2500).select(F.lit(1).alias("conv_id"), F.when(F.col("id") > 0, F.col("id")).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = chat.conversations_to_turns(df).collect()
    assert len(got) == 1 and [m["content"] for m in got[0]["messages"]] == [str(i) for i in range(2500)]
    assert chat.conversations_to_turns(df, 1000).count() == 3


def test_one_hot_has_no_limit(spark):
    df = spark.createDataFrame([(f"v{i:04d}",) for i in range(1200)] + [(None,)], "c string")
    assert prep.one_hot_sparse(df, "c").where("c is not null").select("c_onehot").first()["c_onehot"].size == 1200
    assert len(prep.one_hot(df.limit(5), "c").columns) == 6


@pytest.mark.parametrize("n", [40_000, 60_000])
def test_isolation_forest_is_alike_on_both_sides_of_its_pool(spark, n):
    far = n // 100
    df = spark.range(n).select("id", F.when(F.col("id") < far, 5 + F.rand(5) * 4).otherwise(F.rand(3)).alias("a"), F.when(F.col("id") < far, 5 + F.rand(6) * 4).otherwise(F.rand(4)).alias("b"))
    got = clustering.isolation_forest(df, "id", ["a", "b"], trees=40).orderBy(F.desc("score")).limit(far).collect()
    assert sum(r["id"] < far for r in got) >= 0.9 * far


def test_full_silhouette(spark):
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(0, 1, (40, 3)), r.normal(4, 1, (30, 3)), [[9.0, 9.0, 9.0]]])
    c = [0] * 40 + [1] * 30 + [2]
    df = spark.createDataFrame([(v.tolist(), k) for v, k in zip(x, c)], "x array<double>, c int")
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    want = []
    for i, k in enumerate(c):
        same = np.array(c) == k
        if same.sum() == 1:
            want.append(0.0)
            continue
        a, b = d[i][same].sum() / (same.sum() - 1), min(d[i][np.array(c) == o].mean() for o in {0, 1, 2} - {k})
        want.append((b - a) / max(a, b))
    assert clustering.silhouette_full(df, "x", "c").first()["silhouette"] == pytest.approx(np.mean(want), abs=1e-5)


def test_nan_becomes_null_at_scan(spark, tmp_path):
    from plumbline.sources import readers

    spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double").write.parquet(str(tmp_path / "t"))
    assert readers.scan_parquet(spark, str(tmp_path / "t"), nan_is_null=True).where("x is null").count() == 2


def test_mutual_information_reads_its_input_a_few_times(spark):
    """Rows pass a counter: the counts of bins and classes are made once, not again for each of their totals."""
    rows = [(float(i % 17), None if i % 5 == 0 else float(i % 7), f"c{i * i % 3}") for i in range(340)]
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "a double, b double, y string")
    got = {r["feature"]: r["mi"] for r in profile.mutual_information(df.mapInArrow(passed, df.schema), "y", bins=4).collect()}
    assert seen.value <= 8 * 340
    before = seen.value
    profile.mutual_information(df.where("b is not null").mapInArrow(passed, df.schema), "y", bins=4).collect()
    assert seen.value - before <= 5 * 272  # without holes no medians are needed
    y = [r[2] for r in rows]
    middle = sorted(r[1] for r in rows if r[1] is not None)
    middle = (middle[len(middle) // 2] + middle[(len(middle) - 1) // 2]) / 2
    for k, name in enumerate("ab"):
        x = np.array([middle if r[k] is None else r[k] for r in rows])
        cell = Counter(zip((x[:, None] > np.quantile(x, [0.25, 0.5, 0.75])).sum(axis=1).tolist(), y))
        bins, classes = Counter(), Counter(y)
        for (b, _), n in cell.items():
            bins[b] += n
        assert got[name] == pytest.approx(sum(n / 340 * math.log(n * 340 / bins[b] / classes[c]) for (b, c), n in cell.items()), abs=2e-6)
