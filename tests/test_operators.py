"""Hand-computed cases: ties, missing values, empty classes, constants, boundaries."""

import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.functions.core import rnd, safe_corr, sample_skew
from plumbline.operators import audit, bayes, binary, chat, clustering, inject, multiclass, multilabel, prep, profile, regression, relational
from plumbline.sources import readers
from plumbline.streaming import events


def one(df):
    return df.first().asDict()


def test_moments(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, None), (4.0, 5.0, 8.0)], "a double, c double, b double")
    r = df.agg(safe_corr(F.col("a"), F.col("c")).alias("k"), safe_corr(F.col("a"), F.col("b")).alias("ab"), sample_skew(F.col("a")).alias("s")).first()
    assert r["k"] is None and r["ab"] == pytest.approx(1.0) and r["s"] == pytest.approx(0.93522, abs=1e-4)
    assert str(df.select(rnd(F.lit(-1e-9))).first()[0]) == "0.0"


def test_profile_corner_cases(spark):
    df = spark.createDataFrame([(1, None, True, "x", float("nan"), 1.0), (2, None, True, "x", 1.0, 1.0), (2, None, True, "x", 1.0, 1.0), (3, None, False, None, 2.0, 1.0)],
                               "a int, n double, flag boolean, s string, f double, k double")
    miss = {r["column"]: r["n_missing"] for r in profile.profile_missing(df).collect()}
    assert miss == {"a": 0, "n": 4, "flag": 0, "s": 1, "f": 1, "k": 0}
    assert one(profile.dup_rows(df)) == {"duplicate_rows": 1}
    assert {r["feature"]: r["top_value_freq"] for r in profile.find_near_constant(df).collect()} == {"s": 1.0, "k": 1.0}
    assert one(profile.infer_target_type(df, "flag"))["target_type"] == "binary"
    corr = {(r["col_a"], r["col_b"]): r["pearson"] for r in profile.corr_matrix(df).collect()}
    assert corr[("a", "k")] is None and corr[("a", "n")] is None and corr[("a", "f")] == pytest.approx(1.0)
    hist = profile.profile_histogram(df, ["k"], 4).orderBy("bin").collect()
    assert [r["n"] for r in hist] == [0, 0, 4, 0]


def test_correlations_match_numpy_with_gaps(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, (300, 3))
    x[:, 1] += x[:, 0]
    x[rng.random((300, 3)) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double").repartition(4)
    for r in profile.corr_matrix(df).collect():
        i, j = "abc".index(r["col_a"]), "abc".index(r["col_b"])
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r["pearson"] == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], abs=1e-6)


def test_planted_issues_are_found_and_a_clean_table_is_clean(spark):
    base = spark.range(4000).select("id", (F.rand(5) < 0.2).cast("int").alias("y"), F.randn(6).alias("x"))
    found = {(r["issue"], r["feature"]) for r in profile.eda_findings(inject.inject_issues(base, ["id"], "y", "x", 300), "y").collect()}
    for r in inject.planted_issues(spark, "x").collect():
        assert (r["issue"], r["feature"]) in found
    assert profile.eda_findings(spark.range(10).select(F.lit("a").alias("s"), F.lit(1).alias("y")), "y").select("feature").distinct().count() == 2
    assert profile.eda_findings(spark.range(2000).select((F.rand(1) < 0.5).cast("int").alias("y"), F.rand(2).alias("u")), "y").count() == 0


SCORES = [(1, 1, 0.9), (2, 0, 0.5), (3, 1, 0.5), (4, 0, 0.29), (5, 1, 0.0), (6, 0, 1.0)]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, "row_id long, y int, score double")


def test_threshold_is_inclusive(scores):
    sweep = {round(r["threshold"], 2): (r["tp"], r["fp"], r["tn"], r["fn"]) for r in binary.threshold_sweep(scores).collect()}
    assert len(sweep) == 99
    for t in (0.01, 0.29, 0.3, 0.5, 0.51, 0.99):
        exact = min(binary.THRESHOLDS, key=lambda x: abs(x - t))
        want = (sum(y and s >= exact for _, y, s in SCORES), sum((not y) and s >= exact for _, y, s in SCORES),
                sum((not y) and s < exact for _, y, s in SCORES), sum(y and s < exact for _, y, s in SCORES))
        assert sweep[t] == want


def test_areas_with_ties_and_buckets(scores, spark):
    pos = [s for _, y, s in SCORES if y]
    neg = [s for _, y, s in SCORES if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 9
    for per in (None, 2):
        r = one(binary.curve_areas(scores, rows_per_bucket=per))
        assert r["roc_auc"] == pytest.approx(auc, abs=1e-6)
        assert r["average_precision"] == pytest.approx(0 + 1 / 3 * 1 / 2 + 1 / 3 * 2 / 4 + 1 / 3 * 3 / 6, abs=1e-6)
    flipped = one(binary.roc_auc(scores.withColumn("score", -F.col("score"))))["roc_auc"]
    assert flipped == pytest.approx(1 - auc, abs=1e-6)
    single = one(binary.curve_areas(scores.where("y = 1")))
    assert single["roc_auc"] is None and single["average_precision"] == 1.0
    assert math.isfinite(one(binary.log_loss(scores))["log_loss"])


def test_multiclass_ties_and_unseen_classes(spark):
    df = spark.createDataFrame([(1, 0, 0, [0.4, 0.4, 0.2]), (2, 1, 0, [0.4, 0.4, 0.2]), (3, 1, 2, [0.1, 0.3, 0.6])], "row_id long, y int, yhat int, probs array<double>")
    assert one(multiclass.top_k_accuracy(df, 1))["top_k_accuracy"] == pytest.approx(1 / 3, abs=1e-6)
    per = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in multiclass.per_class_prf(df).collect()}
    assert per == {0: (0.5, 1.0, 1), 1: (0.0, 0.0, 2), 2: (0.0, 0.0, 0)}
    assert one(multiclass.f1_averages(df))["f1_macro"] == pytest.approx((2 / 3) / 3, abs=1e-6)
    assert multiclass.confusion_matrix(df).agg(F.sum("n")).first()[0] == 3


def test_multilabel_rows_without_labels(spark):
    df = spark.createDataFrame([(1, "a", 0, 0), (1, "b", 0, 0), (2, "a", 1, 1), (2, "b", 0, 1)], "row_id long, label string, y int, yhat int")
    assert one(multilabel.hamming_loss(df))["hamming_loss"] == 0.25
    assert one(multilabel.subset_accuracy(df))["subset_accuracy"] == 0.5
    r = one(multilabel.ml_f1_averages(df))
    assert (r["f1_macro"], r["f1_samples"]) == (0.5, pytest.approx(1 / 3, abs=1e-6))
    wide = spark.createDataFrame([(0, 1), (0, 0)], "a int, b int")
    assert {(r["label_i"], r["label_j"]): r["p_j_given_i"] for r in multilabel.label_cooccurrence(wide, ["a", "b"]).collect()}[("a", "b")] == 0.0


def test_conformal_bounds(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 2.0), (2, 5.0, 3.0, 2.0, 4.0)], "row_id long, y double, yhat double, lo double, hi double")
    assert one(regression.interval_coverage(df, 0.0, 0.9))["coverage_raw"] == 0.5
    assert regression.conformal_q(df.where("row_id = 2"), 0.9) == 1.0
    assert regression.conformal_q(df, 0.9) == 1.0


def answer(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize("value,want", [
    ("VERDICT: YES", "YES"), ("verdict: no\nx", "NO"), ("VERDICT: YES\nVERDICT: NO", "NO"), ("VERDICT: NO\nVERDICT: MAYBE", "NO"),
    ("so VERDICT: YES", "UNKNOWN"), ("VERDICT:\nYES", "UNKNOWN"), ("", "UNKNOWN"), (None, None)])
def test_parse_verdict(spark, value, want):
    assert answer(spark, value, text.parse_verdict) == want


@pytest.mark.parametrize("value,want", [("<think>a\nb</think> en ", "en"), ("<think>x</think>", "<think>x</think>"), ("plain", "plain"),
                                        ("<think>a</think>b<think>c</think>", "b"), ("  ", "  "), (None, None)])
def test_strip_thinking(spark, value, want):
    assert answer(spark, value, text.strip_thinking) == want


def test_json_answers(spark):
    df = spark.createDataFrame([('{"fire": "2", "crash": 2, "component": "BRAKES ", "make": null, "year": 2010}',), ("{}",), ('x {"fire": ""}',)], "a string")
    got = [tuple(r)[1:] for r in text.parse_json_prediction(df, "a", ["brakes"]).collect()]
    assert got == [(False, True, "brakes", None, "2010"), (None,) * 5, (False, None, None, None, None)]


def test_longest_prefix_both_forms(spark):
    df = spark.createDataFrame([("  engine and engine cooling",), ("ENGINE",), ("ENGIN",), (None,)], "t string")
    table = {"ENGINE": "e", "ENGINE AND": "c"}
    want = ["c", "e", "other", "other"]
    assert [r["mapped"] for r in relational.lookup_longest_prefix(df, "t", table).collect()] == want
    keys = spark.createDataFrame(list(table.items()), "key string, value string")
    got = {r["t"]: r["mapped"] for r in relational.lookup_longest_prefix_table(df, "t", keys).collect()}
    assert [got[r["t"]] for r in df.collect()] == want


def test_lenient_tsv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("1\ta\t2.5\n2\tb\n3\tc\tx\n4\t\t\n")
    good, bad = readers.scan_tsv_lenient(spark, str(tmp_path / "a.tsv"), {"id": (0, "bigint"), "name": (1, "string"), "v": (2, "double")}, 3)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a", 2.5), (4, None, None)]
    assert sorted(r["reason"] for r in bad.collect()) == ["field count", "field type"]


def test_routing_order_and_repeats(spark):
    rows = ['{"type":"other"}', '{"type":"checkout.session.completed","data":{"object":{"id":"a","metadata":{"platform":"x"}}}}',
            '{"type":"checkout.session.completed","data":{"object":{"id":"b","metadata":{"platform":"shop","bundle":"k"}}}}',
            *['{"type":"checkout.session.completed","created":"2024-01-01T00:00:00Z","data":{"object":{"id":"c","amount_total":500,"customer_details":{"email":"e"},"metadata":{"platform":"shop","bundle":"k"}}}}'] * 2, "junk"]
    routed = events.route_events(events.parse_events(spark.createDataFrame([(r,) for r in rows], "value string")), "shop")
    assert sorted(r["route"] for r in routed.collect()) == ["deliver", "deliver", "foreign", "ignored", "ignored", "invalid"]
    money = one(events.receipt_revenue(events.dedupe_receipts(events.receipts(routed))))
    assert money == {"bundle": "k", "n": 1, "gross_cents": 500, "fee_cents": 45, "net_cents": 455}


def test_cluster_scores(spark):
    df = spark.createDataFrame([(0, 5), (0, 5), (1, 7), (1, 7)], "a int, b int")
    assert one(clustering.adjusted_rand(df, "a", "b"))["ari"] == 1.0
    assert one(clustering.adjusted_rand(df.withColumn("b", F.lit(1)), "a", "b"))["ari"] == 0.0
    assert one(clustering.nmi(df, "a", "b"))["nmi"] == 1.0


def test_davies_bouldin(spark):
    """Spreads 1, 1 and 0 around centres (0, 0), (10, 0) and (0, 4); a row without a cluster takes no part."""
    rows = [(1, [-1.0, 0.0]), (1, [1.0, 0.0]), (2, [9.0, 0.0]), (2, [11.0, 0.0]), (3, [0.0, 4.0]), (None, [50.0, 50.0])]
    df = spark.createDataFrame(rows, "c int, v array<double>")
    assert one(clustering.davies_bouldin(df, "v", "c"))["davies_bouldin"] == pytest.approx((0.25 + 0.2 + 0.25) / 3, abs=1e-6)
    assert one(clustering.davies_bouldin(df.where("c = 1"), "v", "c"))["davies_bouldin"] == 0.0
    gaps = spark.createDataFrame([(1, [0.0, None]), (1, [2.0, 3.0]), (2, [1.0, 13.0]), (2, None)], "c int, v array<float>")
    assert one(clustering.davies_bouldin(gaps, "v", "c"))["davies_bouldin"] == pytest.approx(0.1)


def test_dbscan_long_chain_takes_few_rounds(spark, monkeypatch):
    """Ids in random order along two chains of 300 cells: rounds follow the logarithm of the length, and their plans stay small."""
    import random
    ids = list(range(600))
    random.Random(3).shuffle(ids)
    df = spark.createDataFrame([(ids[i], 0.5 * (i % 300), 9.0 * (i // 300)) for i in range(600)], "id long, x double, y double")
    rounds, drop = [], clustering.remove_folder
    monkeypatch.setattr(clustering, "remove_folder", lambda spark, path: (rounds.append(path), drop(spark, path)))
    got = {r["id"]: r["cluster"] for r in clustering.dbscan(df, "id", ["x", "y"], 0.6, 2).collect()}
    assert got == {i: min(half) for half in (ids[:300], ids[300:]) for i in half}
    assert 1 < len(rounds) <= 16


def test_dbscan_against_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(0, 0.3, (60, 2)), rng.normal(4, 0.3, (60, 2)), rng.uniform(-3, 7, (25, 2)), np.zeros((30, 2))])
    eps, k = 0.5, 6
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, x double, y double")
    got = {r["id"]: r["cluster"] for r in clustering.dbscan(df, "id", ["x", "y"], eps, k).collect()}
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= k
    label = np.where(core, np.arange(len(pts)), -1)
    changed = True
    while changed:
        new = label.copy()
        for i in np.flatnonzero(core):
            new[i] = label[near[i] & core].min()
        changed, label = bool((new != label).any()), new
    for i in range(len(pts)):
        if not core[i] and (near[i] & core).any():
            label[i] = label[near[i] & core].min()
    assert [got[i] for i in range(len(pts))] == label.tolist()


def test_isolation_forest_finds_planted_rows(spark):
    # planted rows are scattered far around the crowd
    far, angle = F.when(F.col("id") < 30, 8 + F.col("id") % 7).otherwise(0), F.col("id") * 2.4
    df = spark.range(1530).select("id", (F.randn(1) + far * F.cos(angle)).alias("x"), (F.randn(2) + far * F.sin(angle)).alias("y"))
    out = clustering.isolation_forest(df, "id", ["x", "y"], trees=50, contamination=0.02).withColumn("truth", F.col("id") < 30)
    r = one(clustering.anomaly_precision_recall(out, "anomaly", "truth"))
    assert r["precision"] >= 0.9 and r["recall"] >= 0.9


def test_label_noise_is_recovered(spark):
    base = spark.range(3000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("t"), F.element_at(F.array(*[F.lit(c) for c in "abcd"]), (F.col("id") % 4 + 1).cast("int")).alias("l"))
    d = inject.inject_label_noise(base, "id", "t", "l", list("abcd"), ("a", "b"), {"random_flip": 0.05, "structural_null": 0.01, "structural_dup": 0.01, "structural_enum": 0.01})
    assert d.count() == 3000 and d.where("corruption = 'random_flip' and untrustworthy_label = label_true").count() == 0
    report = {r["check"]: r["n"] for r in audit.provenance_report(d, list("abcd")).collect()}
    truth = {r["corruption"]: r["count"] for r in d.groupBy("corruption").count().collect()}
    assert report["null or empty data"] == truth["structural_null"] and report["labels outside the set"] == truth["structural_enum"]
    p = F.array(*[F.when(F.col("label_true") == c, 0.85).otherwise(0.05) for c in "abcd"])
    flagged = audit.find_label_issues(audit.label_index(d, list("abcd")).withColumn("probs", p), 4)
    r = one(flagged.agg(F.expr("count_if(flagged and corruption = 'random_flip')").alias("hit"), F.expr("count_if(corruption = 'random_flip')").alias("all")))
    assert r["hit"] >= 0.9 * r["all"]


def test_hdi_holds_the_truth(spark):
    df = spark.range(40_000).select((F.col("id") % 200).alias("g"), (F.rand(4) < 0.3).alias("hit"))
    r = one(bayes.hdi_interval(df, ["g"], F.col("hit")).agg(F.avg(F.expr("0.3 between hdi_low and hdi_high").cast("int")).alias("share")))
    assert 0.88 <= r["share"] <= 0.99


def test_splits(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("c"))
    for per in (None, 50):
        n = {(r["c"], r["split"]): r["count"] for r in prep.split_stratified(df, "id", "c", 0.2, per).groupBy("c", "split").count().collect()}
        assert n == {("rare", "test"): 20, ("rare", "train"): 80, ("common", "test"): 180, ("common", "train"): 720}
    folds = {(r["c"], r["fold"]): r["count"] for r in prep.fold_assign(df, "id", 5, "c").groupBy("c", "fold").count().collect()}
    assert set(folds.values()) == {20, 180}


def test_long_conversations_continue_in_chunks(spark):
    df = spark.range(25).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = chat.conversations_to_turns(df, max_turns=10).orderBy("chunk").collect()
    assert [r["n_turns"] for r in got] == [10, 10, 5] and got[1]["messages"][0]["content"] == "10"


def test_crowded_lanes_are_dealt_to_many_tasks(spark, monkeypatch):
    """Wide neighbourhoods leave a few lanes: each is dealt in parts, and no pair is lost or met twice."""
    import numpy as np
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (150, 3)), np.zeros((6, 3)), rng.normal(9, 0.2, (20, 3))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, x double, y double, z double")
    monkeypatch.setattr(clustering, "CROWD", 10)
    counts = clustering.neighbour_counts(df, "id", ["x", "y", "z"], 1.5)
    assert "__part" in counts._jdf.queryExecution().optimizedPlan().toString()
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= 1.5 * 1.5
    first = [i for i in range(len(x)) if not 150 < i < 156]
    assert {r["pid"]: r["n_within"] for r in counts.collect()} == {i: int(near[i].sum()) for i in first}
    got = {r["id"]: r["cluster"] for r in clustering.dbscan(df, "id", ["x", "y", "z"], 0.9, 5).collect()}
    monkeypatch.setattr(clustering, "CROWD", 10**6)
    assert got == {r["id"]: r["cluster"] for r in clustering.dbscan(df, "id", ["x", "y", "z"], 0.9, 5).collect()}
