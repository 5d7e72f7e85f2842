"""State kept between micro-batches, isotonic blocks, density clusters in many columns, neighbour information, quantile boosting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import binary
from plumbline.streaming import events as ev

LINE = '{{"type": "checkout.session.completed", "created": "2024-01-01T{h:02d}:00:00Z", "data": {{"object": {{"id": {s}, "amount_total": 5, "customer_details": {{"email": "e"}}, "metadata": {{"platform": "shop", "bundle": "b"}}}}}}}}'


def test_stream_state_outlives_a_restart(spark, tmp_path):
    """A second run from the same checkpoint reads new input only, and knows the sessions of the first."""
    at = {n: str(tmp_path / n) for n in ("in", "out", "ck")}

    def feed(sessions):
        rows = [(LINE.format(s="null" if s is None else f'"s{s}"', h=k % 24),) for k, s in enumerate(sessions)]
        spark.createDataFrame(rows, "value string").repartition(3).write.mode("append").text(at["in"])
        return ev.run_deduped(ev.receipts(ev.route_events(ev.read_event_stream(spark, at["in"], 1), "shop")), at["out"], at["ck"])

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    feed([*range(30), *range(10), None, None])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    first = sorted(str(r["session_id"]) for r in spark.read.parquet(at["out"]).collect())
    assert first == sorted([*(f"s{i}" for i in range(30)), "None"])
    progress = feed([*range(20, 40), None])
    assert sum(p["numInputRows"] for p in progress) == 21
    got = [str(r["session_id"]) for r in spark.read.parquet(at["out"]).collect()]
    assert sorted(got) == sorted([*(f"s{i}" for i in range(40)), "None"])


def brute_isotonic(x, y):
    """Distinct scores with the fit by its max-min formula."""
    xs = np.unique(x)
    s, n = np.array([y[x == v].sum() for v in xs]), np.array([(x == v).sum() for v in xs])
    cs, cn = np.append(0, np.cumsum(s)), np.append(0, np.cumsum(n))
    mean = lambda a, b: (cs[b + 1] - cs[a]) / (cn[b + 1] - cn[a])
    k = range(len(xs))
    return xs, np.array([max(min(mean(a, b) for b in k if b >= i) for a in k if a <= i) for i in k])


@pytest.mark.parametrize("rows", [None, 20])
def test_isotonic_equals_brute_force(spark, rows):
    r = random.Random(5)
    data = [(i, float(r.random() < 0.2 + 0.6 * s), s) for i in range(300) for s in [round(r.random(), 2) if r.random() < 0.7 else 0.5]]
    schema = "row_id long, y double, score double"
    train = spark.createDataFrame([*data, (-1, None, 0.1), (-2, 1.0, None), (-3, 1.0, float("nan"))], schema)
    asked = [(i, 0.0, s) for i, s in enumerate([-1.0, 0.0, 0.123, 0.5, 0.505, 0.999, 2.0, 0.5, None, float("nan"), float("inf")])]
    got = {i["row_id"]: i["calibrated"] for i in binary.recalibrate_isotonic(train, spark.createDataFrame(asked, schema), rows).collect()}
    xs, v = brute_isotonic(np.array([s for *_, s in data]), np.array([y for _, y, _ in data]))
    for i, _, s in asked:
        want = None if s is None or math.isnan(s) else float(np.interp(s, xs, v))
        assert got[i] == want or got[i] == pytest.approx(want), s
    blocks = sorted(tuple(b) for b in binary.isotonic_blocks(train, rows).collect())
    means = [t / w for *_, t, w in blocks]
    assert means == sorted(set(means)) and sum(w for *_, w in blocks) == 300
    none = binary.recalibrate_isotonic(train.limit(0), spark.createDataFrame(asked, schema))
    assert none.count() == len(asked) and none.where("calibrated is not null").count() == 0


def test_density_clusters_in_eight_columns(spark, monkeypatch):
    """Blobs, bridges, copies and noise in eight standardised columns against all pairs."""
    from plumbline.operators import clustering, prep

    rng = np.random.default_rng(4)
    x = np.concatenate([*(rng.normal(c, 0.3, (60, 8)) for c in rng.normal(0, 2, (5, 8))), rng.normal(0, 3, (60, 8))])
    x = np.concatenate([x, np.repeat(x[:3], 12, axis=0)])
    names = [f"x{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in names))
    std = prep.standardize(df, names).checkpoint()
    odd = std.limit(1).withColumns({"id": F.lit(9999).cast("long"), "x3": F.lit(None).cast("double")})
    eps, enough = 0.9, 5
    got = {r["id"]: r["cluster"] for r in clustering.dbscan(std.unionByName(odd), "id", names, eps, enough).collect()}
    pts = {r["id"]: np.array([r[c] for c in names]) for r in std.collect()}
    z = np.array([pts[i] for i in range(len(x))])
    near = ((z[:, None] - z[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= enough
    label = np.where(core, np.arange(len(x)), len(x))
    for _ in range(len(x)):
        label = np.where(core, np.where(near & core[None], label[None], len(x)).min(axis=1), len(x))
    edge = np.where(near & core[None], label[None], len(x)).min(axis=1)
    want = np.where(edge < len(x), edge, -1)
    assert len(set(want)) > 4 and (want == -1).sum() > 10
    assert got == {**{i: int(c) for i, c in enumerate(want)}, 9999: -1}
    monkeypatch.setattr(clustering, "_axes", lambda *_: [0, 3, 5])  # whatever columns deal the cells
    assert got == {r["id"]: r["cluster"] for r in clustering.dbscan(std.unionByName(odd), "id", names, eps, enough).collect()}


def test_quantile_boosting_follows_the_spread(spark):
    """Noise whose spread grows with x: the band must grow with it and hold its share everywhere."""
    from plumbline.operators import models

    rng = np.random.default_rng(6)
    x, z = rng.uniform(0, 4, 6000), rng.uniform(0, 1, 6000)
    y = 2 * x + (0.2 + x) * rng.normal(0, 1, 6000)
    rows = [(float(a), float(b), float(c), i % 3) for i, (a, b, c) in enumerate(zip(x, z, y))]
    df = spark.createDataFrame([*rows, (1.0, 0.5, None, 0), (1.0, 0.5, float("nan"), 0)], "x double, z double, y double, fold int")
    got = models.fit_quantile_bounds(df.where("fold < 2"), df.where("fold = 2"), ["x", "z"], "y", rounds=12, rate=0.4, keep_every=4).toPandas()
    inside = (got.y >= got.lo) & (got.y <= got.hi)
    width = got.hi - got.lo
    assert len(got) == 2000 and (width >= 0).all() and 0.86 < inside.mean() < 0.94
    for low in range(4):
        part = (got.x >= low) & (got.x < low + 1)
        assert 0.8 < inside[part].mean() < 0.98
    assert width[got.x > 3].mean() > 2.5 * width[got.x < 1].mean()


@pytest.mark.parametrize(("chunk", "rows"), [(50_000, None), (7, 40)])
def test_neighbour_information_equals_brute_force(spark, chunk, rows):
    """All distances by numpy, over chunks and ranges of any size; planted signals are ranked before noise."""
    from plumbline.operators import information

    rng = np.random.default_rng(8)
    y = rng.integers(0, 3, 260)
    x = {"linear": y + rng.normal(0, 0.5, 260), "noise": rng.normal(0, 1, 260), "ring": np.where(y == 1, 1, -1) * rng.uniform(0.5, 1, 260) * rng.choice([-1, 1], 260), "steps": np.round(y + rng.normal(0, 1, 260))}
    data = [(*(float(v[i]) for v in x.values()), int(y[i])) for i in range(260)]
    df = spark.createDataFrame([*data, (None, 0.1, 0.2, 1.0, 1), (0.3, None, 0.2, 1.0, 2), (0.0, 0.0, 0.0, 0.0, None), (0.0, 0.0, 0.0, 0.0, 7)], ", ".join(f"{c} double" for c in x) + ", y int")
    got = {r["feature"]: r["mi"] for r in information.neighbour_information(df, "y", chunk=chunk, rows_per_bucket=rows).collect()}
    whole = df.where("y is not null").toPandas()
    harmonic = np.append(0, np.cumsum(1 / np.arange(1, 400)))
    psi = lambda n: harmonic[np.asarray(n) - 1] - 0.5772156649015329
    for c in x:
        v, t = whole[c].fillna(whole[c].median()).to_numpy(), whole["y"].to_numpy()
        size = np.array([(t == k).sum() for k in t])
        v, t, size = v[size > 1], t[size > 1], size[size > 1]
        gap = np.abs(v[:, None] - v[None])
        own = np.where((t[:, None] == t[None]) & ~np.eye(len(v), dtype=bool), gap, np.inf)
        k = np.minimum(3, size - 1)
        r = np.sort(own, axis=1)[np.arange(len(v)), k - 1]
        m = np.where(r == 0, (gap == 0).sum(axis=1), (gap < r[:, None]).sum(axis=1))
        assert got[c] == pytest.approx(max(0, psi(len(v)) + psi(k).mean() - psi(size).mean() - psi(m).mean()), abs=2e-6), c
    assert got["linear"] > 5 * got["noise"] + 0.1
    assert information.neighbour_information(df.where("y is null"), "y").count() == 0


def test_many_k_means_runs_share_their_scans(spark, monkeypatch):
    """As many scans for twelve runs as for the slowest of them alone; planted blobs are found; odd vectors take no part."""
    from plumbline.operators import clustering, lloyd

    rng = np.random.default_rng(9)
    centres = np.array([[0, 0, 0], [5, 5, 0], [0, 5, 5], [5, 0, 5]], float)
    x = np.concatenate([c + rng.normal(0, 0.2, (50, 3)) for c in centres])
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("x", F.lit("clash"))
    scans = []
    whole = lloyd.measured
    monkeypatch.setattr(lloyd, "measured", lambda r, runs: scans.append(len(runs)) or whole(r, runs))
    many = lloyd.lloyd(df, "v", "id", [(k, s) for k in (2, 3, 4) for s in range(4)])
    together, alone = len(scans), []
    for r in [r for r in many if r.start == 0]:
        scans.clear()
        one = lloyd.lloyd(df, "v", "id", [(r.k, 0)])[0]
        alone.append(len(scans))
        assert np.allclose(one.centres, r.centres) and one.inertia == pytest.approx(r.inertia)
    assert max(alone) <= together <= 21
    best = lloyd.best_of([r for r in many if r.k == 4])
    got = {r["id"]: r["cluster"] for r in clustering.kmeans_assign(df, "v", best, ["id"]).collect()}
    assert set(got) == set(range(200)) and len({frozenset(i for i in got if got[i] == c) for c in range(4)} & {frozenset(range(50 * b, 50 * b + 50)) for b in range(4)}) == 4
    assert best.inertia == pytest.approx(sum(((x[50 * b : 50 * b + 50] - x[50 * b : 50 * b + 50].mean(axis=0)) ** 2).sum() for b in range(4)))
    picked = [r["k"] for r in clustering.select_k(df, "v", "id", range(2, 7), starts=6).collect() if r["chosen"]]
    assert picked == [4]
    assert clustering.cluster_stability(df, "v", "id", 1, 3).first()["mean_ari"] == 1.0
    with pytest.raises(ValueError):
        lloyd.lloyd(df.where("id >= 198"), "v", "id", [(4, 0)])


def test_sliding_frames_cost_the_same_at_any_length(spark):
    """A frame of 10,000 rows: each row enters once and leaves once, and user functions without an inverse merge each row a few times."""
    from plumbline.operators import sliding

    class Counting(sliding.RunningMedian):
        calls = 0

        def step(self, value):
            Counting.calls += 1
            super().step(value)

        def inverse(self, value):
            Counting.calls += 1
            super().inverse(value)

    r = random.Random(7)
    values = [None if r.random() < 0.05 else float(r.randint(0, 400)) for _ in range(30_000)]
    frame, merges = Counting(), 0

    def merge(a, b):
        nonlocal merges
        merges += 1
        return max(a, b)

    stacks, last = sliding.TwoStacks(lambda v: -1.0 if v is None else v, merge), 0
    for i, v in enumerate(values):
        frame.step(v), stacks.step(v)
        if i >= 10_000:
            frame.inverse(values[i - 10_000]), stacks.inverse(values[i - 10_000])
        if i % 2500 == 0:
            part = [x for x in values[max(0, i - 9999) : i + 1] if x is not None]
            assert frame.value() == np.median(part) and stacks.value() == max(part)
    assert Counting.calls <= 2 * len(values) and merges <= 3 * len(values)

    rows = [(i % 3 if i % 7 else None, i, values[i]) for i in range(600)]
    df = spark.createDataFrame(rows, "who int, at long, v double")
    for width, chunk in ((1, 10), (5, 7), (50, 60), (50, 1000)):
        got = {x["at"]: x["m"] for x in sliding.sliding(df, ["who"], "at", "at", "v", width, sliding.RunningMedian, "double", "m", chunk).collect()}
        for who in (0, 1, 2, None):
            own = [(a, v) for w, a, v in rows if w == who]
            for i, (a, _) in enumerate(own):
                part = [v for _, v in own[max(0, i - width + 1) : i + 1] if v is not None]
                assert got[a] == (np.median(part) if part else None)
    assert sliding.sliding(df.limit(0), ["who"], "at", "at", "v", 3, sliding.RunningMedian, "double").count() == 0


def test_tfidf_shuffles_terms_only(spark, capsys):
    from plumbline.operators import tfidf

    texts = ["The cat sat", "the cat ran; the dog", None, "", "dog", "the cat sat", "x " * 50, "a dog dog dog the"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf.tfidf_features(df, "id", "text", stop_words=["sat"]).collect()}
    docs = [[w for w in (t or "").lower().replace(";", "").split() if len(w) > 1 and w != "sat"] for t in texts]
    grams = [w + [f"{a} {b}" for a, b in zip(w, w[1:])] for w in docs]
    held = {t: sum(t in g for g in grams) for g in grams for t in g}
    want = {}
    for i, g in enumerate(grams):
        w = {t: g.count(t) * (math.log(9 / (1 + held[t])) + 1) for t in set(g) if held[t] >= 2}
        norm = math.sqrt(sum(v * v for v in w.values()))
        want |= {(i, t): v / norm for t, v in w.items()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    counted = tfidf.term_counts(tfidf.token_rows(df, "id", "text", ()))
    counted.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(term") == 1 and plan.count("Exchange") == 1
    out = tfidf.tfidf_features(df, "id", "text")
    out.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert tfidf.tfidf_features(df.limit(0), "id", "text").count() == 0


def test_stored_sketches_merge_to_the_whole(spark, tmp_path):
    from plumbline.operators import relational

    r = random.Random(2)
    rows = [("a" if i % 2 else None, r.randint(0, 4000) / 4, i % 13) for i in range(40_000)] + [("a", None, 1), ("a", float("nan"), 2)]
    df = spark.createDataFrame(rows, "g string, x double, day int")
    path = str(tmp_path / "parts")
    relational.sketch_parts(df.where("day < 7"), ["g"], "x", F.col("day")).write.parquet(path)
    relational.sketch_parts(df.where("day >= 7"), ["g"], "x", F.col("day")).write.mode("append").parquet(path)
    got = {x["g"]: x for x in relational.merged_stats(spark.read.parquet(path), ["g"]).collect()}
    for g in ("a", None):
        own = sorted(x for h, x, _ in rows if h == g and x is not None and x == x)
        assert got[g]["n"] == len(own) and abs(got[g]["approx_distinct"] / len(set(own)) - 1) < 0.04
        for q, p in zip(got[g]["approx_quantiles"], (0.25, 0.5, 0.75)):
            assert abs(sum(v <= q for v in own) / len(own) - p) < 0.02


def test_neighbour_information_reads_its_input_a_few_times(spark):
    """Rows pass a counter: ranges of positions are dealt once, not again for each rank and total; rare classes reach over many ranges."""
    from plumbline.operators import information

    rng = np.random.default_rng(5)
    x, y = rng.normal(0, 1, 399), np.where(np.arange(399) < 390, rng.integers(0, 2, 399), 2 + np.arange(399) // 3)
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int").mapInArrow(passed, "x double, y int")
    got = {r["feature"]: r["mi"] for r in information.neighbour_information(rows, "y", chunk=11, rows_per_bucket=20).collect()}
    assert seen.value <= 6 * 399
    gap, n = np.abs(x[:, None] - x[None]), np.array([(y == k).sum() for k in y])
    assert n.min() > 1
    own = np.where((y[:, None] == y[None]) & ~np.eye(399, dtype=bool), gap, np.inf)
    k = np.minimum(3, n - 1)
    r = np.sort(own, axis=1)[np.arange(399), k - 1]
    psi = information.digammas
    want = psi(399) + psi(k).mean() - psi(n).mean() - psi((gap < r[:, None]).sum(axis=1)).mean()
    assert got["x"] == pytest.approx(max(0, want), abs=2e-6)


def test_density_clusters_meet_across_chunks(spark, monkeypatch):
    """Many small chunks give the clusters of all pairs; an id that comes twice stays two rows, and rows without an id count but have no cluster."""
    from plumbline.operators import clustering

    rng = np.random.default_rng(12)
    chain = np.stack([np.arange(80) * 0.4, np.sin(np.arange(80)) * 0.1, np.zeros(80)], axis=1)
    x = np.concatenate([chain, chain + [0, 6, 0], *(rng.normal(c, 0.5, (70, 3)) for c in rng.uniform(0, 25, (4, 3))), rng.uniform(-3, 30, (80, 3))])
    x = np.concatenate([x, np.repeat(x[:5], 3, axis=0)])
    ids = rng.permutation(len(x)).tolist()
    eps, enough = 0.9, 4
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in zip(ids, x)], "id long, x double, y double, z double").repartition(7)
    monkeypatch.setattr(clustering, "CHUNK", (16, 40))
    got = {r["id"]: r["cluster"] for r in clustering.dbscan(df, "id", ["x", "y", "z"], eps, enough).collect()}
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= eps * eps
    core, none = near.sum(axis=1) >= enough, len(x)
    label = np.where(core, ids, none)
    for _ in x:
        label = np.where(core, np.where(near & core[None], label[None], none).min(axis=1), none)
    edge = np.where(near & core[None], label[None], none).min(axis=1)
    want = np.where(edge < none, edge, -1)
    assert len(set(want)) > 5 and (want == -1).sum() > 20 and (~core & (want >= 0)).any()
    assert got == dict(zip(ids, want.tolist()))

    rows = [(1, 0.0), (1, 9.0), (2, 0.1), (3, 9.1), (None, 0.2), (None, 5.0), (4, 20.0)]
    got = clustering.dbscan(spark.createDataFrame(rows, "id long, x double"), "id", ["x"], 0.3, 3).collect()
    assert sorted((r["id"] or 0, r["cluster"]) for r in got) == [(0, -1), (0, -1), (1, -1), (1, 1), (2, 1), (3, -1), (4, -1)]


def test_density_clusters_compare_few_pairs(monkeypatch):
    """In a crowd of 20,000 points a few comparisons of each point show that it is core and linked, not one with every other point."""
    from plumbline.operators import clustering

    x, compared, close = np.random.default_rng(3).normal(0, 1, (20_000, 3)), [], clustering._close
    monkeypatch.setattr(clustering, "_close", lambda p, q, eps: (compared.append(len(p) * len(q)), close(p, q, eps))[1])
    counts, i, j = clustering._counted(x, np.zeros(len(x)), x, np.ones(len(x)), 0.5, 4)
    up = clustering._met(x[counts >= 4], np.arange((counts >= 4).sum()), 0.5)
    assert (counts >= 4).mean() > 0.98 and (up == 0).mean() > 0.98
    assert sum(compared) < 0.2 * len(x) ** 2
    few = np.flatnonzero(counts < 4)
    near = ((x[few, None] - x[None]) ** 2).sum(axis=2) <= 0.25
    assert (near.sum(axis=1) == counts[few]).all() and set(zip(i, j)) == {(few[a], b) for a, b in zip(*np.nonzero(near))}
    shifted = x[:400] + 1e6  # rounding of the product decides nothing
    exact = ((shifted[:, None] - shifted[None]) ** 2).sum(axis=2)
    assert (close(shifted, shifted, 0.5) == (exact <= 0.25)).all()
