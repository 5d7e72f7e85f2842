"""Clustering: fits with Spark ML, scores from small tables, and two distributed algorithms Spark ML lacks."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from plumbline.functions.core import h32, ratio, rnd
from plumbline.operators.lloyd import Run, best_of, labelled, lloyd, pair_counts, silhouettes
from plumbline.operators.ordering import exact_quantiles
from plumbline.session import ensure_checkpoint_dir, remove_folder, written


def with_vector(df: DataFrame, array_col: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.transform(array_col, lambda x: x.cast("double"))))


def sq_distance(x: Column, centre: Sequence[float]) -> Column:
    """Squared distance of an array column to a literal point."""
    lit = F.array(*[F.lit(float(v)) for v in centre])
    d = F.zip_with(x, lit, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return F.aggregate(d, F.lit(0.0), lambda s, v: s + v)


# --- fits ------------------------------------------------------------------------------------------------------

def kmeans_fit(df: DataFrame, array_col: str, id_col: str, k: int, starts: int = 10, rounds: int = 20) -> Run:
    """The run of least inertia of ``starts`` runs, which share every scan."""
    return best_of(lloyd(df, array_col, id_col, [(k, s) for s in range(starts)], rounds))


def kmeans_assign(df: DataFrame, array_col: str, run: Run, keep: Sequence[str]) -> DataFrame:
    """(keep..., cluster, sq_dist) of each row with a vector."""
    return labelled(df, array_col, keep, [run]).select(*keep, F.get("clusters", F.lit(0)).alias("cluster"), F.get("sq_dists", F.lit(0)).alias("sq_dist"))


def gmm_fit(df: DataFrame, array_col: str, k: int, seed: int = 1):
    from pyspark.ml.clustering import GaussianMixture

    return GaussianMixture(k=k, seed=seed).fit(with_vector(df, array_col).select("features"))


def select_k(df: DataFrame, array_col: str, id_col: str, ks: Sequence[int] = tuple(range(2, 11)), starts: int = 10, rounds: int = 20) -> DataFrame:
    """Silhouette (simplified, squared distances) and inertia per K, of the best of ``starts`` runs by inertia; ``chosen`` marks the first best silhouette.

    All runs of all K move in the same scans, and one more scan scores the best of each K.
    """
    runs = lloyd(df, array_col, id_col, [(k, s) for k in ks for s in range(starts)], rounds)
    best = [best_of([r for r in runs if r.k == k]) for k in ks]
    rows = [(r.k, float(v), r.inertia) for r, v in zip(best, silhouettes(df, array_col, best))]
    chosen = max(rows, key=lambda r: (r[1], -r[0]))[0]
    return df.sparkSession.createDataFrame([(*r, r[0] == chosen) for r in rows], "k int, silhouette double, inertia double, chosen boolean")


def pca_reduce(df: DataFrame, array_col: str, id_col: str, variance: float = 0.9) -> DataFrame:
    """Keep the first components that together explain ``variance``."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    data = with_vector(df, array_col).select(id_col, "features")
    width = len(df.select(array_col).first()[0])
    model = PCA(k=width, inputCol="features", outputCol="__p").fit(data)
    share = np.cumsum(model.explainedVariance.toArray())
    keep = min(int(np.searchsorted(share, variance) + 1), width)
    return model.transform(data).select(id_col, F.slice(vector_to_array("__p"), 1, keep).alias("components"), F.lit(keep).alias("n_components"))


# --- assignment ------------------------------------------------------------------------------------------------

def class_centres(df: DataFrame, array_col: str, by: str) -> dict:
    """Mean vector per group (groups x dimensions numbers on the driver)."""
    long = df.select(by, F.posexplode(array_col).alias("i", "v")).groupBy(by, "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    out: dict = {}
    for r in long.collect():
        out.setdefault(r[by], {})[r["i"]] = r["m"]
    return {k: [v[i] for i in sorted(v)] for k, v in out.items()}


def assign_nearest(df: DataFrame, array_col: str, centres: dict) -> DataFrame:
    """Nearest centre of each row (lowest id on ties) and the squared distance."""
    options = F.array(*[F.struct(sq_distance(F.col(array_col), c).alias("d"), F.lit(k).alias("id")) for k, c in sorted(centres.items())])
    return df.withColumn("__n", F.array_min(options)).withColumns({"cluster": F.col("__n.id"), "sq_dist": F.col("__n.d")}).drop("__n")


def cluster_members(assigned: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """The n rows of each cluster closest to its centre; Spark keeps n rows per cluster and task before the shuffle."""
    w = Window.partitionBy("cluster").orderBy("sq_dist", id_col)
    return assigned.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


# --- scores from the contingency table --------------------------------------------------------------------------

def _pairs2(c: Column) -> Column:
    return c.cast("double") * (c.cast("double") - 1) / 2


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index; 1 when both sides are trivial and equal."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(_pairs2(F.col("n")))).scalar()
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(_pairs2(F.col("n")))).scalar()
    t = cells.agg(F.sum(_pairs2(F.col("n"))).alias("both"), _pairs2(F.sum("n")).alias("total")).withColumns({"ra": rows, "cb": cols})
    expected = ratio(F.col("ra") * F.col("cb"), F.col("total"))
    return t.select(rnd(ratio(F.col("both") - expected, (F.col("ra") + F.col("cb")) / 2 - expected, default=1.0)).alias("ari"))


def nmi(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Homogeneity, completeness, V-measure and normalised mutual information (arithmetic mean) from entropies."""
    cells = df.groupBy(truth, cluster).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").cast("double")).scalar()

    def entropy(part: DataFrame) -> Column:
        p = F.col("n") / F.col("t")
        return part.withColumn("t", total).agg(F.sum(-p * F.ln(p))).scalar()

    h = cells.select(F.lit(1).alias("one")).limit(1).withColumns({
        "hj": entropy(cells), "ht": entropy(cells.groupBy(truth).agg(F.sum("n").alias("n"))),
        "hc": entropy(cells.groupBy(cluster).agg(F.sum("n").alias("n")))})
    mi = F.greatest(F.col("ht") + F.col("hc") - F.col("hj"), F.lit(0.0))
    hom, com = ratio(mi, F.col("ht"), default=1.0), ratio(mi, F.col("hc"), default=1.0)
    return h.select(rnd(hom).alias("homogeneity"), rnd(com).alias("completeness"), rnd(ratio(2 * hom * com, hom + com)).alias("v_measure"),
                    rnd(ratio(mi, (F.col("ht") + F.col("hc")) / 2, default=1.0)).alias("nmi"))


def _cluster_sums(df: DataFrame, array_col: str, cluster: str) -> DataFrame:
    """Per cluster and dimension: count, sum and sum of squares."""
    x = F.col("v").cast("double")
    return df.select(cluster, F.posexplode(array_col).alias("i", "v")).groupBy(cluster, "i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))


def calinski_harabasz(df: DataFrame, array_col: str, cluster: str) -> DataFrame:
    c = _cluster_sums(df, array_col, cluster)
    tot = c.groupBy("i").agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    j = c.join(tot, "i")
    mean, grand = F.col("s") / F.col("n"), F.col("ts") / F.col("tn")
    a = j.agg(F.sum(F.col("n") * (mean - grand) * (mean - grand)).alias("between"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"),
              F.max("tn").alias("n"), F.count_distinct(F.col(cluster)).alias("k"))
    return a.select(rnd(ratio(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1)), 4).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, array_col: str, cluster: str) -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / centre distance; spread is the mean distance to the centre.

    Centres that coincide, and a cluster without others, count as zero.  Rows without a cluster and missing components take no part.
    """

    def gap(a: Column | str, b: Column | str) -> Column:
        met = F.filter(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), lambda z: z.isNotNull())
        return F.when(F.size(met) > 0, F.sqrt(F.aggregate(met, F.lit(0.0), lambda s, z: s + z)))

    rows = df.where(F.col(cluster).isNotNull()).select(F.col(cluster).alias("c"), F.transform(array_col, lambda v: v.cast("double")).alias("x"))
    means = rows.select("c", F.posexplode("x").alias("i", "v")).groupBy("c", "i").agg(F.avg("v").alias("v"))
    centres = means.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda z: z["v"]).alias("m"))
    spread = rows.join(centres, "c").groupBy("c").agg(F.avg(gap("x", "m")).alias("s"))
    a = centres.join(spread, "c")  # one row per cluster
    b = a.select(F.col("c").alias("d"), F.col("m").alias("other"), F.col("s").alias("t"))
    met = a.join(b, F.col("c") != F.col("d"), "left").select("c", F.try_divide(F.col("s") + F.col("t"), gap("m", "other")).alias("r"))
    worst = met.groupBy("c").agg(F.coalesce(F.max("r"), F.lit(0.0)).alias("w"))
    return worst.agg(rnd(F.avg("w")).alias("davies_bouldin"))


def silhouette_full(df: DataFrame, array_col: str, cluster: str) -> DataFrame:
    """Mean silhouette of all rows on squared distances: the moments of each cluster replace the pairs, so cost is rows times clusters."""
    x = F.transform(array_col, lambda v: v.cast("double"))
    rows = df.select(F.col(cluster).alias("c"), x.alias("x"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v).alias("q"))
    sums = rows.select("c", "q", F.posexplode("x").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("s")).groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda z: z["s"]).alias("s"))
    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("sq"))
    each = F.collect_list(F.struct(F.col("c").alias("k"), "n", "s", "sq"))
    table = sums.join(sizes, "c").agg(each.alias("t"))  # one row, clusters x columns numbers
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda p, q: p + q)
    total = lambda k: k["n"] * F.col("q") + k["sq"] - 2 * dot(F.col("x"), k["s"])
    scored = rows.withColumn("__one", F.lit(1)).join(F.broadcast(table.withColumn("__one", F.lit(1))), "__one").select(
        F.aggregate(F.filter("t", lambda k: k["k"] == F.col("c")), F.lit(None).cast("double"), lambda a, k: F.when(k["n"] > 1, total(k) / (k["n"] - 1))).alias("a"),
        F.array_min(F.transform(F.filter("t", lambda k: k["k"] != F.col("c")), lambda k: total(k) / k["n"])).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull() | (F.greatest("a", "b") <= 0), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return scored.agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(value)).alias("silhouette"))


def silhouette_sample(df: DataFrame, array_col: str, cluster: str, id_col: str, n: int) -> DataFrame:
    """Exact pairwise silhouette of a hash sample of ``n`` rows (the sample size is the feature: cost is n squared).

    The sample is collected to the driver as literals of bounded size and compared inside Arrow batches.
    """
    sample = df.orderBy(h32(F.lit("sil"), id_col), id_col).limit(n)
    pts = sample.select(id_col, cluster, F.transform(array_col, lambda v: v.cast("double")).alias("x")).collect()
    xs, labels = np.array([p["x"] for p in pts]), np.array([p[cluster] for p in pts])

    def score(batches):
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy())
            d = np.sqrt(np.maximum(((x[:, None, :] - xs[None, :, :]) ** 2).sum(axis=2), 0.0))
            out = []
            for row, mine in zip(d, pdf["c"].to_numpy()):
                same = labels == mine
                if same.sum() <= 1:
                    out.append(0.0)
                    continue
                a = row[same].sum() / (same.sum() - 1)
                b = min(row[labels == o].mean() for o in set(labels) - {mine}) if len(set(labels)) > 1 else a
                out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
            yield pd.DataFrame({"id": pdf["id"], "s": out})

    src = sample.select(F.col(id_col).alias("id"), F.col(cluster).alias("c"), F.transform(array_col, lambda v: v.cast("double")).alias("x"))
    got = src.mapInPandas(score, f"id {df.schema[id_col].dataType.simpleString()}, s double")
    return got.agg(F.count(F.lit(1)).alias("n_sample"), rnd(F.avg("s")).alias("silhouette"))


def cluster_stability(df: DataFrame, array_col: str, id_col: str, k: int, starts: int = 8, rounds: int = 20) -> DataFrame:
    """Mean ARI between K-means runs with different starts; below 0.7 the clustering is unstable.

    All runs share their scans and label the same rows, so every pair is a count table of k x k cells.
    """
    runs = lloyd(df, array_col, id_col, [(k, s) for s in range(starts)], rounds)
    cells = pair_counts(labelled(df, array_col, [id_col], runs), starts)
    two = lambda c: F.col(c).cast("double") * (F.col(c) - 1) / 2
    both = cells.groupBy("pair").agg(F.sum(two("n")).alias("both"), (F.sum("n").cast("double") * (F.sum("n") - 1) / 2).alias("total"))
    sides = [cells.groupBy("pair", c).agg(F.sum("n").alias("n")).groupBy("pair").agg(F.sum(two("n")).alias(f"s_{c}")) for c in "ab"]
    each = both.join(sides[0], "pair").join(sides[1], "pair")
    expected, most = ratio(F.col("s_a") * F.col("s_b"), F.col("total")), (F.col("s_a") + F.col("s_b")) / 2
    got = each.agg(F.count(F.lit(1)).cast("int").alias("n_pairs"), F.avg(ratio(F.col("both") - expected, most - expected, default=1.0)).alias("mean_ari"))
    return got.select(F.lit(starts).alias("n_runs"), "n_pairs", "mean_ari", (F.col("mean_ari") < 0.7).alias("unstable"))


def anomaly_precision_recall(df: DataFrame, flagged: str, truth: str) -> DataFrame:
    tp, fl, tr = F.count_if(F.col(flagged) & F.col(truth)), F.count_if(F.col(flagged)), F.count_if(F.col(truth))
    return df.agg(tp.alias("tp"), fl.alias("n_flagged"), tr.alias("n_true")).select(
        "tp", "n_flagged", "n_true", rnd(ratio(F.col("tp"), F.col("n_flagged"))).alias("precision"), rnd(ratio(F.col("tp"), F.col("n_true"))).alias("recall"))


# --- density clusters in low dimension ---------------------------------------------------------------------------

def grid_points(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """Distinct positions with their multiplicity and lowest id: copies of a point are handled once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("pid"))


def neighbour_counts(df: DataFrame, id_col: str, cols: Sequence[str], eps: float) -> DataFrame:
    """Rows within ``eps`` of each distinct position, itself and its copies included: ``(pid, *cols, n, n_within)``.

    Meant for sparse data or reports; :func:`dbscan` counts no further than it needs.
    """
    g = [f"__g{i}" for i in range(len(cols))]
    pts = _grid(df, id_col, cols, eps)
    pts = pts.join(pts.groupBy(*g).agg(F.sum("n").alias("cell_n")), g)
    outside = _near(pts, pts, cols, eps, _axes(df, cols, eps)).groupBy("pid").agg(F.sum("q_n").alias("out_n"))
    return pts.join(outside, "pid", "left").withColumn("n_within", F.col("cell_n") + F.coalesce("out_n", F.lit(0)))


def _cell_side(cols: Sequence[str], eps: float) -> float:
    return eps / math.sqrt(len(cols)) * (1 - 1e-9)


def _axes(df: DataFrame, cols: Sequence[str], eps: float) -> list[int]:
    """The columns that deal cells to neighbourhoods: those of the widest spread, as many as make looks and candidates of a point fewest.

    Points within eps differ by at most eps in every column, so any choice finds all of them; the choice is about cost.
    """
    got = df.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    spread = [got[f"s{i}"] or 0.0 for i in range(len(cols))]
    order = sorted(range(len(cols)), key=lambda i: -spread[i])
    met, best, least = float(got["n"]), 1, math.inf
    for k, i in enumerate(order[:8], 1):
        met *= min(1.0, 3 * (eps + _cell_side(cols, eps)) / max(3.5 * spread[i], 1e-300))
        if 3**k + met < least:
            best, least = k, 3**k + met
    return sorted(order[:best])


def _lanes(df: DataFrame, cols: Sequence[str], eps: float, axes: Sequence[int], prefix: str) -> DataFrame:
    """Add the lane ``<prefix>0..`` of each cell: its lower corner along the axes in steps of eps and a cell side, so that neighbours are at most one step apart."""
    side = _cell_side(cols, eps)
    return df.withColumns({f"{prefix}{k}": F.floor(F.col(f"__g{i}") * F.lit(side) / F.lit((eps + side) * (1 + 1e-9))).cast("long") for k, i in enumerate(axes)})


def _steps(axes: Sequence[int]) -> Column:
    from itertools import product

    return F.explode(F.array(*[F.struct(*[F.lit(x).alias(f"o{k}") for k, x in enumerate(move)]) for move in product((-1, 0, 1), repeat=len(axes))]))


CROWD = 4096


def _meet(left: DataFrame, right: DataFrame, lane: Sequence[str], who: str) -> DataFrame:
    """Rows of ``left`` and ``right`` in equal lanes.  Wide neighbourhoods leave a few lanes only: the left rows of a lane with more than ``CROWD`` right rows are dealt
    by a hash of ``who`` to as many parts as make about ``CROWD`` squared pairs of each, and its right rows are copied to all of them."""
    held = right.groupBy(*lane).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    crowded, folder = written(held.select(*lane, F.ceil(F.col("n") * F.col("n") / (CROWD * CROWD)).cast("int").alias("__parts")), "crowded")
    if crowded.isEmpty():
        remove_folder(left.sparkSession, folder)
        return left.join(right, list(lane))
    shares, parts = F.coalesce("__parts", F.lit(1)), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.join(crowded, list(lane), "left").withColumn("__part", F.pmod(F.xxhash64(who), shares).cast("int"))
    right = right.join(crowded, list(lane), "left").withColumn("__part", F.explode(F.sequence(F.lit(0), shares - 1)))
    left, right = (d.drop("__parts").repartition(parts, *lane, "__part") for d in (left, right))
    return left.join(right.hint("shuffle_hash"), [*lane, "__part"]).drop("__part")


def _near(points: DataFrame, others: DataFrame, cols: Sequence[str], eps: float, axes: Sequence[int]) -> DataFrame:
    """Pairs (p, q) of positions in different cells within ``eps``: an equi-join on neighbouring lanes, then the exact distance."""
    g, lane = [f"__g{i}" for i in range(len(cols))], [f"__l{k}" for k in range(len(axes))]
    left = _lanes(points, cols, eps, axes, "__l").select("pid", *[F.col(c).alias(f"p_{c}") for c in cols], *[F.col(x).alias(f"p{x}") for x in g], *lane, _steps(axes).alias("m"))
    left = left.withColumns({x: F.col(x) + F.col(f"m.o{k}") for k, x in enumerate(lane)}).drop("m")
    right = _lanes(others, cols, eps, axes, "__l").select(F.col("pid").alias("qid"), F.col("n").alias("q_n"), *[F.col(c).alias(f"q_{c}") for c in cols], *[F.col(x).alias(f"q{x}") for x in g], *lane)
    gap = sum(((F.col(f"p_{c}") - F.col(f"q_{c}")) * (F.col(f"p_{c}") - F.col(f"q_{c}")) for c in cols), F.lit(0.0))
    apart = functools.reduce(lambda x, y: x | y, [F.col(f"p{x}") != F.col(f"q{x}") for x in g])
    return _meet(left, right, lane, "pid").where(apart & (gap <= eps * eps))


def _grid(df: DataFrame, id_col: str, cols: Sequence[str], eps: float) -> DataFrame:
    side = _cell_side(cols, eps)
    return grid_points(df, id_col, cols).withColumns({f"__g{i}": F.floor(F.col(c) / side).cast("long") for i, c in enumerate(cols)})


# positions of a chunk (a box of the space), of a leaf inside a chunk, chunks at most while these are small, and pairs compared at a time
CHUNK, LEAF, CHUNKS, PAIRS = (4096, 65_536), 256, 16, 1 << 19


def _cut(x: np.ndarray, number: int, first: int = 0) -> list:
    """Boxes of about equal numbers of the rows of ``x`` as nested lists: [column, cut, below, above] or [number of the box]."""
    if number > 1:
        for c in np.argsort(-np.nan_to_num(x.max(axis=0) - x.min(axis=0)), kind="stable"):
            v = np.sort(x[:, c])
            above = v[v > v[0]]
            if len(above):
                cut = max(v[len(v) // 2], above[0])
                low = x[:, c] < cut
                below = _cut(x[low], number // 2, first)
                return [int(c), float(cut), below, _cut(x[~low], number - number // 2, first + number // 2)]
    return [first]


def _box(tree: list, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0], np.int32)
    out = np.empty(len(x), np.int32)
    low = x[:, tree[0]] < tree[1]
    out[low], out[~low] = _box(tree[2], x[low]), _box(tree[3], x[~low])
    return out


def _close(p: np.ndarray, q: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of ``p`` lie within ``eps`` of which rows of ``q``: a product of matrices decides but for pairs so near the edge that its rounding could, whose squares are added column by column."""
    limit = eps * eps
    with np.errstate(all="ignore"):
        pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
        slack = 1e-14 * (p.shape[1] + 4) * (pp.max(initial=0) + qq.max(initial=0) + limit)
        gap = p @ (-2.0 * q.T)
        gap += pp[:, None]
        gap += qq
        near = gap <= limit - slack
        i, j = np.nonzero(~(near | (gap > limit + slack)))
        far = np.zeros(len(i))
        for c in range(p.shape[1]):
            d = p[i, c] - q[j, c]
            far += d * d
        near[i, j] = far <= limit
    return near


def _leaves(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` of ``x`` in groups that lie together, at most LEAF each."""
    out, todo = [], [rows]
    while todo:
        at = todo.pop()
        if len(at) > LEAF:
            with np.errstate(all="ignore"):
                c = np.nan_to_num(np.ptp(x[at], axis=0)).argmax()
            order = np.argpartition(x[at, c], len(at) // 2)
            todo += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]
        elif len(at):
            out.append(at)
    return out


def _ends(x: np.ndarray, groups: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    shape = (len(groups), x.shape[1])
    return tuple(np.array([f(x[at], axis=0) for at in groups]).reshape(shape) for f in (np.min, np.max))


def _reach(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Squared gap between boxes, and whether points of them may lie within ``eps``."""
    with np.errstate(all="ignore"):
        d = np.maximum(np.maximum(lows - high, low - highs), 0.0)
        gap = (d * d).sum(axis=-1)
        return gap, ~(gap > eps * eps * (1 + 1e-9))


def _counted(p: np.ndarray, have: np.ndarray, q: np.ndarray, n: np.ndarray, eps: float, enough: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``have`` and the rows (``n`` of each ``q``) within ``eps`` of each ``p``, exact below ``enough`` where counting stops; and the pairs of those that stay below."""
    counts, groups, pairs = have.astype(float), _leaves(q, np.arange(len(q))), [np.empty((2, 0), np.int64)]
    lows, highs = _ends(q, groups)
    for left in _leaves(p, np.flatnonzero(counts < enough)):
        gap, may = _reach(p[left].min(axis=0), p[left].max(axis=0), lows, highs, eps)
        order = [groups[i] for i in np.argsort(gap, kind="stable") if may[i]]
        while order and len(left):
            some = max(1, PAIRS // (LEAF * len(left)))
            right, order = np.concatenate(order[:some]), order[some:]
            near = _close(p[left], q[right], eps)
            counts[left] += near @ n[right]
            few = counts[left] < enough
            i, j = np.nonzero(near[few])
            left = left[few]
            pairs.append(np.stack([left[i], right[j]]))
    i, j = np.concatenate(pairs, axis=1)
    few = counts[i] < enough
    return counts, i[few], j[few]


def _merge(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the groups ``a`` and ``b`` that meet their lowest number, in ``up``, where every group has its own."""
    while len(a := a[(apart := up[a] != up[b])]):
        b = b[apart]
        np.minimum.at(up, np.maximum(up[a], up[b]), np.minimum(up[a], up[b]))
        while (up != (further := up[up])).any():
            up[:] = further


def _met(x: np.ndarray, group: np.ndarray, eps: float, side: np.ndarray | None = None) -> np.ndarray:
    """The lowest group each group (0, 1, ..) is linked with by points within ``eps``, directly or by others; with ``side`` only points of both sides are compared.

    Points that are in one group already are not compared: a place where nearly all are linked costs little more than its odd points.
    """
    up = np.arange(int(group.max(initial=-1)) + 1)
    left = _leaves(x, np.arange(len(x)) if side is None else np.flatnonzero(~side))
    right = left if side is None else _leaves(x, np.flatnonzero(side))
    lows, highs = _ends(x, right)
    for number, at in enumerate(left):
        may = np.flatnonzero(_reach(x[at].min(axis=0), x[at].max(axis=0), lows, highs, eps)[1])
        others = [right[i] for i in may if side is not None or i >= number]
        if not others:
            continue
        others, mine = np.concatenate(others), up[group[at]]
        names, sizes = np.unique(mine, return_counts=True)
        most = mine == names[sizes.argmax()]
        for some in (at[most], at[~most]):
            step = PAIRS // max(1, len(some))
            for k in range(0, len(others) if len(some) else 0, step):
                block, own = others[k : k + step], up[group[some]]
                if (own == own[0]).all():
                    block = block[up[group[block]] != own[0]]
                near = _close(x[some], x[block], eps)
                while len(block):  # every point with a link to another group takes one: few turns
                    own, their = up[group[some]], up[group[block]]
                    new = near & (own[:, None] != their)
                    i, j = np.flatnonzero(new.any(axis=1)), np.flatnonzero(new.any(axis=0))
                    if not len(i):
                        break
                    _merge(up, np.append(own[i], own[new[:, j].argmax(axis=0)]), np.append(their[new[i].argmax(axis=1)], their[j]))
    return up


def _positions(df: DataFrame, id_col: str, cols: Sequence[str], axes: Sequence[str]) -> tuple[DataFrame, DataFrame, int]:
    """Distinct positions ``(pos, pid, n, *cols, *axes)``, the same dealt to chunks (boxes of the space) ``chunk``, and the number of chunks.  The boxes come from
    a part of the positions: they decide who is compared where, not what is found."""
    pts, _ = written(grid_points(df, id_col, cols).withColumn("pos", F.monotonically_increasing_id()).withColumns({a: F.col(c).cast("double") for a, c in zip(axes, cols)}), "positions")
    m = pts.count()
    number = -(-m // min(max(m // CHUNKS, CHUNK[0]), CHUNK[1]))
    if number <= 1:
        return pts, pts.withColumn("chunk", F.lit(0)), 1
    seen = pts.where(F.pmod(F.xxhash64("pos"), F.lit(max(1, m // max(20_000, 256 * number)))) == 0).select(*axes).collect()
    tree = _cut(np.array(seen, dtype=float).reshape(-1, len(axes)), number)

    def dealt(batches):
        for batch in batches:
            x = np.stack([batch.column(a).to_numpy() for a in axes], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_box(tree, x))], names=[*batch.schema.names, "chunk"])

    return pts, pts.mapInArrow(dealt, StructType([*pts.schema.fields, StructField("chunk", IntegerType())])), number


def _matrix(t: pa.Table, axes: Sequence[str]) -> np.ndarray:
    return np.stack([t.column(a).to_numpy() for a in axes], axis=1) if t.num_rows else np.empty((0, len(axes)))


def _lists(i: np.ndarray, values: np.ndarray, rows: int) -> pa.ListArray:
    """``values`` as one list for each of ``rows``, to which ``i`` assigns them."""
    ends = np.append(0, np.cumsum(np.bincount(i, minlength=rows)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[np.argsort(i, kind="stable")], pa.int64()))


def _chunk_ends(df: DataFrame, axes: Sequence[str], *more: Column) -> list:
    """One row for each chunk: its box and ``more``."""
    return df.groupBy("chunk").agg(*[f(a).alias(f"{k}_{a}") for k, f in (("lo", F.min), ("hi", F.max)) for a in axes], *more).orderBy("chunk").collect()


def _cores(df: DataFrame, id_col: str, cols: Sequence[str], axes: Sequence[str], eps: float, enough: int) -> tuple[DataFrame, DataFrame, int]:
    """Positions, the same with ``core`` and, where that is false, the positions within ``eps`` (``near``), and the number of chunks.

    A position is compared with its own chunk first, and only until ``enough`` rows are found; those that lack rows then visit the chunks within ``eps`` of them.
    """
    spark = df.sparkSession
    pts, dealt, number = _positions(df, id_col, cols, axes)
    tasks = min(2 * number, 4096)

    def own(t: pa.Table) -> pa.Table:
        x, n = _matrix(t, axes), t.column("n").to_numpy().astype(float)
        have, i, j = _counted(x, np.where(np.isfinite(x).all(axis=1), 0.0, n), x, n, eps, enough)
        return t.append_column("have", pa.array(have)).append_column("near", _lists(i, t.column("pos").to_numpy()[j], t.num_rows))

    kind = StructType([*dealt.schema.fields, StructField("have", DoubleType()), StructField("near", ArrayType(LongType()))])
    found, folder = written(dealt.repartition(tasks, "chunk").groupBy("chunk").applyInArrow(own, kind), "counted")
    core = F.col("pid").isNotNull() & (F.col("have") >= enough)
    keep = ["pos", "pid", *axes, "chunk"]
    if number == 1:
        return pts, found.select(*keep, core.alias("core"), "near"), number
    ends = _chunk_ends(found, axes)
    boxes = [(r["chunk"], *(np.array([r[f"{k}_{a}"] for a in axes]) for k in ("lo", "hi"))) for r in ends]

    def visits(batches):
        for batch in batches:
            x, at = np.stack([batch.column(a).to_numpy() for a in axes], axis=1), batch.column("chunk").to_numpy()
            for c, low, high in boxes:
                go = _reach(x, x, low, high, eps)[1] & (at != c)
                if go.any():
                    some = batch.filter(pa.array(go))
                    yield some.set_column(some.schema.get_field_index("chunk"), "chunk", pa.array(np.full(some.num_rows, c, np.int32)))

    def visited(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        have = guests.column("have").to_numpy() if guests.num_rows else np.empty(0)
        n = hosts.column("n").to_numpy().astype(float) if hosts.num_rows else np.empty(0)
        all_, i, j = _counted(_matrix(guests, axes), have, _matrix(hosts, axes), n, eps, enough)
        pos = hosts.column("pos").to_numpy()[j] if hosts.num_rows else np.empty(0, np.int64)
        return pa.table({"pos": guests.column("pos").cast(pa.int64()), "more": pa.array(all_ - have), "far": _lists(i, pos, guests.num_rows)})

    lacking = found.where(F.col("have") < enough).select("pos", *axes, "chunk", "have")
    guests = lacking.repartition(spark.sparkContext.defaultParallelism).mapInArrow(visits, lacking.schema)
    met = guests.repartition(tasks, "chunk").groupBy("chunk").cogroup(found.select("pos", "n", *axes, "chunk").repartition(tasks, "chunk").groupBy("chunk"))
    far = met.applyInArrow(visited, "pos long, more double, far array<long>").groupBy("pos").agg(F.sum("more").alias("more"), F.flatten(F.collect_list("far")).alias("far"))
    core = F.col("pid").isNotNull() & (F.col("have") + F.coalesce("more", F.lit(0.0)) >= enough)
    flagged, _ = written(found.join(far, "pos", "left").select(*keep, core.alias("core"), F.concat("near", F.coalesce("far", F.array().cast("array<long>"))).alias("near")), "cores")
    remove_folder(spark, folder)
    return pts, flagged, number


def _parts(core: DataFrame, axes: Sequence[str], eps: float, number: int) -> tuple[DataFrame, DataFrame]:
    """Core positions with the part ``cell`` (linked positions of one chunk) each belongs to, and pairs of linked parts of different chunks ``(a, b)`` both ways."""
    spark = core.sparkSession
    tasks = min(2 * number, 4096)

    def own(t: pa.Table) -> pa.Table:
        up = _met(_matrix(t, axes), np.arange(t.num_rows), eps)
        return t.append_column("cell", pa.array(t.column("pos").to_numpy()[up]))

    kind = StructType([*core.schema.fields, StructField("cell", LongType())])
    parts, _ = written(core.repartition(tasks, "chunk").groupBy("chunk").applyInArrow(own, kind), "parts")
    ends = _chunk_ends(parts, axes, F.min("cell").alias("first"), F.max("cell").alias("last"))
    low, high = (np.array([[r[f"{k}_{a}"] for a in axes] for r in ends]).reshape(-1, len(axes)) for k in ("lo", "hi"))
    single, up = np.array([r["first"] == r["last"] for r in ends], bool), np.arange(len(ends))
    links, may = [], []
    for i in range(len(ends)):
        near = _reach(low[i], high[i], low[i + 1 :], high[i + 1 :], eps)[1]
        with np.errstate(all="ignore"):
            widest = np.maximum(high[i] - low[i + 1 :], high[i + 1 :] - low[i])
            sure = single[i] & single[i + 1 :] & ((widest * widest).sum(axis=1) <= eps * eps * (1 - 1e-9))  # every point of one with every point of the other
        may += [(i, i + 1 + int(j)) for j in np.flatnonzero(near & ~sure)]
        for j in i + 1 + np.flatnonzero(sure):
            if up[i] != up[j]:
                _merge(up, np.array([i]), np.array([j]))
                links.append((ends[i]["first"], ends[j]["first"]))
    may = [(i, j) for i, j in may if not (single[i] and single[j] and up[i] == up[j])]
    tiles = [(t, ends[i]["chunk"], s) for t, pair in enumerate(may) for s, i in enumerate(pair)]
    found = spark.createDataFrame(links, "a long, b long")
    if tiles:

        def linked(t: pa.Table) -> pa.Table:
            cells, group = np.unique(t.column("cell").to_numpy(), return_inverse=True)
            up = _met(_matrix(t, axes), group, eps, t.column("side").to_numpy() == 1)
            new = np.flatnonzero(up != np.arange(len(up)))
            return pa.table({"a": pa.array(cells[new], pa.int64()), "b": pa.array(cells[up[new]], pa.int64())})

        where = F.broadcast(spark.createDataFrame(tiles, "tile int, chunk int, side int"))
        met = parts.select("cell", "chunk", *axes).join(where, "chunk").repartition(min(2 * len(may), 4096), "tile")
        found = found.unionByName(met.groupBy("tile").applyInArrow(linked, "a long, b long"))
    return parts, found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))


def dbscan(df: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_points: int) -> DataFrame:
    """Density clusters: ``(id, cluster)`` with noise -1; cluster ids are the lowest id of a core row in it.  Rows with a NULL or NaN coordinate or without an id are noise.

    Copies of a position are handled once, and positions are dealt to chunks that lie together.  A position is compared with others only until ``min_points`` rows
    are found, and core positions only where they are not linked already: first inside a chunk, then between chunks.  Linked parts of chunks share the lowest label by
    repeated minima with hooks and pointer jumping (rounds grow with the logarithm of the parts), each round written to the reliable checkpoint folder.  Border rows
    take the lowest label among the core points in reach.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    fit = functools.reduce(lambda x, y: x & y, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols])
    whole = df.where(fit)
    axes = [f"__x{i}" for i in range(len(cols))]
    pts, flagged, number = _cores(whole, id_col, cols, axes, eps, min_points)
    parts, edges = _parts(flagged.where("core").select("pos", "pid", *axes, "chunk"), axes, eps, number)
    edges, links = written(edges, "links")
    labels, last = written(parts.groupBy("cell").agg(F.min("pid").alias("pid")).select("cell", "pid", F.col("cell").alias("label")), "labels")
    while True:  # labels only fall, so this ends
        near = edges.join(labels.select(F.col("cell").alias("b"), "label"), "b").groupBy(F.col("a").alias("cell")).agg(F.min("label").alias("m"))
        met = labels.join(near, "cell", "left").select("cell", "pid", "label", F.least("label", F.coalesce("m", "label")).alias("new"))
        hook = met.groupBy(F.col("label").alias("cell")).agg(F.min("new").alias("h"))  # what any of its cells met moves the label itself
        step = met.join(hook, "cell", "left").select("cell", "pid", "label", F.least("new", F.coalesce("h", "new")).alias("new"))
        jump = step.select(F.col("cell").alias("new"), F.col("new").alias("further"))
        nxt, folder = written(step.join(jump, "new", "left").select("cell", "pid", F.col("label").alias("old"), F.least("new", F.coalesce("further", "new")).alias("label")), "labels")
        remove_folder(spark, last)
        labels, last = nxt.select("cell", "pid", "label"), folder
        if nxt.where("old <> label").isEmpty():
            break
    remove_folder(spark, links)
    lowest = labels.groupBy("label").agg(F.min("pid").alias("name"))
    labelled = parts.join(labels.join(lowest, "label").select("cell", "name"), "cell").select("pos", F.col("name").alias("label"))
    border = flagged.where(~F.col("core") & F.col("pid").isNotNull()).select("pos", F.explode("near").alias("q"))
    edge = border.join(labelled.withColumnRenamed("pos", "q"), "q").groupBy("pos").agg(F.min("label").alias("label"))
    final = labelled.unionByName(edge)
    named = whole.join(pts.select("pos", *cols), list(cols)).join(final, "pos", "left").select(id_col, F.coalesce("label", F.lit(-1)).cast("long").alias("cluster"))
    return named.unionByName(df.where(~fit).select(id_col, F.lit(-1).cast("long").alias("cluster")))


# --- isolation forest --------------------------------------------------------------------------------------------

def _grow(x: np.ndarray, rng: np.random.Generator, depth: int, limit: int) -> list:
    """One isolation tree as nested lists: [feature, cut, left, right] or [rows]."""
    if depth >= limit or len(x) <= 1:
        return [len(x)]
    spread = np.flatnonzero(x.max(axis=0) > x.min(axis=0))
    if not len(spread):
        return [len(x)]
    f = int(rng.choice(spread))
    cut = float(rng.uniform(x[:, f].min(), x[:, f].max()))
    low = x[:, f] < cut
    return [f, cut, _grow(x[low], rng, depth + 1, limit), _grow(x[~low], rng, depth + 1, limit)]


def mean_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _path(tree: list, x: np.ndarray, depth: int = 0) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), depth + float(mean_path(tree[0])))
    out = np.empty(len(x))
    low = x[:, tree[0]] < tree[1]
    out[low], out[~low] = _path(tree[2], x[low], depth + 1), _path(tree[3], x[~low], depth + 1)
    return out


def isolation_forest(df: DataFrame, id_col: str, cols: Sequence[str], trees: int = 100, sample: int = 256, contamination: float | None = None) -> DataFrame:
    """Anomaly score in (0, 1) of every row (Liu, Ting and Zhou 2008); with ``contamination`` also a flag for the top share.

    Each tree is grown in its own task from at most ``sample`` rows picked by hash; the forest (at most
    trees x 2 x sample nodes) is then sent to the tasks that score the rows in Arrow batches.
    """
    n = df.count()
    x = [F.col(c).cast("double").alias(c) for c in cols]
    # each tree draws rows whose own hash for it lies below one threshold, twice as many as it keeps, in the same way at every size
    part = min(1.0, 2.0 * sample / max(n, 1))
    tries = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("__t"), F.pmod(F.xxhash64(F.lit("tree"), t, F.col(id_col)), F.lit(1 << 32)).alias("__h")))
    drawn = df.select(id_col, *x, F.inline(F.filter(tries, lambda v: v["__h"] < part * (1 << 32))))
    w = Window.partitionBy("__t").orderBy("__h", id_col)
    bounded = drawn.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= sample)
    names, limit = list(cols), int(math.ceil(math.log2(max(2, min(sample, n)))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        import json

        pdf = pdf.sort_values("__r")
        t = int(pdf["__t"].iloc[0])
        return pd.DataFrame({"t": [t], "size": [len(pdf)], "tree": [json.dumps(_grow(pdf[names].to_numpy(float), np.random.default_rng(t), 0, limit))]})

    import json

    grown = bounded.groupBy("__t").applyInPandas(grow, "t int, size int, tree string").collect()  # `trees` bounded rows
    forest = [json.loads(r["tree"]) for r in sorted(grown, key=lambda r: r["t"])]
    norm = float(np.mean([mean_path(r["size"]) for r in grown])) or 1.0

    def score(batches):
        for pdf in batches:
            m = pdf[names].to_numpy(float)
            depth = sum(_path(tree, m) for tree in forest) / len(forest)
            yield pd.DataFrame({id_col: pdf[id_col], "score": np.power(2.0, -depth / norm)})

    out = df.select(id_col, *x).mapInPandas(score, f"{id_col} {df.schema[id_col].dataType.simpleString()}, score double")
    if contamination is None:
        return out
    cut = exact_quantiles(out, ["score"], [1 - contamination])[("score",)][0]
    return out.withColumn("anomaly", F.col("score") > cut)
