"""Mutual information of numeric columns with a discrete target by nearest neighbours, without comparing all rows."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.core import as_number, rnd
from plumbline.operators.ordering import MAX_BUCKETS, exact_quantiles
from plumbline.operators.profile import roles
from plumbline.session import ensure_checkpoint_dir, written

ROWS_PER_BUCKET = 500_000
BATCHES = 16
"""Arrow batches whose equal values are counted together before they are dealt."""
POINTS = "f int, b int, y string, ny long, x array<double>, c array<long>"
ENDS = "first_x array<double>, first_c array<long>, last_x array<double>, last_c array<long>"


def digamma(x: Column) -> Column:
    """Digamma function of x >= 1, by its series behind six steps of its recurrence (error below 1e-11)."""
    z = x.cast("double") + 6
    i2 = 1 / (z * z)
    tail = i2 * (F.lit(1 / 12) - i2 * (F.lit(1 / 120) - i2 * (F.lit(1 / 252) - i2 * (F.lit(1 / 240) - i2 * F.lit(1 / 132)))))
    return F.ln(z) - 0.5 / z - tail - sum((1 / (x.cast("double") + i) for i in range(6)), F.lit(0.0))


def digammas(x: np.ndarray) -> np.ndarray:
    """The same of many numbers."""
    x = np.asarray(x, dtype=float)
    z = x + 6
    i2 = 1 / (z * z)
    tail = i2 * (1 / 12 - i2 * (1 / 120 - i2 * (1 / 252 - i2 * (1 / 240 - i2 / 132))))
    return np.log(z) - 0.5 / z - tail - sum(1 / (x + i) for i in range(6))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys starts."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    change = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(np.concatenate([[True], change]))


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values, kind))


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy()


def _sizes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().value_lengths().to_numpy().astype(np.int64)


def _cuts(filled: DataFrame, feats: list[str], n: int, rows_per_bucket: int) -> list[np.ndarray]:
    """Cut points of each feature, about ``rows_per_bucket`` rows apart; results do not depend on them."""
    want = min(MAX_BUCKETS, -(-n // rows_per_bucket))
    if want <= 1:
        return [np.empty(0) for _ in feats]
    levels = F.array(*[F.lit(i / want) for i in range(1, want)])
    got = filled.agg(*[F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(c, min(65_535, max(200, 32 * want))), levels).alias(c) for c in feats]).first()
    return [np.unique(np.array(got[c], dtype=float)) for c in feats]


def _dealt(filled: DataFrame, feats: list[str], cuts: list[np.ndarray]) -> DataFrame:
    """Distinct positions with their copies, in order, one row for each feature ``f``, bucket ``b`` and class."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        while some := list(itertools.islice(batches, BATCHES)):
            rows = pa.Table.from_batches(some).combine_chunks()
            if not rows.num_rows:
                continue
            named = rows.column("y").combine_chunks().dictionary_encode()
            code, names = named.indices.to_numpy(), named.dictionary
            ny = np.zeros(len(names), np.int64)
            ny[code] = rows.column("ny").to_numpy()
            code = code.astype(np.int16) if len(names) < 1 << 15 else code
            for f, name in enumerate(feats):
                x = rows.column(name).to_numpy()
                order = np.argsort(x, kind="stable")
                order = order[np.argsort(code[order], kind="stable")]
                x, y = x[order], code[order]
                new = _runs(x, y)
                c = np.diff(np.append(new, len(x)))
                x, y = x[new], y[new]
                b = np.searchsorted(cuts[f], x)
                starts = _runs(b, y)
                of = y[starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), f), pa.int32()), pa.array(b[starts], pa.int32()), names.take(pa.array(of)), pa.array(ny[of]), _lists(x, starts, pa.float64()), _lists(c, starts, pa.int64())],
                    ["f", "b", "y", "ny", "x", "c"])

    return filled.mapInArrow(pack, POINTS)


def _merged(dealt: DataFrame, neighbours: int) -> DataFrame:
    """One row for each feature, bucket and class: its positions in order, its number of rows, and its first and last ``neighbours`` positions."""

    def merge(rows: pa.Table) -> pa.Table:
        named = rows.column("y").combine_chunks().dictionary_encode()
        each, names = named.indices.to_numpy(), named.dictionary
        ny = np.zeros(len(names), np.int64)
        ny[each] = rows.column("ny").to_numpy()
        y, x, c = np.repeat(each, _sizes(rows.column("x"))), _flat(rows.column("x")), _flat(rows.column("c"))
        order = np.lexsort((x, y))
        y, x, c = y[order], x[order], c[order]
        new = _runs(x, y)
        c = np.add.reduceat(c, new)
        x, y = x[new], y[new]
        starts = _runs(y)
        ends = np.append(starts[1:], len(y))
        of = y[starts]
        edge = []
        for low, high in ((starts, np.minimum(starts + neighbours, ends)), (np.maximum(ends - neighbours, starts), ends)):
            size = high - low
            upto = np.cumsum(size)
            at = np.arange(upto[-1]) + np.repeat(low - (upto - size), size)
            edge += [_lists(x[at], upto - size, pa.float64()), _lists(c[at], upto - size, pa.int64())]
        f, b = (pa.array(np.full(len(of), rows.column(k)[0].as_py()), pa.int32()) for k in "fb")
        return pa.table([f, b, names.take(pa.array(of)), pa.array(ny[of]), _lists(x, starts, pa.float64()), _lists(c, starts, pa.int64()), pa.array(np.add.reduceat(c, starts)), *edge],
                        ["f", "b", "y", "ny", "x", "c", "n", "first_x", "first_c", "last_x", "last_c"])

    return dealt.groupBy("f", "b").applyInArrow(merge, f"{POINTS}, n long, {ENDS}")


def _beside(buckets: DataFrame, neighbours: int) -> DataFrame:
    """(f, b, y) with the ``neighbours`` positions of the class before its bucket and behind it."""
    w = Window.partitionBy("f", "y").orderBy("b")
    kinds = {"x": "array<double>", "c": "array<long>"}
    tried = range(1, neighbours + 1)  # a bucket with any position of the class is a row
    near = {}
    for k, kind in kinds.items():
        none = F.array().cast(kind)
        before = F.concat(*[F.coalesce(F.lag(f"last_{k}", j).over(w), none) for j in reversed(tried)])
        near[f"before_{k}"] = before
        near[f"after_{k}"] = F.concat(*[F.coalesce(F.lead(f"first_{k}", j).over(w), none) for j in tried])
    got = buckets.select("f", "b", "y", *[c.alias(k) for k, c in near.items()])
    cut = {k: F.slice(k, F.greatest(F.size(k) - neighbours, F.lit(0)) + 1, neighbours) if k.startswith("before") else F.slice(k, 1, neighbours) for k in near}
    return got.select("f", "b", "y", *[c.alias(k) for k, c in cut.items()])


def intervals(x: np.ndarray, c: np.ndarray, first: int, last: int, kk: int, neighbours: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, lo, hi) of the distinct positions ``first`` to ``last`` of a class, ``x`` in order with ``c`` copies: the distance to the ``kk``-th nearest other row and the
    ends of the interval, which ends at that neighbour itself where it lies, and as far away on the other side."""
    at = np.arange(first, last)
    steps = [*range(-neighbours, 0), *range(1, neighbours + 1)]
    place = at[:, None] + np.array(steps)
    met = (place >= 0) & (place < len(x))
    place = np.clip(place, 0, max(len(x) - 1, 0))
    v = x[place]
    with np.errstate(invalid="ignore"):
        gap = np.where(met, np.abs(x[at][:, None] - v), np.inf)
    order = np.argsort(gap, axis=1, kind="stable")
    copies = np.take_along_axis(np.where(met, c[place], 0), order, axis=1)
    hit = np.argmax((c[at] - 1)[:, None] + np.cumsum(copies, axis=1) >= kk, axis=1)
    which = order[np.arange(len(at)), hit]
    r, v = gap[np.arange(len(at)), which], v[np.arange(len(at)), which]
    alone = c[at] > kk
    x = x[at]
    with np.errstate(invalid="ignore", over="ignore"):
        lo, hi = np.where(which < neighbours, v, x - r), np.where(which < neighbours, x + r, v)
    return np.where(alone, 0.0, r), np.where(alone, x, lo), np.where(alone, x, hi)


def neighbour_information(df: DataFrame, target: str, neighbours: int = 3, chunk: int = 50_000, rows_per_bucket: int | None = None) -> DataFrame:
    """MI (nats) of each numeric feature with a discrete target by the estimator of Ross (2014).

    For each row the distance to its ``neighbours``-th nearest row of its own class, then the number of rows of any class nearer than that.  Each feature is cut into
    buckets of about ``rows_per_bucket`` rows; a bucket holds its values in order, equal ones once for each class, and meets the few positions of a class beside it.
    Its rows are counted before its first value, so ends of intervals are looked up where they lie: most in the bucket itself, ``chunk`` positions at a time, the others
    in a second pass by the buckets of the ends.  Missing values take the median; a feature without any value, rows without a target and classes of one row take no
    part.  :func:`profile.mutual_information` is the cheap form by bins.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    feats = roles(df, target).features
    clean = df.where(F.col(target).isNotNull()).select(F.col(target).cast("string").alias("y"), *[as_number(df, c).cast("double").alias(f"x{i}") for i, c in enumerate(feats)])
    number = {f"x{i}": c for i, c in enumerate(feats)}
    held = clean.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in number]).first() if feats else {}
    own = [c for c in number if held[c]]
    if not own:
        return spark.createDataFrame([], "feature string, mi double")
    holes = [c for c in own if held[c] < held["n"]]
    medians = exact_quantiles(clean, holes, [0.5]) if holes else {}
    size = clean.groupBy("y").agg(F.count(F.lit(1)).alias("ny")).where("ny > 1")
    filled = clean.select("y", *[((F.coalesce(F.col(c), F.lit(medians[(c,)][0])) if c in holes else F.col(c)) + 0.0).alias(c) for c in own])
    cuts = _cuts(filled, own, held["n"], rows_per_bucket or ROWS_PER_BUCKET)
    buckets, _ = written(_merged(_dealt(filled.join(size, "y"), own, cuts), neighbours), "buckets")

    numbers = spark.createDataFrame([(f, b) for f, c in enumerate(cuts) for b in range(len(c) + 1)], "f int, b int")
    rows = numbers.join(buckets.groupBy("f", "b").agg(F.sum("n").alias("n")), ["f", "b"], "left")
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_BUCKETS rows
    base, _ = written(rows.select("f", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "base")

    def measure(rows: pa.Table) -> pa.Table:
        f, b, cut = rows.column("f")[0].as_py(), rows.column("b")[0].as_py(), cuts[rows.column("f")[0].as_py()]
        every, copies = _flat(rows.column("x")), _flat(rows.column("c"))
        order = np.argsort(every, kind="stable")
        every, upto = every[order], np.append(0, np.cumsum(copies[order]))
        low, high = cut[b - 1] if b else -np.inf, cut[b] if b < len(cut) else np.inf
        total, left = np.zeros(4), []
        names = ["ny", "x", "c", "before_x", "before_c", "after_x", "after_c"]
        for ny, x, c, bx, bc, ax, ac in zip(*(rows.column(k).combine_chunks() for k in names)):
            ny, (x, c, bx, bc, ax, ac) = ny.as_py(), (v.values.to_numpy() for v in (x, c, bx, bc, ax, ac))
            kk, mine = min(neighbours, ny - 1), len(x)
            x, c = np.concatenate([bx, x, ax]), np.concatenate([bc, c, ac])
            for i in range(len(bx), len(bx) + mine, chunk):
                j = min(i + chunk, len(bx) + mine)
                # what is close enough to be met
                s, e = max(0, i - neighbours), min(len(x), j + neighbours)
                r, lo, hi = intervals(x[s:e], c[s:e], i - s, j - s, kk, neighbours)
                w = c[i:j]
                same = upto[np.searchsorted(every, x[i:j], "right")] - upto[np.searchsorted(every, x[i:j], "left")]
                inside = upto[np.searchsorted(every, hi, "left")] - upto[np.searchsorted(every, lo, "right")]
                here = (r == 0) | ((lo >= low) & (hi <= high))
                m = np.maximum(np.where(r == 0, same, inside), 1)
                total += [w.sum(), w.sum() * float(digammas(kk)), w.sum() * float(digammas(ny)), (w * digammas(m))[here].sum()]
                left.append(np.stack([lo[~here], hi[~here], w[~here].astype(float)]))
        lo, hi, w = np.concatenate(left, axis=1)
        to = [np.searchsorted(cut, v) for v in (lo, hi)]
        whole = [f, b, *total, *(v.tolist() for v in (lo, hi, w.astype(np.int64), *to))]
        return pa.Table.from_pylist([dict(zip(shape.names, whole))], shape)

    shape = pa.schema([("f", pa.int32()), ("b", pa.int32()), *[(k, pa.float64()) for k in ("w", "psi_k", "psi_n", "psi_m")], ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                       ("c", pa.list_(pa.int64())), ("to_lo", pa.list_(pa.int32())), ("to_hi", pa.list_(pa.int32()))])
    with_sides = buckets.select("f", "b", "y", "ny", "x", "c").join(_beside(buckets, neighbours), ["f", "b", "y"])
    measured, _ = written(with_sides.groupBy("f", "b").applyInArrow(
        measure, "f int, b int, w double, psi_k double, psi_n double, psi_m double, lo array<double>, hi array<double>, c array<long>, to_lo array<int>, to_hi array<int>"), "measured")

    def counted(ends: pa.Table, rows: pa.Table) -> pa.Table:
        every, copies = _flat(rows.column("x")), _flat(rows.column("c"))
        order = np.argsort(every, kind="stable")
        every, upto = every[order], np.append(0, np.cumsum(copies[order]))
        v, high = ends.column("v").to_numpy(), ends.column("high").to_numpy()
        n = np.where(high, upto[np.searchsorted(every, v, "left")], -upto[np.searchsorted(every, v, "right")])
        return ends.select(["f", "from", "i", "high", "c", "b"]).append_column("n", pa.array(n, pa.int64()))

    each = measured.select("f", F.col("b").alias("from"), F.posexplode(F.arrays_zip("lo", "hi", "c", "to_lo", "to_hi")).alias("i", "e"))
    ends = each.select("f", "from", "i", "e.c", F.inline(F.array(*[F.struct(F.col(f"e.to_{k}").alias("b"), F.col(f"e.{k}").alias("v"), F.lit(k == "hi").alias("high")) for k in ("lo", "hi")])))
    met = ends.groupBy("f", "b").cogroup(buckets.select("f", "b", "x", "c").groupBy("f", "b")).applyInArrow(counted, "f int, from int, i int, high boolean, c long, b int, n long")
    signed = F.col("n") + F.when(F.col("high"), F.col("base")).otherwise(-F.col("base"))
    m = met.join(base, ["f", "b"]).groupBy("f", "from", "i").agg(F.max("c").alias("c"), F.sum(signed).alias("m"))
    late = m.select("f", *[F.lit(0.0).alias(k) for k in ("w", "psi_k", "psi_n")], (F.col("c") * digamma(F.greatest("m", F.lit(1)))).alias("psi_m"))
    each = measured.select("f", "w", "psi_k", "psi_n", "psi_m").unionByName(late).groupBy("f").agg(*[F.sum(k).alias(k) for k in ("w", "psi_k", "psi_n", "psi_m")])
    mi = digamma(F.col("w")) + (F.col("psi_k") - F.col("psi_n") - F.col("psi_m")) / F.col("w")
    titles = F.array(*[F.lit(number[c]) for c in own])
    return each.select(F.get(titles, F.col("f")).alias("feature"), rnd(F.greatest(mi, F.lit(0.0))).alias("mi"))
