"""K-means with many models to a scan: every pass over the table moves the centres of all (K, start) runs at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.core import h32

SLICE = 4096


@dataclass(frozen=True)
class Run:
    """One K-means run: its centres, the rows and the squared distances that fell to each, and whether it has settled."""

    k: int
    start: int
    centres: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    inertia: float
    settled: bool = False


def usable(df: DataFrame, array_col: str, *keep: str) -> DataFrame:
    """(keep..., x): rows with a vector of finite numbers as array<double>."""
    x = F.col(f"`{array_col}`").cast("array<double>")
    return df.select(*keep, x.alias("x")).where(F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)


def _stack(runs: Sequence[Run]) -> tuple[np.ndarray, list[slice]]:
    ends = np.cumsum([r.k for r in runs]).tolist()
    return np.concatenate([r.centres for r in runs]), [slice(i, j) for i, j in zip([0, *ends], ends)]


def _nearest(x: np.ndarray, centres: np.ndarray, own: list[slice]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, runs): number of the nearest centre within each run (the lowest on ties) and its squared distance, by one matrix product for all runs."""
    far = (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)[None]
    pick = np.stack([far[:, s].argmin(axis=1) for s in own], axis=1)
    gone = np.stack([np.maximum(far[:, s].min(axis=1), 0.0) for s in own], axis=1)
    return pick, gone


def first_centres(rows: DataFrame, id_col: str, runs: Sequence[tuple[int, int]]) -> list[Run]:
    """Each start draws the rows whose hashes for it are smallest, as many as its largest K asks; smaller K take the first of them."""
    most = {s: max(k for k, t in runs if t == s) for _, s in runs}
    tries = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(k).alias("most")) for s, k in most.items()]))
    drawn = rows.select(id_col, "x", tries.alias("t")).select("t.s", "t.most", "x", h32(F.lit("start"), "t.s", id_col).alias("h"), id_col)
    drawn = drawn.withColumn("c", F.row_number().over(Window.partitionBy("s").orderBy("h", id_col))).where(F.col("c") <= max(most.values()))
    got = drawn.where("c <= most").orderBy("s", "c").collect()  # starts x K rows
    by = {s: np.array([r["x"] for r in got if r["s"] == s], float) for s in most}
    blank = lambda k, d: (np.zeros(k), np.zeros((k, d)), np.zeros(k))
    out = []
    for k, s in runs:
        centres = by[s][:k]
        if len(centres) < k:
            raise ValueError(f"K = {k} but only {len(centres)} rows hold a vector")
        counts, sums, squares = blank(k, centres.shape[1])
        out.append(Run(k, s, centres, counts, sums, squares, 0.0))
    return out


def measured(rows: DataFrame, runs: Sequence[Run]) -> list[Run]:
    """One scan for all runs: rows, sums and squares of what is nearest to each centre, and the inertia.

    A task adds up its rows by matrix products and hands on one row for each centre; these are added in the order of tasks.
    """
    centres, own = _stack(runs)
    sent = rows.sparkSession.sparkContext.broadcast((centres, own))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, parts = sent.value
        n, s, q, d = np.zeros(len(c)), np.zeros_like(c), np.zeros(len(c)), np.zeros(len(c))
        first = np.array([p.start for p in parts])
        for _, x in _matrices(batches):
            pick, gone = _nearest(x, c, parts)
            at = pick + first[None]
            hot = np.zeros((len(x), len(c)))
            hot[np.arange(len(x))[:, None], at] = 1.0
            n += hot.sum(axis=0)
            s += hot.T @ x
            q += hot.T @ (x * x).sum(axis=1)
            np.add.at(d, at.ravel(), gone.ravel())
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(np.full(len(some), TaskContext.get().partitionId()), pa.int32()), pa.array(n[some]), pa.array(q[some]), pa.array(d[some]), pa.array(list(s[some]), pa.list_(pa.float64()))],
            ["centre", "task", "n", "q", "d", "s"],
        )

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("task")
        return pd.DataFrame({"centre": pdf["centre"].iloc[:1], "n": pdf["n"].sum(), "q": pdf["q"].sum(), "d": pdf["d"].sum(), "s": [np.sum(np.stack(pdf["s"]), axis=0)]})

    parts = rows.select("x").mapInArrow(add, "centre int, task int, n double, q double, d double, s array<double>")
    got = parts.groupBy("centre").applyInPandas(total, "centre int, n double, q double, d double, s array<double>").collect()  # one row for each centre
    sent.destroy()
    n, s, q, d = np.zeros(len(centres)), np.zeros_like(centres), np.zeros(len(centres)), np.zeros(len(centres))
    for r in got:
        n[r["centre"]], s[r["centre"]], q[r["centre"]], d[r["centre"]] = r["n"], r["s"], r["q"], r["d"]
    return [replace(r, counts=n[p], sums=s[p], squares=q[p], inertia=float(d[p].sum())) for r, p in zip(runs, own)]


def lloyd(df: DataFrame, array_col: str, id_col: str, runs: Sequence[tuple[int, int]], rounds: int = 20, tolerance: float = 1e-8) -> list[Run]:
    """Lloyd's algorithm for every (K, start) of ``runs``: at most ``rounds`` moves, one scan each whatever the number of runs, and one to measure the end.

    A centre that no row is nearest to stays.  A run leaves the scans when its centres move less than ``tolerance`` (squared).
    Only centres reach the driver.  Vectors that are null, empty or hold null or non-finite numbers take no part.
    """
    rows = usable(df, array_col, id_col)
    state = first_centres(rows, id_col, runs)
    for _ in range(rounds):
        moving = [i for i, r in enumerate(state) if not r.settled]
        if not moving:
            break
        for i, r in zip(moving, measured(rows, [state[i] for i in moving])):
            moved = np.where(r.counts[:, None] > 0, r.sums / np.maximum(r.counts, 1)[:, None], r.centres)
            settled = bool(((moved - r.centres) ** 2).sum(axis=1).max() <= tolerance)
            state[i] = replace(r, centres=moved, settled=settled)
    return measured(rows, state)


def best_of(runs: Sequence[Run]) -> Run:
    """The run of least inertia, the first start of several."""
    return min(runs, key=lambda r: (r.inertia, r.start))


def labelled(df: DataFrame, array_col: str, keep: Sequence[str], runs: Sequence[Run]) -> DataFrame:
    """(keep..., clusters, sq_dists): for each row an array with its cluster in every run, and the squared distances."""
    centres, own = _stack(runs)
    sent = df.sparkSession.sparkContext.broadcast((centres, own))
    rows = usable(df, array_col, *keep)
    kept = rows.drop("x").schema.simpleString()[len("struct<") : -1]

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            pick, gone = _nearest(x, *sent.value)
            lists = [pa.array(list(pick.astype(np.int32)), pa.list_(pa.int32())), pa.array(list(gone), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *lists], [*keep, "clusters", "sq_dists"])

    return rows.mapInArrow(name, kept + ", clusters array<int>, sq_dists array<double>")


def silhouettes(df: DataFrame, array_col: str, runs: Sequence[Run]) -> list[float]:
    """Mean simplified silhouette (squared distances to all members of a cluster, by its sums) of each measured run, in one scan."""
    centres, own = _stack(runs)
    stats = [(r.counts, r.sums, r.squares) for r in runs]
    sent = df.sparkSession.sparkContext.broadcast((centres, own, stats))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, parts, known = sent.value
        total, rows = np.zeros(len(parts)), 0
        for _, x in _matrices(batches):
            pick, _ = _nearest(x, c, parts)
            norm = (x * x).sum(axis=1)
            rows += len(x)
            for k, (n, s, q) in enumerate(known):
                some = np.maximum(n, 1)
                mean = norm[:, None] + (q / some)[None] - 2 * x @ (s / some[:, None]).T
                at = (np.arange(len(x)), pick[:, k])
                size = n[pick[:, k]]
                a = np.maximum(mean[at], 0) * size / np.maximum(size - 1, 1)
                mean[:, n == 0] = np.inf
                mean[at] = np.inf
                b = np.maximum(mean.min(axis=1), 0)
                most = np.maximum(a, b)
                fit = (size > 1) & np.isfinite(b) & (most > 0)
                total[k] += ((b - a)[fit] / most[fit]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), pa.array(total), pa.array(np.full(len(parts), rows), pa.int64())], ["run", "s", "n"])

    got = usable(df, array_col).mapInArrow(score, "run int, s double, n long").groupBy("run").agg((F.sum("s") / F.sum("n")).alias("v")).collect()
    sent.destroy()
    return [r["v"] for r in sorted(got, key=lambda r: r["run"])]


def pair_counts(named: DataFrame, runs: int) -> DataFrame:
    """(pair, a, b, n): how often run i says a where run j says b, for every pair of runs; each task counts its rows first."""
    pairs = list(combinations(range(runs), 2))
    cells = F.array(*[F.struct(F.lit(p).alias("pair"), F.get("clusters", F.lit(i)).alias("a"), F.get("clusters", F.lit(j)).alias("b")) for p, (i, j) in enumerate(pairs)])
    return named.select(F.inline(cells)).groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("n"))
