"""Exact global order statistics without a single-partition window.

Ranks, prefix sums and quantiles over a whole table normally need one sorted
task.  Here the key range is cut into buckets first, bucket totals give every
bucket its offset, and the window runs inside the buckets.  The cut points come
from a sketch, but the result does not depend on them.  Cut points are collected
once and used as literals, so a recomputed task sees the same buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 8192
BRACKET_ROWS = 5_000_000
MAX_ACCURACY = 1_000_000


def cut_points(df: DataFrame, key: str, rows_per_bucket: int | None = None) -> tuple[list[float], list[float]]:
    """(strictly increasing inner cut points, values so frequent that they repeat as cut points).

    Both lists hold at most MAX_BUCKETS numbers.  A table that fits one bucket gives empty lists.
    """
    per = rows_per_bucket or ROWS_PER_BUCKET
    n = df.count()
    want = min(MAX_BUCKETS, -(-n // per))
    if want <= 1:
        return [], []
    fractions = [i / want for i in range(1, want)]
    got = df.agg(F.percentile_approx(F.col(key).cast("double"), fractions, max(10_000, 4 * want)).alias("q")).first()["q"]
    got = got or []
    hot = sorted({a for a, b in zip(got, got[1:]) if a == b})
    return sorted(set(got)), hot


def with_bucket(df: DataFrame, key: str, cuts: list[float], hot: list[float], name: str) -> DataFrame:
    """Add an order-preserving bucket; a hot value sits alone in its own bucket."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    tmp = f"__{name}"
    splits = [float("-inf"), *cuts, float("inf")]
    out = df.withColumn(f"{tmp}_k", F.col(key).cast("double"))
    out = Bucketizer(splits=splits, inputCol=f"{tmp}_k", outputCol=tmp, handleInvalid="keep").transform(out)
    alone = F.col(f"{tmp}_k").isin(hot) if hot else F.lit(False)
    return out.withColumn(name, (2 * F.col(tmp) + F.when(alone, 0).otherwise(1)).cast("int")).drop(tmp, f"{tmp}_k")


def rank_rows(
    df: DataFrame,
    order: str,
    tie: str,
    by: Sequence[str] = (),
    descending: bool = False,
    name: str = "rank",
    running: dict[str, str] | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Position (from 1) of each row by ``order`` then ascending ``tie``, inside each group of ``by``.

    ``running`` adds running sums of columns in the same order.  ``tie`` must be numeric and unique inside a
    group.  A value of ``order`` shared by a large part of the table is spread over buckets of ``tie``, so no
    task receives an unbounded group.
    """
    by, running = list(by), dict(running or {})
    cuts, hot = cut_points(df, order, rows_per_bucket)
    out = with_bucket(df, order, cuts, hot, "__b1")
    if hot:
        tie_cuts, tie_hot = cut_points(df, tie, rows_per_bucket)
        out = with_bucket(out, tie, tie_cuts, tie_hot, "__b2")
        out = out.withColumn("__b2", F.when(F.col(order).cast("double").isin(hot), F.col("__b2")).otherwise(0))
    else:
        out = out.withColumn("__b2", F.lit(0))
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "__b1", "__b2").orderBy(direction, F.col(tie).asc())
    sums = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = out.withColumns({"__r": F.row_number().over(inside).cast("long"),
                              **{f"__s_{k}": F.sum(v).over(sums) for k, v in running.items()}})
    if not cuts:  # one bucket only: positions inside it are the answer
        return ranked.select(*df.columns, F.col("__r").alias(name), *[F.col(f"__s_{k}").alias(k) for k in running])
    b1 = F.col("__b1").desc() if descending else F.col("__b1").asc()
    totals = out.groupBy(*by, "__b1", "__b2").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__t_{k}") for k, v in running.items()])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(b1, F.col("__b2").asc()).rowsBetween(
        Window.unboundedPreceding, -1)  # at most MAX_BUCKETS rows per group
    totals = totals.select(
        *by, "__b1", "__b2", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        *[F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in running])
    joined = ranked.join(totals, [ranked[c].eqNullSafe(totals[c]) for c in [*by, "__b1", "__b2"]], "inner")
    return joined.select(
        *[ranked[c] for c in df.columns], (F.col("__off") + F.col("__r")).alias(name),
        *[(F.col(f"__o_{k}") + F.col(f"__s_{k}")).alias(k) for k in running])


def rolling(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    tie: str,
    width: int,
    make: Callable[[WindowSpec], dict[str, Column]],
    chunk: int = 100_000,
) -> DataFrame:
    """Evaluate window expressions over the last ``width`` rows of each entity.

    ``make(window)`` returns the named expressions.  An entity of any size is cut into chunks of its
    row positions; each chunk also receives the ``width - 1`` rows before it, so a hot entity is shared by many tasks.
    """
    chunk = max(chunk, width)
    pos = rank_rows(df, order, tie, by=by, name="__pos")
    own = F.floor((F.col("__pos") - 1) / chunk)
    ahead = (F.pmod(F.col("__pos") - 1, F.lit(chunk)) >= chunk - (width - 1)) if width > 1 else F.lit(False)
    homes = F.when(ahead, F.array(own, own + 1)).otherwise(F.array(own))
    spread = pos.withColumn("__own", own).withColumn("__chunk", F.explode(homes))
    w = Window.partitionBy(*by, "__chunk").orderBy("__pos").rowsBetween(-(width - 1), 0)
    out = spread.withColumns(make(w)).where(F.col("__own") == F.col("__chunk"))
    return out.drop("__pos", "__own", "__chunk")


def running_totals(
    df: DataFrame,
    key: str,
    measures: dict[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    rows_per_bucket: int | None = None,
    keys: str | None = None,
) -> DataFrame:
    """One row per distinct key with each measure and its running total ``cum_<measure>`` up to and including the key.

    Rows are summed per key before any ordering, so repeated keys cost nothing.  ``keys`` names a further measure that counts the keys.
    """
    by = list(by)
    cuts, hot = cut_points(df, key, rows_per_bucket)
    grouped = df.groupBy(*by, key).agg(*[F.sum(m).alias(n) for n, m in measures.items()])
    if keys:
        grouped, measures = grouped.withColumn(keys, F.lit(1)), measures | {keys: F.lit(1)}
    order = F.col(key).desc() if descending else F.col(key).asc()
    if not cuts:
        # the whole table is below one bucket, so this window is bounded
        w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return grouped.withColumns({f"cum_{n}": F.sum(n).over(w) for n in measures})
    parts = with_bucket(grouped, key, cuts, hot, "__b")
    b = F.col("__b").desc() if descending else F.col("__b").asc()
    totals = parts.groupBy(*by, "__b").agg(*[F.sum(n).alias(f"__t_{n}") for n in measures])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *by, "__b", *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in measures])
    inside = Window.partitionBy(*by, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumns({f"__c_{n}": F.sum(n).over(inside) for n in measures})
    joined = parts.join(totals, [parts[c].eqNullSafe(totals[c]) for c in [*by, "__b"]], "inner")
    return joined.select(
        *[parts[c] for c in [*by, key, *measures]],
        *[(F.col(f"__c_{n}") + F.col(f"__o_{n}")).alias(f"cum_{n}") for n in measures])


def bracket_accuracy(n: int) -> int:
    """Accuracy of the sketch that keeps a bracket of ``n`` rows near BRACKET_ROWS."""
    return int(min(MAX_ACCURACY, max(1_000, 4 * n // BRACKET_ROWS)))


def bracket_aggregates(columns: Sequence[Column], probs: Sequence[float], accuracy: int) -> list[Column]:
    """Aggregates of the first pass of :func:`exact_quantiles`: values and rank brackets of each column.

    KLL sketches take a value in a fraction of the time of ``percentile_approx``; at four times the accuracy their ranks are off by less than half a bracket.
    """
    k = min(65_535, max(8, 4 * accuracy))
    eps = 8.0 / k
    levels = F.array(*[F.lit(min(1.0, max(0.0, p + s))) for p in probs for s in (-eps, eps)])
    return [F.count(c).alias(f"n__{i}") for i, c in enumerate(columns)] + [
        F.when(F.count(c) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(c, k), levels)).alias(f"s__{i}") for i, c in enumerate(columns)]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
    first: Sequence[Row] | None = None,
) -> dict[tuple, list[float | None]]:
    """Linear-interpolated quantiles, exact at any size: ``{(*group, column): [q per prob]}``.

    ``by`` must have few groups (classes, epochs, tree leaves): the result is collected.  Exact percentile
    aggregates keep every distinct value of a column in one task, so two passes are used instead.  A sketch
    gives a narrow bracket around every wanted rank; then each Arrow batch counts the values below each
    bracket and keeps only those inside, repeated values once.  The rank is read off exactly, and a bracket
    that missed is widened and tried again.  The sketch is made finer with the table, so that a bracket
    holds about BRACKET_ROWS rows at most.  ``first`` passes rows of :func:`bracket_aggregates` that the caller
    has from a scan of its own.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    source = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    if first is None:
        accuracy = accuracy or bracket_accuracy(source.count())
        first = source.groupBy(*by).agg(*bracket_aggregates([F.col(c) for c in columns], probs, accuracy)).collect()
    groups = [tuple(r[b] for b in by) for r in first]
    result: dict[tuple, list] = {}
    todo: dict[tuple[int, int, int], dict] = {}
    for g, r in enumerate(first):
        for i, c in enumerate(columns):
            n, sketch = r[f"n__{i}"], r[f"s__{i}"]
            result[(*groups[g], c)] = [None] * len(probs)
            for j, p in enumerate(probs if n else []):
                rank = p * (n - 1)
                k = int(rank)
                todo[(g, i, j)] = {"lo": sketch[2 * j], "hi": sketch[2 * j + 1], "k": k, "k1": min(k + 1, n - 1), "f": rank - k}
    number = {g: i for i, g in enumerate(groups)}
    while todo:
        brackets: dict[tuple[int, int], list] = {}
        for (g, i, j), t in todo.items():
            brackets.setdefault((g, i), []).append((j, t["lo"], t["hi"]))

        def narrow(batches):
            below: dict[tuple, int] = {}
            for pdf in batches:
                parts = [((), pdf)] if not by else pdf.groupby(by, dropna=False, sort=False)
                rows = []
                for name, part in parts:
                    g = number[tuple(None if v != v else v for v in name)]
                    for i, c in enumerate(columns):
                        wanted = brackets.get((g, i))
                        if not wanted:
                            continue
                        v = part[c].to_numpy(dtype=float)
                        for j, lo, hi in wanted:
                            below[(g, i, j)] = below.get((g, i, j), 0) + int((v < lo).sum())
                            if lo == hi:  # a value so frequent that it fills its bracket
                                u, n = np.array([lo]), np.array([(v == lo).sum()])
                            else:
                                u, n = np.unique(v[(v >= lo) & (v <= hi)], return_counts=True)
                            rows.append((np.full(len(u), g), np.full(len(u), i), np.full(len(u), j), u, n))
                if rows:
                    yield pd.DataFrame(dict(zip("gijvn", map(np.concatenate, zip(*rows)))))
            if below:
                yield pd.DataFrame([(*k, None, n) for k, n in below.items()], columns=["g", "i", "j", "v", "n"])

        hits = source.mapInPandas(narrow, "g int, i int, j int, v double, n bigint").groupBy("g", "i", "j", "v").agg(F.sum("n").alias("n"))
        wanted = source.sparkSession.createDataFrame([(*key, t["k"], t["k1"]) for key, t in todo.items()], "g int, i int, j int, k bigint, k1 bigint")
        w = Window.partitionBy("g", "i", "j").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        cum = hits.withColumn("c", F.sum("n").over(w)).join(F.broadcast(wanted), ["g", "i", "j"])  # groups x columns x probs rows

        def at(k: str) -> Column:
            return F.max(F.when((F.col("c") - F.col("n") <= F.col(k)) & (F.col(k) < F.col("c")), F.col("v")))

        for r in cum.groupBy("g", "i", "j").agg(at("k").alias("a"), at("k1").alias("b")).collect():
            if r["a"] is not None and r["b"] is not None:
                t = todo.pop((r["g"], r["i"], r["j"]))
                result[(*groups[r["g"]], columns[r["i"]])][r["j"]] = r["a"] + (r["b"] - r["a"]) * t["f"]
        for t in todo.values():
            wider = 8 * max(t["hi"] - t["lo"], 1e-6 * max(abs(t["lo"]), abs(t["hi"])), 1e-300)
            t["lo"], t["hi"] = (t["lo"] - wider, t["hi"] + wider) if math.isfinite(wider) else (float("-inf"), float("inf"))
    return result


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> DataFrame:
    """The quantiles as rows ``(column, prob, value)``."""
    got = exact_quantiles(df, columns, probs, **kw)
    rows = [(k[-1], float(p), v) for k, vs in got.items() for p, v in zip(probs, vs)]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")
