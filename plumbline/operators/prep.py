"""Preparation: imputing, scaling, encoding, splitting and weighting.

Statistics that are one number per column are collected and used as literals, so applying them needs no join.
Per-value statistics stay tables and are joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.core import as_number, h32, hash_bucket, ratio, rnd, unit
from plumbline.operators.ordering import exact_quantiles, rank_rows


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[as_number(df, c).cast("double").alias(c) for c in columns])


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    q = exact_quantiles(_doubles(df, columns), columns, [0.5])
    return df.withColumns({c: F.coalesce(as_number(df, c).cast("double"), F.lit(q[(c,)][0])) for c in columns})


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the most frequent value; of equals the smallest."""
    fills = {}
    for c in columns:
        top = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(c)).first()
        if top is not None:
            fills[c] = F.coalesce(F.col(c), F.lit(top[c]))
    return df.withColumns(fills) if fills else df


def impute_sentinel(df: DataFrame, columns: Sequence[str], value: str = "missing") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    row = _doubles(df, columns).agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(columns)
                                      for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    out = {}
    for i, c in enumerate(columns):
        s = row[f"s{i}"] or 1.0
        out[c] = (as_number(df, c).cast("double") - F.lit(row[f"m{i}"])) / F.lit(s)
    return df.withColumns(out)


def one_hot(df: DataFrame, column: str, categories: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per category of the fit; an unseen or missing value is all zeros.

    Without ``categories`` the column's own values are listed, as each becomes a column; ``one_hot_sparse`` has one vector column instead.
    """
    if categories is None:
        categories = sorted(r[column] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in categories})


def one_hot_sparse(df: DataFrame, column: str) -> DataFrame:
    """``<column>_onehot``: a sparse vector with one place per category, all zeros for a missing value; for any number of categories."""
    index = StringIndexer(inputCol=column, outputCol="__i", handleInvalid="keep", stringOrderType="alphabetAsc").fit(df.where(F.col(column).isNotNull()))
    coded = index.transform(df)
    return OneHotEncoder(inputCol="__i", outputCol=f"{column}_onehot", dropLast=True).fit(coded).transform(coded).drop("__i")


def encode_frequency(df: DataFrame, column: str) -> DataFrame:
    """Share of rows holding the same value."""
    total = df.agg(F.count(column)).scalar()
    freq = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    freq = freq.select(column, ratio(F.col("__n"), total).alias(f"{column}_freq"))
    return df.join(freq, column, "left")


def encode_target(df: DataFrame, column: str, target: str, fold: str, smoothing: float = 10.0) -> DataFrame:
    """Smoothed target mean of the value, taken from the other folds only."""
    cells = df.groupBy(column, fold).agg(F.sum(target).cast("double").alias("s"), F.count(target).cast("double").alias("n"))
    whole = cells.groupBy(F.col(column).alias("__wk")).agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    folds = cells.groupBy(F.col(fold).alias("__wf")).agg(F.sum("s").alias("fs"), F.sum("n").alias("fn"))
    total = cells.agg(F.struct(F.sum("s").alias("s"), F.sum("n").alias("n"))).scalar()
    prior = ratio(total["s"] - F.col("fs"), total["n"] - F.col("fn"))
    value = (F.col("all_s") - F.col("s") + smoothing * prior) / (F.col("all_n") - F.col("n") + smoothing)
    enc = (cells.join(whole, F.col(column).eqNullSafe(F.col("__wk"))).join(folds, F.col(fold) == F.col("__wf"))
           .select(F.col(column).alias("__k"), F.col(fold).alias("__f"), value.alias(f"{column}_target")))
    return df.join(enc, F.col(column).eqNullSafe(F.col("__k")) & (F.col(fold) == F.col("__f")), "left").drop("__k", "__f")


def encode_hash(df: DataFrame, column: str, buckets: int) -> DataFrame:
    return df.withColumn(f"{column}_hash", F.when(F.col(column).isNotNull(), hash_bucket(buckets, column)))


def transform_log(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """log(1 + x) for x > -1, else NULL."""
    return df.withColumns({c: F.log1p(F.when(as_number(df, c) > -1, as_number(df, c).cast("double"))) for c in columns})


def winsorize(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    q = exact_quantiles(_doubles(df, columns), columns, [low, high])
    return df.withColumns({c: F.when(as_number(df, c).isNotNull(), F.least(F.greatest(as_number(df, c).cast("double"), F.lit(q[(c,)][0])), F.lit(q[(c,)][1])))
                           for c in columns})


def robust_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - median) / IQR; a zero IQR divides by 1."""
    q = exact_quantiles(_doubles(df, columns), columns, [0.25, 0.5, 0.75])
    return df.withColumns({c: (as_number(df, c).cast("double") - F.lit(q[(c,)][1])) / F.lit((q[(c,)][2] - q[(c,)][0]) or 1.0) if q[(c,)][1] is not None else F.lit(None).cast("double") for c in columns})


def box_cox_grid(df: DataFrame, column: str, lambdas: Sequence[float]) -> DataFrame:
    """Box-Cox log likelihood of each power over the positive values, from one pass."""
    x = F.when(F.col(column) > 0, F.col(column).cast("double"))

    def power(lam: float) -> Column:
        return F.ln(x) if lam == 0 else (F.pow(x, F.lit(float(lam))) - 1) / lam

    row = df.agg(F.count(x).alias("n"), F.sum(F.ln(x)).alias("sl"), *[F.var_pop(power(v)).alias(f"v{i}") for i, v in enumerate(lambdas)])
    cells = [F.struct(F.lit(float(v)).alias("lam"), ((v - 1) * F.col("sl") - F.col("n") / 2 * F.ln(f"v{i}")).alias("llf")) for i, v in enumerate(lambdas)]
    return row.select(F.inline(F.array(*cells))).select("lam", rnd(F.col("llf"), 2).alias("llf"))


def drop_flagged(df: DataFrame, findings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop leaking and near-constant columns and the second column of each redundant pair."""
    rows = findings.where(F.col("issue").isin("target leakage", "near constant", "redundant pair")).select("issue", "feature").collect()
    out = {r["feature"].split(" <-> ")[-1] for r in rows}  # a few names, bounded by the schema
    return df.drop(*sorted(out - set(keep)))


def split_stratified(df: DataFrame, row_id: str, label: str, test_share: float, rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``split``: in every class the first round(n * test_share) rows by hash are test, the rest train."""
    h = df.withColumn("__h", h32(F.lit("split"), row_id))
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one per class
    ranked = rank_rows(h, "__h", row_id, by=[label], name="__r", rows_per_bucket=rows_per_bucket)
    cut = F.lit(0)
    for value, n in sizes.items():
        cut = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(int(math.floor(n * test_share + 0.5)))).otherwise(cut)
    return ranked.withColumn("split", F.when(F.col("__r") <= cut, "test").otherwise("train")).drop("__h", "__r")


def split_three_way(df: DataFrame, row_id: str, calibration: float = 0.2, test: float = 0.2) -> DataFrame:
    """Add ``split`` train / calibration / test by hash ranges: no shuffle."""
    u = unit(F.lit("three"), row_id)
    return df.withColumn("split", F.when(u < test, "test").when(u < test + calibration, "calibration").otherwise("train"))


def dedupe_across_split(df: DataFrame, content: Sequence[str], test_share: float) -> DataFrame:
    """Add ``split`` from the hash of the row content, so equal rows are always on the same side."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in content]
    return df.withColumn("split", F.when(unit(*cells) < test_share, "test").otherwise("train"))


def fold_assign(df: DataFrame, row_id: str, k: int = 5, label: str | None = None, rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``fold`` 0..k-1: by hash, or dealt out in hash order inside each class."""
    if label is None:
        return df.withColumn("fold", hash_bucket(k, row_id))
    h = df.withColumn("__h", h32(row_id))
    ranked = rank_rows(h, "__h", row_id, by=[label], name="__r", rows_per_bucket=rows_per_bucket)
    return ranked.withColumn("fold", F.pmod(F.col("__r") - 1, F.lit(k)).cast("int")).drop("__h", "__r")


def class_weights_balanced(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = n / (classes * rows of the class)."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one per class
    total, k = sum(sizes.values()), len(sizes)
    w = F.lit(None).cast("double")
    for value, n in sizes.items():
        w = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(total / (k * n))).otherwise(w)
    return df.withColumn("weight", w)


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive; 1 when there are no positives."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg")).select(
        "n_pos", "n_neg", rnd(ratio(F.col("n_neg"), F.col("n_pos"), default=1.0)).alias("scale_pos_weight"))
