"""Multilabel evaluation over long rows ``(row_id, label, y, yhat)``, or wide 0/1 columns where rows stay whole."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.core import agg_per_column, f1_of, ratio, rnd
from plumbline.operators.binary import best_f1_threshold


def to_long(df: DataFrame, row_id: str, labels: Sequence[str], y: str = "y_", yhat: str = "yhat_") -> DataFrame:
    cells = [F.struct(F.lit(n).alias("label"), F.col(f"{y}{n}").alias("y"), F.col(f"{yhat}{n}").alias("yhat")) for n in labels]
    return df.select(row_id, F.inline(F.array(*cells)))


def label_positive_rate(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.sum("y").alias("n_pos"), rnd(F.avg("y")).alias("share"))


def label_cooccurrence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P(j on | i on) for wide 0/1 columns; 0 where i is never on."""
    names = list(columns)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The 0/1 columns' matrix product counts every pair of a task's rows at once."""
        both = np.zeros((len(names), len(names)))
        for pdf in batches:
            x = (pdf[names].to_numpy(dtype=float) == 1).astype(float)
            both += x.T @ x
        i, j = np.indices(both.shape).reshape(2, -1)
        yield pd.DataFrame({"i": i, "j": j, "n": both.ravel().astype("int64")})

    pairs = df.select(*names).mapInPandas(products, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("both"))
    single = pairs.where("i = j").select("i", F.col("both").alias("n_i"))
    label = F.array(*[F.lit(c) for c in names])
    return pairs.join(single, "i").select(
        F.get(label, F.col("i")).alias("label_i"), F.get(label, F.col("j")).alias("label_j"), rnd(ratio(F.col("both"), F.col("n_i"))).alias("p_j_given_i"))


def cooccurrence_lift(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P(j|i) / P(j) for pairs of different labels: far from 1 means dependent labels."""
    cond = label_cooccurrence(df, columns).where("label_i <> label_j")
    base = agg_per_column(df, {c: {"p": F.avg(F.col(c).cast("double"))} for c in columns}, key="label_j")
    return cond.join(base, "label_j").select("label_i", "label_j", rnd(ratio(F.col("p_j_given_i"), F.col("p")), 4).alias("lift"))


def hamming_loss(df: DataFrame) -> DataFrame:
    return df.agg(rnd(F.avg((F.col("y") != F.col("yhat")).cast("int"))).alias("hamming_loss"))


def _per_row(df: DataFrame) -> DataFrame:
    y, p = F.col("y") == 1, F.col("yhat") == 1
    return df.groupBy("row_id").agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))


def subset_accuracy(df: DataFrame) -> DataFrame:
    """Share of rows with every label right."""
    return _per_row(df).agg(rnd(F.avg(((F.col("fp") == 0) & (F.col("fn") == 0)).cast("int"))).alias("subset_accuracy"))


def per_label_prf(df: DataFrame, digits: int | None = 6) -> DataFrame:
    y, p = F.col("y") == 1, F.col("yhat") == 1
    c = df.groupBy("label").agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))
    prec, rec = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    show = (lambda x: rnd(x, digits)) if digits is not None else (lambda x: x)
    return c.select("label", "tp", "fp", "fn", show(prec).alias("precision"), show(rec).alias("recall"), show(f1_of(prec, rec)).alias("f1"),
                    (F.col("tp") + F.col("fn")).alias("support"))


def ml_f1_averages(df: DataFrame) -> DataFrame:
    """Macro, micro, weighted and per-row (samples) F1."""
    a = per_label_prf(df, digits=None).agg(
        rnd(F.avg("f1")).alias("f1_macro"),
        rnd(ratio(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("fp") + F.sum("fn"))).alias("f1_micro"),
        rnd(ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support"))).alias("f1_weighted"))
    f = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    samples = _per_row(df).agg(rnd(F.avg(f))).scalar()
    return a.withColumn("f1_samples", samples)


def label_cardinality(df: DataFrame) -> DataFrame:
    """Mean labels per row, true and predicted, and density."""
    r = df.groupBy("row_id").agg(F.sum("y").alias("t"), F.sum("yhat").alias("p"), F.count(F.lit(1)).alias("k"))
    return r.agg(rnd(F.avg("t")).alias("cardinality_true"), rnd(F.avg("p")).alias("cardinality_pred"),
                 rnd(ratio(F.sum("t"), F.sum("k"))).alias("density_true"), rnd(ratio(F.sum("p"), F.sum("k"))).alias("density_pred"))


def label_cardinality_histogram(df: DataFrame) -> DataFrame:
    """Rows by number of labels on, true and predicted."""
    r = df.groupBy("row_id").agg(F.sum("y").alias("t"), F.sum("yhat").alias("p"))
    e = r.select(F.inline(F.array(F.struct(F.lit("true").alias("side"), F.col("t").alias("n_labels")),
                                  F.struct(F.lit("pred").alias("side"), F.col("p").alias("n_labels")))))
    return e.groupBy("side", "n_labels").agg(F.count(F.lit(1)).alias("n"))


def per_label_thresholds(df: DataFrame) -> DataFrame:
    """Best F1 threshold of each label; ``df`` has ``(label, y, score)``."""
    return best_f1_threshold(df, ["label"])
