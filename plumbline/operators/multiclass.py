"""Multiclass evaluation over ``(row_id, y, yhat, probs)``; all class tables come from the confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.core import f1_of, ratio, rnd
from plumbline.operators.binary import EPS, curve_areas, roc_curve


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(rnd(F.avg((F.col("y") == F.col("yhat")).cast("int"))).alias("accuracy"))


def _counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "y", "yhat").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, labels: Sequence | None = None) -> DataFrame:
    """Counts for every (true, predicted) pair of ``labels`` or of the classes seen on either side."""
    counts = _counts(df)
    if labels is None:
        seen = counts.select(F.explode(F.array("y", "yhat")).alias("c")).distinct()
        labels = sorted(r["c"] for r in seen.collect())  # one value per class
    dtype = df.schema["y"].dataType.simpleString()
    grid = df.sparkSession.createDataFrame([(a, b) for a in labels for b in labels], f"y {dtype}, yhat {dtype}")
    return grid.join(counts, ["y", "yhat"], "left").select("y", "yhat", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_matrix_norm(df: DataFrame, labels: Sequence | None = None) -> DataFrame:
    """Row shares; an empty row gives 0."""
    m = confusion_matrix(df, labels)
    rows = m.groupBy("y").agg(F.greatest(F.sum("n"), F.lit(1)).alias("t"))
    return m.join(rows, "y").select("y", "yhat", rnd(F.col("n") / F.col("t")).alias("share"))


def per_class_prf(df: DataFrame, by: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """precision, recall, F1 and support per class, over the union of true and predicted classes."""
    c = _counts(df, by)
    hit = F.col("y") == F.col("yhat")
    sides = c.select(*by, "n", hit.cast("long").alias("hit"), F.inline(F.array(
        F.struct(F.col("y").alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p")),
        F.struct(F.col("yhat").alias("class"), F.lit(0).alias("t"), F.lit(1).alias("p")))))
    a = sides.groupBy(*by, "class").agg(
        F.sum(F.col("n") * F.col("t") * F.col("hit")).alias("tp"), F.sum(F.col("n") * F.col("t")).alias("support"),
        F.sum(F.col("n") * F.col("p")).alias("predicted"))
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    show = (lambda x: rnd(x, digits)) if digits is not None else (lambda x: x)
    return a.select(*by, "class", "tp", "predicted", "support", show(p).alias("precision"), show(r).alias("recall"), show(f1_of(p, r)).alias("f1"))


def f1_averages(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    c = per_class_prf(df, by, digits=None)
    micro = ratio(F.sum("tp"), F.sum("support"))
    return c.groupBy(*by).agg(
        rnd(F.avg("f1")).alias("f1_macro"), rnd(micro).alias("f1_micro"),
        rnd(ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support"))).alias("f1_weighted"))


def classification_report(df: DataFrame) -> DataFrame:
    """Per class rows, then accuracy, macro and weighted averages, in one table."""
    c = per_class_prf(df, digits=None)
    rows = c.select(F.col("class").cast("string").alias("row"), rnd(F.col("precision")).alias("precision"),
                    rnd(F.col("recall")).alias("recall"), rnd(F.col("f1")).alias("f1"), "support")
    n = F.sum("support")

    def weighted(x: str) -> Column:
        return rnd(ratio(F.sum(F.col(x) * F.col("support")), F.sum("support"))).alias(x)

    acc = rnd(ratio(F.sum("tp"), F.sum("support")))
    return (rows.unionByName(c.agg(F.lit("accuracy").alias("row"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), n.alias("support")))
            .unionByName(c.agg(F.lit("macro avg").alias("row"), *[rnd(F.avg(x)).alias(x) for x in ("precision", "recall", "f1")], n.alias("support")))
            .unionByName(c.agg(F.lit("weighted avg").alias("row"), *[weighted(x) for x in ("precision", "recall", "f1")], n.alias("support"))))


def multiclass_log_loss(df: DataFrame) -> DataFrame:
    p = F.col("probs")[F.col("y").cast("int")].cast("double")
    return df.agg(rnd(F.avg(-F.ln(F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS))))).alias("log_loss"))


def top_k_accuracy(df: DataFrame, k: int) -> DataFrame:
    """Share of rows whose true class is among the k most probable; of equal scores the higher class index ranks first."""
    own = F.col("probs")[F.col("y").cast("int")]
    ahead = F.size(F.filter(
        F.transform("probs", lambda p, i: F.struct(p.alias("p"), i.alias("i"))),
        lambda e: (e["p"] > own) | ((e["p"] == own) & (e["i"] > F.col("y")))))
    return df.agg(rnd(F.avg((ahead < k).cast("int"))).alias("top_k_accuracy")).withColumn("k", F.lit(k))


def one_vs_rest(df: DataFrame) -> DataFrame:
    """Long form ``(row_id, class, y, score)``: one binary problem per class."""
    e = df.select("row_id", F.col("y").alias("__y"), F.posexplode("probs").alias("class", "score"))
    return e.select("row_id", "class", (F.col("__y") == F.col("class")).cast("int").alias("y"), "score")


def roc_ovr(df: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """One-vs-rest ROC area, average precision and positive share per class."""
    return curve_areas(one_vs_rest(df), ["class"], rows_per_bucket)


def roc_ovr_curve(df: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    return roc_curve(one_vs_rest(df), ["class"], rows_per_bucket)


def most_confused(df: DataFrame, top: int = 10) -> DataFrame:
    """Off-diagonal pairs with the largest share of the true class."""
    m = confusion_matrix_norm(df).where("y <> yhat and share > 0")
    return m.orderBy(F.col("share").desc(), "y", "yhat").limit(top)
