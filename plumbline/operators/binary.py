"""Binary evaluation over ``(row_id, y, score)`` with y in {0, 1}; every metric comes from small count tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.core import bin_index, f1_of, ratio, rnd
from plumbline.operators.ordering import cut_points, exact_quantiles, running_totals, with_bucket
from plumbline.operators.relational import argmax_first
from plumbline.session import ensure_checkpoint_dir

# The 99 thresholds of the sweep.
THRESHOLDS = [float(t) for t in np.linspace(0.01, 0.99, 99)]
EPS = 2.220446049250313e-16


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return p, r, f1_of(p, r)


def apply_threshold(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add the prediction ``yhat`` (score >= threshold) and whether it is right."""
    hit = (F.col("score") >= threshold).cast("int")
    return df.withColumn("yhat", hit).withColumn("correct", F.col("yhat") == F.col("y"))


def confusion_at_threshold(df: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    pos, hit = F.col("y") == 1, F.col("score") >= threshold
    c = df.groupBy(*by).agg(
        F.count_if(pos & hit).alias("tp"), F.count_if(~pos & hit).alias("fp"),
        F.count_if(~pos & ~hit).alias("tn"), F.count_if(pos & ~hit).alias("fn"))
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(*by, "tp", "fp", "tn", "fn", rnd(p).alias("precision"), rnd(r).alias("recall"), rnd(f).alias("f1"))


def threshold_sweep(df: DataFrame, by: Sequence[str] = (), thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Counts, precision, recall and F1 at each threshold, from one pass.

    A row's slot is the number of thresholds not above its score; at most 100 slots per group remain to be
    summed from the top.
    """
    t = list(thresholds)
    slots = Bucketizer(splits=[float("-inf"), *t, float("inf")], inputCol="__s", outputCol="__slot").transform(
        df.where(F.col("score").isNotNull()).select(*by, "y", F.col("score").cast("double").alias("__s")))
    hist = slots.groupBy(*by, F.col("__slot").cast("int").alias("slot")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    grid = F.inline(F.array(*[F.struct(F.lit(i + 1).alias("slot"), F.lit(x).alias("threshold")) for i, x in enumerate(t)],
                            F.struct(F.lit(0).alias("slot"), F.lit(None).cast("double").alias("threshold"))))
    full = hist.select(*by).distinct().select(*by, grid) if by else df.sparkSession.range(1).select(grid)
    joined = full.join(hist, [*by, "slot"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.col("slot").desc())
    whole = Window.partitionBy(*(by or [F.lit(0)]))  # 100 rows per group
    c = joined.select(*by, "threshold", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                      F.sum("pos").over(whole).alias("__p"), F.sum("neg").over(whole).alias("__n"))
    c = c.where("threshold is not null").withColumns({"fn": F.col("__p") - F.col("tp"), "tn": F.col("__n") - F.col("fp")})
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(*by, "threshold", "tp", "fp", "tn", "fn", rnd(p).alias("precision"), rnd(r).alias("recall"), rnd(f).alias("f1"))


def best_f1_threshold(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The lowest threshold that reaches the highest F1."""
    return argmax_first(threshold_sweep(df, by), "f1", "threshold", by)


def best_cost_threshold(df: DataFrame, fp_cost: float, fn_cost: float, by: Sequence[str] = ()) -> DataFrame:
    """The lowest threshold with the lowest fp * fp_cost + fn * fn_cost."""
    sweep = threshold_sweep(df, by).withColumn("__gain", -(F.col("fp") * float(fp_cost) + F.col("fn") * float(fn_cost)))
    return argmax_first(sweep, "__gain", "threshold", by).select(*by, "threshold", (-F.col("__gain") + F.lit(0.0)).alias("cost"))


def score_totals(df: DataFrame, by: Sequence[str] = (), rows_per_bucket: int | None = None) -> DataFrame:
    """Per distinct score from the top: positives, negatives, their running totals, and the group totals."""
    pos = (F.col("y") == 1).cast("long")
    cum = running_totals(df.select(*by, "y", "score"), "score", {"pos": pos, "neg": 1 - pos}, by=by, descending=True,
                         rows_per_bucket=rows_per_bucket)
    if by:
        tot = df.groupBy(*by).agg(F.sum(pos).alias("n_pos"), F.sum(1 - pos).alias("n_neg"))
        return cum.join(tot, list(by))
    return cum.withColumns({"n_pos": df.agg(F.sum(pos)).scalar(), "n_neg": df.agg(F.sum(1 - pos)).scalar()})


def roc_curve(df: DataFrame, by: Sequence[str] = (), rows_per_bucket: int | None = None) -> DataFrame:
    """False and true positive rate at each distinct score used as threshold."""
    s = score_totals(df, by, rows_per_bucket)
    return s.select(*by, F.col("score").alias("threshold"), rnd(ratio(F.col("cum_neg"), F.col("n_neg"))).alias("fpr"),
                    rnd(ratio(F.col("cum_pos"), F.col("n_pos"))).alias("tpr"))


def pr_curve(df: DataFrame, by: Sequence[str] = (), rows_per_bucket: int | None = None) -> DataFrame:
    s = score_totals(df, by, rows_per_bucket)
    return s.select(*by, F.col("score").alias("threshold"),
                    rnd(ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    rnd(ratio(F.col("cum_pos"), F.col("n_pos"))).alias("recall"))


def curve_areas(df: DataFrame, by: Sequence[str] = (), rows_per_bucket: int | None = None) -> DataFrame:
    """ROC area, step-wise average precision, trapezoid PR area and the positive share, from one set of totals."""
    s = score_totals(df, by, rows_per_bucket)
    pos, neg, cp, cn = (F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg"))
    before_p, before_n = cp - pos, cn - neg
    prec = ratio(cp, cp + cn)
    prec_before = ratio(before_p, before_p + before_n, default=1.0)
    a = s.groupBy(*by).agg(
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"),
        F.sum(neg * (before_p + pos / 2)).alias("roc"), F.sum(pos * prec).alias("ap"),
        F.sum(pos * (prec + prec_before) / 2).alias("trap"))
    p, n = F.col("n_pos"), F.col("n_neg")
    return a.select(*by, rnd(ratio(F.col("roc"), p.cast("double") * n, default=None)).alias("roc_auc"),
                    rnd(ratio(F.col("ap"), p)).alias("average_precision"), rnd(ratio(F.col("trap"), p)).alias("pr_auc_trapezoid"),
                    rnd(ratio(p, p + n)).alias("positive_share"))


def roc_auc(df: DataFrame, by: Sequence[str] = (), **kw) -> DataFrame:
    return curve_areas(df, by, **kw).select(*by, "roc_auc")


def average_precision(df: DataFrame, by: Sequence[str] = (), **kw) -> DataFrame:
    return curve_areas(df, by, **kw).select(*by, "average_precision", "positive_share")


def pr_auc_trapezoid(df: DataFrame, by: Sequence[str] = (), **kw) -> DataFrame:
    return curve_areas(df, by, **kw).select(*by, "pr_auc_trapezoid")


def _loss(y: Column, score: Column) -> Column:
    p = F.least(F.greatest(score.cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    return -F.ln(F.when(y == 1, p).otherwise(1 - p))


def log_loss(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(rnd(F.avg(_loss(F.col("y"), F.col("score")))).alias("log_loss"))


def brier_score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    d = F.col("score") - F.col("y")
    return df.groupBy(*by).agg(rnd(F.avg(d * d)).alias("brier"))


def calibration_curve(df: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score against observed positive share in quantile bins; empty bins are dropped."""
    edges = exact_quantiles(df, ["score"], [i / bins for i in range(1, bins)]).get(("score",), [])
    bin_no = F.lit(0)
    for e in edges:
        if e is not None:
            bin_no = bin_no + (F.col("score") > e).cast("int")
    return df.groupBy(bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("score")).alias("mean_score"), rnd(F.avg("y")).alias("positive_share"))


def score_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins between the lowest and the highest score; empty bins are kept."""
    from plumbline.operators.profile import profile_histogram

    return profile_histogram(df, ["score"], bins).drop("column")


def metric_rows(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The headline metrics in long form ``(*by, metric, value)``."""
    a = curve_areas(df, by)
    b = df.groupBy(*by).agg(rnd(F.avg(_loss(F.col("y"), F.col("score")))).alias("log_loss"),
                            rnd(F.avg((F.col("score") - F.col("y")) ** 2)).alias("brier"))
    c = confusion_at_threshold(df, 0.5, by).select(*by, "f1")
    if by:
        wide = a.join(b, list(by)).join(c, list(by))
    else:
        wide = a.withColumns({"log_loss": b.select("log_loss").scalar(), "brier": b.select("brier").scalar(), "f1": c.select("f1").scalar()})
    names = ["roc_auc", "average_precision", "log_loss", "brier", "f1"]
    return wide.select(*by, F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))


def compare_models(df: DataFrame, models: Sequence[str], baseline: str) -> DataFrame:
    """Metric by model with the difference of each model to the baseline; ``df`` has a ``model`` column."""
    wide = metric_rows(df, ["model"]).groupBy("metric").pivot("model", list(models)).agg(F.first("value"))
    deltas = [rnd(F.col(m) - F.col(baseline)).alias(f"{m}_delta") for m in models if m != baseline]
    return wide.select("metric", *models, *deltas)


def pool_adjacent(lo: np.ndarray, hi: np.ndarray, total: np.ndarray, weight: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Blocks (lo, hi, total, weight) in rising order pooled until their means rise strictly.

    Pooling is the same whatever was pooled before, so blocks of neighbouring ranges can be pooled again together.
    """
    out: list[tuple[float, float, float, float]] = []
    for block in zip(lo.tolist(), hi.tolist(), total.tolist(), weight.tolist()):
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            first = out.pop()
            block = (first[0], block[1], first[2] + block[2], first[3] + block[3])
        out.append(block)
    return out


def isotonic_blocks(train: DataFrame, rows_per_bucket: int | None = None, fan_in: int = 8) -> DataFrame:
    """(lo, hi, total, weight): the blocks of the isotonic least-squares fit of ``y`` on ``score``; rows without either take no part.

    Rows are summed per distinct score and cut into score ranges, whose blocks are pooled in parallel; then the blocks of ``fan_in`` neighbouring
    ranges are pooled together, level by level.  Only blocks move between levels, and a pooled range shrinks to about the cube root of its scores.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    known = train.select(F.col("score").cast("double").alias("score"), F.col("y").cast("double").alias("y")).where("score is not null and y is not null and not isnan(score)")
    cuts, hot = cut_points(known, "score", rows_per_bucket)
    sums = known.groupBy("score").agg(F.sum("y").alias("total"), F.count(F.lit(1)).cast("double").alias("weight"))
    shape = "lo double, hi double, total double, weight double"
    rows = with_bucket(sums, "score", cuts, hot, "part").select(F.col("score").alias("lo"), F.col("score").alias("hi"), "total", "weight", "part")

    def pooled(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        return pd.DataFrame(pool_adjacent(*(pdf[c].to_numpy(float) for c in ("lo", "hi", "total", "weight"))), columns=["lo", "hi", "total", "weight"]).assign(part=int(pdf["part"].iloc[0]))

    blocks = rows.groupBy("part").applyInPandas(pooled, shape + ", part int").checkpoint()
    ranges = 2 * len(cuts) + 2 if cuts else 1
    while ranges > 1:
        ranges = -(-ranges // fan_in)
        blocks = blocks.withColumn("part", F.floor(F.col("part") / fan_in).cast("int")).groupBy("part").applyInPandas(pooled, shape + ", part int").checkpoint()
    return blocks.drop("part")


def recalibrate_isotonic(train: DataFrame, df: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """``df`` with ``calibrated``: the isotonic map of score to probability fitted on ``train``.

    Between two blocks the map is linear, outside it is constant; a NULL or NaN score, or an empty ``train``, gives NULL.  Each distinct score is looked up once,
    in the range of scores that it lies in; a range holds its own ends of blocks and the nearest one on either side, so nothing is collected or sent to all tasks.
    """
    blocks = isotonic_blocks(train, rows_per_bucket)
    value = (F.col("total") / F.col("weight")).alias("v")
    ends = blocks.select(F.explode(F.array("lo", "hi")).alias("x"), value).distinct()
    # NaN and infinite scores compare with no cut point
    asked = df.select(F.col("score").cast("double").alias("x")).where("x is not null and not isnan(x)").distinct()
    cuts, hot = cut_points(ends, "x", rows_per_bucket)
    ends, asked = with_bucket(ends, "x", cuts, hot, "part"), with_bucket(asked, "x", cuts, hot, "part")
    every = df.sparkSession.range(2 * len(cuts) + 2).select(F.col("id").cast("int").alias("part"))
    own = ends.groupBy("part").agg(F.min(F.struct("x", "v")).alias("first"), F.max(F.struct("x", "v")).alias("last"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")  # one row for each range, of which there are a bounded number
    sides = every.join(own, "part", "left").select(
        "part", F.last("last", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("below"), F.first("first", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("above")
    )
    ghosts = sides.select("part", F.explode(F.array("below", "above")).alias("e")).where("e is not null").select("e.x", "e.v", "part")

    def look_up(key: tuple, scores: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(scores) or not len(known):
            return pd.DataFrame({"x": scores["x"], "calibrated": np.nan})
        known = known.sort_values("x")
        return pd.DataFrame({"x": scores["x"], "calibrated": np.interp(scores["x"], known["x"], known["v"])})

    found = asked.groupBy("part").cogroup(ends.unionByName(ghosts).groupBy("part")).applyInPandas(look_up, "x double, calibrated double")
    found = found.select(F.col("x").alias("__x"), F.nanvl("calibrated", F.lit(None).cast("double")).alias("__c"))
    return df.join(found, F.col("score").cast("double") == F.col("__x"), "left").select(*[df[c] for c in df.columns if c != "calibrated"], F.col("__c").alias("calibrated"))


def recalibrate_sigmoid(train: DataFrame, df: DataFrame) -> DataFrame:
    """Sigmoid (Platt) map of score to probability, fitted on ``train``, applied to ``df``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array

    def vec(d: DataFrame) -> DataFrame:
        return d.withColumn("__f", array_to_vector(F.array(F.col("score").cast("double")))).withColumn("__y", F.col("y").cast("double"))

    model = LogisticRegression(featuresCol="__f", labelCol="__y", probabilityCol="__p", rawPredictionCol="__r", predictionCol="__o").fit(vec(train))
    return model.transform(vec(df)).withColumn("calibrated", vector_to_array("__p")[1]).drop("__f", "__y", "__p", "__r", "__o")
