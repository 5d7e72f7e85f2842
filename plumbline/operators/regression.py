"""Regression evaluation over ``(row_id, y, yhat, lo, hi)`` and conformal intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.core import bin_index, ratio, rnd
from plumbline.operators.ordering import exact_quantiles
from plumbline.operators.profile import column_ranges, profile_histogram


def regression_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 in one pass."""
    e = F.col("y") - F.col("yhat")
    a = df.groupBy(*by).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop("y").alias("v"))
    return a.select(*by, rnd(F.sqrt("mse")).alias("rmse"), rnd(F.col("mae")).alias("mae"),
                    rnd(1 - F.try_divide(F.col("mse"), F.col("v"))).alias("r2"))


def rmse_above_floor(df: DataFrame, noise_std: float) -> DataFrame:
    e = F.col("y") - F.col("yhat")
    return df.agg(F.sqrt(F.avg(e * e)).alias("r")).select(rnd(F.col("r")).alias("rmse"), rnd(F.col("r") - noise_std).alias("rmse_above_floor"))


def residuals(df: DataFrame) -> DataFrame:
    return df.withColumn("residual", F.col("y") - F.col("yhat"))


def residual_table(df: DataFrame, bins: int = 20) -> DataFrame:
    """Mean and spread of the residual by predicted value: a funnel or a curve shows here."""
    lo, hi = column_ranges(df, ["yhat"])["yhat"]
    return residuals(df).groupBy(bin_index(F.col("yhat"), lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("residual")).alias("mean_residual"), rnd(F.stddev_samp("residual")).alias("std_residual"))


def residual_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    """Residual density per bin and the normal density (population std) at the bin centre."""
    r = residuals(df).select("residual")
    s = r.agg(F.count("residual").alias("n"), F.avg("residual").alias("m"), F.stddev_pop("residual").alias("s"),
              F.min("residual").alias("lo"), F.max("residual").alias("hi")).first()
    width = (s["hi"] - s["lo"]) / bins or 1.0 / bins
    h = profile_histogram(r, ["residual"], bins)
    centre = F.lit(s["lo"]) + (F.col("bin") + 0.5) * width
    z = (centre - s["m"]) / s["s"] if s["s"] else F.lit(None).cast("double")
    normal = F.exp(-z * z / 2) / (s["s"] * math.sqrt(2 * math.pi)) if s["s"] else F.lit(None).cast("double")
    return h.select("bin", "n", rnd(F.col("n") / (s["n"] * width)).alias("density"), rnd(normal).alias("normal_density"))


def qq_points(df: DataFrame, levels: int = 99) -> DataFrame:
    """Residual quantiles at evenly spaced levels against standard normal quantiles (a fixed grid replaces one point per row)."""
    from statistics import NormalDist

    probs = [i / (levels + 1) for i in range(1, levels + 1)]
    q = exact_quantiles(residuals(df).select("residual"), ["residual"], probs)[("residual",)]
    rows = [(p, NormalDist().inv_cdf(p), v) for p, v in zip(probs, q)]
    out = df.sparkSession.createDataFrame(rows, "level double, normal double, residual double")
    return out.select(rnd(F.col("level")).alias("level"), rnd(F.col("normal")).alias("normal"), rnd(F.col("residual")).alias("residual"))


def conformal_scores(df: DataFrame) -> DataFrame:
    """Signed distance outside the interval: max(lo - y, y - hi)."""
    return df.withColumn("conformity", F.greatest(F.col("lo") - F.col("y"), F.col("y") - F.col("hi")))


def conformal_q(calibration: DataFrame, coverage: float) -> float:
    """The quantile of the conformity scores at min(1, ceil(coverage * (n + 1)) / n)."""
    s = conformal_scores(calibration).select("conformity")
    n = s.count()
    if not n:
        raise ValueError("empty calibration set")
    level = min(1.0, math.ceil(coverage * (n + 1)) / n)
    return exact_quantiles(s, ["conformity"], [level])[("conformity",)][0]


def conformal_intervals(df: DataFrame, q: float) -> DataFrame:
    """Widen (or narrow) both ends by q."""
    return df.withColumns({"lo_cal": F.col("lo") - q, "hi_cal": F.col("hi") + q})


def interval_coverage(df: DataFrame, q: float, nominal: float) -> DataFrame:
    """Raw and calibrated coverage, distance to nominal and mean width."""
    d = conformal_intervals(df, q)

    def inside(lo: str, hi: str) -> Column:
        return F.avg(((F.col("y") >= F.col(lo)) & (F.col("y") <= F.col(hi))).cast("int"))

    a = d.agg(inside("lo", "hi").alias("raw"), inside("lo_cal", "hi_cal").alias("cal"),
              F.avg(F.col("hi") - F.col("lo")).alias("w_raw"), F.avg(F.col("hi_cal") - F.col("lo_cal")).alias("w_cal"))
    return a.select(rnd(F.col("raw")).alias("coverage_raw"), rnd(F.col("cal")).alias("coverage_conformal"),
                    rnd(F.abs(F.col("raw") - nominal)).alias("coverage_error_raw"), rnd(F.abs(F.col("cal") - nominal)).alias("coverage_error_conformal"),
                    rnd(F.col("w_raw"), 4).alias("interval_width_raw"), rnd(F.col("w_cal"), 4).alias("interval_width_conformal"))


def interval_rows(df: DataFrame, q: float) -> DataFrame:
    d = conformal_intervals(df, q)
    return d.select("row_id", rnd(F.col("yhat"), 4).alias("point"), rnd(F.col("lo_cal"), 4).alias("low"), rnd(F.col("hi_cal"), 4).alias("high"),
                    ((F.col("y") >= F.col("lo_cal")) & (F.col("y") <= F.col("hi_cal"))).alias("inside"))
