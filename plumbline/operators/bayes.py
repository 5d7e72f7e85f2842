"""Beta-Binomial summaries per group, and trends.

All of it is closed form or a fixed grid evaluated inside the group's own row, so the only shuffle is the
count of successes per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.core import rnd

GRID = 1000


def beta_posterior(df: DataFrame, by: Sequence[str], outcome: Column, alpha: float = 1.0, beta: float = 1.0, digits: int | None = 6) -> DataFrame:
    """Per group: n, k, and the posterior Beta(alpha + k, beta + n - k) with its mean and standard deviation."""
    g = df.groupBy(*by).agg(F.count(outcome).alias("n"), F.coalesce(F.sum(outcome.cast("int")), F.lit(0)).alias("k"))
    a, b = F.col("k") + F.lit(float(alpha)), F.col("n") - F.col("k") + F.lit(float(beta))
    g = g.withColumns({"a": a, "b": b})
    mean = F.col("a") / (F.col("a") + F.col("b"))
    sd = F.sqrt(F.col("a") * F.col("b") / ((F.col("a") + F.col("b")) * (F.col("a") + F.col("b")) * (F.col("a") + F.col("b") + 1)))
    show = (lambda x: rnd(x, digits)) if digits is not None else (lambda x: x)
    return g.select(*by, "n", "k", "a", "b", show(mean).alias("mean"), show(sd).alias("sd"))


def _with_grid(post: DataFrame, cells: int) -> DataFrame:
    """Add grid points within 20 standard deviations of the mean and their normalised mass."""
    mean, sd = F.col("mean"), F.col("sd")
    low, high = F.greatest(mean - 20 * sd, F.lit(0.0)), F.least(mean + 20 * sd, F.lit(1.0))
    d = post.withColumns({"__lo": low, "__step": (high - low) / cells})
    d = d.withColumn("__x", F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda i: F.col("__lo") + (i + 0.5) * F.col("__step")))
    # The density at the mean keeps the exponentials in range.  Scalars are used inside the element functions
    # below only where they are cheap: anything that walks the array again there would be quadratic.
    top = (F.col("a") - 1) * F.ln(mean) + (F.col("b") - 1) * F.ln(1 - mean)
    return d.withColumn("__w", F.transform("__x", lambda x: F.exp((F.col("a") - 1) * F.ln(x) + (F.col("b") - 1) * F.ln(1 - x) - top)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def prob_within(df: DataFrame, by: Sequence[str], outcome: Column, low: float, high: float, cells: int = GRID) -> DataFrame:
    """P(low <= p <= high) under the flat-prior posterior of each group."""
    d = _with_grid(beta_posterior(df, by, outcome, digits=None), cells)
    inside = F.zip_with("__x", "__w", lambda x, w: F.when((x >= low) & (x <= high), w).otherwise(F.lit(0.0)))
    return d.select(*by, "n", "k", rnd(_sum(inside) / _sum(F.col("__w"))).alias("prob_within"))


def hdi_interval(df: DataFrame, by: Sequence[str], outcome: Column, mass: float = 0.94, cells: int = GRID) -> DataFrame:
    """Highest-density interval: the densest grid cells that together reach ``mass``."""
    d = _with_grid(beta_posterior(df, by, outcome, digits=None), cells)
    pairs = F.reverse(F.sort_array(F.zip_with("__w", "__x", lambda w, x: F.struct(w.alias("w"), (-x).alias("x")))))
    goal = F.lit(mass) * _sum(F.col("__w"))
    start = F.struct(F.lit(0.0).alias("s"), F.lit(2.0).alias("lo"), F.lit(-1.0).alias("hi"), goal.alias("goal"))

    def step(acc: Column, p: Column) -> Column:
        return F.when(acc["s"] >= acc["goal"], acc).otherwise(F.struct(
            (acc["s"] + p["w"]).alias("s"), F.least(acc["lo"], -p["x"]).alias("lo"), F.greatest(acc["hi"], -p["x"]).alias("hi"), acc["goal"].alias("goal")))

    d = d.withColumn("__h", F.aggregate(pairs, start, step))
    half = F.col("__step") / 2
    return d.select(*by, "n", "k", rnd(F.col("__h.lo") - half).alias("hdi_low"), rnd(F.col("__h.hi") + half).alias("hdi_high"))


def recovery_error(estimates: DataFrame, truth: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distance of each estimate to the known truth, and whether the interval holds it."""
    return estimates.join(truth, list(by)).select(
        *by, rnd(F.abs(F.col("estimate") - F.col("truth"))).alias("error"), ((F.col("truth") >= F.col("low")) & (F.col("truth") <= F.col("high"))).alias("inside"))


def drift_slope(df: DataFrame, by: Sequence[str], index: str, outcome: str) -> DataFrame:
    """Linear trend of the outcome on its index per group."""
    y, x = F.col(outcome).cast("double"), F.col(index).cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), rnd(F.regr_slope(y, x), 8).alias("slope"), rnd(F.regr_intercept(y, x)).alias("intercept"))
