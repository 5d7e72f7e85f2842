"""Rates per user, and trends."""

from pyspark.sql import functions as F

from plumbline.functions.core import rnd
from plumbline.operators import bayes
from plumbline.plans.registry import R, query, table

C = F.col
BY = ["user_id"]
POST = """po AS (SELECT user_id, n, k, k + 1.0::DOUBLE AS a, n - k + 1.0::DOUBLE AS b FROM (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS k FROM events GROUP BY 1)),
ms AS (SELECT *, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd FROM po),
gr AS (SELECT *, greatest(mean - 20 * sd, 0.0::DOUBLE) AS lo, (least(mean + 20 * sd, 1.0::DOUBLE) - greatest(mean - 20 * sd, 0.0::DOUBLE)) / 1000 AS step FROM ms),
pt AS (SELECT user_id, n, k, step, x, (a - 1) * ln(x) + (b - 1) * ln(1 - x) AS l FROM (SELECT *, lo + (i + 0.5::DOUBLE) * step AS x FROM gr, range(1000) t(i))),
wt AS (SELECT *, exp(l - max(l) OVER (PARTITION BY user_id)) AS w FROM pt), nm AS (SELECT *, w / sum(w) OVER (PARTITION BY user_id) AS m FROM wt)"""


def bought(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_id", (C("event_type") == "purchase").alias("hit"))


@query("beta_posterior", f"WITH {POST} SELECT user_id, n, k, a, b, {R('mean')} AS mean, {R('sd')} AS sd FROM ms")
def _(spark, sf):
    return bayes.beta_posterior(bought(spark, sf), BY, C("hit"))


@query("prob_within", f"WITH {POST} SELECT user_id, any_value(n) AS n, any_value(k) AS k, {R('coalesce(sum(m) FILTER (x >= 0.15 AND x <= 0.25), 0)')} AS prob_within FROM nm GROUP BY 1")
def _(spark, sf):
    return bayes.prob_within(bought(spark, sf), BY, C("hit"), 0.15, 0.25)


HDI = """hd AS (SELECT *, sum(m) OVER (PARTITION BY user_id ORDER BY m DESC, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM nm)"""


@query("hdi_interval", f"WITH {POST}, {HDI} SELECT user_id, any_value(n) AS n, any_value(k) AS k, {R('min(x) - any_value(step) / 2')} AS hdi_low, {R('max(x) + any_value(step) / 2')} AS hdi_high FROM hd WHERE coalesce(before, 0) < 0.94 GROUP BY 1")
def _(spark, sf):
    return bayes.hdi_interval(bought(spark, sf), BY, C("hit"))


@query("recovery_error", f"WITH {POST} SELECT user_id, {R('abs(mean - 0.2)')} AS error, 0.2 >= mean - 2 * sd AND 0.2 <= mean + 2 * sd AS inside FROM ms")
def _(spark, sf):
    p = bayes.beta_posterior(bought(spark, sf), BY, C("hit"), digits=None)
    est = p.select("user_id", C("mean").alias("estimate"), (C("mean") - 2 * C("sd")).alias("low"), (C("mean") + 2 * C("sd")).alias("high"))
    truth = table(spark, sf, "events").select("user_id").distinct().withColumn("truth", F.lit(0.2))
    return bayes.recovery_error(est, truth, BY)


@query("drift_slope", f"SELECT user_id, count(*) AS n, {R('regr_slope((event_type = ' + chr(39) + 'purchase' + chr(39) + ')::INT, event_id)', 8)} AS slope, {R('regr_intercept((event_type = ' + chr(39) + 'purchase' + chr(39) + ')::INT, event_id)')} AS intercept FROM events GROUP BY 1")
def _(spark, sf):
    return bayes.drift_slope(bought(spark, sf).withColumn("y", C("hit").cast("int")), BY, "event_id", "y")
