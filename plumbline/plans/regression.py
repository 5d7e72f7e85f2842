"""Regression evaluation queries over lineitem prices."""

from statistics import NormalDist

from pyspark.sql import functions as F

from plumbline.functions.core import rnd, unit
from plumbline.operators import regression as ev
from plumbline.plans.fixtures import PREDICTED, predicted, predicted_table
from plumbline.plans.registry import R, U, key, query

W = f"WITH {PREDICTED}"
CAL = f"{U(key(chr(39) + 'cal' + chr(39), 'row_id'))} < 0.5"
CONF = f"""conf AS (SELECT greatest(lo - y, y - hi) AS e FROM predicted WHERE {CAL}), nn AS (SELECT count(*) AS n, least(1.0::DOUBLE, ceil(0.9::DOUBLE * (count(*) + 1)) / count(*)) AS lv FROM conf),
ranked AS (SELECT e, row_number() OVER (ORDER BY e) - 1 AS k FROM conf),
pos AS (SELECT lv * (n - 1) AS h FROM nn), q AS (SELECT a.e + (b.e - a.e) * (h - floor(h)) AS q FROM pos JOIN ranked a ON a.k = floor(h) JOIN ranked b ON b.k = ceil(h))"""


def calib(df):
    return df.where(unit(F.lit("cal"), "row_id") < 0.5)


def test(df):
    return df.where(unit(F.lit("cal"), "row_id") >= 0.5)


@query("regression_metrics", f"{W} SELECT {R('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, {R('avg(abs(y - yhat))')} AS mae, {R('1 - avg((y - yhat) * (y - yhat)) / var_pop(y)')} AS r2 FROM predicted")
def _(spark, sf):
    return ev.regression_metrics(predicted(spark, sf))


@query("rmse_above_floor", f"{W} SELECT {R('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, {R('sqrt(avg((y - yhat) * (y - yhat))) - 1')} AS rmse_above_floor FROM predicted")
def _(spark, sf):
    return ev.rmse_above_floor(predicted(spark, sf), 1.0)


@query("residual_table", f"{W}, r AS (SELECT min(yhat) AS a, max(yhat) AS b FROM predicted) SELECT least(floor((yhat - a) / (b - a) * 20)::INT, 19) AS bin, count(*) AS n, {R('avg(y - yhat)')} AS mean_residual, {R('stddev_samp(y - yhat)')} AS std_residual FROM predicted, r GROUP BY 1")
def _(spark, sf):
    return ev.residual_table(predicted(spark, sf))


@query("residual_histogram", f"""{W}, s AS (SELECT count(*) AS t, avg(y - yhat) AS m, stddev_pop(y - yhat) AS s, min(y - yhat) AS rl, (max(y - yhat) - min(y - yhat)) / 40 AS w FROM predicted),
h AS (SELECT least(floor((y - yhat - rl) / (s.w * 40) * 40)::INT, 39) AS bin, count(*) AS n FROM predicted, s GROUP BY 1)
SELECT b.i::INT AS bin, coalesce(n, 0) AS n, {R('coalesce(n, 0) / (t * s.w)')} AS density, {R('exp(-(((rl + (b.i + 0.5) * s.w - m) / s.s) ** 2) / 2) / (s.s * sqrt(2 * pi()))')} AS normal_density FROM range(40) b(i) CROSS JOIN s LEFT JOIN h ON h.bin = b.i""")
def _(spark, sf):
    return ev.residual_histogram(predicted_table(spark, sf))


@query("qq_points", f"{W} " + " UNION ALL ".join(f"SELECT {R(f'{i / 100}')} AS level, {R(repr(NormalDist().inv_cdf(i / 100)))} AS normal, {R(f'quantile_cont(y - yhat, {i / 100})')} AS residual FROM predicted" for i in range(1, 100)))
def _(spark, sf):
    return ev.qq_points(predicted_table(spark, sf))


@query("conformal_scores", f"{W} SELECT row_id, {R('greatest(lo - y, y - hi)')} AS conformity FROM predicted")
def _(spark, sf):
    return ev.conformal_scores(predicted(spark, sf)).select("row_id", rnd(F.col("conformity")).alias("conformity"))


@query("conformal_q", f"{W}, {CONF} SELECT n, {R('q')} AS q FROM nn, q")
def _(spark, sf):
    c = calib(predicted_table(spark, sf))
    return c.agg(F.count(F.lit(1)).alias("n")).withColumn("q", rnd(F.lit(ev.conformal_q(c, 0.9))))


@query("conformal_intervals", f"{W}, {CONF} SELECT row_id, {R('lo - q')} AS lo_cal, {R('hi + q')} AS hi_cal FROM predicted, q WHERE NOT ({CAL})")
def _(spark, sf):
    p = predicted_table(spark, sf)
    return ev.conformal_intervals(test(p), ev.conformal_q(calib(p), 0.9)).select("row_id", rnd(F.col("lo_cal")).alias("lo_cal"), rnd(F.col("hi_cal")).alias("hi_cal"))


@query("interval_coverage", f"""{W}, {CONF}, c AS (SELECT avg((y >= lo AND y <= hi)::INT) AS raw, avg((y >= lo - q AND y <= hi + q)::INT) AS cal, avg(hi - lo) AS wr, avg(hi + q - lo + q) AS wc FROM predicted, q WHERE NOT ({CAL}))
SELECT {R('raw')} AS coverage_raw, {R('cal')} AS coverage_conformal, {R('abs(raw - 0.9)')} AS coverage_error_raw, {R('abs(cal - 0.9)')} AS coverage_error_conformal, {R('wr', 4)} AS interval_width_raw, {R('wc', 4)} AS interval_width_conformal FROM c""")
def _(spark, sf):
    p = predicted_table(spark, sf)
    return ev.interval_coverage(test(p), ev.conformal_q(calib(p), 0.9), 0.9)


@query("interval_rows", f"{W}, {CONF} SELECT row_id, {R('yhat', 4)} AS point, {R('lo - q', 4)} AS low, {R('hi + q', 4)} AS high, y >= lo - q AND y <= hi + q AS inside FROM predicted, q WHERE NOT ({CAL})")
def _(spark, sf):
    p = predicted_table(spark, sf)
    return ev.interval_rows(test(p), ev.conformal_q(calib(p), 0.9))
