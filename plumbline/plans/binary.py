"""Binary evaluation queries over scored events."""

from pyspark.sql import functions as F

from plumbline.functions.core import rnd, unit
from plumbline.operators import binary as ev
from plumbline.plans.fixtures import SCORED, scored
from plumbline.plans.registry import D, R, U, key, query

W = f"WITH {SCORED}"
PRF = f"""{R(D('tp', 'tp + fp'))} AS precision, {R(D('tp', 'tp + fn'))} AS recall, {R(D('2 * tp', '2 * tp + fp + fn'))} AS f1"""
T_LIST = "[" + ", ".join(f"{t!r}::DOUBLE" for t in ev.THRESHOLDS) + "]"
SWEEP = f"""sweep AS (SELECT threshold, count(*) FILTER (y = 1 AND score >= threshold) AS tp, count(*) FILTER (y = 0 AND score >= threshold) AS fp,
 count(*) FILTER (y = 0 AND score < threshold) AS tn, count(*) FILTER (y = 1 AND score < threshold) AS fn FROM scored, (SELECT unnest({T_LIST}) AS threshold) GROUP BY 1)"""
TOTALS = """g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1), n AS (SELECT sum(y) AS p, sum(1 - y) AS q FROM scored),
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn, p, q FROM g, n)"""
LOSS = "avg(-ln(CASE WHEN y = 1 THEN pc ELSE 1 - pc END))"
CLIP = "least(greatest(score, 2.220446049250313e-16::DOUBLE), 1 - 2.220446049250313e-16::DOUBLE)"


@query("confusion_at_threshold", f"{W}, c AS (SELECT count(*) FILTER (y = 1 AND score >= 0.5) AS tp, count(*) FILTER (y = 0 AND score >= 0.5) AS fp, count(*) FILTER (y = 0 AND score < 0.5) AS tn, count(*) FILTER (y = 1 AND score < 0.5) AS fn FROM scored) SELECT tp, fp, tn, fn, {PRF} FROM c")
def _(spark, sf):
    return ev.confusion_at_threshold(scored(spark, sf), 0.5)


@query("apply_threshold", f"{W} SELECT row_id, y, score, (score >= 0.29)::INT AS yhat, (score >= 0.29)::INT = y AS correct FROM scored")
def _(spark, sf):
    return ev.apply_threshold(scored(spark, sf), 0.29)


@query("threshold_sweep", f"{W}, {SWEEP} SELECT threshold, tp, fp, tn, fn, {PRF} FROM sweep")
def _(spark, sf):
    return ev.threshold_sweep(scored(spark, sf))


@query("best_f1_threshold", f"{W}, {SWEEP} SELECT threshold, f1 FROM (SELECT threshold, {PRF} FROM sweep) ORDER BY f1 DESC, threshold LIMIT 1")
def _(spark, sf):
    return ev.best_f1_threshold(scored(spark, sf))


@query("best_cost_threshold", f"{W}, {SWEEP} SELECT threshold, (fp * 5 + fn * 100)::DOUBLE AS cost FROM sweep ORDER BY cost, threshold LIMIT 1")
def _(spark, sf):
    return ev.best_cost_threshold(scored(spark, sf), 5, 100)


@query("roc_curve", f"{W}, {TOTALS} SELECT score AS threshold, {R('cn / q')} AS fpr, {R('cp / p')} AS tpr FROM c")
def _(spark, sf):
    return ev.roc_curve(scored(spark, sf))


@query("pr_curve", f"{W}, {TOTALS} SELECT score AS threshold, {R('cp / (cp + cn)')} AS precision, {R('cp / p')} AS recall FROM c")
def _(spark, sf):
    return ev.pr_curve(scored(spark, sf))


@query("roc_auc", f"{W}, r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored), n AS (SELECT sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS q FROM scored) SELECT {R('(sum(rk) FILTER (y = 1) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * any_value(q))')} AS roc_auc FROM r, n")
def _(spark, sf):
    return ev.roc_auc(scored(spark, sf))


@query("average_precision", f"{W}, {TOTALS} SELECT {R('sum(pos * cp / (cp + cn)) / any_value(p)')} AS average_precision, {R('any_value(p) / (any_value(p) + any_value(q))')} AS positive_share FROM c")
def _(spark, sf):
    return ev.average_precision(scored(spark, sf))


@query("pr_auc_trapezoid", f"{W}, {TOTALS}, t AS (SELECT *, cp / (cp + cn) AS pr, lag(cp / (cp + cn), 1, 1.0) OVER (ORDER BY score DESC) AS before FROM c) SELECT {R('sum(pos * (pr + before) / 2) / any_value(p)')} AS pr_auc_trapezoid FROM t")
def _(spark, sf):
    return ev.pr_auc_trapezoid(scored(spark, sf))


@query("log_loss", f"{W} SELECT {R(LOSS)} AS log_loss FROM (SELECT y, {CLIP} AS pc FROM scored)")
def _(spark, sf):
    return ev.log_loss(scored(spark, sf))


@query("brier_score", f"{W} SELECT {R('avg((score - y) * (score - y))')} AS brier FROM scored")
def _(spark, sf):
    return ev.brier_score(scored(spark, sf))


EDGES = ", ".join(f"quantile_cont(score, {i / 10}) AS e{i}" for i in range(1, 10))


@query("calibration_curve", f"{W}, e AS (SELECT {EDGES} FROM scored) SELECT {' + '.join(f'(score > e{i})::INT' for i in range(1, 10))} AS bin, count(*) AS n, {R('avg(score)')} AS mean_score, {R('avg(y)')} AS positive_share FROM scored, e GROUP BY 1")
def _(spark, sf):
    return ev.calibration_curve(scored(spark, sf))


@query("score_histogram", f"""{W}, r AS (SELECT min(score) AS lo, max(score) AS hi FROM scored), b AS (SELECT i::INT AS bin, lo + (hi - lo) * i / 30 AS le FROM r, range(30) t(i)),
c AS (SELECT least(greatest(floor((score - lo) / (hi - lo) * 30)::INT, 0), 29) AS bin, count(*) AS n FROM scored, r GROUP BY 1) SELECT bin, {R('le')} AS left_edge, coalesce(n, 0) AS n FROM b LEFT JOIN c USING (bin)""")
def _(spark, sf):
    return ev.score_histogram(scored(spark, sf))


def two_models(spark, sf):
    s = scored(spark, sf)
    other = F.floor(1000 * (0.5 * F.col("score") + 0.5 * unit(F.lit("other"), "row_id"))).cast("double") / 1000.0
    return s.withColumn("model", F.lit("tuned")).unionByName(s.withColumn("score", other).withColumn("model", F.lit("base")))


def _metrics_sql():
    parts = []
    for m in ("base", "tuned"):
        src = f"(SELECT * FROM models WHERE model = '{m}')"
        parts.append(f"""m_{m} AS (WITH scored AS {src}, {TOTALS}, areas AS (SELECT sum(neg * (cp - pos + pos / 2.0)) / (any_value(p)::DOUBLE * any_value(q)) AS roc, sum(pos * cp / (cp + cn)) / any_value(p) AS ap FROM c),
 rest AS (SELECT {LOSS} AS ll, avg((score - y) * (score - y)) AS br, 2.0 * count(*) FILTER (y = 1 AND score >= 0.5) / (count(*) FILTER (y = 1) + count(*) FILTER (score >= 0.5)) AS f FROM (SELECT *, {CLIP} AS pc FROM scored))
 SELECT unnest(['roc_auc','average_precision','log_loss','brier','f1']) AS metric, unnest([{R('roc')}, {R('ap')}, {R('ll')}, {R('br')}, {R('f')}]) AS v FROM areas, rest)""")
    return ", ".join(parts)


@query("compare_models", f"""{W}, models AS (SELECT 'tuned' AS model, row_id, y, score FROM scored UNION ALL SELECT 'base', row_id, y, floor(1000::DOUBLE * (0.5::DOUBLE * score + 0.5::DOUBLE * {U(key("'other'", 'row_id'))})) / 1000.0::DOUBLE FROM scored),
{_metrics_sql()} SELECT metric, b.v AS base, t.v AS tuned, {R('t.v - b.v')} AS tuned_delta FROM m_base b JOIN m_tuned t USING (metric)""")
def _(spark, sf):
    return ev.compare_models(two_models(spark, sf), ["base", "tuned"], "base")


def halves(spark, sf):
    s = scored(spark, sf)
    h = unit(F.lit("half"), "row_id") < 0.5
    return s.where(h), s.where(~h)


HALF = f"{U(key(chr(39) + 'half' + chr(39), 'row_id'))} < 0.5"
# the fit by its formula: at a score the largest, over starts at or below it, of the smallest mean of the ranges from there to an end at or above it
FIT = f"""tr AS (SELECT score, sum(y)::DOUBLE AS s, count(*)::DOUBLE AS n FROM scored WHERE {HALF} GROUP BY 1), ps AS (SELECT score, s, n, sum(s) OVER w AS cs, sum(n) OVER w AS cn FROM tr WINDOW w AS (ORDER BY score)),
means AS (SELECT a.score AS a, b.score AS b, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m FROM ps a JOIN ps b ON a.score <= b.score),
fit AS (SELECT b AS score, max(m) AS v FROM (SELECT a, b, min(m) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m FROM means) GROUP BY 1)"""


@query("recalibrate_isotonic", f"""{W}, {FIT}, te AS (SELECT row_id, y, score FROM scored WHERE NOT {HALF}),
lo AS (SELECT te.*, f.score AS x0, f.v AS v0 FROM te ASOF LEFT JOIN fit f ON te.score >= f.score), both_ AS (SELECT lo.*, f.score AS x1, f.v AS v1 FROM lo ASOF LEFT JOIN fit f ON lo.score <= f.score)
SELECT row_id, y, score, {R('CASE WHEN x0 IS NULL THEN v1 WHEN x1 IS NULL OR x1 = x0 THEN v0 ELSE v0 + (v1 - v0) * (score - x0) / (x1 - x0) END')} AS calibrated FROM both_""")
def _(spark, sf):
    a, b = halves(spark, sf)
    return ev.recalibrate_isotonic(a, b).select("row_id", "y", "score", rnd(F.col("calibrated")).alias("calibrated"))


@query("recalibrate_sigmoid")
def _(spark, sf):
    a, b = halves(spark, sf)
    return ev.recalibrate_sigmoid(a, b)
