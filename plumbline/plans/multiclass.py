"""Multiclass evaluation queries over order status with three class probabilities."""

from functools import reduce

from plumbline.operators import multiclass as ev
from plumbline.plans.fixtures import CLASS_PROBS, class_probs
from plumbline.plans.registry import D, R, query

W = f"WITH {CLASS_PROBS}"
GRID = "grid AS (SELECT a.c AS y, b.c AS yhat FROM (SELECT y AS c FROM class_probs UNION SELECT yhat FROM class_probs) a, (SELECT y AS c FROM class_probs UNION SELECT yhat FROM class_probs) b)"
CM = f"{GRID}, k AS (SELECT y, yhat, count(*) AS n FROM class_probs GROUP BY 1, 2), cm AS (SELECT y, yhat, coalesce(n, 0) AS n FROM grid LEFT JOIN k USING (y, yhat))"
PC = f"""{CM}, pc AS (SELECT y AS class, tp, support, predicted, {D('tp', 'predicted')} AS p, {D('tp', 'support')} AS r, {D('2 * tp', 'support + predicted')} AS f FROM
 (SELECT y, sum(n)::BIGINT AS support, sum(n) FILTER (y = yhat)::BIGINT AS tp FROM cm GROUP BY 1) JOIN (SELECT yhat AS y, sum(n)::BIGINT AS predicted FROM cm GROUP BY 1) USING (y))"""


@query("accuracy", f"{W} SELECT {R('avg((y = yhat)::INT)')} AS accuracy FROM class_probs")
def _(spark, sf):
    return ev.accuracy(class_probs(spark, sf))


@query("confusion_matrix", f"{W}, {CM} SELECT * FROM cm")
def _(spark, sf):
    return ev.confusion_matrix(class_probs(spark, sf))


@query("confusion_matrix_norm", f"{W}, {CM} SELECT y, yhat, {R('n / greatest(sum(n) OVER (PARTITION BY y), 1)')} AS share FROM cm")
def _(spark, sf):
    return ev.confusion_matrix_norm(class_probs(spark, sf))


@query("per_class_prf", f"{W}, {PC} SELECT class, tp, predicted, support, {R('p')} AS precision, {R('r')} AS recall, {R('f')} AS f1 FROM pc")
def _(spark, sf):
    return ev.per_class_prf(class_probs(spark, sf))


@query("f1_averages", f"{W}, {PC} SELECT {R('avg(f)')} AS f1_macro, {R('sum(tp) / sum(support)')} AS f1_micro, {R('sum(f * support) / sum(support)')} AS f1_weighted FROM pc")
def _(spark, sf):
    return ev.f1_averages(class_probs(spark, sf))


@query("classification_report", f"""{W}, {PC} SELECT class::VARCHAR AS "row", {R('p')} AS precision, {R('r')} AS recall, {R('f')} AS f1, support FROM pc
UNION ALL SELECT 'accuracy', {R('sum(tp) / sum(support)')}, {R('sum(tp) / sum(support)')}, {R('sum(tp) / sum(support)')}, sum(support)::BIGINT FROM pc
UNION ALL SELECT 'macro avg', {R('avg(p)')}, {R('avg(r)')}, {R('avg(f)')}, sum(support)::BIGINT FROM pc
UNION ALL SELECT 'weighted avg', {R('sum(p * support) / sum(support)')}, {R('sum(r * support) / sum(support)')}, {R('sum(f * support) / sum(support)')}, sum(support)::BIGINT FROM pc""")
def _(spark, sf):
    return ev.classification_report(class_probs(spark, sf))


@query("multiclass_log_loss", f"{W} SELECT {R('avg(-ln(least(greatest(probs[y + 1], 2.220446049250313e-16::DOUBLE), 1 - 2.220446049250313e-16::DOUBLE)))')} AS log_loss FROM class_probs")
def _(spark, sf):
    return ev.multiclass_log_loss(class_probs(spark, sf))


_AHEAD = " + ".join(f"(p{c} > own OR (p{c} = own AND {c} > y))::INT" for c in range(3))


@query("top_k_accuracy", " UNION ALL ".join(f"SELECT {R(f'avg((ahead < {k})::INT)')} AS top_k_accuracy, {k} AS k FROM ({W} SELECT {_AHEAD} AS ahead FROM (SELECT *, probs[y + 1] AS own FROM class_probs))" for k in (1, 2, 3)))
def _(spark, sf):
    return reduce(lambda a, b: a.unionByName(b), [ev.top_k_accuracy(class_probs(spark, sf), k) for k in (1, 2, 3)])


OVR = """ovr AS (SELECT row_id, 0 AS class, (y = 0)::INT AS y, p0 AS score FROM class_probs UNION ALL SELECT row_id, 1, (y = 1)::INT, p1 FROM class_probs UNION ALL SELECT row_id, 2, (y = 2)::INT, p2 FROM class_probs),
g AS (SELECT class, score, sum(y) AS pos, sum(1 - y) AS neg FROM ovr GROUP BY 1, 2), n AS (SELECT class, sum(y) AS p, sum(1 - y) AS q FROM ovr GROUP BY 1),
c AS (SELECT class, score, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, p, q FROM g JOIN n USING (class) WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
c2 AS (SELECT *, cp / (cp + cn) AS pr, lag(cp / (cp + cn), 1, 1.0) OVER (PARTITION BY class ORDER BY score DESC) AS before FROM c)"""


@query("roc_ovr", f"""{W}, {OVR} SELECT class, {R('sum(neg * (cp - pos + pos / 2.0)) / (any_value(p)::DOUBLE * any_value(q))')} AS roc_auc, {R('sum(pos * pr) / any_value(p)')} AS average_precision,
 {R('sum(pos * (pr + before) / 2) / any_value(p)')} AS pr_auc_trapezoid, {R('any_value(p) / (any_value(p) + any_value(q))')} AS positive_share FROM c2 GROUP BY 1""")
def _(spark, sf):
    return ev.roc_ovr(class_probs(spark, sf))


@query("roc_ovr_curve", f"{W}, {OVR} SELECT class, {R('score')} AS threshold, {R('cn / q')} AS fpr, {R('cp / p')} AS tpr FROM c")
def _(spark, sf):
    from pyspark.sql import functions as F

    from plumbline.functions.core import rnd
    return ev.roc_ovr_curve(class_probs(spark, sf)).withColumn("threshold", rnd(F.col("threshold")))


@query("most_confused", f"{W}, {CM} SELECT * FROM (SELECT y, yhat, {R('n / greatest(sum(n) OVER (PARTITION BY y), 1)')} AS share FROM cm) WHERE y <> yhat AND share > 0 ORDER BY share DESC, y, yhat LIMIT 3")
def _(spark, sf):
    return ev.most_confused(class_probs(spark, sf), 3)
