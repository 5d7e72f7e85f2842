"""Multilabel evaluation queries over three order labels."""

from plumbline.operators import multilabel as ev
from plumbline.operators.binary import THRESHOLDS
from plumbline.plans.fixtures import ML_LABELS, MULTILABEL, MULTILABEL_WIDE, multilabel, multilabel_wide
from plumbline.plans.registry import D, R, query

W = f"WITH {MULTILABEL}"
Y = [f"y_{n}" for n in ML_LABELS]
PL = f"""pl AS (SELECT label, tp, fp, fn, {D('tp', 'tp + fp')} AS p, {D('tp', 'tp + fn')} AS r, {D('2 * tp', '2 * tp + fp + fn')} AS f, tp + fn AS support FROM
 (SELECT label, count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp, count(*) FILTER (y = 1 AND yhat = 0) AS fn FROM ml GROUP BY 1))"""
PR = "pr AS (SELECT row_id, count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp, count(*) FILTER (y = 1 AND yhat = 0) AS fn FROM ml GROUP BY 1)"


@query("label_positive_rate", f"{W} SELECT label, sum(y)::BIGINT AS n_pos, {R('avg(y)')} AS share FROM ml GROUP BY 1")
def _(spark, sf):
    return ev.label_positive_rate(multilabel(spark, sf))


def _co(a, b):
    return D(f"count(*) FILTER ({a} = 1 AND {b} = 1)", f"count(*) FILTER ({a} = 1)")


@query("label_cooccurrence", f"WITH {MULTILABEL_WIDE} " + " UNION ALL ".join(f"SELECT '{a}' AS label_i, '{b}' AS label_j, {R(_co(a, b))} AS p_j_given_i FROM mlw" for a in Y for b in Y))
def _(spark, sf):
    return ev.label_cooccurrence(multilabel_wide(spark, sf), Y)


@query("cooccurrence_lift", f"WITH {MULTILABEL_WIDE} " + " UNION ALL ".join(f"SELECT '{a}' AS label_i, '{b}' AS label_j, {R(R(_co(a, b)) + f' / avg({b})', 4)} AS lift FROM mlw" for a in Y for b in Y if a != b))
def _(spark, sf):
    return ev.cooccurrence_lift(multilabel_wide(spark, sf), Y)


@query("hamming_loss", f"{W} SELECT {R('avg((y <> yhat)::INT)')} AS hamming_loss FROM ml")
def _(spark, sf):
    return ev.hamming_loss(multilabel(spark, sf))


@query("subset_accuracy", f"{W}, {PR} SELECT {R('avg((fp = 0 AND fn = 0)::INT)')} AS subset_accuracy FROM pr")
def _(spark, sf):
    return ev.subset_accuracy(multilabel(spark, sf))


@query("ml_f1_averages", f"{W}, {PL}, {PR} SELECT {R('avg(f)')} AS f1_macro, {R(D('2 * sum(tp)', '2 * sum(tp) + sum(fp) + sum(fn)'))} AS f1_micro, {R('sum(f * support) / sum(support)')} AS f1_weighted, (SELECT {R('avg(' + D('2 * tp', '2 * tp + fp + fn') + ')')} FROM pr) AS f1_samples FROM pl")
def _(spark, sf):
    return ev.ml_f1_averages(multilabel(spark, sf))


@query("per_label_prf", f"{W}, {PL} SELECT label, tp, fp, fn, {R('p')} AS precision, {R('r')} AS recall, {R('f')} AS f1, support FROM pl")
def _(spark, sf):
    return ev.per_label_prf(multilabel(spark, sf))


@query("label_cardinality", f"{W}, r AS (SELECT row_id, sum(y) AS t, sum(yhat) AS p, count(*) AS k FROM ml GROUP BY 1) SELECT {R('avg(t)')} AS cardinality_true, {R('avg(p)')} AS cardinality_pred, {R('sum(t) / sum(k)')} AS density_true, {R('sum(p) / sum(k)')} AS density_pred FROM r")
def _(spark, sf):
    return ev.label_cardinality(multilabel(spark, sf))


@query("label_cardinality_histogram", f"{W}, r AS (SELECT row_id, sum(y)::BIGINT AS t, sum(yhat)::BIGINT AS p FROM ml GROUP BY 1) SELECT 'true' AS side, t AS n_labels, count(*) AS n FROM r GROUP BY 2 UNION ALL SELECT 'pred', p, count(*) FROM r GROUP BY 2")
def _(spark, sf):
    return ev.label_cardinality_histogram(multilabel(spark, sf))


_T = "[" + ", ".join(f"{t!r}::DOUBLE" for t in THRESHOLDS) + "]"


@query("per_label_thresholds", f"""{W}, s AS (SELECT label, t, count(*) FILTER (y = 1 AND score >= t) AS tp, count(*) FILTER (y = 0 AND score >= t) AS fp, count(*) FILTER (y = 1 AND score < t) AS fn FROM ml, (SELECT unnest({_T}) AS t) GROUP BY 1, 2),
f AS (SELECT label, t, {R(D('2 * tp', '2 * tp + fp + fn'))} AS f1 FROM s) SELECT label, t AS threshold, f1 FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, t) AS r FROM f) WHERE r = 1""")
def _(spark, sf):
    return ev.per_label_thresholds(multilabel(spark, sf))
