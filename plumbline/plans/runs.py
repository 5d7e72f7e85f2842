"""Run tracking queries: metrics of the two scored models are logged and compared."""

from pyspark.sql import functions as F

from plumbline.operators import tracking
from plumbline.operators.binary import metric_rows
from plumbline.plans.binary import SCORED, _metrics_sql, two_models
from plumbline.plans.registry import R, U, key, query
from plumbline.session import shared_folder

C = F.col


def logged(spark, sf):
    path = shared_folder(spark, "runs")
    m = metric_rows(two_models(spark, sf), ["model"])
    tracking.log_run(m.select(C("model").alias("run_id"), F.lit("metric").alias("kind"), C("metric").alias("key"), "value", F.lit(None).cast("string").alias("text")), path)
    for name in ("base", "tuned"):
        tracking.log_run(tracking.run_rows(spark, name, params={"threshold": 0.5}, tags={"stage": "test"}), path)
    return spark.read.parquet(path)


MODELS = f"""{SCORED}, models AS (SELECT 'tuned' AS model, row_id, y, score FROM scored UNION ALL SELECT 'base', row_id, y, floor(1000::DOUBLE * (0.5::DOUBLE * score + 0.5::DOUBLE * {U(key("'other'", 'row_id'))})) / 1000.0::DOUBLE FROM scored)"""
LOGGED = " UNION ALL ".join(
    f"SELECT '{r}' AS run_id, 'metric' AS kind, metric AS key, v AS value, NULL::VARCHAR AS text FROM m_{r} UNION ALL SELECT '{r}', 'param', 'threshold', 0.5::DOUBLE, '0.5' UNION ALL SELECT '{r}', 'tag', 'stage', NULL, 'test'"
    for r in ("base", "tuned"))


@query("log_run", f"WITH {MODELS}, {_metrics_sql()} {LOGGED}")
def _(spark, sf):
    return logged(spark, sf).select("run_id", "kind", "key", "value", "text")


@query("compare_runs", f"""WITH {SCORED}, models AS (SELECT 'tuned' AS model, row_id, y, score FROM scored UNION ALL SELECT 'base', row_id, y, floor(1000::DOUBLE * (0.5::DOUBLE * score + 0.5::DOUBLE * {U(key("'other'", 'row_id'))})) / 1000.0::DOUBLE FROM scored),
{_metrics_sql()}, j AS (SELECT metric, b.v AS base, t.v AS tuned, CASE WHEN metric IN ('log_loss', 'brier') THEN -1 ELSE 1 END AS s FROM m_base b JOIN m_tuned t USING (metric))
SELECT metric, base, tuned, CASE WHEN base * s >= tuned * s THEN 'base' ELSE 'tuned' END AS best_run, {R('CASE WHEN base * s >= tuned * s THEN base ELSE tuned END - base')} AS best_delta FROM j""")
def _(spark, sf):
    return tracking.compare_runs(logged(spark, sf), ["base", "tuned"], "base", ["log_loss", "brier"])
