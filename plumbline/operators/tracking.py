"""Run tracking as one append-only long table ``(run_id, kind, key, value, text, ts)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.core import rnd

RUN_SCHEMA = "run_id string, kind string, key string, value double, text string"


def run_rows(spark, run_id: str, params: dict | None = None, metrics: dict | None = None, tags: dict | None = None) -> DataFrame:
    """A run's settings and results as rows."""
    rows = [(run_id, "param", k, float(v) if isinstance(v, (int, float)) else None, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, float(v), None) for k, v in (metrics or {}).items()]
    rows += [(run_id, "tag", k, None, str(v)) for k, v in (tags or {}).items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def log_run(rows: DataFrame, path: str) -> None:
    """Append rows of one or many runs; writers never touch each other's files."""
    rows.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


def compare_runs(runs: DataFrame, run_ids: Sequence[str], baseline: str, lower_is_better: Sequence[str] = ()) -> DataFrame:
    """Metric by run, the best run (first name on ties) and its distance to the baseline."""
    m = runs.where("kind = 'metric'").where(F.col("run_id").isin(*run_ids))
    wide = m.groupBy("key").pivot("run_id", list(run_ids)).agg(F.max("value"))
    sign = F.when(F.col("key").isin(*lower_is_better), -1.0).otherwise(1.0) if lower_is_better else F.lit(1.0)
    order = sorted(run_ids)
    best = F.array_max(F.array(*[F.struct((F.col(r) * sign).alias("v"), F.lit(-i).alias("i")) for i, r in enumerate(order)]))
    return wide.select(F.col("key").alias("metric"), *run_ids, F.element_at(F.array(*[F.lit(r) for r in order]), 1 - best["i"]).alias("best_run"),
                       rnd(best["v"] * sign - F.col(baseline)).alias("best_delta"))
