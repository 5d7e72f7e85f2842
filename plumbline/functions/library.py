"""The function library as SQL functions of a session, and the typed UDF surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each entry is a SQL function body over its parameters, so calls stay inside the engine's own expressions.
SQL_FUNCTIONS = {
    "normalize_ws": ("c STRING", "STRING", r"trim(regexp_replace(c, '\\s+', ' '))"),
    "safe_multiply": ("a STRING, b STRING", "DOUBLE", "try_cast(a AS DOUBLE) * try_cast(b AS DOUBLE)"),
    "contains_ssn": ("c STRING", "INT", r"CASE WHEN c IS NOT NULL THEN CAST(c RLIKE '\\b\\d{3}-\\d{2}-\\d{4}\\b' AS INT) END"),
    "lead_score": ("revenue DOUBLE, recency_days DOUBLE, engagement DOUBLE", "DOUBLE",
                   "CASE WHEN revenue IS NOT NULL AND recency_days IS NOT NULL AND engagement IS NOT NULL THEN round(least(revenue / 10000, 1.0D) * 40"
                   " + greatest(1 - recency_days / 365, 0.0D) * 30 + least(engagement / 100, 1.0D) * 30, 2) END"),
    "iso_to_epoch": ("iso STRING", "BIGINT", "unix_seconds(to_timestamp(iso, \"yyyy-MM-dd'T'HH:mm:ssXXX\"))"),
    "yn_to_bool": ("c STRING", "BOOLEAN", r"upper(regexp_replace(c, '^\\s+|\\s+$', '')) = 'Y'"),
    "similarity": ("a STRING, b STRING", "DOUBLE",
                   "CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0D WHEN a IS NULL OR b IS NULL THEN NULL"
                   " ELSE 1 - levenshtein(lower(a), lower(b)) / CAST(greatest(length(a), length(b)) AS DOUBLE) END"),
    "expit": ("x DOUBLE", "DOUBLE", "1 / (1 + exp(-x))"),
    "logit": ("p DOUBLE", "DOUBLE", "ln(try_divide(p, 1 - p))"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the whole library callable from SQL text in this session; returns the names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    spark.udf.register("window_median", window_median)
    return [*SQL_FUNCTIONS, "window_median"]


@F.pandas_udf(T.DoubleType())
def window_median(v: pd.Series) -> float:
    """Aggregate UDF for frames and groups of bounded size: median ignoring NULL."""
    return float(v.median()) if v.notna().any() else None


def salted_aggregate(df, by: list[str], partial, final, salt: Column, salts: int):
    """Two-step aggregate for user-defined step / finalize pairs: partial per (group, salt), then final per group."""
    step = df.groupBy(*by, F.pmod(salt, F.lit(salts)).alias("__salt")).agg(*partial)
    return step.groupBy(*by).agg(*final)
