"""The query registry and the SQL fragments shared by the oracle texts."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = (
    "relational", "scalars", "profiling", "preparation", "binary", "multiclass", "multilabel", "regression",
    "audit", "chat", "bayes", "clusters", "models", "runs", "events", "io",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the same question for a SQL engine."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"plumbline.plans.{m}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Share rows among all cores when the input arrives in fewer pieces; a large input is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def H(expr: str, part: int = 0) -> str:
    """SQL twin of ``functions.core.h32`` over one ready-made string expression."""
    return f"(('0x' || substr(md5({expr}), {1 + 8 * part}, 8))::BIGINT)"


def key(*parts: str) -> str:
    return "concat_ws('|', " + ", ".join(parts) + ")"


def U(expr: str, part: int = 0) -> str:
    """SQL twin of ``functions.core.unit``."""
    return f"({H(expr, part)} / 4294967296::DOUBLE)"


def R(expr: str, digits: int = 6) -> str:
    """SQL twin of ``functions.core.rnd``."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0::DOUBLE)"


def D(a: str, b: str, default: str = "0") -> str:
    """SQL twin of ``functions.core.ratio``."""
    return f"(CASE WHEN ({b}) = 0 OR ({b}) IS NULL OR ({a}) IS NULL THEN {default}::DOUBLE ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"
