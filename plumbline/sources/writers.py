"""Sinks: parquet with a sidecar, CSV, text rows as JSON lines, and persisted computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import shared_folder


def sink_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def sink_parquet_sidecar(df: DataFrame, path: str, problem: str, truth: dict | None = None) -> DataFrame:
    """Write the data, and next to it one JSON row naming problem, row count, columns, types and ground truth.

    The row count comes from the footers of the files just written, so the source is read once.
    """
    import json

    df.write.mode("overwrite").parquet(f"{path}/data")
    n_rows = df.sparkSession.read.parquet(f"{path}/data").count()
    names = [f.name for f in df.schema]
    types = [f.dataType.simpleString() for f in df.schema]
    row = [(problem, n_rows, names, types, json.dumps(truth or {}, sort_keys=True))]
    side = df.sparkSession.createDataFrame(
        row, "problem string, n_rows bigint, columns array<string>, dtypes array<string>, ground_truth string")
    side.coalesce(1).write.mode("overwrite").json(f"{path}/sidecar")
    return side


def sink_sft_jsonl(df: DataFrame, path: str, columns: list[str]) -> None:
    """One JSON object per line."""
    df.select(F.to_json(F.struct(*columns)).alias("value")).write.mode("overwrite").text(path)


def write_with_computed(df: DataFrame, name: str, value: Column, keep: Column, path: str | None = None) -> DataFrame:
    """Store a computed column and keep only the rows of interest: the table form of a partial expression index."""
    path = path or shared_folder(df.sparkSession, name)
    df.withColumn(name, value).where(keep).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
