"""Readers: every source arrives with a stated schema, and bad rows are kept apart instead of lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.core import nan_to_null


def scan_parquet(spark: SparkSession, path: str, nan_is_null: bool = False) -> DataFrame:
    """A parquet table; with ``nan_is_null`` NaN in floating columns is read as missing, at the price of filters on them reaching the file."""
    df = spark.read.parquet(path)
    return nan_to_null(df) if nan_is_null else df


def scan_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def scan_tsv_lenient(spark: SparkSession, path: str, fields: dict[str, tuple[int, str]], width: int) -> tuple[DataFrame, DataFrame]:
    """Header-less TSV with positional fields ``{name: (position, type)}``: (good rows, bad lines with the reason).

    A line is bad when it has another number of fields than ``width`` or a non-empty field does not fit its type.
    """
    parts = spark.read.text(path).withColumn("__p", F.split("value", "\t"))
    typed = parts.withColumns({n: F.nullif(F.col("__p").getItem(i), F.lit("")).try_cast(t) for n, (i, t) in fields.items()})
    misfit = F.lit(False)
    for n, (i, _) in fields.items():
        misfit = misfit | (F.col(n).isNull() & (F.coalesce(F.col("__p").getItem(i), F.lit("")) != ""))
    reason = F.when(F.size("__p") != width, "field count").when(misfit, "field type")
    marked = typed.withColumn("__bad", reason)
    return (marked.where("__bad is null").select(*fields), marked.where("__bad is not null").select(F.col("value").alias("line"), F.col("__bad").alias("reason")))


def scan_json_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, low: int = 0, high: int = 0, partitions: int = 1, **options) -> DataFrame:
    """A database table, read in parallel ranges of ``column`` when given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if column:
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=partitions)
    return reader.load()


def from_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def validate_json_records(records: DataFrame, key: str, required: list[str], list_field: str, listing: DataFrame) -> DataFrame:
    """One row per violation: a required field that is missing, or a listed item that ``listing`` (key, item) does not hold.

    ``records`` has the raw JSON in ``value``; a field set to JSON null counts as present.
    """
    keys = records.select(F.get_json_object("value", f"$.{key}").alias(key), "value", F.json_object_keys("value").alias("__keys"))
    missing = keys.select(key, F.explode(F.filter(F.array(*[F.when(~F.coalesce(F.array_contains("__keys", f), F.lit(False)), F.lit(f)) for f in required]),
                                                  lambda x: x.isNotNull())).alias("item"))
    items = keys.select(key, F.explode(F.from_json(F.get_json_object("value", f"$.{list_field}"), "array<string>")).alias("item"))
    lost = items.join(listing.select(key, "item"), [key, "item"], "left_anti")
    return missing.select(key, F.lit("missing field").alias("problem"), "item").unionByName(lost.select(key, F.lit("listed item missing").alias("problem"), "item"))
