"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import remove_folder, shared_folder

WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written on the way, in one folder of the shared checkpoint folder.

    A written table cuts the lineage: a lost executor repeats only what came after it.  ``drop`` removes a
    table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, shared_folder(spark, name)

    def write(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.at}/{name}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, f"{self.at}/{name}")


def parts(spark: SparkSession, nbytes: int, each: int) -> int:
    """Shuffle partitions for ``nbytes`` of data: the session's number, or more to keep each below ``each`` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(nbytes) // each))


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """(rows, bytes of text) of a table."""
    got = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("b")).first()
    return got["n"], got["b"] or 0


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` bytes of ``column``; one longer value stays whole."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, s in enumerate(sizes.tolist()):
            if held and held + s > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += s
        if start < batch.num_rows:
            yield batch.slice(start)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str) -> DataFrame:
    """mapInArrow over slices of bounded size, one record batch in and one out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, column):
            yield fn(batch)

    return df.mapInArrow(run, schema)
