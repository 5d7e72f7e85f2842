"""Session helpers: settings the operators rely on, and the checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "plumbline", cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings tests and benchmarks use.

    On a cluster, pass your own session: operators read nothing from here.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a folder inside the session's
    warehouse is used, which all executors share as well; never a machine-local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for tables written on the way."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a table written to a :func:`shared_folder`, and that folder.

    For tables of a loop: a checkpoint takes over the constraints of the plan behind it, which grow with every round.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`shared_folder`, through the file system that Spark uses for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
