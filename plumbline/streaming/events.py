"""Checkout events: routing, receipts, repeats, and money per bundle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The event type that means a paid checkout, and the payment fee (2.9 % and 30 cents).
PAID = "checkout.session.completed"
FEE_PER_MILLE = 29
FEE_FIXED_CENTS = 30

STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

EVENT_SCHEMA = (
    "type string, created string, data struct<object: struct<id: string, amount_total: bigint, "
    "customer_details: struct<email: string>, metadata: struct<platform: string, bundle: string>>>"
)


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to columns; unparsable text keeps NULL fields."""
    e = raw.withColumn("__e", F.from_json(value, EVENT_SCHEMA))
    o = "__e.data.object"
    return e.select(
        F.col("__e.type").alias("type"), F.to_timestamp("__e.created").alias("created"), F.col(f"{o}.id").alias("session_id"),
        F.col(f"{o}.amount_total").alias("amount_cents"), F.col(f"{o}.customer_details.email").alias("email"),
        F.col(f"{o}.metadata.platform").alias("platform"), F.col(f"{o}.metadata.bundle").alias("bundle"))


def route(platform: str) -> Column:
    """ignored / foreign / invalid / deliver; the order of the tests matters."""
    def blank(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) == "")

    return (F.when(F.col("type").isNull() | (F.col("type") != PAID), "ignored")
            .when(F.col("platform").isNull() | (F.col("platform") != platform), "foreign")
            .when(blank("email") | blank("bundle"), "invalid").otherwise("deliver"))


def route_events(parsed: DataFrame, platform: str) -> DataFrame:
    return parsed.withColumn("route", route(platform))


def receipts(routed: DataFrame) -> DataFrame:
    """One receipt per delivered event."""
    return routed.where("route = 'deliver'").select("session_id", "email", "bundle", "amount_cents", F.col("created").alias("delivered_at"))


def dedupe_receipts(r: DataFrame) -> DataFrame:
    """Batch form: the first receipt of each session; a session repeated any number of times is reduced before the shuffle."""
    first = F.min(F.struct("delivered_at", "email", "bundle", "amount_cents")).alias("r")
    return r.groupBy("session_id").agg(first).select("session_id", "r.email", "r.bundle", "r.amount_cents", "r.delivered_at")


def first_seen(stream: DataFrame, by: str = "session_id") -> DataFrame:
    """Stream form: the first receipt of each session to arrive, whatever its age; a NULL session is one session.

    The sessions seen are keys of a state store, dealt by hash over the shuffle partitions, so a micro-batch looks up its own sessions and reads no earlier
    receipt.  There is no watermark: nothing is dropped for being late, and the state grows by one key a session.  Of the receipts of one session in
    its first micro-batch one is kept, which one is not defined.
    """
    return stream.dropDuplicates([by])


def run_deduped(stream: DataFrame, out: str, checkpoint: str) -> list[dict]:
    """Append the receipt of each session seen for the first time and stop when all input is read; the progress of each micro-batch.

    The state lives on RocksDB, off the heap, with its changes in the checkpoint folder; a run that starts from the same folder goes on where
    the last one ended.
    """
    conf = stream.sparkSession.conf
    kept = {k: conf.get(k, None) for k in STATE_ON_DISK}
    for k, v in STATE_ON_DISK.items():
        conf.set(k, v)
    try:
        return run_to_files(first_seen(stream), out, checkpoint)
    finally:
        for k, v in kept.items():
            conf.unset(k) if v is None else conf.set(k, v)


def read_event_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Text lines of a folder as a stream of parsed events."""
    return parse_events(spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(path))


def run_to_files(stream: DataFrame, out: str, checkpoint: str) -> list[dict]:
    """Append everything that is available to a folder, once each, and stop; the progress of each micro-batch."""
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return list(q.recentProgress)


def undelivered_sessions(routed: DataFrame, written: DataFrame) -> DataFrame:
    """Paid sessions that should have been delivered and have no receipt."""
    return routed.where("route = 'deliver'").select("session_id", "email", "bundle").distinct().join(written.select("session_id"), "session_id", "left_anti")


def fee_cents(gross: Column) -> Column:
    """Fee in whole cents, rounded half up."""
    return F.floor((gross * FEE_PER_MILLE + 500) / 1000).cast("long") + FEE_FIXED_CENTS


def receipt_revenue(r: DataFrame) -> DataFrame:
    g = r.withColumn("__fee", fee_cents(F.col("amount_cents"))).groupBy("bundle").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("gross_cents"), F.sum("__fee").alias("fee_cents"))
    return g.withColumn("net_cents", F.col("gross_cents") - F.col("fee_cents"))
