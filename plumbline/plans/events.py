"""Purchase events as checkout messages, in batch and as a stream."""

from pyspark.sql import functions as F

from plumbline.functions.core import hash_bucket
from plumbline.plans.registry import H, key, query, table
from plumbline.session import shared_folder
from plumbline.streaming import events as ev

C = F.col


def messages(spark, sf):
    """events as checkout JSON: purchases are paid checkouts, three in a hundred are sent twice."""
    copies = F.when(hash_bucket(33, F.lit("twice"), "event_id") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = table(spark, sf, "events").withColumn("copy", F.explode(copies))
    h = hash_bucket(10, F.lit("rt"), "event_id")
    body = F.struct(
        F.when(C("event_type") == "purchase", ev.PAID).otherwise(C("event_type")).alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.struct(F.struct(
            F.concat(F.lit("cs_"), C("event_id").cast("string")).alias("id"), F.floor(C("value") * 100 + 0.5).cast("long").alias("amount_total"),
            F.struct(F.when(h != 1, F.concat(F.lit("u"), C("user_id").cast("string"), F.lit("@example.com"))).alias("email")).alias("customer_details"),
            F.struct(F.when(h == 0, "other").otherwise("shop").alias("platform"), F.when(h != 2, F.concat(F.lit("bundle-"), (C("user_id") % 4).cast("string"))).alias("bundle")).alias("metadata"),
        ).alias("object")).alias("data"))
    return e.select(F.to_json(body).alias("value"))


_H = H(key("'rt'", "event_id")) + " % 10"
MSG = f"""msg AS (SELECT 'cs_' || event_id AS session_id, event_type = 'purchase' AS paid, date_trunc('second', ts) AS created, floor(value * 100 + 0.5)::BIGINT AS amount_cents,
 CASE WHEN h <> 1 THEN 'u' || user_id || '@example.com' END AS email, CASE WHEN h = 0 THEN 'other' ELSE 'shop' END AS platform, CASE WHEN h <> 2 THEN 'bundle-' || (user_id % 4) END AS bundle
 FROM (SELECT *, {_H} AS h, unnest(CASE WHEN {H(key("'twice'", 'event_id'))} % 33 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events)),
routed AS (SELECT *, CASE WHEN NOT paid THEN 'ignored' WHEN platform <> 'shop' THEN 'foreign' WHEN email IS NULL OR bundle IS NULL THEN 'invalid' ELSE 'deliver' END AS route FROM msg),
rcp AS (SELECT DISTINCT session_id, email, bundle, amount_cents FROM routed WHERE route = 'deliver')"""


def routed(spark, sf):
    return ev.route_events(ev.parse_events(messages(spark, sf)), "shop")


@query("route_events", f"WITH {MSG} SELECT session_id, route, email, bundle FROM routed")
def _(spark, sf):
    return routed(spark, sf).select("session_id", "route", "email", "bundle")


@query("dedupe_events", f"WITH {MSG} SELECT * FROM rcp")
def _(spark, sf):
    return ev.dedupe_receipts(ev.receipts(routed(spark, sf))).drop("delivered_at")


def streamed(spark, sf, dedupe, files_per_batch=1):
    src, out, ck = (shared_folder(spark, n) for n in ("events-in", "receipts", "receipts-ck"))
    messages(spark, sf).repartition(8).write.text(src)  # several files, in no order of time
    r = ev.receipts(ev.route_events(ev.read_event_stream(spark, src, files_per_batch), "shop"))
    (ev.run_deduped if dedupe else ev.run_to_files)(r, out, ck)
    return spark.read.parquet(out).select("session_id", "email", "bundle", "amount_cents")


@query("receipts_stream", f"WITH {MSG} SELECT session_id, email, bundle, amount_cents FROM routed WHERE route = 'deliver'")
def _(spark, sf):
    return streamed(spark, sf, False)


@query("dedupe_events_stream", f"WITH {MSG} SELECT * FROM rcp")
def _(spark, sf):
    return streamed(spark, sf, True)


@query("undelivered_sessions", f"WITH {MSG} SELECT session_id, email, bundle FROM rcp WHERE {H(key(chr(39) + 'lost' + chr(39), 'session_id'))} % 20 = 0")
def _(spark, sf):
    r = routed(spark, sf)
    return ev.undelivered_sessions(r, ev.receipts(r).where(hash_bucket(20, F.lit("lost"), "session_id") != 0))


@query("receipt_revenue", f"WITH {MSG} SELECT bundle, count(*) AS n, sum(amount_cents)::BIGINT AS gross_cents, sum(floor((amount_cents * 29 + 500) / 1000) + 30)::BIGINT AS fee_cents, (sum(amount_cents) - sum(floor((amount_cents * 29 + 500) / 1000) + 30))::BIGINT AS net_cents FROM rcp GROUP BY 1")
def _(spark, sf):
    return ev.receipt_revenue(ev.dedupe_receipts(ev.receipts(routed(spark, sf))))
