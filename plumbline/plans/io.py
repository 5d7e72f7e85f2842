"""Source and sink queries: given tables are written in each format to the shared folder and read back."""

from pyspark.sql import functions as F

from plumbline.functions.core import hash_bucket, rnd
from plumbline.plans.registry import H, R, key, query, table
from plumbline.session import shared_folder
from plumbline.sources import readers, writers

C = F.col


@query("scan_parquet", f"SELECT l_returnflag, count(*) AS n, {R('sum(l_quantity)', 2)} AS qty FROM lineitem WHERE l_quantity > 10 GROUP BY 1")
def _(spark, sf):
    return readers.scan_parquet(spark, f"{sf}/lineitem.parquet").where("l_quantity > 10").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("l_quantity"), 2).alias("qty"))


@query("scan_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    path = shared_folder(spark, "csv")
    writers.sink_csv(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return readers.scan_csv(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")


def _tsv(spark, sf):
    path = shared_folder(spark, "tsv")
    e = table(spark, sf, "events")
    h = hash_bucket(20, F.lit("tsv"), "event_id")
    line = F.concat_ws("\t", C("event_id").cast("string"), "event_type", F.when(h == 1, "n/a").otherwise(C("value").cast("string")), F.when(h != 0, C("props")))
    e.select(line.alias("value")).write.text(path)
    return readers.scan_tsv_lenient(spark, path, {"event_id": (0, "bigint"), "event_type": (1, "string"), "value": (2, "double")}, 4)


_BUCKET = H(key("'tsv'", "event_id")) + " % 20"


@query("scan_tsv_lenient", f"SELECT event_id, event_type, value FROM events WHERE {_BUCKET} > 1")
def _(spark, sf):
    return _tsv(spark, sf)[0]


@query("scan_tsv_lenient_rejects", f"SELECT 'field count' AS reason, count(*) AS n FROM events WHERE {_BUCKET} = 0 UNION ALL SELECT 'field type', count(*) FROM events WHERE {_BUCKET} = 1")
def _(spark, sf):
    return _tsv(spark, sf)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("scan_json_events", "SELECT event_id, event_type AS type, value FROM events")
def _(spark, sf):
    path = shared_folder(spark, "json")
    table(spark, sf, "events").select("event_id", C("event_type").alias("type"), "value").write.json(path)
    return readers.scan_json_events(spark, path, "event_id bigint, type string, value double")


@query("from_rows", "SELECT l_returnflag, meaning, count(*) AS n FROM lineitem JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) t(f, meaning) ON f = l_returnflag GROUP BY 1, 2")
def _(spark, sf):
    names = readers.from_rows(spark, [("A", "accepted"), ("N", "none"), ("R", "returned")], "l_returnflag string, meaning string")
    return table(spark, sf, "lineitem").join(names, "l_returnflag").groupBy("l_returnflag", "meaning").agg(F.count(F.lit(1)).alias("n"))


@query("sink_parquet_sidecar", """SELECT 'status' AS problem, count(*) AS n_rows, 'o_orderkey,o_orderstatus' AS columns, 'bigint,string' AS dtypes, '{"target": "o_orderstatus"}' AS ground_truth FROM orders""")
def _(spark, sf):
    path = shared_folder(spark, "sidecar")
    writers.sink_parquet_sidecar(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path, "status", {"target": "o_orderstatus"})
    side = spark.read.schema("problem string, n_rows bigint, columns array<string>, dtypes array<string>, ground_truth string").json(f"{path}/sidecar")
    return side.select("problem", "n_rows", F.array_join("columns", ",").alias("columns"), F.array_join("dtypes", ",").alias("dtypes"), "ground_truth")


@query("sink_parquet", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(spark, sf):
    path = shared_folder(spark, "parquet")
    writers.sink_parquet(table(spark, sf, "customer"), path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("sink_csv", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(spark, sf):
    path = shared_folder(spark, "csv")
    writers.sink_csv(table(spark, sf, "customer"), path)
    return readers.scan_csv(spark, path, table(spark, sf, "customer").schema).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("sink_sft_jsonl", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def _(spark, sf):
    path = shared_folder(spark, "jsonl")
    writers.sink_sft_jsonl(table(spark, sf, "documents"), path, ["doc_id", "lang", "text"])
    return spark.read.schema("doc_id bigint, lang string, text string").json(path).select("doc_id", "lang", F.md5("text").alias("text_md5"))


@query("validate_json_records", f"""WITH r AS (SELECT p_partkey, 'b' || p_partkey AS name, {H(key("'js'", 'p_partkey'))} % 5 AS h FROM part)
SELECT name, 'missing field' AS problem, 'title' AS item FROM r WHERE h = 0 UNION ALL SELECT name, 'missing field', 'files' FROM r WHERE h = 1
UNION ALL SELECT name, 'listed item missing', 'extra.md' FROM r WHERE h = 2""")
def _(spark, sf):
    name = F.concat(F.lit("b"), C("p_partkey").cast("string"))
    r = table(spark, sf, "part").select(name.alias("name"), C("p_name").alias("title"), hash_bucket(5, F.lit("js"), "p_partkey").alias("h"))
    files = F.when(C("h") == 2, F.array(F.lit("read.md"), F.lit("extra.md"))).when(C("h") != 1, F.array(F.lit("read.md")))
    path = shared_folder(spark, "records")
    r.select(F.to_json(F.struct("name", F.when(C("h") != 0, C("title")).alias("title"), files.alias("files"))).alias("value")).write.text(path)
    listing = r.select("name", F.lit("read.md").alias("item"))
    return readers.validate_json_records(spark.read.text(path), "name", ["name", "title", "files"], "files", listing)
