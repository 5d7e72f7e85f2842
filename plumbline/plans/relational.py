"""Relational queries over the business tables."""

import functools
from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.core import hash_bucket, ratio, rnd, unit
from plumbline.operators import profile
from plumbline.operators import relational as rel
from plumbline.operators.ordering import rank_rows
from plumbline.plans.fixtures import CLASS_PROBS, SCORED, class_probs, scored
from plumbline.plans.registry import H, R, U, key, query, table
from plumbline.session import shared_folder

C = F.col


@query("select_cols", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@query("drop_cols", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").drop("s_name", "s_nationkey")


@query("select_by_role", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def _(spark, sf):
    return rel.select_by_role(table(spark, sf, "lineitem"), prefix="l_", types=[T.DoubleType])


@query("filter_rows", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE (o_totalprice > 300000 AND o_orderstatus = 'O') OR o_orderpriority IS NULL OR o_orderpriority = '1-URGENT'")
def _(spark, sf):
    o = table(spark, sf, "orders")
    keep = ((C("o_totalprice") > 300000) & (C("o_orderstatus") == "O")) | C("o_orderpriority").isNull() | (C("o_orderpriority") == "1-URGENT")
    return o.where(keep).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("filter_min_length", "SELECT doc_id, source, length(text) AS n FROM documents WHERE length(text) >= 50 AND length(source) > 0")
def _(spark, sf):
    return table(spark, sf, "documents").where((F.length("text") >= 50) & (F.length("source") > 0)).select("doc_id", "source", F.length("text").alias("n"))


@query("derive_cols", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue, l_extendedprice / l_quantity AS unit_price FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (C("l_extendedprice") * (1 - C("l_discount"))).alias("revenue"),
        (C("l_extendedprice") / C("l_quantity")).alias("unit_price"))


@query("case_bucket", "SELECT CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'low' END AS band, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    p = C("o_totalprice")
    return table(spark, sf, "orders").groupBy(F.when(p >= 300000, "high").when(p >= 100000, "medium").otherwise("low").alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("cast_null_fill", """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INT), -1) AS k, (CASE WHEN event_type = 'error' THEN NULL ELSE value END) IS NULL AS is_missing,
 coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value END, 0.0::DOUBLE) AS filled FROM events""")
def _(spark, sf):
    v = F.when(C("event_type") != "error", C("value"))
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"),
        v.isNull().alias("is_missing"), F.coalesce(v, F.lit(0.0)).alias("filled"))


TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("schema_of", " UNION ALL ".join(f"""SELECT '{c}' AS "column", '{t}' AS type, count({c}) AS n_valid FROM lineitem""" for c, t in TYPES.items()))
def _(spark, sf):
    return rel.schema_of(table(spark, sf, "lineitem"))


DESC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]  # all numeric columns


@query("describe_table", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {R(f'avg({c})', 4)} AS mean, {R(f'stddev_samp({c})', 4)} AS std, min({c}) AS min, max({c}) AS max,
 {R(f'quantile_cont({c}, 0.25)', 4)} AS q25, {R(f'quantile_cont({c}, 0.5)', 4)} AS q50, {R(f'quantile_cont({c}, 0.75)', 4)} AS q75 FROM lineitem""" for c in DESC))
def _(spark, sf):
    return rel.describe_table(table(spark, sf, "lineitem"), DESC)


@query("head_n", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 20")
def _(spark, sf):
    return table(spark, sf, "events").orderBy("event_id").limit(20).select("event_id", "event_type", "value")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(spark, sf):
    return table(spark, sf, "orders").orderBy(C("o_totalprice").desc(), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


# one order in seven and one customer in five get a key that nothing matches
JOIN = """SELECT o_orderkey, c_custkey, c_name, o_totalprice FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN -1 - o_custkey ELSE o_custkey END AS k FROM orders) {how} JOIN
 (SELECT CASE WHEN c_custkey % 5 = 0 THEN 1000000000 + c_custkey ELSE c_custkey END AS c_custkey, c_name FROM customer) ON k = c_custkey"""
for _how, _sql in (("left", "LEFT"), ("inner", "INNER"), ("right", "RIGHT"), ("full_outer", "FULL OUTER")):
    def _join(spark, sf, how=_how):
        key = F.when(C("o_orderkey") % 7 == 0, -1 - C("o_custkey")).otherwise(C("o_custkey"))
        o = table(spark, sf, "orders").select("o_orderkey", key.alias("k"), "o_totalprice")
        c = table(spark, sf, "customer").select(F.when(C("c_custkey") % 5 == 0, 1000000000 + C("c_custkey")).otherwise(C("c_custkey")).alias("c_custkey"), "c_name")
        return o.join(c, o.k == c.c_custkey, how).select("o_orderkey", "c_custkey", "c_name", "o_totalprice")

    query(f"join_{'outer' if _how == 'full_outer' else _how}", JOIN.format(how=_sql))(_join)


VERDICTS = f"verdicts AS (SELECT doc_id AS row_id, CASE WHEN {U(key(chr(39) + 'v' + chr(39), 'doc_id'))} < 0.5 THEN 'YES' ELSE 'NO' END AS verdict FROM documents WHERE {H(key(chr(39) + 'q' + chr(39), 'doc_id'))} % 10 = 0)"


@query("join_verdicts", f"WITH {VERDICTS} SELECT doc_id AS row_id, lang, verdict FROM documents LEFT JOIN verdicts ON doc_id = row_id")
def _(spark, sf):
    from plumbline.functions.core import h32
    d = table(spark, sf, "documents").select(C("doc_id").alias("row_id"), "lang")
    v = d.where(F.pmod(h32(F.lit("q"), "row_id"), F.lit(10)) == 0).select("row_id", F.when(unit(F.lit("v"), "row_id") < 0.5, "YES").otherwise("NO").alias("verdict"))
    return d.join(v, "row_id", "left")


@query("join_full_fill0", """SELECT k AS user_id, coalesce(a.n_buy, 0) AS n_buy, coalesce(b.n_error, 0) AS n_error FROM
 (SELECT user_id AS k, count(*) AS n_buy FROM events WHERE event_type = 'purchase' GROUP BY 1) a FULL JOIN (SELECT user_id AS k, count(*) AS n_error FROM events WHERE event_type = 'error' GROUP BY 1) b USING (k)""")
def _(spark, sf):
    e = table(spark, sf, "events")
    a = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_buy"))
    b = e.where("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_error"))
    return rel.join_full_fill0(a, b, ["user_id"])


# A small code list for the prefix lookup query.
PART_PREFIXES = {"SMALL": "tiny", "SMALL RING": "jewel", "RED": "colour", "BLUE": "colour", "RED WIDGET": "gadget", "LARGE": "big"}
PREFIX_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in PART_PREFIXES.items())
PREFIX_SQL = f"""WITH keys AS (SELECT * FROM (VALUES {PREFIX_VALUES}) t(key, value)),
hit AS (SELECT p_partkey, arg_max(value, length(key)) AS v FROM part JOIN keys ON starts_with(upper(trim(p_name)), key) GROUP BY 1)
SELECT p.p_partkey, coalesce(v, 'other') AS mapped FROM part p LEFT JOIN hit USING (p_partkey)"""


@query("lookup_longest_prefix", PREFIX_SQL)
def _(spark, sf):
    return rel.lookup_longest_prefix(table(spark, sf, "part"), "p_name", PART_PREFIXES).select("p_partkey", "mapped")


@query("lookup_longest_prefix_table", PREFIX_SQL)
def _(spark, sf):
    keys = spark.createDataFrame(list(PART_PREFIXES.items()), "key string, value string")
    return rel.lookup_longest_prefix_table(table(spark, sf, "part"), "p_name", keys).select("p_partkey", "mapped")


@query("pending_judge_calls", f"""WITH f AS (SELECT doc_id AS row_id, sha256('check: ' || text) AS prompt_hash FROM documents),
cache AS (SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 'stale' ELSE prompt_hash END AS prompt_hash FROM f WHERE {H(key("'c'", 'row_id'))} % 3 = 0)
SELECT f.row_id, f.prompt_hash FROM f ANTI JOIN cache USING (row_id, prompt_hash)""")
def _(spark, sf):
    f = table(spark, sf, "documents").select(C("doc_id").alias("row_id"), F.concat(F.lit("check: "), "text").alias("prompt"))
    cache = f.where(hash_bucket(3, F.lit("c"), "row_id") == 0).select("row_id", F.when(C("row_id") % 5 == 0, "stale").otherwise(F.sha2("prompt", 256)).alias("prompt_hash"))
    return rel.pending_judge_calls(f, cache).select("row_id", "prompt_hash")


@query("align_predictions", f"""WITH {CLASS_PROBS} SELECT row_id, y, yhat AS base, CASE WHEN {H(key("'m'", 'row_id'))} % 4 = 0 THEN y ELSE yhat END AS tuned FROM class_probs""")
def _(spark, sf):
    p = class_probs(spark, sf)
    base = p.select("row_id", F.lit("base").alias("model"), "yhat")
    tuned = p.select("row_id", F.lit("tuned").alias("model"), F.when(hash_bucket(4, F.lit("m"), "row_id") == 0, C("y")).otherwise(C("yhat")).alias("yhat"))
    return rel.align_predictions(p.select("row_id", "y"), base.unionByName(tuned), ["base", "tuned"])


@query("pair_columns", "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(f'corr({a}, {b})')} AS pearson FROM lineitem" for a, b in combinations(DESC, 2)))
def _(spark, sf):
    return profile.corr_matrix(table(spark, sf, "lineitem"), DESC)


@query("group_agg", f"""SELECT l_returnflag, l_linestatus, {R('sum(l_quantity)', 2)} AS sum_qty, {R('sum(l_extendedprice)', 2)} AS sum_price, {R('avg(l_discount)')} AS avg_disc,
 {R('stddev_samp(l_extendedprice)', 4)} AS std_price, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        rnd(F.sum("l_quantity"), 2).alias("sum_qty"), rnd(F.sum("l_extendedprice"), 2).alias("sum_price"),
        rnd(F.avg("l_discount")).alias("avg_disc"), rnd(F.stddev_samp("l_extendedprice"), 4).alias("std_price"), F.count(F.lit(1)).alias("n"))


@query("global_agg", f"SELECT count(*) AS n, count(*) FILTER (event_type = 'purchase') AS n_pos, {R('avg(value)')} AS mean_value, {R('stddev_pop(value)')} AS std_value FROM events")
def _(spark, sf):
    return table(spark, sf, "events").agg(F.count(F.lit(1)).alias("n"), F.count_if(C("event_type") == "purchase").alias("n_pos"),
                                          rnd(F.avg("value")).alias("mean_value"), rnd(F.stddev_pop("value")).alias("std_value"))


@query("count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_supp FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct(C("l_partkey")).alias("n_parts"), F.count_distinct(C("l_suppkey")).alias("n_supp"))


@query("value_counts", f"SELECT o_orderpriority AS value, count(*) AS n, {R('count(*) / (SELECT count(o_orderpriority) FROM orders)::DOUBLE')} AS share FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return rel.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("having_filter", "SELECT l_partkey, count(*) AS n, count(DISTINCT l_returnflag) AS n_flags FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1 AND count(*) > 30")
def _(spark, sf):
    return (table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(C("l_returnflag")).alias("n_flags"))
            .where("n_flags > 1 and n > 30"))


@query("conditional_count", "SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS n_buy, count(*) FILTER (event_type = 'error' AND value > 10) AS n_bad FROM events GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(C("event_type") == "purchase").alias("n_buy"),
        F.count_if((C("event_type") == "error") & (C("value") > 10)).alias("n_bad"))


@query("weighted_avg", f"""SELECT event_type, {R('sum(value * w) / nullif(sum(w), 0)')} AS wavg FROM (SELECT event_type, value, CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 5)::DOUBLE END AS w FROM events)
 WHERE value IS NOT NULL AND w IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    w = F.when(C("event_id") % 7 != 0, (C("event_id") % 5).cast("double"))
    return table(spark, sf, "events").groupBy("event_type").agg(rnd(rel.weighted_avg(C("value"), w)).alias("wavg"))


# sketches of every ship month are stored, read again and merged; the exact numbers say whether the estimates keep their bounds
@query("running_stats", "SELECT l_returnflag, count(*) AS n, true AS distinct_within, true AS quartiles_within, true AS parts_agree FROM lineitem GROUP BY 1")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", C("l_extendedprice").alias("x"), F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    stored = f"{shared_folder(spark, 'sketches')}/lineitem"
    rel.sketch_parts(li, ["l_returnflag"], "x", C("month")).write.parquet(stored)
    merged = rel.merged_stats(spark.read.parquet(stored), ["l_returnflag"])
    at_once = rel.running_stats(li, ["l_returnflag"], "x").select(C("l_returnflag").alias("g"), C("approx_quantiles").alias("once"))
    both = merged.join(at_once, C("l_returnflag") == C("g"))
    # one row per group travels, the lines stay where they are: joined by their few flags, all lines of a flag would meet in one task
    rows = li.join(F.broadcast(both.select(C("l_returnflag").alias("h"), "approx_quantiles", "once")), C("l_returnflag") == C("h"))
    share = lambda q, i: F.avg((C("x") <= F.get(q, F.lit(i))).cast("int"))
    near = functools.reduce(lambda a, b: a & b, [F.abs(share("approx_quantiles", i) - p) < 0.02 for i, p in enumerate((0.25, 0.5, 0.75))])
    agree = functools.reduce(lambda a, b: a & b, [F.abs(share("approx_quantiles", i) - share("once", i)) < 0.02 for i in range(3)])
    exact = rows.groupBy("h").agg(F.count_distinct("x").alias("d"), near.alias("quartiles_within"), agree.alias("parts_agree"))
    return both.join(exact, C("l_returnflag") == C("h")).select("l_returnflag", "n", (F.abs(C("approx_distinct") / C("d") - 1) < 0.04).alias("distinct_within"), "quartiles_within", "parts_agree")


@query("dup_rows", "SELECT (sum(n) - count(*))::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type, value)")
def _(spark, sf):
    return profile.dup_rows(table(spark, sf, "events").select("user_id", "event_type", "value"))


@query("rank_in_group", "SELECT o_orderkey, o_orderpriority, o_totalprice, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank FROM orders")
def _(spark, sf):
    return rel.rank_in_group(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice")


@query("rank_in_group_bucketed", "SELECT o_orderkey, o_orderpriority, o_totalprice, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank FROM orders")
def _(spark, sf):
    cols = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rel.rank_in_group(cols, ["o_orderpriority"], "o_totalprice", rows_per_bucket=700)  # the way large tables take


@query("running_median", f"SELECT user_id, event_id, {R('median(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)')} AS running_median FROM events")
def _(spark, sf):
    return rel.running_median(table(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", "event_id", "value").select(
        "user_id", "event_id", rnd(C("running_median")).alias("running_median"))


@query("rolling_mean", f"""SELECT user_id, event_id, {R('CASE WHEN n = 25 THEN m END')} AS rolling_mean FROM (SELECT user_id, event_id, avg(value) OVER w AS m, count(*) OVER w AS n FROM events
 WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW))""")
def _(spark, sf):
    return rel.rolling_mean(table(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", "event_id", "value").select(
        "user_id", "event_id", rnd(C("rolling_mean")).alias("rolling_mean"))


@query("precision_recall_at_k", f"""WITH {SCORED}, r AS (SELECT row_number() OVER (ORDER BY score, row_id) AS k, sum(y) OVER (ORDER BY score, row_id ROWS UNBOUNDED PRECEDING)::BIGINT AS hits FROM scored)
SELECT k, hits, {R('hits / k::DOUBLE')} AS precision_at_k, {R('hits / (SELECT greatest(sum(y), 1) FROM scored)::DOUBLE')} AS recall_at_k FROM r""")
def _(spark, sf):
    return rel.precision_recall_at_k(scored(spark, sf), "score", "row_id", "y")


@query("global_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rank FROM orders")
def _(spark, sf):
    return rank_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey").select("o_orderkey", "rank")


@query("sort_rows", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey")
def _(spark, sf):
    return (table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
            .orderBy(C("l_extendedprice").desc(), "l_orderkey", "l_partkey", "l_suppkey"))


@query("top_k", f"WITH {SCORED} SELECT row_id, score, y FROM scored ORDER BY score, row_id LIMIT 25")
def _(spark, sf):
    return scored(spark, sf).orderBy("score", "row_id").limit(25).select("row_id", "score", "y")


@query("sample_by_hash", f"""SELECT doc_id, lang, part FROM (SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY h, doc_id) <= 60 THEN 'train' ELSE 'eval' END AS part
 FROM (SELECT *, {H('doc_id::VARCHAR')} AS h FROM documents ORDER BY h, doc_id LIMIT 80))""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    train = rel.sample_by_hash(d, "doc_id", 60, by="md5").withColumn("part", F.lit("train"))
    both = rel.sample_by_hash(d, "doc_id", 80, by="md5")
    return both.join(train.select("doc_id", "part"), "doc_id", "left").select("doc_id", "lang", F.coalesce("part", F.lit("eval")).alias("part"))


@query("sample_by_id", "SELECT doc_id, lang FROM documents ORDER BY abs(doc_id) % 2147483647, doc_id LIMIT 80")
def _(spark, sf):
    return rel.sample_by_hash(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 80)


@query("argmax_first", "SELECT l_returnflag, arg_min(d, ord) AS disc, any_value(best) AS n FROM (SELECT l_returnflag, d, n AS best, d AS ord, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, d) AS r FROM (SELECT l_returnflag, l_discount AS d, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE r = 1 GROUP BY 1")
def _(spark, sf):
    t = table(spark, sf, "lineitem").groupBy("l_returnflag", C("l_discount").alias("disc")).agg(F.count(F.lit(1)).alias("n"))
    return rel.argmax_first(t, "n", "disc", ["l_returnflag"])


SIM = "(CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein(lower({a}), lower({b})) / greatest(length({a}), length({b}))::DOUBLE END)"


@query("similarity_top_k", f"SELECT p_partkey, p_name, {R(SIM.format(a='p_name', b=chr(39) + 'small rings' + chr(39)))} AS score FROM part WHERE {SIM.format(a='p_name', b=chr(39) + 'small rings' + chr(39))} > 0.6 ORDER BY score DESC, p_partkey LIMIT 10")
def _(spark, sf):
    return rel.similarity_top_k(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "small rings", "p_partkey")


@query("fuzzy_match", f"SELECT p_partkey, {R(SIM.format(a='p_name', b='p_type'))} AS score FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rnd(rel.similarity(C("p_name"), C("p_type"))).alias("score"))
