"""Scalar functions as table jobs, and the UDF surface."""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import library, text
from plumbline.functions.core import hash_bucket, rnd
from plumbline.operators import sliding
from plumbline.operators.ordering import rank_rows
from plumbline.operators.relational import weighted_avg
from plumbline.plans.fixtures import SCORED, scored
from plumbline.plans.registry import H, R, key, query, table

C = F.col
CLASSES = ["brakes", "engine", "tires", "other"]


@query("normalize_ws", r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.normalize_ws(C("text"))).alias("digest"))


@query("json_dig", """SELECT event_id, json_extract_string(j, '$.meta.props.k') AS k, json_extract_string(j, '$.tags[1]') AS second, json_extract_string(j, '$.none') AS missing,
 json_extract_string(bad, '$.k') AS broken FROM (SELECT event_id, '{"meta":{"props":' || props || '},"tags":["a","' || event_type || '"]}' AS j, CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS bad FROM events)""")
def _(spark, sf):
    e = table(spark, sf, "events")
    j = F.concat(F.lit('{"meta":{"props":'), "props", F.lit('},"tags":["a","'), "event_type", F.lit('"]}'))
    bad = F.when(C("event_id") % 2 == 0, F.lit('{"k": ')).otherwise(C("props"))
    return e.select("event_id", text.json_dig(j, "meta", "props", "k").alias("k"), text.json_dig(j, "tags", "1").alias("second"),
                    text.json_dig(j, "none").alias("missing"), text.json_dig(bad, "k").alias("broken"))


@query("safe_multiply", "SELECT event_id, TRY_CAST(a AS DOUBLE) * TRY_CAST(b AS DOUBLE) AS product FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE (event_id % 100)::VARCHAR END AS a, json_extract_string(props, '$.k') AS b FROM events)")
def _(spark, sf):
    a = F.when(C("event_id") % 3 == 0, C("event_type")).otherwise((C("event_id") % 100).cast("string"))
    return table(spark, sf, "events").select("event_id", text.safe_multiply(a, F.get_json_object("props", "$.k")).alias("product"))


LEAD = "round(least(revenue / 10000, 1.0::DOUBLE) * 40 + greatest(1 - days / 365::DOUBLE, 0.0::DOUBLE) * 30 + least(engagement / 100::DOUBLE, 1.0::DOUBLE) * 30, 2)"
LEADS = "leads AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE floor(c_acctbal) END AS revenue, (c_custkey % 73) * 5 AS days, (c_nationkey * 5)::BIGINT AS engagement FROM customer)"


def leads(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(C("c_custkey") % 11 != 0, F.floor("c_acctbal").cast("double")).alias("revenue"),
        ((C("c_custkey") % 73) * 5).alias("days"), (C("c_nationkey") * 5).alias("engagement"))


@query("lead_score", f"WITH {LEADS} SELECT c_custkey, {LEAD} AS score FROM leads WHERE revenue IS NOT NULL UNION ALL SELECT c_custkey, NULL FROM leads WHERE revenue IS NULL")
def _(spark, sf):
    return leads(spark, sf).select("c_custkey", text.lead_score(C("revenue"), C("days"), C("engagement")).alias("score"))


@query("hot_leads", f"WITH {LEADS} SELECT c_custkey, {LEAD} AS score FROM leads WHERE revenue IS NOT NULL AND {LEAD} > 70")
def _(spark, sf):
    from plumbline.sources.writers import write_with_computed
    return write_with_computed(leads(spark, sf), "score", text.lead_score(C("revenue"), C("days"), C("engagement")), C("score") > 70).select("c_custkey", "score")


@query("epoch_to_iso", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM events")
def _(spark, sf):
    secs = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return table(spark, sf, "events").select("event_id", text.epoch_to_iso(secs).alias("iso"))


@query("iso_to_epoch", "SELECT event_id, floor(epoch(ts))::BIGINT - 7200 AS secs FROM events")
def _(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    return table(spark, sf, "events").select("event_id", text.iso_to_epoch(iso).alias("secs"))


@query("contains_ssn", r"""SELECT lang, count(*) AS n, sum(regexp_matches(text, '\b\d{3}-\d{2}-\d{4}\b')::INT)::BIGINT AS n_ssn,
 sum(regexp_matches(text || ' ' || lpad((doc_id % 1000)::VARCHAR, 3, '0') || '-12-3456', '\b\d{3}-\d{2}-\d{4}\b')::INT)::BIGINT AS n_planted FROM documents GROUP BY 1""")
def _(spark, sf):
    planted = F.concat("text", F.lit(" "), F.lpad((C("doc_id") % 1000).cast("string"), 3, "0"), F.lit("-12-3456"))
    return table(spark, sf, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(text.contains_ssn(C("text"))).alias("n_ssn"), F.sum(text.contains_ssn(planted)).alias("n_planted"))


@query("yn_to_bool", "SELECT o_orderkey, upper(trim(yn)) = 'Y' AS flag FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN ' y ' WHEN 'O' THEN 'N' END AS yn FROM orders)")
def _(spark, sf):
    yn = F.when(C("o_orderstatus") == "F", " y ").when(C("o_orderstatus") == "O", "N")
    return table(spark, sf, "orders").select("o_orderkey", text.yn_to_bool(yn).alias("flag"))


@query("concat_label", "SELECT p_partkey, concat_ws(' ', p_size, p_brand, p_name) AS label FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", C("p_size").cast("string"), "p_brand", "p_name").alias("label"))


@query("string_ops", r"SELECT p_partkey, substring(p_name, 1, 4) AS head, upper(p_name) AS up, lower(p_brand) AS low, regexp_extract(p_brand, '#(\d+)', 1) AS num, regexp_replace(p_name, '[aeiou]', '_', 'g') AS masked FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.substring("p_name", 1, 4).alias("head"), F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"),
        F.regexp_extract("p_brand", r"#(\d+)", 1).alias("num"), F.regexp_replace("p_name", "[aeiou]", "_").alias("masked"))


@query("numeric_ops", f"SELECT o_orderkey, round(o_totalprice) AS whole, {R('ln(o_totalprice)')} AS log_price, abs(o_totalprice - 200000) AS gap, o_orderkey % 7 AS m FROM orders")
def _(spark, sf):
    p = C("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", F.round(p).alias("whole"), rnd(F.ln(p)).alias("log_price"), F.abs(p - 200000).alias("gap"), (C("o_orderkey") % 7).alias("m"))


@query("temporal_ops", "SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS due FROM orders")
def _(spark, sf):
    d = C("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.date_format(d, "yyyy-MM").alias("ym"),
                                             F.date_format(d + F.expr("INTERVAL 30 DAY"), "yyyy-MM-dd").alias("due"))


@query("collection_ops", f"""SELECT vec_id, {R('list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))', 4)} AS sq_norm, len(list_filter(embedding, lambda x: x > 0)) AS n_pos FROM embeddings""")
def _(spark, sf):
    e = F.transform("embedding", lambda x: x.cast("double") * x)
    return table(spark, sf, "embeddings").select(
        "vec_id", rnd(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), 4).alias("sq_norm"),
        F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("n_pos"))


@query("unnest", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("logit_expit", f"WITH {SCORED} SELECT row_id, {R('ln(score / (1 - score))')} AS z, {R('1 / (1 + exp(-(4 * score - 2)))')} AS p FROM scored WHERE score > 0 AND score < 1")
def _(spark, sf):
    s = C("score")
    return scored(spark, sf).where((s > 0) & (s < 1)).select("row_id", rnd(text.logit(s)).alias("z"), rnd(text.expit(4 * s - 2)).alias("p"))


ANSWERS = f"""answers AS (SELECT doc_id AS row_id, lang, text, CASE {H(key("'ans'", 'doc_id'))} % 6
 WHEN 0 THEN '<think>' || text || '</think> ' || upper(lang) WHEN 1 THEN 'Label: ' || lang WHEN 2 THEN '<think>' || lang || '</think>' WHEN 3 THEN 'none of these: ???'
 WHEN 4 THEN '  <think>a</think>' || lang || '<think>b</think>  ' ELSE lang END AS answer FROM documents)"""


def answers(spark, sf):
    d = table(spark, sf, "documents")
    h = hash_bucket(6, F.lit("ans"), "doc_id")
    lang = C("lang")
    a = (F.when(h == 0, F.concat(F.lit("<think>"), "text", F.lit("</think> "), F.upper(lang))).when(h == 1, F.concat(F.lit("Label: "), lang))
         .when(h == 2, F.concat(F.lit("<think>"), lang, F.lit("</think>"))).when(h == 3, "none of these: ???")
         .when(h == 4, F.concat(F.lit("  <think>a</think>"), lang, F.lit("<think>b</think>  "))).otherwise(lang))
    return d.select(C("doc_id").alias("row_id"), "lang", "text", a.alias("answer"))


STRIP = r"CASE WHEN best = '' THEN answer ELSE best END"
BEST = r"""(SELECT *, CASE WHEN cleaned = '' AND contains(answer, '</think>') THEN regexp_replace(list_last(string_split(answer, '</think>')), '^\s+|\s+$', '', 'g') ELSE cleaned END AS best
 FROM (SELECT *, regexp_replace(regexp_replace(answer, '(?s)<think>.*?</think>', '', 'g'), '^\s+|\s+$', '', 'g') AS cleaned FROM answers))"""


@query("strip_thinking", f"WITH {ANSWERS} SELECT row_id, {STRIP} AS cleaned FROM {BEST}")
def _(spark, sf):
    return answers(spark, sf).select("row_id", text.strip_thinking(C("answer")).alias("cleaned"))


@query("parse_label", f"WITH {ANSWERS} SELECT row_id, CASE WHEN contains(a, 'en') THEN 0 WHEN contains(a, 'fr') THEN 1 WHEN contains(a, 'de') THEN 2 WHEN contains(a, 'es') THEN 3 ELSE -1 END AS pred FROM (SELECT row_id, lower({STRIP}) AS a FROM {BEST})")
def _(spark, sf):
    return answers(spark, sf).select("row_id", text.parse_label(C("answer"), ["en", "fr", "de", "es"]).alias("pred"))


JSON_ANSWERS = f"""json_answers AS (SELECT row_id, CASE h
 WHEN 0 THEN '{{"fire": true, "crash": "No", "component": " Brakes ", "make": " ford ", "year": "2010"}}' WHEN 1 THEN 'Sure: {{"fire": "yes", "crash": 1, "component": "engine", "make": "", "year": "' || row_id || '"}} ok'
 WHEN 2 THEN '<think>{{"fire": true}}</think>{{"fire": false, "crash": null, "component": "sofa", "make": "bmw"}}' WHEN 3 THEN '{{"fire": tru' WHEN 4 THEN '{{"fire": oops}}' ELSE 'no idea' END AS answer
 FROM (SELECT p_partkey AS row_id, {H(key("'js'", 'p_partkey'))} % 6 AS h FROM part))"""


def json_answers(spark, sf):
    p = table(spark, sf, "part").select(C("p_partkey").alias("row_id"))
    h = hash_bucket(6, F.lit("js"), "row_id")
    options = [
        F.lit('{"fire": true, "crash": "No", "component": " Brakes ", "make": " ford ", "year": "2010"}'),
        F.concat(F.lit('Sure: {"fire": "yes", "crash": 1, "component": "engine", "make": "", "year": "'), C("row_id").cast("string"), F.lit('"} ok')),
        F.lit('<think>{"fire": true}</think>{"fire": false, "crash": null, "component": "sofa", "make": "bmw"}'),
        F.lit('{"fire": tru'), F.lit('{"fire": oops}'), F.lit("no idea")]
    a = F.element_at(F.array(*options), h + 1)
    return p.select("row_id", a.alias("answer"))


def _truth_sql(f):
    return f"""CASE WHEN json_extract_string(j, '$.{f}') IS NULL THEN NULL WHEN json_type(j, '$.{f}') = 'VARCHAR' THEN lower(json_extract_string(j, '$.{f}')) IN ('true','yes','y','1')
      WHEN json_type(j, '$.{f}') = 'BOOLEAN' THEN json_extract_string(j, '$.{f}') = 'true' ELSE TRY_CAST(json_extract_string(j, '$.{f}') AS DOUBLE) <> 0 END AS {f}"""


JSON_PARSED = rf"""parsed AS (SELECT row_id, {_truth_sql('fire')}, {_truth_sql('crash')},
 CASE WHEN lower(trim(json_extract_string(j, '$.component'))) IN ('brakes','engine','tires','other') THEN lower(trim(json_extract_string(j, '$.component'))) END AS component,
 nullif(upper(trim(json_extract_string(j, '$.make'))), '') AS make, nullif(trim(json_extract_string(j, '$.year')), '') AS year
 FROM (SELECT row_id, CASE WHEN json_valid(body) THEN body END AS j FROM (SELECT row_id, regexp_extract(regexp_replace(answer, '(?s)<think>.*?</think>', '', 'g'), '\{{[^}}]+\}}') AS body FROM json_answers)))"""


@query("parse_json_prediction", f"WITH {JSON_ANSWERS}, {JSON_PARSED} SELECT * FROM parsed")
def _(spark, sf):
    return text.parse_json_prediction(json_answers(spark, sf), "answer", CLASSES).drop("answer")


def verdict_text():
    h = hash_bucket(7, F.lit("vt"), "row_id")
    other = F.when(C("lang") == "en", "fr").otherwise("en")
    return (F.when(h == 0, "VERDICT: YES\nCORRECT_LABEL: SAME").when(h == 1, F.concat(F.lit("verdict: no\ncorrect_label: "), other))
            .when(h == 2, F.concat(F.lit("VERDICT: YES\nVERDICT: NO  \nCORRECT_LABEL: same\nCORRECT_LABEL: "), other)).when(h == 3, "VERDICT: MAYBE\nCORRECT_LABEL: klingon")
            .when(h == 4, "__ERROR__ timeout").when(h == 5, F.concat(F.lit("  VERDICT:NO\r\n  CORRECT_LABEL:  "), other, F.lit("\r\n"))).otherwise("I think VERDICT: YES"))


VERDICT_TEXT = f"""CASE {H(key("'vt'", 'row_id'))} % 7 WHEN 0 THEN E'VERDICT: YES\\nCORRECT_LABEL: SAME' WHEN 1 THEN E'verdict: no\\ncorrect_label: ' || other
 WHEN 2 THEN E'VERDICT: YES\\nVERDICT: NO  \\nCORRECT_LABEL: same\\nCORRECT_LABEL: ' || other WHEN 3 THEN E'VERDICT: MAYBE\\nCORRECT_LABEL: klingon' WHEN 4 THEN '__ERROR__ timeout'
 WHEN 5 THEN E'  VERDICT:NO\\r\\n  CORRECT_LABEL:  ' || other || E'\\r\\n' ELSE 'I think VERDICT: YES' END"""
VERDICTS = rf"""raw AS (SELECT row_id, lang, {VERDICT_TEXT} AS answer FROM (SELECT doc_id AS row_id, lang, CASE lang WHEN 'en' THEN 'fr' ELSE 'en' END AS other FROM documents)),
verdicts AS (SELECT row_id, coalesce(upper(list_last(regexp_extract_all(answer, '(?im)^[ \t]*VERDICT:[ \t]*(YES|NO)[ \t\r]*$', 1))), 'UNKNOWN') AS verdict,
 CASE WHEN upper(l) = 'SAME' THEN lang ELSE l END AS corrected_label FROM (SELECT *, list_last(regexp_extract_all(answer, '(?m)^[ \t]*(?i:CORRECT_LABEL:)[ \t]*((?i:SAME)|de|en|es|fr)[ \t\r]*$', 1)) AS l FROM raw))"""


def verdicts(spark, sf, label="lang"):
    d = table(spark, sf, "documents").select(C("doc_id").alias("row_id"), "lang").withColumn("answer", verdict_text())
    return d.select("row_id", text.parse_verdict(C("answer")).alias("verdict"), text.parse_corrected(C("answer"), C("lang"), ["de", "en", "es", "fr"]).alias("corrected_label"))


@query("parse_verdict", f"WITH {VERDICTS} SELECT * FROM verdicts")
def _(spark, sf):
    return verdicts(spark, sf)


@query("register_functions", f"""SELECT p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS name,
 {R("1 - levenshtein(lower(p_name), lower(p_type))::DOUBLE / greatest(length(p_name), length(p_type))")} AS score,
 regexp_matches(p_name, '\\b\\d{{3}}-\\d{{2}}-\\d{{4}}\\b')::INT AS ssn, {R("1 / (1 + exp(-(p_size / 50.0::DOUBLE)))")} AS p FROM part""")
def _(spark, sf):
    library.register_functions(spark)
    table(spark, sf, "part").createOrReplaceTempView("__plumbline_part")
    return spark.sql("SELECT p_partkey, normalize_ws(p_name) AS name, round(similarity(p_name, p_type), 6) AS score, contains_ssn(p_name) AS ssn, round(expit(p_size / 50.0D), 6) AS p FROM __plumbline_part")


@query("scalar_udf", "SELECT e.event_id, (e.value * 2 + e.event_id % 3)::DOUBLE AS v FROM events e")
def _(spark, sf):
    @F.pandas_udf("double")
    def weigh(a: pd.Series, b: pd.Series) -> pd.Series:
        return a * 2 + b

    return table(spark, sf, "events").select("event_id", weigh(C("value"), C("event_id") % 3).alias("v"))


@query("aggregate_udf", f"SELECT l_returnflag, {R('sum(l_extendedprice * l_quantity) / sum(l_quantity)', 4)} AS wavg FROM lineitem GROUP BY 1")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_partkey", "l_extendedprice", "l_quantity")
    partial = [F.sum(C("l_extendedprice") * C("l_quantity")).alias("num"), F.sum("l_quantity").alias("den")]
    final = [rnd(F.try_divide(F.sum("num"), F.sum("den")), 4).alias("wavg")]
    return library.salted_aggregate(li, ["l_returnflag"], partial, final, C("l_partkey"), 64)


@query("window_udf", f"SELECT user_id, event_id, {R('median(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)')} AS m FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    out = sliding.sliding(e, ["user_id"], "event_id", "event_id", "value", 5, sliding.RunningMedian, "double", "m")
    return out.select("user_id", "event_id", rnd(C("m")).alias("m"))


@query("window_udf_long_frame", f"SELECT event_id, {R('median(value) OVER w')} AS m, max(value) OVER w AS top FROM events WINDOW w AS (ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    mid = sliding.sliding(e, [], "event_id", "event_id", "value", 1000, sliding.RunningMedian, "double", "m", chunk=20_000)
    top = sliding.sliding(mid, [], "event_id", "event_id", "value", 1000, lambda: sliding.TwoStacks(lambda v: v, max), "double", "top", chunk=20_000)
    return top.select("event_id", rnd(C("m")).alias("m"), "top")


@query("udf_determinism", "SELECT o_orderkey, o_orderkey * o_orderkey AS sq, true AS stamped FROM orders")
def _(spark, sf):
    @F.pandas_udf("long")
    def pure(v: pd.Series) -> pd.Series:
        return v * v

    def stamp(v: pd.Series) -> pd.Series:
        import time
        return pd.Series([time.time_ns()] * len(v))

    impure = F.pandas_udf(stamp, "long").asNondeterministic()
    return table(spark, sf, "orders").select("o_orderkey", pure(C("o_orderkey")).alias("sq"), (impure(C("o_orderkey")) > 0).alias("stamped"))


@query("udf_null_rules", "SELECT o_orderkey, o_orderkey % 3 = 0 AS missing, CASE WHEN o_orderkey % 3 = 0 THEN 14 ELSE 0 END AS n_null FROM orders")
def _(spark, sf):
    from plumbline.operators.relational import similarity
    # every third row is missing; the others hold a value that each function has an answer for

    def given(value):
        return F.when(C("o_orderkey") % 3 != 0, F.lit(value))

    s, n, number = given("VERDICT: YES a"), given(0.25), C("o_orderkey").cast("string")
    outs = [text.normalize_ws(s), text.json_dig(given('{"k": 1}'), "k"), text.safe_multiply(F.when(s.isNotNull(), number), F.lit("2")), text.lead_score(n, F.lit(1), F.lit(1)),
            text.epoch_to_iso(n.cast("long")), text.iso_to_epoch(given("2024-01-01T00:00:00+00:00")), text.contains_ssn(s), text.yn_to_bool(s), text.strip_thinking(s),
            text.parse_label(s, ["a"]), text.parse_verdict(s), text.logit(n), text.expit(n), similarity(s, F.lit("a"))]
    nulls = F.lit(0)
    for o in outs:
        nulls = nulls + o.isNull().cast("int")
    return table(spark, sf, "orders").select("o_orderkey", (C("o_orderkey") % 3 == 0).alias("missing"), nulls.alias("n_null"))
