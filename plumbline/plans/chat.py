"""Chat rows and parsed-answer queries."""

from pyspark.sql import functions as F

from plumbline.functions.core import hash_bucket
from plumbline.functions.text import parse_json_prediction
from plumbline.operators import chat
from plumbline.plans.fixtures import CLASS_PROBS, class_probs
from plumbline.plans.registry import D, H, R, key, query, table
from plumbline.plans.scalars import CLASSES, JSON_ANSWERS, JSON_PARSED, json_answers

C = F.col
Q = chr(39)
COMPLAINTS = f"""complaints AS (SELECT p_partkey AS id, '  ' || p_name || E' broke\\n ' AS narrative, ' ' || p_brand AS make, p_name AS model, p_size::VARCHAR AS year,
 CASE {H(key("'fire'", 'p_partkey'))} % 3 WHEN 0 THEN ' y' WHEN 1 THEN 'N' ELSE '' END AS fire, CASE {H(key("'crash'", 'p_partkey'))} % 2 WHEN 0 THEN 'Y' ELSE 'N' END AS crash,
 CASE {H(key("'inj'", 'p_partkey'))} % 4 WHEN 0 THEN '2' WHEN 1 THEN '' ELSE '0' END AS injured,
 ['Service Brakes: hydraulic', ' ENGINE', 'ENGINE AND ENGINE COOLING:FAN', 'TIRES:TREAD', 'unknown', 'SEAT BELTS', 'SEATS'][({H(key("'comp'", 'p_partkey'))} % 7) + 1] AS compdesc FROM part)"""
COMPONENT_CASE = "CASE " + " ".join(f"WHEN starts_with(upper(trim(compdesc)), '{k}') THEN '{chat.COMPONENT_MAP[k]}'" for k in sorted(chat.COMPONENT_MAP, key=lambda k: -len(k))) + " ELSE 'other' END"
PROG = f"""{COMPLAINTS}, prog AS (SELECT id, regexp_replace(narrative, '^\\s+|\\s+$', '', 'g') AS narrative, trim(make) AS make, trim(year) AS year, trim(concat_ws(' ', year, make, model)) AS vehicle,
 upper(trim(fire)) = 'Y' AS fire, upper(trim(crash)) = 'Y' AS crash, coalesce(TRY_CAST(injured AS INT), 0) > 0 AS injured, {COMPONENT_CASE} AS component FROM complaints)"""


def complaints(spark, sf):
    p = table(spark, sf, "part")

    def pick(tag, n, *values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), hash_bucket(n, F.lit(tag), "p_partkey") + 1)

    return p.select(
        C("p_partkey").alias("id"), F.concat(F.lit("  "), "p_name", F.lit(" broke\n ")).alias("narrative"), F.concat(F.lit(" "), "p_brand").alias("make"), C("p_name").alias("model"),
        C("p_size").cast("string").alias("year"), pick("fire", 3, " y", "N", "").alias("fire"), pick("crash", 2, "Y", "N").alias("crash"), pick("inj", 4, "2", "", "0", "0").alias("injured"),
        pick("comp", 7, "Service Brakes: hydraulic", " ENGINE", "ENGINE AND ENGINE COOLING:FAN", "TIRES:TREAD", "unknown", "SEAT BELTS", "SEATS").alias("compdesc"))


def labelled(spark, sf):
    return chat.programmatic_labels(complaints(spark, sf))


@query("programmatic_labels", f"WITH {PROG} SELECT * FROM prog")
def _(spark, sf):
    return labelled(spark, sf)


@query("label_distribution", f"WITH {PROG} " + " UNION ALL ".join(f"SELECT '{c}' AS target, {c}::VARCHAR AS value, count(*) AS n FROM prog GROUP BY 2" for c in ("fire", "crash", "component")))
def _(spark, sf):
    return chat.label_distribution(labelled(spark, sf), ["fire", "crash", "component"])


ASK = "Name the language of this text: de, en, es, fr."


@query("format_chat_rows", f"SELECT doc_id, 2 AS n_messages, md5(E'<|user|>\\n{ASK}\\n\\n' || text || E'<|end|>\\n<|assistant|>\\n' || lang || E'<|end|>\\n') AS text_md5 FROM documents")
def _(spark, sf):
    d = chat.format_chat_rows(table(spark, sf, "documents"), F.concat(F.lit(ASK + "\n\n"), "text"), C("lang"), bos="<s>")
    return d.select("doc_id", F.size("messages").alias("n_messages"), F.md5("formatted_text").alias("text_md5"))


TARGETS = ["fire", "crash", "component", "make", "year"]
JSON_T = "json_object('fire', fire, 'crash', crash, 'component', component, 'make', make, 'year', year)::VARCHAR"


@query("format_json_targets", f"WITH {PROG} SELECT id, {JSON_T} AS target FROM (SELECT * REPLACE (nullif(component, 'other') AS component) FROM prog)")
def _(spark, sf):
    return labelled(spark, sf).withColumn("component", F.nullif("component", F.lit("other"))).select("id", chat.format_json_targets(TARGETS).alias("target"))


@query("strip_bos", "SELECT p_partkey, CASE WHEN starts_with(t, '<s>') THEN substr(t, 4) ELSE t END AS stripped FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '<s>' || p_name ELSE p_name || '<s>' END AS t FROM part)")
def _(spark, sf):
    t = F.when(C("p_partkey") % 2 == 0, F.concat(F.lit("<s>"), "p_name")).otherwise(F.concat("p_name", F.lit("<s>")))
    return table(spark, sf, "part").withColumn("t", t).select("p_partkey", chat.strip_bos(C("t"), "<s>").alias("stripped"))


@query("check_mask_tokens", "SELECT conv_id, turn, CASE WHEN role <> 'user' AND role <> 'assistant' THEN '<|user|>,<|assistant|>' WHEN role <> 'user' THEN '<|user|>' ELSE '<|assistant|>' END AS missing_markers FROM conversations")
def _(spark, sf):
    d = table(spark, sf, "conversations").withColumn("t", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text"))
    return chat.check_mask_tokens(d, "t", ["<|user|>", "<|assistant|>"]).select("conv_id", "turn", "missing_markers")


@query("conversations_to_turns", "SELECT conv_id, 0 AS chunk, count(*)::INT AS n_turns, md5(string_agg(role || ': ' || text, '|' ORDER BY turn, role, text)) AS digest FROM conversations GROUP BY 1, 2")
def _(spark, sf):
    d = chat.conversations_to_turns(table(spark, sf, "conversations"))
    flat = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "|")
    return d.select("conv_id", "chunk", "n_turns", F.md5(flat).alias("digest"))


TRUTH = f"""truth AS (SELECT p_partkey AS row_id, p_partkey % 2 = 0 AS true_fire, p_partkey % 3 = 0 AS true_crash, ['brakes','engine','tires','other'][p_partkey % 4 + 1] AS true_component FROM part),
pairs AS (SELECT t.*, p.fire AS pred_fire, p.crash AS pred_crash, p.component AS pred_component FROM truth t JOIN parsed p USING (row_id))"""
ANS = f"WITH {JSON_ANSWERS}, {JSON_PARSED}, {TRUTH}"
NAMES = ["fire", "crash", "component"]


def pairs(spark, sf):
    k = C("p_partkey")
    t = table(spark, sf, "part").select(k.alias("row_id"), (k % 2 == 0).alias("true_fire"), (k % 3 == 0).alias("true_crash"),
                                        F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (k % 4 + 1).cast("int")).alias("true_component"))
    p = parse_json_prediction(json_answers(spark, sf), "answer", CLASSES).select("row_id", *[C(n).alias(f"pred_{n}") for n in NAMES])
    return t.join(p, "row_id")


@query("parse_rate", f"{ANS} " + " UNION ALL ".join(f"SELECT '{n}' AS target, count(*) AS n, {R(f'avg((pred_{n} IS NOT NULL)::INT)')} AS parse_rate FROM pairs" for n in NAMES))
def _(spark, sf):
    p = pairs(spark, sf)
    return chat.parse_rate(p.select(*[C(f"pred_{n}").alias(n) for n in NAMES]), NAMES)


LONG = "lg AS (" + " UNION ALL ".join(f"SELECT '{n}' AS target, true_{n}::VARCHAR AS y, pred_{n}::VARCHAR AS yhat FROM pairs" for n in NAMES) + ")"


@query("eval_parsed", f"""{ANS}, {LONG}, ok AS (SELECT * FROM lg WHERE yhat IS NOT NULL), cls AS (SELECT target, y AS c FROM ok UNION SELECT target, yhat FROM ok),
pc AS (SELECT target, c, (SELECT count(*) FROM ok WHERE ok.target = cls.target AND y = c AND yhat = c) AS tp, (SELECT count(*) FROM ok WHERE ok.target = cls.target AND y = c) AS s, (SELECT count(*) FROM ok WHERE ok.target = cls.target AND yhat = c) AS p FROM cls),
f AS (SELECT target, {R('avg(2.0 * tp / (s + p))')} AS f1_macro, {R('sum(tp) / sum(s)')} AS f1_micro, {R('sum(s * 2.0 * tp / (s + p)) / sum(s)')} AS f1_weighted FROM pc GROUP BY 1)
SELECT target, count(*) AS n, count(yhat) AS n_parsed, {R('avg((yhat IS NOT NULL)::INT)')} AS parse_rate, {R('avg((y = yhat)::INT) FILTER (yhat IS NOT NULL)')} AS accuracy, any_value(f1_macro) AS f1_macro, any_value(f1_micro) AS f1_micro, any_value(f1_weighted) AS f1_weighted FROM lg LEFT JOIN f USING (target) GROUP BY 1""")
def _(spark, sf):
    return chat.eval_parsed(pairs(spark, sf), NAMES)


@query("confusion_active", f"""{ANS}, ok AS (SELECT true_component AS y, pred_component AS yhat FROM pairs WHERE pred_component IS NOT NULL), act AS (SELECT DISTINCT y AS c FROM ok)
SELECT a.c AS y, b.c AS yhat, (SELECT count(*) FROM ok WHERE ok.y = a.c AND ok.yhat = b.c) AS n FROM act a, act b""")
def _(spark, sf):
    return chat.confusion_active(pairs(spark, sf).select(C("true_component").alias("y"), C("pred_component").alias("yhat")))


MOVES = f"{CLASS_PROBS}, moves AS (SELECT row_id, yhat = y AS ok_a, {H(key(Q + 'm' + Q, 'row_id'))} % 4 = 0 OR (yhat = y AND row_id % 5 > 0) AS ok_b FROM class_probs), mb AS (SELECT *, CASE WHEN ok_a AND ok_b THEN 'kept' WHEN ok_a THEN 'regressed' WHEN ok_b THEN 'fixed' ELSE 'still wrong' END AS bucket FROM moves)"


def moves(spark, sf):
    ok = C("yhat") == C("y")
    return class_probs(spark, sf).select("row_id", ok.alias("ok_a"), ((hash_bucket(4, F.lit("m"), "row_id") == 0) | (ok & (C("row_id") % 5 > 0))).alias("ok_b"))


@query("transition_table", f"WITH {MOVES} SELECT bucket, count(*) AS n, (SELECT sum(ok_b::INT - ok_a::INT) FROM moves)::BIGINT AS net_change FROM mb GROUP BY 1")
def _(spark, sf):
    return chat.transition_table(moves(spark, sf), "ok_a", "ok_b")


@query("transition_examples", f"WITH {MOVES} SELECT bucket, position::INT AS position, row_id FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY row_id) AS position FROM mb) WHERE position <= 8")
def _(spark, sf):
    return chat.transition_examples(moves(spark, sf), "ok_a", "ok_b").select("bucket", "position", "row_id")
