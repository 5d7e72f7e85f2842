"""Inputs the evaluation queries share: deterministic predictions derived from the given tables.

Models cannot be repeated in SQL, so metrics are checked on score columns built from md5 hashes of the row
keys.  Each fixture exists twice: as a DataFrame and as the SQL text of a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.core import mix_factors, unit
from plumbline.operators.inject import ISSUE_HASHES, inject_issues, inject_label_noise
from plumbline.plans.registry import H, U, key, spread, table
from plumbline.session import shared_folder

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def n_sql(tag: str) -> str:
    a, b = mix_factors(ISSUE_HASHES.index(tag))
    return f"((h0 * {a} + h1 * {b}) % 2147483647)"


def u_sql(tag: str) -> str:
    return f"({n_sql(tag)} / 2147483647::DOUBLE)"


def z_sql(tag: str) -> str:
    return (f"(sqrt(-2.0::DOUBLE * ln(({n_sql(tag + '_a')} + 1.0::DOUBLE) / 2147483647::DOUBLE)) "
            f"* cos(6.283185307179586::DOUBLE * {u_sql(tag + '_b')}))")


def profiled(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with the 0/1 target ``is_returned`` and one planted column per issue."""
    li = spread(table(spark, sf, "lineitem")).withColumn("is_returned", (F.col("l_returnflag") == "R").cast("int"))
    return inject_issues(li, LINE_KEY, "is_returned", "l_quantity")


def profiled_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a written table, for plans that read it many times."""
    path = shared_folder(spark, "profiled")
    profiled(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


PROFILED = f"""profiled AS MATERIALIZED (SELECT * EXCLUDE (h0, h1),
  is_returned * 100.0::DOUBLE + {z_sql('leak')} AS leak_after_event,
  concat('user_', ({n_sql('user')} % 666)::VARCHAR) AS session_user,
  ({u_sql('rare')} < 0.01)::INT AS rare_flag,
  CASE WHEN {u_sql('miss')} >= 0.30 THEN l_quantity END AS feature_missing,
  exp(5.0::DOUBLE + 2.0::DOUBLE * {z_sql('skew')}) AS skewed_amount,
  CASE WHEN {u_sql('spike')} < 0.02 THEN 1500.0::DOUBLE + 3500.0::DOUBLE * {u_sql('level')}
       ELSE 100.0::DOUBLE + 20.0::DOUBLE * {z_sql('lat')} END AS latency_ms,
  l_quantity + 0.01::DOUBLE * {z_sql('copy')} AS feature_copy,
  ['north','south','east','west'][({n_sql('area')} % 4) + 1] AS area
  FROM (SELECT *, (l_returnflag = 'R')::INT AS is_returned, {H(key(*LINE_KEY))} % 2147483647 AS h0, {H(key(*LINE_KEY), 1)} % 2147483647 AS h1 FROM lineitem))"""

PROFILED_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "is_returned", "leak_after_event", "rare_flag", "feature_missing", "skewed_amount",
                    "latency_ms", "feature_copy"]
PROFILED_TEXT = ["l_returnflag", "l_linestatus", "session_user", "area"]
PROFILED_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "is_returned", "leak_after_event", "session_user",
                "rare_flag", "feature_missing", "skewed_amount", "latency_ms", "feature_copy", "area"]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """events as ``(row_id, y, score)``: y = purchase, score in steps of 0.001."""
    e = spread(table(spark, sf, "events"))
    y = (F.col("event_type") == "purchase").cast("int")
    return e.select(F.col("event_id").alias("row_id"), y.alias("y"),
                    (F.floor(1000 * (0.3 * y + 0.7 * unit(F.lit("score"), "event_id"))).cast("double") / 1000.0).alias("score"))


SCORED = f"""scored AS (SELECT event_id AS row_id, y,
  floor(1000::DOUBLE * (0.3::DOUBLE * y + 0.7::DOUBLE * {U(key("'score'", 'event_id'))})) / 1000.0::DOUBLE AS score
  FROM (SELECT event_id, (event_type = 'purchase')::INT AS y FROM events))"""


def class_probs(spark: SparkSession, sf: str) -> DataFrame:
    """orders as ``(row_id, y, yhat, probs)`` over the classes F, O, P = 0, 1, 2."""
    o = spread(table(spark, sf, "orders"))
    y = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    base = o.select(F.col("o_orderkey").alias("row_id"), y.alias("y"))
    base = base.withColumns({f"w{c}": 0.05 + unit(F.lit(f"p{c}"), "row_id") + 0.6 * (F.col("y") == c).cast("double") for c in range(3)})
    base = base.withColumn("total", F.col("w0") + F.col("w1") + F.col("w2"))
    out = base.select("row_id", "y", F.array(*[F.col(f"w{c}") / F.col("total") for c in range(3)]).alias("probs"))
    p = F.col("probs")
    best = F.when((p[0] >= p[1]) & (p[0] >= p[2]), 0).when(p[1] >= p[2], 1).otherwise(2)
    return out.withColumn("yhat", best)


_W = [f"(0.05::DOUBLE + {U(key(f'{chr(39)}p{c}{chr(39)}', 'row_id'))} + 0.6::DOUBLE * (y = {c})::INT)" for c in range(3)]
CLASS_PROBS = f"""class_probs AS (SELECT row_id, y, [p0, p1, p2] AS probs, p0, p1, p2,
  CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS yhat
  FROM (SELECT row_id, y, w0/(w0+w1+w2) AS p0, w1/(w0+w1+w2) AS p1, w2/(w0+w1+w2) AS p2 FROM (
    SELECT row_id, y, {_W[0]} AS w0, {_W[1]} AS w1, {_W[2]} AS w2 FROM (
      SELECT o_orderkey AS row_id, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y FROM orders))))"""

ML_LABELS = ["urgent", "open", "big"]


def multilabel_wide(spark: SparkSession, sf: str) -> DataFrame:
    """orders as ``row_id, y_<label>, p_<label>`` for three labels."""
    o = spread(table(spark, sf, "orders"))
    base = o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("y_urgent"),
        (F.col("o_orderstatus") == "O").cast("int").alias("y_open"),
        (F.col("o_totalprice") > 400000).cast("int").alias("y_big"))
    return base.withColumns({
        f"p_{n}": F.floor(100 * (0.35 * F.col(f"y_{n}") + 0.65 * unit(F.lit(n), "row_id"))).cast("double") / 100.0
        for n in ML_LABELS})


_P = ", ".join(
    f"floor(100::DOUBLE * (0.35::DOUBLE * y_{n} + 0.65::DOUBLE * {U(key(f'{chr(39)}{n}{chr(39)}', 'row_id'))})) / 100.0::DOUBLE AS p_{n}"
    for n in ML_LABELS)
MULTILABEL_WIDE = f"""mlw AS (SELECT *, {_P} FROM (SELECT o_orderkey AS row_id,
  (o_orderpriority IN ('1-URGENT','2-HIGH'))::INT AS y_urgent, (o_orderstatus = 'O')::INT AS y_open,
  (o_totalprice > 400000)::INT AS y_big FROM orders))"""
MULTILABEL = MULTILABEL_WIDE + """, ml AS (
  SELECT row_id, 'urgent' AS label, y_urgent AS y, p_urgent AS score, (p_urgent >= 0.5)::INT AS yhat FROM mlw
  UNION ALL SELECT row_id, 'open', y_open, p_open, (p_open >= 0.5)::INT FROM mlw
  UNION ALL SELECT row_id, 'big', y_big, p_big, (p_big >= 0.5)::INT FROM mlw)"""


def multilabel(spark: SparkSession, sf: str) -> DataFrame:
    """Long form ``(row_id, label, y, score, yhat)``."""
    w = multilabel_wide(spark, sf)
    cells = [F.struct(F.lit(n).alias("label"), F.col(f"y_{n}").alias("y"), F.col(f"p_{n}").alias("score")) for n in ML_LABELS]
    return w.select("row_id", F.inline(F.array(*cells))).withColumn("yhat", (F.col("score") >= 0.5).cast("int"))


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as ``(row_id, y, yhat, lo, hi)``: price in thousands with a triangular error."""
    li = spread(table(spark, sf, "lineitem"))
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in [*LINE_KEY]], (F.round(F.col("l_extendedprice") * 100)).cast("long").cast("string"))
    base = li.select(F.md5(k.cast("binary")).alias("row_id"), (F.col("l_extendedprice") / 1000.0).alias("y"))
    err = 8.0 * (unit(F.lit("e1"), "row_id") + unit(F.lit("e2"), "row_id") - 1.0)
    out = base.withColumn("yhat", F.col("y") + err)
    return out.withColumns({"lo": F.col("yhat") - 2.5 - unit(F.lit("w"), "row_id"), "hi": F.col("yhat") + 2.5 + unit(F.lit("w"), "row_id")})


def predicted_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a written table, for plans that read it many times."""
    path = shared_folder(spark, "predicted")
    predicted(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


PREDICTED = f"""predicted AS (SELECT *, yhat - 2.5::DOUBLE - w AS lo, yhat + 2.5::DOUBLE + w AS hi FROM (
  SELECT row_id, y, y + 8.0::DOUBLE * ({U(key("'e1'", 'row_id'))} + {U(key("'e2'", 'row_id'))} - 1.0::DOUBLE) AS yhat, {U(key("'w'", 'row_id'))} AS w
  FROM (SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice * 100)::BIGINT)) AS row_id,
        l_extendedprice / 1000.0::DOUBLE AS y FROM lineitem)))"""

LANGS = ["de", "en", "es", "fr"]
NOISE = {"off_by_one": 0.02, "random_flip": 0.03, "systematic": 0.04, "structural_null": 0.01,
         "structural_dup": 0.01, "structural_enum": 0.005}


def noisy_docs(spark: SparkSession, sf: str) -> DataFrame:
    """documents labelled by language, with planted label errors."""
    return inject_label_noise(spread(table(spark, sf, "documents")), "doc_id", "text", "lang", LANGS, ("en", "fr"), NOISE)


def _noise_sql() -> str:
    low, cases = 0.0, []
    for k, r in NOISE.items():
        high = low + r
        extra = " AND lang IN ('en','fr')" if k == "systematic" else ""
        cases.append(f"WHEN u >= {low!r}::DOUBLE AND u < {high!r}::DOUBLE{extra} THEN '{k}'")
        low = high
    langs = "['de','en','es','fr']"
    return f"""noise_base AS (SELECT doc_id AS row_id, lang AS label_true, corruption,
    CASE WHEN corruption = 'structural_null' THEN '' ELSE text END AS data,
    CASE corruption WHEN 'off_by_one' THEN {langs}[(list_position({langs}, lang) - 1 + 1) % 4 + 1]
      WHEN 'random_flip' THEN {langs}[(list_position({langs}, lang) - 1 + 1 + {H(key("'flip'", 'doc_id'))} % 3) % 4 + 1]
      WHEN 'systematic' THEN CASE lang WHEN 'en' THEN 'fr' ELSE 'en' END
      WHEN 'structural_enum' THEN 'MISC' ELSE lang END AS noisy,
    {H(key("'cell'", 'doc_id'))} % 64 AS cell
  FROM (SELECT *, CASE {' '.join(cases)} ELSE 'clean' END AS corruption
        FROM (SELECT *, {U(key("'noise'", 'doc_id'))} AS u FROM documents))),
noise_src AS (SELECT cell, arg_min(data, row_id) AS s_data, arg_min(noisy, row_id) AS s_noisy FROM noise_base
  WHERE corruption = 'clean' AND length(data) > 0 GROUP BY cell),
noisy AS (SELECT row_id,
    CASE WHEN corruption = 'structural_dup' AND s_data IS NOT NULL THEN s_data ELSE data END AS data,
    CASE WHEN corruption = 'structural_dup' AND s_data IS NOT NULL AND noisy = s_noisy
         THEN {langs}[list_position({langs}, s_noisy) % 4 + 1] ELSE noisy END AS untrustworthy_label,
    label_true, corruption
  FROM noise_base LEFT JOIN noise_src USING (cell))"""


NOISY = _noise_sql()
