"""Preparation queries."""

from pyspark.sql import functions as F

from plumbline.functions.core import hash_bucket, rnd
from plumbline.operators import prep, profile
from plumbline.plans.fixtures import NOISY, PROFILED, noisy_docs, profiled, profiled_table
from plumbline.plans.registry import H, R, U, key, query, table

C = F.col
LID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
IDS = ", ".join(LID)
W = f"WITH {PROFILED}"


@query("impute_median", f"{W} SELECT {IDS}, coalesce(feature_missing, (SELECT quantile_cont(feature_missing, 0.5) FROM profiled)) AS feature_missing FROM profiled")
def _(spark, sf):
    return prep.impute_median(profiled_table(spark, sf), ["feature_missing"]).select(*LID, "feature_missing")


GAPS = "gaps AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id FROM events)"


def gaps(spark, sf):
    return table(spark, sf, "events").select("event_id", F.when(C("event_id") % 4 != 0, C("event_type")).alias("kind"), F.when(C("event_id") % 5 != 0, C("user_id")).alias("user_id"))


def _mode(c):
    return f"(SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("impute_mode", f"WITH {GAPS} SELECT event_id, coalesce(kind, {_mode('kind')}) AS kind, coalesce(user_id, {_mode('user_id')}) AS user_id FROM gaps")
def _(spark, sf):
    return prep.impute_mode(gaps(spark, sf), ["kind", "user_id"])


@query("impute_sentinel", f"WITH {GAPS} SELECT event_id, coalesce(kind, 'missing') AS kind, user_id FROM gaps")
def _(spark, sf):
    return prep.impute_sentinel(gaps(spark, sf), ["kind"])


@query("standardize", f"SELECT {IDS}, {R('(l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem)')} AS l_quantity, {R('(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem)')} AS l_extendedprice FROM lineitem")
def _(spark, sf):
    d = prep.standardize(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return d.select(*LID, rnd(C("l_quantity")).alias("l_quantity"), rnd(C("l_extendedprice")).alias("l_extendedprice"))


@query("one_hot", "SELECT o_orderkey, (o_orderstatus = 'F')::INT AS o_orderstatus_F, (o_orderstatus = 'O')::INT AS o_orderstatus_O, (o_orderstatus = 'P')::INT AS o_orderstatus_P FROM orders")
def _(spark, sf):
    return prep.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus").drop("o_orderstatus")


@query("encode_frequency", f"SELECT event_id, {R('count(*) OVER (PARTITION BY user_id) / (SELECT count(user_id) FROM events)::DOUBLE')} AS user_id_freq FROM events")
def _(spark, sf):
    return prep.encode_frequency(table(spark, sf, "events").select("event_id", "user_id"), "user_id").select("event_id", rnd(C("user_id_freq")).alias("user_id_freq"))


@query("encode_target", f"""WITH e AS (SELECT event_id, user_id, (event_type = 'purchase')::INT AS y, {H('event_id::VARCHAR')} % 5 AS fold FROM events),
c AS (SELECT user_id, fold, sum(y)::DOUBLE AS s, count(y)::DOUBLE AS n FROM e GROUP BY 1, 2), w AS (SELECT user_id, sum(s) AS ts, sum(n) AS tn FROM c GROUP BY 1), f AS (SELECT fold, sum(s) AS fs, sum(n) AS fn FROM c GROUP BY 1), t AS (SELECT sum(s) AS gs, sum(n) AS gn FROM c)
SELECT event_id, {R('(ts - s + 10 * (gs - fs) / (gn - fn)) / (tn - n + 10)')} AS user_id_target FROM e JOIN c USING (user_id, fold) JOIN w USING (user_id) JOIN f USING (fold), t""")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", (C("event_type") == "purchase").cast("int").alias("y"), hash_bucket(5, "event_id").alias("fold"))
    return prep.encode_target(e, "user_id", "y", "fold").select("event_id", rnd(C("user_id_target")).alias("user_id_target"))


@query("encode_hash", f"SELECT p_partkey, ({H('p_name')} % 16)::INT AS p_name_hash FROM part")
def _(spark, sf):
    return prep.encode_hash(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", 16).select("p_partkey", "p_name_hash")


@query("transform_log", f"{W} SELECT {IDS}, {R('ln(1 + skewed_amount)')} AS skewed_amount FROM profiled")
def _(spark, sf):
    return prep.transform_log(profiled(spark, sf), ["skewed_amount"]).select(*LID, rnd(C("skewed_amount")).alias("skewed_amount"))


@query("winsorize", f"{W} SELECT {IDS}, {R('least(greatest(latency_ms, (SELECT quantile_cont(latency_ms, 0.01) FROM profiled)), (SELECT quantile_cont(latency_ms, 0.99) FROM profiled))')} AS latency_ms FROM profiled")
def _(spark, sf):
    return prep.winsorize(profiled_table(spark, sf), ["latency_ms"]).select(*LID, rnd(C("latency_ms")).alias("latency_ms"))


@query("robust_scale", f"{W} SELECT {IDS}, {R('(latency_ms - (SELECT quantile_cont(latency_ms, 0.5) FROM profiled)) / ((SELECT quantile_cont(latency_ms, 0.75) FROM profiled) - (SELECT quantile_cont(latency_ms, 0.25) FROM profiled))')} AS latency_ms FROM profiled")
def _(spark, sf):
    return prep.robust_scale(profiled_table(spark, sf), ["latency_ms"]).select(*LID, rnd(C("latency_ms")).alias("latency_ms"))


LAMBDAS = [-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]


@query("box_cox_grid", " UNION ALL ".join(f"SELECT {v}::DOUBLE AS lam, {R(f'({v} - 1) * sum(ln(o_totalprice)) - count(*) / 2.0 * ln(var_pop(' + ('ln(o_totalprice)' if v == 0 else f'(o_totalprice ** {v}::DOUBLE - 1) / {v}') + '))', 2)} AS llf FROM orders WHERE o_totalprice > 0" for v in LAMBDAS))
def _(spark, sf):
    return prep.box_cox_grid(table(spark, sf, "orders"), "o_totalprice", LAMBDAS)


@query("drop_flagged", f"{W} SELECT {IDS}, l_quantity, is_returned, session_user, round(latency_ms, 4) + 0.0 AS latency_ms FROM profiled")
def _(spark, sf):
    df = profiled_table(spark, sf)
    out = prep.drop_flagged(df, profile.eda_findings(df, "is_returned"))
    gone = {"leak_after_event", "rare_flag", "feature_copy", "feature_missing"} & set(out.columns)
    if gone:
        raise AssertionError(f"still present: {gone}")
    return out.select(*LID, "l_quantity", "is_returned", "session_user", rnd(C("latency_ms"), 4).alias("latency_ms"))


@query("split_stratified", f"SELECT o_orderkey, o_orderstatus, CASE WHEN r <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split FROM (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H(key(chr(39) + 'split' + chr(39), 'o_orderkey'))}, o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)")
def _(spark, sf):
    return prep.split_stratified(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 0.2)


@query("split_three_way", f"SELECT event_id, CASE WHEN u < 0.2 THEN 'test' WHEN u < 0.4 THEN 'calibration' ELSE 'train' END AS split FROM (SELECT event_id, {U(key(chr(39) + 'three' + chr(39), 'event_id'))} AS u FROM events)")
def _(spark, sf):
    return prep.split_three_way(table(spark, sf, "events").select("event_id"), "event_id")


@query("dedupe_across_split", f"SELECT doc_id, CASE WHEN {U(key(*[f'coalesce(' + chr(39) + '=' + chr(39) + f' || {c}, ' + chr(39) + '~' + chr(39) + ')' for c in ('text', 'lang')]))} < 0.2 THEN 'test' ELSE 'train' END AS split FROM documents")
def _(spark, sf):
    return prep.dedupe_across_split(table(spark, sf, "documents"), ["text", "lang"], 0.2).select("doc_id", "split")


@query("fold_assign", f"SELECT event_id, ({H('event_id::VARCHAR')} % 5)::INT AS fold FROM events")
def _(spark, sf):
    return prep.fold_assign(table(spark, sf, "events").select("event_id"), "event_id")


@query("fold_assign_stratified", f"SELECT event_id, event_type, ((row_number() OVER (PARTITION BY event_type ORDER BY {H('event_id::VARCHAR')}, event_id) - 1) % 5)::INT AS fold FROM events")
def _(spark, sf):
    return prep.fold_assign(table(spark, sf, "events").select("event_id", "event_type"), "event_id", label="event_type")


@query("class_weights_balanced", f"SELECT event_id, {R('(SELECT count(*) FROM events)::DOUBLE / ((SELECT count(DISTINCT event_type) FROM events) * count(*) OVER (PARTITION BY event_type))')} AS weight FROM events")
def _(spark, sf):
    return prep.class_weights_balanced(table(spark, sf, "events").select("event_id", "event_type"), "event_type").select("event_id", rnd(C("weight")).alias("weight"))


@query("scale_pos_weight", f"SELECT sum(toxic)::BIGINT AS n_pos, sum(1 - toxic)::BIGINT AS n_neg, {R('sum(1 - toxic) / sum(toxic)')} AS scale_pos_weight FROM labels")
def _(spark, sf):
    return prep.scale_pos_weight(table(spark, sf, "labels"), "toxic")


@query("inject_label_noise", f"WITH {NOISY} SELECT row_id, md5(data) AS data_md5, untrustworthy_label, label_true, corruption FROM noisy")
def _(spark, sf):
    return noisy_docs(spark, sf).select("row_id", F.md5("data").alias("data_md5"), "untrustworthy_label", "label_true", "corruption")
