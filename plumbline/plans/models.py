"""Model queries over line items with planted signal columns and over order labels."""

from pyspark.sql import functions as F

from plumbline.functions.core import hash_bucket, rnd, unit
from plumbline.operators import models as md
from plumbline.operators import tfidf
from plumbline.operators.ordering import quantile_table
from plumbline.plans.fixtures import ML_LABELS, multilabel_wide, scored
from plumbline.plans.registry import H, R, key, query, spread, table
from plumbline.session import shared_folder

C = F.col
FEATS = ["x1", "x2", "x3"]


def events_xy(spark, sf):
    """events with a noisy signal for purchases, a noise column and the raw value; five hash folds."""
    e = table(spark, sf, "events")
    y = (C("event_type") == "purchase").cast("int")
    return e.select("event_id", y.alias("y"), (0.5 * y + unit(F.lit("x1"), "event_id")).alias("x1"), unit(F.lit("x2"), "event_id").alias("x2"),
                    C("value").alias("x3"), hash_bucket(3, F.lit("fold"), "event_id").alias("fold"))


def lines_xy(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_quantity", "l_discount", "l_tax", "l_linenumber", (C("l_extendedprice") / 1000).alias("price"),
                     F.when(C("l_returnflag") == "A", 0).when(C("l_returnflag") == "N", 1).otherwise(2).alias("flag"))


LINE_FEATS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("fit_logistic")
def _(spark, sf):
    return md.fit_logistic(events_xy(spark, sf), FEATS, "y")[1]


@query("fit_linear")
def _(spark, sf):
    return md.fit_linear(lines_xy(spark, sf), LINE_FEATS, "price")[1]


@query("fit_linear_one_feature", f"SELECT {R('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope, {R('regr_intercept(l_extendedprice, l_quantity)', 2)} AS intercept FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(rnd(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"), rnd(F.regr_intercept("l_extendedprice", "l_quantity"), 2).alias("intercept"))


# fold 0 fits, fold 1 decides when to stop, fold 2 is scored
@query("fit_boosted_binary", f"SELECT event_id, (event_type = 'purchase')::INT AS y, true AS scored FROM events WHERE {H(key(chr(39) + 'fold' + chr(39), 'event_id'))} % 3 = 2")
def _(spark, sf):
    d = events_xy(spark, sf).withColumn("valid", C("fold") == 1)
    model = md.fit_boosted_binary(d.where("fold < 2"), FEATS, "y", "valid", maxIter=5, maxDepth=3)
    return md.probability(model.transform(d.where("fold = 2"))).select("event_id", "y", C("score").between(0, 1).alias("scored"))


@query("fit_boosted_multiclass")
def _(spark, sf):
    d = lines_xy(spark, sf)
    return md.fit_boosted_multiclass(d, LINE_FEATS, "flag").transform(d).groupBy("flag", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("fit_boosted_regression")
def _(spark, sf):
    from plumbline.operators.regression import regression_metrics
    d = lines_xy(spark, sf)
    d = d.withColumn("fold", F.pmod(F.xxhash64(*LINE_FEATS, "price"), F.lit(5)))
    model = md.fit_boosted_regression(d.where("fold < 4").withColumn("valid", C("fold") == 3), LINE_FEATS, "price", "valid", maxIter=5, maxDepth=3, lossType="absolute")
    p = model.transform(d.where("fold = 4"))
    return regression_metrics(p.select(C("price").alias("y"), C("prediction").alias("yhat")))


# two thirds of the lines fit, the rest is scored: counts are exact, the band must hold about nine in ten and be narrower than the constant one
LINE = key("'band'", "l_orderkey", "l_linenumber")


@query("fit_quantile_bounds", f"SELECT count(*) AS n, true AS covered, true AS below_level, true AS above_level, true AS narrower, 0::BIGINT AS crossed FROM lineitem WHERE {H(LINE)} % 3 = 2")
def _(spark, sf):
    fold = hash_bucket(3, F.lit("band"), "l_orderkey", "l_linenumber")
    d = table(spark, sf, "lineitem").select(*LINE_FEATS, (C("l_extendedprice") / 1000 + 2 * C("l_quantity")).alias("price"), fold.alias("fold"))
    train, held = d.where("fold < 2"), d.where("fold = 2")
    b = md.fit_quantile_bounds(train, held, LINE_FEATS, "price", rounds=6, rate=0.5)
    flat = quantile_table(train, ["price"], [0.05, 0.95]).agg((F.max("value") - F.min("value")).alias("flat"))
    inside, below, above = (F.avg(x.cast("int")) for x in (C("price").between(C("lo"), C("hi")), C("price") < C("lo"), C("price") > C("hi")))
    got = b.agg(F.count(F.lit(1)).alias("n"), inside.between(0.87, 0.93).alias("covered"), below.between(0.03, 0.07).alias("below_level"), above.between(0.03, 0.07).alias("above_level"),
                F.avg(C("hi") - C("lo")).alias("width"), F.count_if(C("lo") > C("hi")).alias("crossed"))
    return got.join(flat).select("n", "covered", "below_level", "above_level", (C("width") < 0.9 * C("flat")).alias("narrower"), "crossed")


def orders_xy(spark, sf):
    w = multilabel_wide(spark, sf)
    return w.select("row_id", *[C(f"p_{n}").alias(f"x_{n}") for n in ML_LABELS], *[C(f"y_{n}") for n in ML_LABELS])


@query("fit_multi_output")
def _(spark, sf):
    d, labels = orders_xy(spark, sf), [f"y_{n}" for n in ML_LABELS]
    return md.predict_multi_output(md.fit_multi_output(d, [f"x_{n}" for n in ML_LABELS], labels), d, ["row_id"])


@query("fit_classifier_chain")
def _(spark, sf):
    d, labels = orders_xy(spark, sf), [f"y_{n}" for n in ML_LABELS]
    return md.fit_classifier_chain(d, [f"x_{n}" for n in ML_LABELS], labels).select("row_id", *[f"p_{n}" for n in labels])


def _fit(train):
    return md.logistic(FEATS, "y", maxIter=20).fit(train)


@query("cv_score")
def _(spark, sf):
    return md.cv_score(events_xy(spark, sf), "y", "fold", 3, _fit)


@query("oof_probabilities")
def _(spark, sf):
    return md.oof_probabilities(events_xy(spark, sf), "fold", 3, _fit).select("event_id", "y", "fold", "score")


@query("grid_search")
def _(spark, sf):
    return md.grid_search(events_xy(spark, sf), FEATS, "y", "fold", 3, [0.0, 0.1], [0.0, 0.5])


@query("random_search")
def _(spark, sf):
    return md.random_search(events_xy(spark, sf), FEATS, "y", "fold", 3, 3)


TOK = "[\\p{L}\\p{N}_]{2,}"


@query("tfidf_features", f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{TOK}') AS w FROM documents), u AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w),
g AS (SELECT doc_id, t AS term FROM u UNION ALL SELECT a.doc_id, a.t || ' ' || b.t FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.i = a.i + 1), tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2),
v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS idf, sum(tf) AS total FROM tf GROUP BY 1 HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 15000),
r AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN v USING (term)) SELECT doc_id, term, {R('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM r""")
def _(spark, sf):
    return tfidf.tfidf_features(spread(table(spark, sf, "documents")), "doc_id", "text").select("doc_id", "term", rnd(C("weight")).alias("weight"))


@query("permutation_importance")
def _(spark, sf):
    d = events_xy(spark, sf)
    return md.permutation_importance(_fit(d), d, FEATS, "y", "event_id")


@query("batch_predict")
def _(spark, sf):
    d = events_xy(spark, sf)
    path = shared_folder(spark, "model")
    _fit(d).write().overwrite().save(path)
    return md.batch_predict(path, d).select("event_id", "score", "yhat")
