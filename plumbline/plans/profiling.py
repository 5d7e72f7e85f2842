"""Table profile queries over lineitem with planted issues."""

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.operators import information, inject, profile
from plumbline.plans.fixtures import (
    PROFILED, PROFILED_ALL, PROFILED_NUMERIC, PROFILED_TEXT, profiled, profiled_table,
)
from plumbline.plans.registry import D, H, R, key, query, table

NUM = PROFILED_NUMERIC
FEATS = [c for c in NUM if c != "is_returned"]
W = f"WITH {PROFILED}"


def union(parts):
    return "\nUNION ALL ".join(parts)


def corr_sql(a, b):
    c = f"corr({a}, {b})"
    return f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)"


def fences_sql(cols):
    return "fences AS (" + union(
        f"SELECT '{c}' AS feature, quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS q2, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM profiled"
        for c in cols) + ")"


def long_sql(cols, name="long", source="profiled"):
    return f"{name} AS (" + union(f"SELECT '{c}' AS feature, {c}::DOUBLE AS x FROM {source} WHERE {c} IS NOT NULL" for c in cols) + ")"


@query("profile_shape", f"{W} SELECT count(*) AS n_rows, 20 AS n_cols, 15 AS n_numeric, 4 AS n_categorical FROM profiled")
def _(spark, sf):
    return profile.profile_shape(profiled(spark, sf))


@query("profile_missing", f"{W} " + union(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_missing, {R(f'count(*) FILTER ({c} IS NULL) / count(*)::DOUBLE')} AS missing_share FROM profiled"
    for c in PROFILED_ALL))
def _(spark, sf):
    return profile.profile_missing(profiled(spark, sf))


@query("profile_missing_total", f"""{W} SELECT sum(m)::BIGINT AS missing_cells, (count(*) * 20)::BIGINT AS n_cells, {R('sum(m) / (count(*) * 20.0)')} AS missing_share
FROM (SELECT {' + '.join(f'({c} IS NULL)::INT' for c in PROFILED_ALL)} AS m FROM profiled)""")
def _(spark, sf):
    return profile.total_missing(profiled(spark, sf))


@query("infer_target_type", """
SELECT 'is_returned' AS target, count(DISTINCT l_returnflag = 'R') AS n_unique, 'binary' AS target_type FROM lineitem
UNION ALL SELECT 'l_linenumber', count(DISTINCT l_linenumber), CASE WHEN count(DISTINCT l_linenumber) = 2 THEN 'binary' WHEN count(DISTINCT l_linenumber) <= 20 THEN 'multiclass' ELSE 'regression' END FROM lineitem
UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey), CASE WHEN count(DISTINCT l_partkey) = 2 THEN 'binary' WHEN count(DISTINCT l_partkey) <= 20 THEN 'multiclass' ELSE 'regression' END FROM lineitem
UNION ALL SELECT 'l_discount', count(DISTINCT l_discount), 'regression' FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag), 'categorical' FROM lineitem""")
def _(spark, sf):
    df = profiled(spark, sf)
    out = None
    for c in ("is_returned", "l_linenumber", "l_partkey", "l_discount", "l_returnflag"):
        part = profile.infer_target_type(df, c)
        out = part if out is None else out.unionByName(part)
    return out


@query("class_balance", f"SELECT l_returnflag AS value, count(*) AS n, {R('count(*) / (SELECT count(*) FROM lineitem WHERE l_returnflag IS NOT NULL)::DOUBLE')} AS share FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return profile.class_balance(table(spark, sf, "lineitem"), "l_returnflag")


@query("profile_skew", f"{W}, " + long_sql(NUM) + f" SELECT feature AS \"column\", {R('skewness(x)', 4)} AS skew, abs(skewness(x)) > 1 AS flagged FROM long GROUP BY feature")
def _(spark, sf):
    return profile.profile_skew(profiled(spark, sf))


HIST = ["l_quantity", "l_extendedprice", "skewed_amount", "latency_ms", "feature_missing"]


@query("profile_histogram", f"""{W}, {long_sql(HIST)}, rng AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM long GROUP BY 1),
bins AS (SELECT feature, b, lo + (hi - lo) * b / 40 AS left_edge FROM rng, range(40) t(b)),
cnt AS (SELECT feature, least(greatest(floor((x - lo) / (hi - lo) * 40)::INT, 0), 39) AS b, count(*) AS n FROM long JOIN rng USING (feature) GROUP BY 1, 2)
SELECT bins.feature AS "column", bins.b::INT AS bin, {R('left_edge')} AS left_edge, coalesce(n, 0) AS n FROM bins LEFT JOIN cnt USING (feature, b)""")
def _(spark, sf):
    return profile.profile_histogram(profiled_table(spark, sf), HIST)


@query("class_histograms", f"""{W}, long AS ({union(f"SELECT is_returned AS class, '{c}' AS feature, {c}::DOUBLE AS x FROM profiled WHERE {c} IS NOT NULL" for c in HIST)}),
rng AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM long GROUP BY 1), tot AS (SELECT class, feature, count(*) AS t FROM long GROUP BY 1, 2),
cnt AS (SELECT class, feature, least(greatest(floor((x - lo) / (hi - lo) * 30)::INT, 0), 29) AS b, count(*) AS n, any_value((hi - lo) / 30) AS width FROM long JOIN rng USING (feature) GROUP BY 1, 2, 3)
SELECT class, feature AS "column", b AS bin, n, {R('n / (t * width)')} AS density FROM cnt JOIN tot USING (class, feature)""")
def _(spark, sf):
    return profile.class_histograms(profiled_table(spark, sf), "is_returned", HIST)


@query("profile_cardinality", f"{W} " + union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, count(*) AS n_rows, count(DISTINCT {c}) > 50 AS flagged FROM profiled" for c in PROFILED_TEXT))
def _(spark, sf):
    return profile.profile_cardinality(profiled(spark, sf))


NEAR_SQL = union(
    f"SELECT '{c}' AS feature, max(n) / sum(n)::DOUBLE AS f FROM (SELECT count(*) AS n FROM profiled WHERE {c} IS NOT NULL GROUP BY {c})" for c in PROFILED_ALL)


@query("find_near_constant", f"{W} SELECT feature, {R('f', 4)} AS top_value_freq FROM ({NEAR_SQL}) WHERE f > 0.98")
def _(spark, sf):
    return profile.find_near_constant(profiled_table(spark, sf))


@query("corr_matrix", f"{W} " + union(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(corr_sql(a, b))} AS pearson FROM profiled" for a, b in combinations(NUM[4:], 2)))
def _(spark, sf):
    return profile.corr_matrix(profiled_table(spark, sf), NUM[4:])


LEAK_SQL = union(f"SELECT '{c}' AS feature, {corr_sql(c, 'is_returned')} AS p FROM profiled" for c in FEATS)


@query("find_leakage", f"{W} SELECT feature, {R('p', 4)} AS pearson, abs(p) > 0.99 AS certain FROM ({LEAK_SQL}) WHERE abs(p) > 0.95")
def _(spark, sf):
    return profile.find_leakage(profiled_table(spark, sf), "is_returned")


PAIR_SQL = union(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {corr_sql(a, b)} AS p FROM profiled" for a, b in combinations(FEATS, 2))


@query("find_redundant_pairs", f"{W} SELECT col_a, col_b, {R('abs(p)', 4)} AS pearson FROM ({PAIR_SQL}) WHERE abs(p) > 0.95")
def _(spark, sf):
    return profile.find_redundant_pairs(profiled_table(spark, sf), "is_returned")


OUT_SQL = """SELECT feature, count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
FROM long JOIN fences USING (feature) GROUP BY feature"""


@query("find_outliers_iqr", f"""{W}, {long_sql(NUM)}, {fences_sql(NUM)}
SELECT feature, n_outliers, {R('n_outliers / n::DOUBLE', 4)} AS outlier_pct, n_outliers / n::DOUBLE > 0.01 AS flagged FROM ({OUT_SQL})""")
def _(spark, sf):
    return profile.find_outliers_iqr(profiled_table(spark, sf))


@query("box_stats", f"""{W}, {long_sql(NUM)}, {fences_sql(NUM)}
SELECT feature AS "column", {R('any_value(q1)')} AS q1, {R('any_value(q2)')} AS median, {R('any_value(q3)')} AS q3,
 {R('min(x) FILTER (x >= q1 - 1.5 * (q3 - q1))')} AS whisker_lo, {R('max(x) FILTER (x <= q3 + 1.5 * (q3 - q1))')} AS whisker_hi,
 count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM long JOIN fences USING (feature) GROUP BY feature""")
def _(spark, sf):
    return profile.box_stats(profiled_table(spark, sf))


@query("find_scale_mismatch", f"""{W}, {long_sql(NUM)}, s AS (SELECT feature, stddev_samp(x) AS spread FROM long GROUP BY 1), m AS (SELECT median(spread) AS mid FROM s)
SELECT feature AS "column", {R('spread', 4)} AS spread, {R('spread / mid', 4)} AS ratio_to_median, abs(log10(spread / mid)) >= 2 AS flagged FROM s, m""")
def _(spark, sf):
    return profile.find_scale_mismatch(profiled(spark, sf))


def mi_sql():
    med = ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM profiled)) AS {c}" for c in FEATS)
    levels = [i / 10 for i in range(1, 10)]
    edges = union(f"SELECT '{c}' AS feature, " + ", ".join(f"quantile_cont({c}, {p}) AS e{i}" for i, p in enumerate(levels)) + " FROM filled" for c in FEATS)
    cells = union(f"SELECT is_returned AS y, '{c}' AS feature, {c} AS x FROM filled" for c in FEATS)
    b = " + ".join(f"(x > e{i})::INT" for i in range(9))
    return f"""filled AS MATERIALIZED (SELECT is_returned, {med} FROM profiled), edges AS ({edges}), cells AS ({cells}),
cont AS (SELECT feature, {b} AS b, y, count(*)::DOUBLE AS n FROM cells JOIN edges USING (feature) GROUP BY 1, 2, 3),
fb AS (SELECT feature, b, sum(n) AS nb FROM cont GROUP BY 1, 2), fy AS (SELECT feature, y, sum(n) AS ny FROM cont GROUP BY 1, 2),
ft AS (SELECT feature, sum(n) AS t FROM cont GROUP BY 1),
mi AS (SELECT feature, {R('greatest(sum(n / t * ln(n * t / (nb * ny))), 0)')} AS mi FROM cont JOIN fb USING (feature, b) JOIN fy USING (feature, y) JOIN ft USING (feature) GROUP BY feature)"""


@query("mutual_information", f"{W}, {mi_sql()} SELECT feature, mi FROM mi")
def _(spark, sf):
    return profile.mutual_information(profiled_table(spark, sf), "is_returned")


def neighbour_mi_sql():
    med = ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM profiled)) AS {c}" for c in FEATS)
    cells = union(f"SELECT is_returned AS y, '{c}' AS feature, {c} + 0.0::DOUBLE AS x FROM filled" for c in FEATS)
    near = ", ".join(f"{{'d': abs(x - {f}(x, {j}) OVER w), 's': {s}, 'v': {f}(x, {j}) OVER w}}" for j in (1, 2, 3) for f, s in (("lag", -1), ("lead", 1)))

    def psi(n):
        z = f"({n} + 6.0::DOUBLE)"
        steps = " + ".join(f"1.0::DOUBLE / ({n} + {i})" for i in range(6))
        return f"(ln({z}) - 0.5::DOUBLE / {z} - 1.0::DOUBLE / (12 * {z} ** 2) + 1.0::DOUBLE / (120 * {z} ** 4) - 1.0::DOUBLE / (252 * {z} ** 6) + 1.0::DOUBLE / (240 * {z} ** 8) - ({steps}))"

    return f"""filled AS MATERIALIZED (SELECT is_returned, {med} FROM profiled), cells AS ({cells}), ny AS (SELECT is_returned AS y, count(*) AS n FROM filled GROUP BY 1 HAVING count(*) > 1),
nb AS (SELECT feature, x, n, least(3, n - 1) AS k, list_sort(list_filter([{near}], lambda e: e.d IS NOT NULL))[least(3, n - 1)] AS e FROM cells JOIN ny USING (y) WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
iv AS MATERIALIZED (SELECT feature, x, n, k, e.d AS r, CASE WHEN e.s = -1 THEN e.v ELSE x - e.d END AS lo, CASE WHEN e.s = 1 THEN e.v ELSE x + e.d END AS hi FROM nb),
vals AS MATERIALIZED (SELECT feature, x, c, sum(c) OVER (PARTITION BY feature ORDER BY x) AS cum FROM (SELECT feature, x, count(*) AS c FROM iv GROUP BY 1, 2)),
met AS (SELECT iv.feature, iv.n, iv.k, CASE WHEN iv.r = 0 THEN s.c ELSE greatest(coalesce(h.cum, 0) - coalesce(l.cum, 0), 1) END AS m FROM iv JOIN vals s ON s.feature = iv.feature AND s.x = iv.x
 ASOF LEFT JOIN vals h ON h.feature = iv.feature AND iv.hi > h.x ASOF LEFT JOIN vals l ON l.feature = iv.feature AND iv.lo >= l.x)
SELECT feature, {R(f"greatest({psi('count(*)')} + avg({psi('k')}) - avg({psi('n')}) - avg({psi('m')}), 0)")} AS mi FROM met GROUP BY feature"""


@query("mutual_information_neighbours", f"{W}, {neighbour_mi_sql()}")
def _(spark, sf):
    return information.neighbour_information(profiled_table(spark, sf), "is_returned")


@query("mi_vs_pearson_gap", f"""{W}, {mi_sql()}, p AS (SELECT feature, coalesce(abs(p), 0) AS p FROM ({LEAK_SQL}))
SELECT feature, mi, {R('p')} AS abs_pearson, mi > 0.05 AND p < 0.1 AS gap FROM mi JOIN p USING (feature) ORDER BY mi DESC, feature LIMIT 5""")
def _(spark, sf):
    return profile.mi_vs_pearson_gap(profiled_table(spark, sf), "is_returned")


FINDINGS = f"""{long_sql(FEATS)}, {fences_sql(FEATS)}, findings AS (
SELECT 'target leakage' AS issue, feature, 'pearson' AS metric, {R('p', 4)} AS value FROM ({LEAK_SQL}) WHERE abs(p) > 0.95
UNION ALL SELECT 'high cardinality', feature, 'n_unique', n::DOUBLE FROM ({union(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n FROM profiled" for c in PROFILED_TEXT)}) WHERE n > 50
UNION ALL SELECT 'near constant', feature, 'top_value_freq', {R('f', 4)} FROM ({NEAR_SQL}) WHERE f > 0.98
UNION ALL SELECT 'redundant pair', col_a || ' <-> ' || col_b, 'pearson', {R('abs(p)', 4)} FROM ({PAIR_SQL}) WHERE abs(p) > 0.95
UNION ALL SELECT 'missing data', feature, 'missing_pct', {R('f', 4)} FROM ({union(f"SELECT '{c}' AS feature, {R(f'avg(({c} IS NULL)::INT)')} AS f FROM profiled" for c in PROFILED_ALL)}) WHERE f > 0
UNION ALL SELECT 'skewed distribution', feature, 'skew', {R('s', 4)} FROM (SELECT feature, skewness(x) AS s FROM long GROUP BY 1) WHERE abs(s) > 1
UNION ALL SELECT 'outliers', feature, 'outlier_pct', {R('n_outliers / n::DOUBLE', 4)} FROM ({OUT_SQL}) WHERE n_outliers / n::DOUBLE > 0.01)"""


@query("eda_findings", f"{W}, {FINDINGS} SELECT * FROM findings")
def _(spark, sf):
    return profile.eda_findings(profiled_table(spark, sf), "is_returned")


@query("findings_diff", f"""{W}, {FINDINGS}, old AS (SELECT 'missing data' AS issue, c AS feature, v AS value FROM (VALUES ('l_tax', 0.5::DOUBLE), ('feature_missing', 0.1::DOUBLE)) t(c, v)
  UNION ALL SELECT issue, feature, value FROM findings WHERE issue = 'outliers')
SELECT issue, feature, old.value AS old_value, f.value AS new_value,
 CASE WHEN old.value IS NULL THEN 'new' WHEN f.value IS NULL THEN 'gone' WHEN round(old.value, 4) = round(f.value, 4) THEN 'same' ELSE 'changed' END AS change
FROM old FULL JOIN findings f USING (issue, feature)""")
def _(spark, sf):
    new = profile.eda_findings(profiled_table(spark, sf), "is_returned")
    old = new.where("issue = 'outliers'").unionByName(spark.createDataFrame(
        [("missing data", "l_tax", "missing_pct", 0.5), ("missing data", "feature_missing", "missing_pct", 0.1)], profile.FINDING_SCHEMA))
    return profile.findings_diff(old, new)


@query("suggest_actions", f"""{W}, {FINDINGS} SELECT issue, feature, CASE issue WHEN 'target leakage' THEN 'drop' WHEN 'high cardinality' THEN 'encode' WHEN 'near constant' THEN 'drop'
 WHEN 'redundant pair' THEN 'drop one' WHEN 'missing data' THEN 'impute' WHEN 'skewed distribution' THEN 'log transform' WHEN 'outliers' THEN 'robust scale or winsorize' END AS action FROM findings""")
def _(spark, sf):
    return profile.suggest_actions(profile.eda_findings(profiled_table(spark, sf), "is_returned"))


def _fp(cols):
    k = key(*[f"coalesce('=' || {c}::VARCHAR, '~')" for c in cols])
    return H(k)


FP_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"]
FP_CENTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]  # engines print doubles differently, whole hundredths alike


@query("dataset_fingerprint", f"SELECT count(*) AS n_rows, sum(h)::BIGINT AS hash_sum, bit_xor(h)::BIGINT AS hash_xor FROM (SELECT {_fp(FP_COLS + [f'round({c} * 100)::BIGINT' for c in FP_CENTS])} AS h FROM lineitem)")
def _(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({c: F.round(F.col(c) * 100).cast("long") for c in FP_CENTS})
    return profile.dataset_fingerprint(df, FP_COLS + FP_CENTS)


@query("feature_target_grid", f"""WITH r AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh FROM lineitem)
SELECT least(floor((l_quantity - xl) / (xh - xl) * 20)::INT, 19) AS x_bin, least(floor((l_extendedprice - yl) / (yh - yl) * 20)::INT, 19) AS y_bin,
 count(*) AS n, {R('avg(l_extendedprice)', 4)} AS mean_target FROM lineitem, r GROUP BY 1, 2""")
def _(spark, sf):
    return profile.feature_target_grid(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


@query("project_pca2")
def _(spark, sf):
    df = profiled(spark, sf).withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return profile.project_pca2(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "leak_after_event", "feature_copy"], "row_id")


@query("inject_issues", f"""{W} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {R('leak_after_event')} AS leak_after_event, session_user, rare_flag,
 feature_missing, {R('skewed_amount', 4)} AS skewed_amount, {R('latency_ms')} AS latency_ms, {R('feature_copy')} AS feature_copy, area FROM profiled""")
def _(spark, sf):
    from plumbline.functions.core import rnd
    c = F.col
    return profiled(spark, sf).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", rnd(c("leak_after_event")).alias("leak_after_event"), "session_user",
        "rare_flag", "feature_missing", rnd(c("skewed_amount"), 4).alias("skewed_amount"), rnd(c("latency_ms")).alias("latency_ms"),
        rnd(c("feature_copy")).alias("feature_copy"), "area")


@query("recovered_issues", f"""{W}, {FINDINGS}, planted AS (SELECT * FROM (VALUES ('target leakage','leak_after_event'), ('high cardinality','session_user'), ('near constant','rare_flag'),
 ('missing data','feature_missing'), ('skewed distribution','skewed_amount'), ('outliers','latency_ms'), ('redundant pair','l_quantity <-> feature_copy')) t(issue, feature))
SELECT p.issue, p.feature, f.issue IS NOT NULL AS found FROM planted p LEFT JOIN findings f ON p.issue = f.issue AND p.feature = f.feature""")
def _(spark, sf):
    found = profile.eda_findings(profiled_table(spark, sf), "is_returned").select("issue", "feature", F.lit(True).alias("hit"))
    return (inject.planted_issues(spark, "l_quantity").join(found, ["issue", "feature"], "left")
            .select("issue", "feature", F.coalesce("hit", F.lit(False)).alias("found")))
