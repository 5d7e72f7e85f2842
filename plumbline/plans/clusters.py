"""Clustering queries over embeddings, and density clusters over order and event planes."""

from pyspark.sql import functions as F

from plumbline.functions.core import h32, rnd
from plumbline.operators import clustering as cl
from plumbline.operators import prep
from plumbline.plans.registry import H, R, key, query, table

C = F.col
DIST = "list_sum(list_transform(list_zip(e.embedding, c.m), lambda z: (z[1]::DOUBLE - z[2]) ** 2))"
CENTRES = "cen AS (SELECT label, list(m ORDER BY i) AS m FROM (SELECT label, i, avg(v::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"
NEAR = f"{CENTRES}, near AS (SELECT vec_id, truth, cluster, sq_dist FROM (SELECT e.vec_id, e.label AS truth, c.label AS cluster, {DIST} AS sq_dist, row_number() OVER (PARTITION BY e.vec_id ORDER BY {DIST}, c.label) AS r FROM embeddings e, cen c) WHERE r = 1)"


def emb(spark, sf):
    return table(spark, sf, "embeddings")


def near(spark, sf):
    e = emb(spark, sf)
    return cl.assign_nearest(e, "embedding", cl.class_centres(e, "embedding", "label"))


@query("assign_nearest", f"WITH {NEAR} SELECT vec_id, cluster, {R('sq_dist')} AS sq_dist FROM near")
def _(spark, sf):
    return near(spark, sf).select("vec_id", "cluster", rnd(C("sq_dist")).alias("sq_dist"))


@query("cluster_members", f"WITH {NEAR} SELECT cluster, position::INT AS position, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY sq_dist, vec_id) AS position FROM near) WHERE position <= 5")
def _(spark, sf):
    return cl.cluster_members(near(spark, sf), "vec_id").select("cluster", "position", "vec_id")


ARI = """ct AS (SELECT truth, cluster, count(*)::DOUBLE AS n FROM {src} GROUP BY 1, 2), s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM ct) AS b, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM ct GROUP BY truth)) AS ra,
 (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM ct GROUP BY cluster)) AS cb, (SELECT sum(n) * (sum(n) - 1) / 2 FROM ct) AS t)"""


@query("adjusted_rand", f"WITH {NEAR}, {ARI.format(src='near')} SELECT {R('(b - ra * cb / t) / ((ra + cb) / 2 - ra * cb / t)')} AS ari FROM s")
def _(spark, sf):
    return cl.adjusted_rand(near(spark, sf), "label", "cluster")


ENT = """ct AS (SELECT truth, cluster, count(*)::DOUBLE AS n FROM {src} GROUP BY 1, 2), tt AS (SELECT sum(n) AS t FROM ct),
en AS (SELECT (SELECT sum(-n / t * ln(n / t)) FROM ct, tt) AS hj, (SELECT sum(-n / t * ln(n / t)) FROM (SELECT sum(n) AS n FROM ct GROUP BY truth), tt) AS ht, (SELECT sum(-n / t * ln(n / t)) FROM (SELECT sum(n) AS n FROM ct GROUP BY cluster), tt) AS hc),
mi AS (SELECT *, ht + hc - hj AS mi FROM en)"""
MOVED = f"moved AS (SELECT o_orderpriority AS truth, CASE WHEN {H(key(chr(39) + 'mv' + chr(39), 'o_orderkey'))} % 5 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS cluster FROM orders)"


def moved(spark, sf):
    return table(spark, sf, "orders").select(C("o_orderpriority").alias("truth"), F.when(F.pmod(h32(F.lit("mv"), "o_orderkey"), F.lit(5)) == 0, "1-URGENT").otherwise(C("o_orderpriority")).alias("cluster"))


@query("nmi", f"WITH {MOVED}, {ENT.format(src='moved')} SELECT {R('mi / ht')} AS homogeneity, {R('mi / hc')} AS completeness, {R('2 * mi / ht * mi / hc / (mi / ht + mi / hc)')} AS v_measure, {R('mi / ((ht + hc) / 2)')} AS nmi FROM mi")
def _(spark, sf):
    return cl.nmi(moved(spark, sf), "truth", "cluster")


@query("homogeneity_completeness", f"WITH {MOVED}, {ENT.format(src='moved')} SELECT {R('mi / ht')} AS homogeneity, {R('mi / hc')} AS completeness FROM mi")
def _(spark, sf):
    return cl.nmi(moved(spark, sf), "truth", "cluster").select("homogeneity", "completeness")


SUMS = "su AS (SELECT label, i, count(*)::DOUBLE AS n, sum(v) AS s, sum(v * v) AS q FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2), tot AS (SELECT i, sum(s) AS ts, sum(n) AS tn FROM su GROUP BY 1)"


@query("calinski_harabasz", f"WITH {SUMS} SELECT {R('sum(n * (s / n - ts / tn) ** 2) * (max(tn) - count(DISTINCT label)) / (sum(q - s * s / n) * (count(DISTINCT label) - 1))', 4)} AS calinski_harabasz FROM su JOIN tot USING (i)")
def _(spark, sf):
    return cl.calinski_harabasz(emb(spark, sf), "embedding", "label")


@query("davies_bouldin", f"""WITH {CENTRES}, sp AS (SELECT e.label, avg(sqrt({DIST})) AS s FROM embeddings e JOIN cen c ON e.label = c.label GROUP BY 1),
pr AS (SELECT a.label, max((x.s + y.s) / sqrt(list_sum(list_transform(list_zip(a.m, b.m), lambda z: (z[1] - z[2]) ** 2)))) AS w FROM cen a JOIN cen b ON a.label <> b.label JOIN sp x ON x.label = a.label JOIN sp y ON y.label = b.label GROUP BY 1) SELECT {R('avg(w)')} AS davies_bouldin FROM pr""")
def _(spark, sf):
    return cl.davies_bouldin(emb(spark, sf), "embedding", "label")


@query("silhouette_sample", f"""WITH sm AS (SELECT vec_id, label, embedding FROM embeddings ORDER BY {H(key(chr(39) + 'sil' + chr(39), 'vec_id'))}, vec_id LIMIT 300),
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))) AS d FROM sm a, sm b),
g AS (SELECT vec_id, la, lb, sum(d) AS s, count(*) AS n FROM d GROUP BY 1, 2, 3), f AS (SELECT vec_id, max(CASE WHEN la = lb AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN la <> lb THEN s / n END) AS b FROM g GROUP BY 1)
SELECT count(*) AS n_sample, {R('avg(coalesce((b - a) / greatest(a, b), 0))')} AS silhouette FROM f""")
def _(spark, sf):
    return cl.silhouette_sample(emb(spark, sf), "embedding", "label", "vec_id", 300)


@query("silhouette_full", f"""WITH d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2)) AS d FROM embeddings a, embeddings b),
g AS (SELECT vec_id, la, lb, sum(d) AS s, count(*) AS n FROM d GROUP BY 1, 2, 3), f AS (SELECT vec_id, max(CASE WHEN la = lb AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN la <> lb THEN s / n END) AS b FROM g GROUP BY 1)
SELECT count(*) AS n, {R('avg(coalesce((b - a) / greatest(a, b), 0))')} AS silhouette FROM f""")
def _(spark, sf):
    return cl.silhouette_full(emb(spark, sf), "embedding", "label")


ROUNDS = 5


def lloyd_sql(runs):
    """Lloyd's algorithm written out: ``fin`` has the cluster and squared distance of each row in every run (k, s) after ROUNDS moves."""
    pairs = ", ".join(f"({k}, {s})" for k, s in runs)
    gap = "list_sum(list_transform(list_zip(e.v, c.m), lambda z: (z[1] - z[2]) ** 2))"
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"n{i} AS MATERIALIZED (SELECT k, s, vec_id, c, d FROM (SELECT c.k, c.s, e.vec_id, c.c, {gap} AS d, row_number() OVER (PARTITION BY c.k, c.s, e.vec_id ORDER BY {gap}, c.c) AS r FROM pts e, c{i} c) WHERE r = 1)")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.k, o.s, o.c, coalesce(w.m, o.m) AS m FROM c{i} o LEFT JOIN (SELECT k, s, c, list(m ORDER BY i) AS m FROM
 (SELECT n.k, n.s, n.c, u.i, avg(u.x) AS m FROM n{i} n JOIN (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM pts) u USING (vec_id) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3) w USING (k, s, c))""")
    return f"""pts AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), runs AS (SELECT * FROM (VALUES {pairs}) t(k, s)),
c0 AS MATERIALIZED (SELECT k, s, c, v AS m FROM (SELECT k, s, v, row_number() OVER (PARTITION BY k, s ORDER BY {H(key(chr(39) + 'start' + chr(39), 's', 'vec_id'))}, vec_id) - 1 AS c FROM pts, runs) WHERE c < k),
{', '.join(steps)}, fin AS (SELECT * FROM n{ROUNDS}), cost AS (SELECT k, s, sum(d) AS inertia FROM fin GROUP BY 1, 2), won AS (SELECT k, arg_min(s, (inertia, s)) AS s, min(inertia) AS inertia FROM cost GROUP BY 1)"""


@query("kmeans_fit", f"WITH {lloyd_sql([(10, s) for s in range(4)])} SELECT vec_id, label, c::INT AS cluster, {R('d', 4)} AS sq_dist FROM fin JOIN won USING (k, s) JOIN embeddings USING (vec_id)")
def _(spark, sf):
    e = emb(spark, sf)
    run = cl.kmeans_fit(e, "embedding", "vec_id", 10, starts=4, rounds=ROUNDS)
    return cl.kmeans_assign(e, "embedding", run, ["vec_id", "label"]).withColumn("sq_dist", rnd(C("sq_dist"), 4))


@query("gmm_fit")
def _(spark, sf):
    e = cl.pca_reduce(emb(spark, sf), "embedding", "vec_id", 0.5)
    return cl.gmm_fit(e, "components", 5).transform(cl.with_vector(e, "components")).select("vec_id", C("prediction").alias("cluster"))


# squared distances to the members of a cluster from its sums, as in the simplified silhouette
SIL = """mem AS (SELECT f.k, f.vec_id, f.c, p.v FROM fin f JOIN won USING (k, s) JOIN pts p USING (vec_id)), cs AS (SELECT k, c, count(*)::DOUBLE AS n, sum(list_sum(list_transform(v, lambda x: x * x))) AS q FROM mem GROUP BY 1, 2),
cv AS (SELECT k, c, list(m ORDER BY i) AS m FROM (SELECT k, c, i, avg(x) AS m FROM (SELECT k, c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM mem) GROUP BY 1, 2, 3) GROUP BY 1, 2),
far AS (SELECT mem.k, mem.vec_id, mem.c = cs.c AS own, cs.n, list_sum(list_transform(mem.v, lambda x: x * x)) + cs.q / cs.n - 2 * list_inner_product(mem.v, cv.m) AS d FROM mem JOIN cs ON cs.k = mem.k JOIN cv ON cv.k = cs.k AND cv.c = cs.c),
ab AS (SELECT k, vec_id, max(CASE WHEN own AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN NOT own THEN d END) AS b FROM far GROUP BY 1, 2), sil AS (SELECT k, avg(coalesce((b - a) / greatest(a, b), 0)) AS v FROM ab GROUP BY 1)"""


@query("select_k", f"WITH {lloyd_sql([(k, s) for k in range(2, 9) for s in range(3)])}, {SIL} SELECT k, {R('v')} AS silhouette, {R('inertia', 4)} AS inertia, k = (SELECT arg_max(k, (v, -k)) FROM sil) AS chosen FROM won JOIN sil USING (k)")
def _(spark, sf):
    got = cl.select_k(emb(spark, sf), "embedding", "vec_id", range(2, 9), starts=3, rounds=ROUNDS)
    return got.select("k", rnd(C("silhouette")).alias("silhouette"), rnd(C("inertia"), 4).alias("inertia"), "chosen")


@query("cluster_stability", f"""WITH {lloyd_sql([(10, s) for s in range(8)])}, ct AS (SELECT x.s AS p, y.s AS q, x.c AS a, y.c AS b, count(*)::DOUBLE AS n FROM fin x JOIN fin y USING (vec_id) WHERE x.s < y.s GROUP BY 1, 2, 3, 4),
ag AS (SELECT p, q, sum(n * (n - 1) / 2) AS both_, sum(n) * (sum(n) - 1) / 2 AS t FROM ct GROUP BY 1, 2), ra AS (SELECT p, q, sum(n * (n - 1) / 2) AS x FROM (SELECT p, q, a, sum(n) AS n FROM ct GROUP BY 1, 2, 3) GROUP BY 1, 2), rb AS (SELECT p, q, sum(n * (n - 1) / 2) AS y FROM (SELECT p, q, b, sum(n) AS n FROM ct GROUP BY 1, 2, 3) GROUP BY 1, 2),
ari AS (SELECT (both_ - x * y / t) / ((x + y) / 2 - x * y / t) AS v FROM ag JOIN ra USING (p, q) JOIN rb USING (p, q)) SELECT 8 AS n_runs, count(*)::INT AS n_pairs, {R('avg(v)')} AS mean_ari, avg(v) < 0.7 AS unstable FROM ari""")
def _(spark, sf):
    return cl.cluster_stability(emb(spark, sf), "embedding", "vec_id", 10, rounds=ROUNDS).withColumn("mean_ari", rnd(C("mean_ari")))


@query("pca_reduce")
def _(spark, sf):
    return cl.pca_reduce(emb(spark, sf), "embedding", "vec_id")


PLANE = "plane AS (SELECT p_partkey AS id, (p_size * 1.0)::DOUBLE AS x, ((p_partkey * 37 % 1000) / 20.0)::DOUBLE AS y FROM part)"


def plane(spark, sf):
    return table(spark, sf, "part").select(C("p_partkey").alias("id"), C("p_size").cast("double").alias("x"), ((C("p_partkey") * 37 % 1000) / 20.0).alias("y"))


@query("neighbour_counts", f"WITH {PLANE}, q AS (SELECT x, y, count(*) AS n, min(id) AS pid FROM plane GROUP BY 1, 2) SELECT a.pid, sum(b.n)::BIGINT AS n_within FROM q a JOIN q b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 0.8::DOUBLE * 0.8::DOUBLE GROUP BY 1")
def _(spark, sf):
    return cl.neighbour_counts(plane(spark, sf), "id", ["x", "y"], 0.8).select("pid", "n_within")


def density_sql(points, near, enough):
    """Density clusters of ``points`` (id, ...): the core rows each core row reaches, the least of them as label."""
    return f"""WITH RECURSIVE {points}, nb AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON {near}), core AS (SELECT a AS id FROM nb GROUP BY a HAVING count(*) >= {enough}),
 e AS (SELECT a, b FROM nb WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)), reach AS (SELECT id, id AS root FROM core UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.id),
 lab AS (SELECT id, min(root) AS label FROM reach GROUP BY id), edge AS (SELECT nb.a AS id, min(label) AS label FROM nb JOIN lab ON lab.id = nb.b GROUP BY 1)
 SELECT id, coalesce(lab.label, edge.label, -1)::BIGINT AS cluster FROM pts LEFT JOIN lab USING (id) LEFT JOIN edge USING (id)"""


@query("dbscan", density_sql(f"{PLANE}, pts AS (SELECT * FROM plane)", "(a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 0.8::DOUBLE * 0.8::DOUBLE", 4))
def _(spark, sf):
    return cl.dbscan(plane(spark, sf), "id", ["x", "y"], 0.8, 4)


EIGHT = [f"f{i}" for i in range(8)]
EIGHT_SQL = ", ".join(f"(embedding[{i + 1}]::DOUBLE - avg(embedding[{i + 1}]::DOUBLE) OVER ()) / stddev_pop(embedding[{i + 1}]::DOUBLE) OVER () AS f{i}" for i in range(8))


@query("dbscan_8_columns", density_sql(f"pts AS (SELECT vec_id AS id, {EIGHT_SQL} FROM embeddings)", " + ".join(f"(a.f{i} - b.f{i}) ** 2" for i in range(8)) + " <= 1.7::DOUBLE * 1.7::DOUBLE", 4))
def _(spark, sf):
    e = emb(spark, sf).select(C("vec_id").alias("id"), *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(EIGHT)])
    return cl.dbscan(prep.standardize(e, EIGHT), "id", EIGHT, 1.7, 4)


@query("isolation_forest")
def _(spark, sf):
    li = table(spark, sf, "events").select("event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return cl.isolation_forest(li, "event_id", ["value", "k"], contamination=0.02)


@query("anomaly_precision_recall", f"SELECT *, {R('tp / n_flagged')} AS precision, {R('tp / n_true')} AS recall FROM (SELECT count(*) FILTER (value > 60 AND t) AS tp, count(*) FILTER (value > 60) AS n_flagged, count(*) FILTER (t) AS n_true FROM (SELECT value, value > 55 AND {H(key(chr(39) + 'an' + chr(39), 'event_id'))} % 3 > 0 AS t FROM events))")
def _(spark, sf):
    e = table(spark, sf, "events").select((C("value") > 60).alias("f"), ((C("value") > 55) & (F.pmod(h32(F.lit("an"), "event_id"), F.lit(3)) > 0)).alias("t"))
    return cl.anomaly_precision_recall(e, "f", "t")
