"""The registered queries of this subpackage: thin views of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, forest, licenses, lines, negatives, packing, repair, sharding, simhash, sketch, substrings, toxicity, warc
from plumbline.llm.common import WORD_BREAK, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query(
    "op1_warc_zstd",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS top FROM p)
    SELECT page_id, payload_bytes,
      list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), 'string_agg', '') AS payload_digest,
      CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
    FROM d""",
)
def warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), TOKENIZER)
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim)


@query("op3_kd_sharding")
def kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query(
    "op4_suffix_tree_dedup",
    r"""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    g AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k FROM w, unnest(range(1, len(ws) - 11)) AS t(p)),
    m AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)),
    r AS (SELECT doc_id, p FROM g JOIN m USING (k) WHERE first < doc_id),
    c AS (SELECT DISTINCT doc_id, q FROM r, unnest(range(p, p + 13)) AS t(q)),
    k AS (SELECT doc_id, list(q) AS gone FROM c GROUP BY doc_id)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
      sha256(array_to_string(list_filter(ws, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), ' ')) AS kept_sha256
    FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
)
def suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), WORD_BREAK, " "))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


@query("op5_simhash_popcount_grid")
def simhash_popcount_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_classes(table(spark, sf_dir, "documents"))
    digits = F.lower(F.hex("fp"))  # the lowest byte comes first
    name = F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])
    return got.select("doc_id", name.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op6_rare_token_licenses")
def rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("found")


@query("op7_threshold_sketch")
def threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_sketches(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch.as_text(F.col("sketch")).alias("fingerprint"),
        sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketch.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketch.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


@query("op8_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_toxicity_chain")
def toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.corpus_categories())
    scored = chain.score(docs.select("doc_id", "text"))
    return scored.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= toxicity.REJECT).alias("toxic"))


@query("op10_prefix_forest")
def prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


@query(
    "op11_threshold_negatives",
    """
    WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.x, r.x)::BIGINT AS score
      FROM r a JOIN r ON a.vec_id <> r.vec_id AND len(a.x) = len(r.x) WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
)
def threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, "id % 100 = 0")


def _repair_sql() -> str:
    """The lattice walked forwards row by row: per state the least (cost, audit) with the lines it writes."""

    def step(state: str, cost: str, letter: str, line: str | None = None, when: str = "true") -> str:
        out = f"{state}.o" if line is None else f"list_append({state}.o, {line})"
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {out}}} END"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def rows(state: str, role: str, initials: str) -> list[str]:
        """Keep and rerole from a state."""
        return [
            step(state, "3 * cut", "K", "role || ':' || text", f"NOT gone AND initial = '{initials}'"),
            step(state, "3 + 3 * cut", "R", f"'{role}:' || text", "NOT gone"),
        ]

    blanks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    closed2 = least("s2", *[step(s, "3", "I", "'user:'") for s in ("s0", "s1", "s3")])
    closed3 = least("s3", step("w2", "3", "I", "'assistant:'"))
    into2 = [x for s in ("s0", "s1", "w3") for x in rows(s, "user", "u")]
    start = "{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}"
    never = "NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])"
    return f"""
    WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
    src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
    kinds AS (SELECT src.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM src, t),
    hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds WHERE kind <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
        trim(text, {blanks}) AS bare, left(role, 1) AS initial FROM hurt),
    flawed AS (SELECT *, CASE WHEN bare = '' THEN 'blank'
          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
          WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM placed),
    f AS (SELECT conv_id, pos, role, text, initial, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS cut FROM flawed),
    dp AS (
      SELECT DISTINCT conv_id, 0::BIGINT AS i, {start} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM f
      UNION ALL
      SELECT conv_id, pos, {step("s0", "4", "D")}, {least(step("s1", "4", "D"), step("s0", "3 * cut", "K", "role || ':' || text", "NOT gone AND initial = 's'"))},
        {least(step("w2", "4", "D"), *into2)}, {least(step("w3", "4", "D"), *rows("w2", "assistant", "a"))}
      FROM (SELECT *, {closed3} AS w3 FROM (SELECT dp.*, f.pos, f.role, f.text, f.initial, f.gone, f.cut, {closed2} AS w2
          FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.pos = dp.i + 1))),
    done AS (SELECT conv_id, {least("s0", closed3)} AS best FROM (SELECT dp.*, {closed2} AS w2 FROM dp
        JOIN (SELECT conv_id AS c, max(pos) AS n FROM f GROUP BY 1) ON c IS NOT DISTINCT FROM conv_id AND i = n)),
    counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM flawed GROUP BY conv_id)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
      sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
      LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id"""


@query("op12_auction_repair", _repair_sql())
def auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    report, repaired = repair.repair(repair.damage(given))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    convs = given.select("conv_id").distinct()
    report = report.withColumnRenamed("conv_id", "c1")
    digests = repair.digest(repaired).withColumnRenamed("conv_id", "c2")
    joined = convs.join(report, F.col("conv_id").eqNullSafe(F.col("c1")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256")
    )


@query(
    "op13_line_bitmaps",
    """
    WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
    k AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (top <> doc_id) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (top IS NULL OR top = doc_id), '')) AS kept_sha256
    FROM k LEFT JOIN c USING (key) GROUP BY doc_id""",
)
def line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
