"""Threshold-scaled document sketches.

A sketch keeps every hash of a word shingle that lies below a fixed part of the hash range, so the sketch of a union is the
union of sketches, and the share of a sketch found in another estimates containment however unequal the documents are.  A
document none of whose hashes is below the threshold keeps its smallest hash, so that no text with words has an empty sketch.

Everything is a DataFrame expression: hashes are made inside the row, without exploding shingles.

Null text counts as empty.  A text without words has an empty sketch; two empty sketches are alike (1), an empty and another are not (0).  A text
shorter than a shingle is one shingle.  Equal texts have equal sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD_BREAK, parts, text_bytes

WORDS = 5
FRACTION = 1 / 8


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def sketch(words: Column, fraction: float = FRACTION, size: int = WORDS) -> Column:
    """Sorted distinct retained hashes (63 bits each) of an array of words."""
    count = F.size(words)
    places = F.sequence(F.lit(0), F.greatest(count - size, F.lit(0)))
    hashed = F.transform(places, lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(words, i + k) for k in range(size)]), 1))
    low = F.array_distinct(F.filter(hashed, lambda h: h < int(fraction * (1 << 63))))
    return F.when(count == 0, F.array().cast("array<bigint>")).otherwise(F.array_sort(F.when(F.size(low) > 0, low).otherwise(F.array(F.array_min(hashed)))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated containment of the smaller document in the larger one."""
    least = F.least(F.size(a), F.size(b))
    both_empty = F.greatest(F.size(a), F.size(b)) == 0
    return F.when(both_empty, 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def as_text(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.hex(h))), ",")


def merge(a: Column, b: Column) -> Column:
    """Sketch of two documents together (exact where neither holds only its smallest hash)."""
    return F.array_sort(F.array_union(a, b))


def _bucket(key: Column, cuts: list) -> Column:
    """Number of cut points at or below the key, found in two steps so that a row compares with few of them."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    below = lambda among: F.size(F.filter(among, lambda c: c <= key))
    coarse = below(F.array(*[F.lit(g[0]) for g in groups]))
    fine = below(F.get(F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups]), coarse - 1))
    return F.when(key.isNull() | (coarse == 0), 0).otherwise((coarse - 1) * step + fine)


def with_next(docs: DataFrame, id_col: str, columns: list[str], nbytes: int, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Add ``next_<column>`` of the following row by ascending id (after the last: the first), null ids first, ties by the hash of ``columns[0]``.

    Ids are cut into ranges; the window runs inside a range, and the first row of each range is looked up for the last of the one before.
    """
    spark = docs.sparkSession
    want = parts(spark, nbytes, bucket_bytes)
    cuts = docs.agg(F.percentile_approx(F.col(id_col), [i / want for i in range(1, want)], 100 * want).alias("q")).first()["q"] if want > 1 else []
    rows = docs.withColumns({"__bucket": _bucket(F.col(id_col), sorted(set(cuts or []))), "__tie": F.xxhash64(columns[0])})
    firsts = rows.groupBy("__bucket").agg(F.min(F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"), F.col("__tie").alias("tie"))).alias("f")).orderBy("__bucket").collect()
    if not firsts:
        return rows.select(*docs.columns, *[F.col(c).alias(f"next_{c}") for c in columns])
    kind = docs.schema[id_col].dataType.simpleString()
    ahead = [(a["__bucket"], b["f"]["id"], b["f"]["tie"]) for a, b in zip(firsts, firsts[1:] + firsts[:1])]
    ahead_df = spark.createDataFrame(ahead, f"__from int, __id {kind}, __t long")
    heads = rows.join(F.broadcast(ahead_df), F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tie") == F.col("__t")))
    heads = heads.dropDuplicates(["__from"]).select(F.col("__from").alias("__bucket"), *[F.col(c).alias(f"__{c}") for c in columns])
    order = Window.partitionBy("__bucket").orderBy(F.asc_nulls_first(id_col), "__tie")
    near = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    joined = near.join(heads, "__bucket", "left")
    return joined.select(*docs.columns, *[F.coalesce(f"next_{c}", f"__{c}").alias(f"next_{c}") for c in columns])


def edited_sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION, size: int = WORDS) -> DataFrame:
    """(id, n_chars, edited, sketch, edited_sketch, next_sketch): each text, its copy whose last quarter is taken from the next text, and that text."""
    _, nbytes = text_bytes(docs, text_col)
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("body"))
    base = base.withColumn("words", words_of(F.col("body"))).withColumn("sketch", sketch(F.col("words"), fraction, size)).drop("words")
    rows = with_next(base, "id", ["body", "sketch"], nbytes)
    n = F.length("body")
    taken = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("body"), F.lit(1), n - taken), F.substring(F.col("next_body"), F.lit(1), taken))
    rows = rows.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", F.col("next_sketch"))
    rows = rows.withColumn("words", words_of(F.col("edited"))).withColumn("edited_sketch", sketch(F.col("words"), fraction, size)).drop("words")
    return rows.withColumnRenamed("id", id_col)
