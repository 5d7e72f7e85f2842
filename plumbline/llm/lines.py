"""Repeated lines across documents, found on hashes alone.

Every line becomes a key (white space stripped at both ends, A-Z lower-cased) and its 128-bit hash.  The hashes are range-partitioned and
sorted inside a partition by document, the largest id first, and by position; a window streams over each run of equal hashes and marks
where a new document begins, so the first one of a run is the one that keeps its lines.  A run is cut into ``SLOTS`` slots by a hash of the
document, and the slot is part of the range key: a line that a third of all documents share is spread over as many partitions.  Per slot one
number of documents and one largest id are left; their sums per hash say which keys are frequent, and a join on hash *and* slot brings that back.

The result is not text but one keep bitmap per document, compressed as the runs of kept lines (start, length), as a run container
of a compressed bitmap has them.  ``kept_text`` applies it inside the row.  Everything is a DataFrame expression.

Null and empty text is one empty line.  Documents are told apart by their id; all rows without an id count as one document, below every
other.  A row is known by (id, hash of its text), so repeated rows share one bitmap, and a key that occurs several times in its keeping
document stays each time.  Very long texts are split whole; an empty table gives an empty result; columns of other names play no part.
Keys whose 128 bits collide would be taken for equal (chance about 1e-15 for 1e12 different lines).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, parts

BLANKS = "\t\n\x0b\x0c\r "
SLOTS = 64
ROW_BYTES = 48


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _runs(n: Column, gone: Column) -> Column:
    """Kept runs (start, length) of ``n`` places from the sorted places that are gone."""
    last = F.size(gone) - 1
    starts = F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) != x - 1))
    ends = F.filter(gone, lambda x, i: (i == last) | (F.get(gone, i + 1) != x + 1))
    between = F.zip_with(
        F.concat(F.array(F.lit(-1)), ends), F.concat(starts, F.array(n)), lambda e, s: F.struct((e + 1).alias("start"), (s - e - 1).alias("length"))
    )
    return F.filter(between, lambda r: r["length"] > 0)


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(id, text_hash, n_lines, n_dropped, keep): one row per distinct (id, text); ``keep`` is the bitmap of lines that stay.

    A key of at least ``least_chars`` code points found in at least ``least_docs`` documents keeps its lines only in the largest id that has it.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "lines")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    slim = docs.select(docs[id_col].alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))

    lines = slim.select("doc", "th", F.posexplode(split_lines(F.col("text"))).alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    lines = lines.where(F.char_length("key") >= least_chars)
    slot = F.pmod(F.when(F.col("doc").isNull(), F.col("th")).otherwise(F.xxhash64("doc")), F.lit(slots)).cast("int")
    lines = work.write(lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), slot.alias("slot"), "doc", "th", "pos"), "lines")

    order = [F.col("doc").desc_nulls_last(), F.col("th"), F.col("pos")]
    by = ["h1", "h2", "slot"]
    ranged = lines.repartitionByRange(parts(spark, lines.count() * ROW_BYTES, 64 << 20), *by).sortWithinPartitions(*by, *order)
    run = Window.partitionBy(*by).orderBy(*order)
    first = (F.row_number().over(run) == 1) | ~F.col("doc").eqNullSafe(F.lag("doc").over(run))
    ranged = work.write(ranged.withColumn("first", first), "ranged")
    work.drop("lines")

    known = F.col("doc").isNotNull()
    runs = ranged.groupBy(*by).agg(F.count_if(F.col("first") & known).alias("n"), F.bool_or(~known).alias("nameless"), F.max("doc").alias("top"))
    total = runs.groupBy("h1", "h2").agg((F.sum("n") + F.bool_or("nameless").cast("long")).alias("docs"), F.max("top").alias("top"))
    frequent = runs.select(*by).join(total.where(F.col("docs") >= least_docs).select("h1", "h2", "top"), ["h1", "h2"])
    gone = ranged.join(frequent, by).where(~F.col("doc").eqNullSafe(F.col("top"))).select("doc", "th", F.lit(None).cast("int").alias("n_lines"), "pos")

    heads = slim.select("doc", "th", (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines"), F.lit(None).cast("int").alias("pos"))
    bits = heads.unionByName(gone).groupBy("doc", "th").agg(F.max("n_lines").alias("n"), F.sort_array(F.collect_set("pos")).alias("gone"))
    return bits.select(
        F.col("doc").alias(id_col),
        F.col("th").alias("text_hash"),
        F.col("n").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        _runs(F.col("n"), F.col("gone")).alias("keep"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined again."""
    lines = split_lines(text)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """The documents with the bitmap applied: all columns, the text without dropped lines, and ``n_lines`` and ``n_dropped`` (which replace
    columns of these names)."""
    bits = keep_bitmaps(docs, id_col=id_col, text_col=text_col, **how).select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__th"), F.struct("n_lines", "n_dropped", "keep").alias("__bits"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn("__hash", F.xxhash64(body))
    joined = rows.join(bits, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th")))
    whole = F.when(F.col("__bits.n_dropped") == 0, body).otherwise(kept_text(body, F.col("__bits.keep")))
    return joined.select(*[whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in names], "__bits.n_lines", "__bits.n_dropped")
