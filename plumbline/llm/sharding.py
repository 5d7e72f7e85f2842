"""Shards by a k-d tree over metadata, cut at weighted medians.

A node of the tree is a set of rows that must become a number of shards.  It is cut along its widest metadata dimension (its
span as a part of the whole table's span) at the weighted median of the row sizes, or at the matching quantile where the number of shards
is odd, and its halves are cut again until a node is one shard of the target size.

The median is found without sorting: all nodes of a level are cut together.  A pass adds up the bytes in at most ``bins`` equal
intervals of each node, the next pass looks only into the interval that holds the median, and so on until that interval
weighs less than ``slack`` of a shard.  Where a single coordinate is heavier, the search goes on inside it by the hash of the text, then by row number.
Copies of a text count with the smallest metadata among them, so equal texts stay together unless a cut falls into a text whose copies weigh more than
``slack`` of a shard.  Only sums (at most ``bins`` for each node) reach the driver.

Everything on the rows is a DataFrame expression.  Strings become numbers by their first six bytes.  Null metadata sorts before
everything.  Null text has size 1 and counts as equal to the empty text.  A text of any length is one row of its size and is never cut.  Ties in a coordinate
are settled by the hash of the text, then the row number.  Repeated rows are placed each, as row numbers tell them apart.  An empty table gives an empty
result.  Extra columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import Scratch

BINS = 2048
SLACK = 0.0005
HEAVY = 1000  # a text with more than this part of the rows is looked up by broadcast: so many texts at most


def coordinate(df: DataFrame, name: str) -> Column:
    """A column as a double that keeps its order."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        padded = F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0")
        return F.coalesce(F.conv(padded, 16, 10).cast("double"), F.lit(-1.0))
    return F.coalesce(col.cast("double"), F.lit(float("-1e300")))


@dataclass
class Cut:
    """The search for one node's cut: rows whose keys so far equal ``fixed`` and whose current key is below ``low`` are left of it."""

    node: int
    dim: int
    shards: int
    goal: float  # bytes that belong to the left
    stage: int = 0  # 0 coordinate, 1 hash of the text, 2 row number
    fixed: list[float] = field(default_factory=list)
    low: float = 0.0
    high: float = 0.0
    before: float = 0.0  # bytes left of low
    open: bool = True


def shard(
    docs: DataFrame,
    shards: int = 8,
    dims: Sequence[str] = ("n_chars", "source", "lang"),
    id_col: str = "doc_id",
    text_col: str = "text",
    bins: int = BINS,
    slack: float = SLACK,
    target_bytes: int | None = None,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot).  ``target_bytes`` sets the number of shards instead of ``shards``."""
    spark = docs.sparkSession
    work = Scratch(spark, "shards")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).cast("double").alias("h"),
        *[coordinate(docs, d).alias(f"c{i}") for i, d in enumerate(dims)],
    )
    names = [f"c{i}" for i in range(len(dims))]
    rows = work.write(_together(work, work.write(rows, "slim"), names), "rows").withColumn("r", F.monotonically_increasing_id())
    work.drop("slim", "copies")
    last = "rows"
    known = F.lit(0)
    whole = rows.agg(F.sum("size").alias("b"), *[F.min(c).alias(f"{c}l") for c in names], *[F.max(c).alias(f"{c}h") for c in names]).first()
    total = float(whole["b"] or 0)
    if target_bytes:
        shards = max(1, round(total / target_bytes))
    unit = {c: max((whole[f"{c}h"] or 0) - (whole[f"{c}l"] or 0), 1e-300) for c in names}
    want = {0: shards}  # open nodes and their numbers of shards; a node's number is that of its first shard
    while total and any(k > 1 for k in want.values()):
        cuts = _level(rows.withColumn("node", known), {n: k for n, k in want.items() if k > 1}, names, unit, slack * total / shards, bins)
        moved = F.lit(0)
        for cut in cuts:
            right = cut.node + (cut.shards + 1) // 2
            moved = F.when((F.col("node") == cut.node) & ~_left(cut, names), F.lit(right - cut.node)).otherwise(moved)
        left, known_now = {c.node: (c.shards + 1) // 2 for c in cuts}, known
        rows_now = rows.withColumn("node", known_now).withColumn("node", F.col("node") + moved)
        rows = work.write(rows_now, f"level{len(want)}")
        work.drop(last)
        last, known = f"level{len(want)}", F.col("node")
        want = {n: left.get(n, k) for n, k in want.items()} | {c.node + (c.shards + 1) // 2: c.shards // 2 for c in cuts}
    placed = rows.withColumn("shard", known.cast("int")).select("id", "size", "text_crc32", "shard", "r")
    return _slots(placed).withColumnRenamed("id", id_col)


def _together(work: Scratch, rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows with the smallest metadata among the copies of their text.

    Copies are counted before the shuffle, and only texts whose copies differ in metadata are joined.  Those with more than 1 / ``HEAVY`` of
    all rows are fewer than ``HEAVY`` and are broadcast, so that no task receives the copies of a hot text.
    """
    key = ["h", "size", "text_crc32"]
    least = [f"l_{c}" for c in names]
    copies = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(x) for c, x in zip(names, least)], *[F.max(c).alias(f"m_{c}") for c in names])
    differ = reduce(or_, [F.col(f"l_{c}") < F.col(f"m_{c}") for c in names], F.lit(False))
    copies = work.write(copies.where(differ).select(*key, "n", *least), "copies")
    many = F.col("n") * HEAVY > rows.count()
    hot, some = F.broadcast(copies.where(many).drop("n")), copies.where(~many).drop("n")
    joined = rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(some, key, "left"))
    return joined.select("id", *key, *[F.coalesce(x, c).alias(c) for c, x in zip(names, least)])


def _key(cut: Cut, names: list[str]) -> Column:
    return F.col([names[cut.dim], "h", "r"][cut.stage]).cast("double")


def _same(cut: Cut, names: list[str]) -> Column:
    """Rows that share the keys the search has fixed."""
    out = F.col("node") == cut.node
    for name, value in zip([names[cut.dim], "h"], cut.fixed):
        out = out & (F.col(name) == F.lit(value))
    return out


def _left(cut: Cut, names: list[str]) -> Column:
    keys = [names[cut.dim], "h", "r"]
    out = F.lit(False)
    for i in range(cut.stage, -1, -1):
        edge = cut.low if i == cut.stage else cut.fixed[i]
        here = F.col(keys[i]).cast("double")
        out = (here < F.lit(edge)) | ((here == F.lit(edge)) & out) if i < cut.stage else here < F.lit(edge)
    return out


def _bounds(rows: DataFrame, cuts: list[Cut], names: list[str]) -> None:
    """Give each open search the span of its current key."""
    case = F.lit(None)
    key = F.lit(None).cast("double")
    for c in cuts:
        case = F.when(_same(c, names), F.lit(c.node)).otherwise(case)
        key = F.when(F.col("node") == c.node, _key(c, names)).otherwise(key)
    got = rows.select(case.alias("at"), key.alias("k")).where("at is not null").groupBy("at").agg(F.min("k").alias("l"), F.max("k").alias("h")).collect()
    for r in got:
        cut = next(c for c in cuts if c.node == r["at"])
        cut.low, cut.high = r["l"], r["h"]


def _level(rows: DataFrame, want: dict[int, int], names: list[str], unit: dict[str, float], slack: float, bins: int) -> list[Cut]:
    """The cuts of all nodes of one level."""
    spans = rows.where(F.col("node").isin(list(want))).groupBy("node").agg(F.sum("size").alias("b"), *[(F.max(c) - F.min(c)).alias(c) for c in names]).collect()
    cuts = []
    for r in spans:
        widths = [r[c] / unit[c] for c in names]
        k = want[r["node"]]
        cuts.append(Cut(r["node"], widths.index(max(widths)), k, r["b"] * ((k + 1) // 2) / k))
    cuts.sort(key=lambda c: c.node)
    _bounds(rows, cuts, names)
    while any(c.open for c in cuts):
        live = [c for c in cuts if c.open]
        at, bin_ = F.lit(None), F.lit(None).cast("long")
        for c in live:
            key = _key(c, names)
            width = (c.high - c.low) / bins
            inside = _same(c, names) & (key >= F.lit(c.low)) & (key <= F.lit(c.high))
            place = F.least(F.floor((key - F.lit(c.low)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
            at = F.when(inside, F.lit(c.node)).otherwise(at)
            bin_ = F.when(inside, place.cast("long")).otherwise(bin_)
        key_now = F.lit(None).cast("double")
        for c in live:
            key_now = F.when(F.col("node") == c.node, _key(c, names)).otherwise(key_now)
        sums = rows.select(at.alias("at"), bin_.alias("bin"), "size", key_now.alias("k")).where("at is not null")
        sums = sums.groupBy("at", "bin").agg(F.sum("size").alias("b"), F.min("k").alias("l"), F.max("k").alias("h")).collect()
        deeper = []
        for c in live:
            own = sorted((r for r in sums if r["at"] == c.node), key=lambda r: r["bin"])
            before = c.before
            for r in own:
                if before + r["b"] > c.goal:
                    break
                before += r["b"]
            over = before + r["b"] - c.goal
            if r["b"] <= slack or over <= 0:  # near enough: cut at the nearer edge of this interval
                following = [x["l"] for x in own if x["bin"] > r["bin"]]
                c.before = before
                c.low = r["l"] if c.goal - before <= over else (following[0] if following else float("inf"))
                c.open = False
            elif r["l"] < r["h"]:
                c.low, c.high, c.before = r["l"], r["h"], before
            elif c.stage < 2:  # one key holds the median
                c.fixed.append(r["l"])
                c.stage, c.before = c.stage + 1, before
                deeper.append(c)
            else:
                c.low, c.before, c.open = r["l"], before, False
        if deeper:
            _bounds(rows, deeper, names)
    return cuts


def _slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0: counts by task of the row number give offsets, numbering runs inside them."""
    part = F.shiftright("r", 33)
    rows = placed.withColumn("part", part)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "part").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("r")) - 1
    return rows.withColumn("slot", inside).join(offsets, ["shard", "part"]).select("id", "size", "text_crc32", "shard", (F.col("slot") + F.col("offset")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents (unique ids) into one folder for each shard."""
    docs.join(placed.select(id_col, "shard"), id_col).write.partitionBy("shard").parquet(path)
