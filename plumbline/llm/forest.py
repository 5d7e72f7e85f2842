"""Approximate nearest neighbours by a forest of sorted hash strings.

Each tree hashes a vector to a string of ``BITS`` bits, the sides of random hyperplanes, and keeps all strings in sorted order, so
that the vectors sharing a prefix with a query are one stretch of it.  A query descends in every tree at once to its longest
prefixes and then ascends in all of them together, one bit at a time, until the stretches hold ``wanted`` vectors; the depth it
stops at differs from query to query.  All vectors of these stretches are compared exactly.

Effort follows recall: the true neighbours of ``TRIED`` queries, drawn by hash, are found among all rows; a neighbour is found at the depth of the
longest prefix that it shares with its query in some tree, so the recall of any ``wanted`` is known without a search, and the smallest one that reaches ``recall`` is
taken.  At worst that is every row, which finds everything.

How it is spread: a tree's strings are counted by cells, the strings of one short prefix.  Consecutive cells make a block of about ``block`` strings, so a stretch
deeper than a cell lies in one block, and a shallower one is a range of blocks: a query is sent to each of them.  Its counts come from its own block below
the cells' depth and from the cells' counts above it.  A block that is larger (many vectors of one string) is dealt into parts by a hash, each of which
is searched.  Queries of one block are dealt into parts as well, so a task holds a bounded number of vectors and of queries.

Equal vectors are one class: it keeps its smallest ids only as far as an answer can hold them, so that any number of copies costs nothing.

Vectors that are null, zero, empty or hold null or non-finite components take no part, nor do rows without an id.  Vectors of
different lengths are not compared.  Repeated rows with one id and one vector count once.  Ties go to the smaller id.  An empty table, or one without queries, gives
no rows.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch

TREES = 24
BITS = 62
BLOCK = 65_536
TRIED = 512
RECALL = 0.96


def planes(size: int, trees: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, trees * BITS))


def strings(x: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """(rows, trees) hash strings as whole numbers, first bit highest."""
    out = np.empty((len(x), trees), np.int64)
    p = planes(x.shape[1], trees, seed)
    weight = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for t in range(trees):
        out[:, t] = ((x @ p[:, t * BITS : (t + 1) * BITS]) > 0) @ weight
    return out


def stretch(sorted_keys: np.ndarray, key: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 place of the strings that share the first ``depth`` bits with each key."""
    shift = BITS - depth
    low = (key >> shift) << shift
    return np.searchsorted(sorted_keys, low, "left"), np.searchsorted(sorted_keys, low + (np.int64(1) << shift) - 1, "right")


def precise(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines, each from its own two vectors only, so that no grouping of rows changes a digit."""
    return (v * q).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum()))


def effort(counts: dict[int, np.ndarray], found_at: dict[int, list[int]], most: int, recall: float) -> int:
    """The smallest number of vectors to look at (by powers of 1.1) with which tried queries reach ``recall``.

    ``counts`` has for each query the vectors sharing its prefixes of each depth, over all trees; ``found_at`` the depth at which each true neighbour is met.
    """
    total = sum(map(len, found_at.values()))
    wanted = 1.0
    while total and wanted < most:
        hit = 0
        for query, depths in found_at.items():
            enough = np.flatnonzero(counts[query] >= wanted)
            depth = enough[-1] if len(enough) else 0
            hit += sum(d >= depth for d in depths)
        if hit >= recall * total:
            break
        wanted = max(wanted + 1, 1.1 * wanted)
    return int(wanted)


def nearest(
    vectors: DataFrame, asked: str, k: int = 5, trees: int = TREES, wanted: int | None = None, block: int = BLOCK, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row that satisfies the SQL condition ``asked`` on column ``id``."""
    spark = vectors.sparkSession
    work = Scratch(spark, "forest")
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(fit).distinct()
    rows = work.write(rows, "rows")
    # the limit to k + 1 rows of a class is applied before the shuffle as well
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    classes = few.groupBy("v").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids"))
    queries = rows.where(asked).select(F.col("id").alias("query_id"), "v")
    ask = queries.select("v").distinct().withColumn("ask", F.lit(True))
    classes = classes.join(ask, "v", "left").select("class", "ids", F.col("ask").isNotNull().alias("ask"), F.size("v").alias("size"), "v")
    classes = work.write(classes, "classes")
    n, n_asked = classes.agg(F.count(F.lit(1)), F.count_if("ask")).first()
    top = max(4, (n // block).bit_length() + 6)  # depth of the cells

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for size, part in pdf.groupby("size"):
                for i in range(0, len(part), 2048):
                    cut = part.iloc[i : i + 2048]
                    keys = strings(np.stack(cut["v"].to_numpy()), trees, seed)
                    for t in range(trees):
                        yield pd.DataFrame({"size": size, "tree": t, "key": keys[:, t], "class": cut["class"].to_numpy(), "ask": cut["ask"].to_numpy()})

    table = work.write(classes.select("class", "ask", "size", "v").mapInPandas(hashed, "size int, tree int, key long, class long, ask boolean"), "strings")
    table = table.withColumn("cell", F.shiftright("key", BITS - top).cast("int"))
    own = ["size", "tree"]
    cells = table.groupBy(*own, "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*own).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = work.write(cells.withColumn("block", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / block).cast("int")), "cells")
    blocks = cells.groupBy(*own, "block").agg(F.min("cell").alias("first"), F.max("cell").alias("last"), F.ceil(F.sum("n") / block).cast("int").alias("parts"))
    blocks = work.write(blocks, "blocks")
    dealt = table.join(cells.select(*own, "cell", "block"), [*own, "cell"]).join(blocks.select(*own, "block", "parts"), [*own, "block"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))

    place = [*own, "block", "part"]
    asking = dealt.where("ask").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    inner = dealt.select(*place, "key", "class", F.lit(False).alias("asks")).unionByName(asking.select(*place, "key", "class", F.lit(True).alias("asks")))

    def counts(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["asks"]
        keys, key, who = np.sort(pdf.loc[~own, "key"].to_numpy()), pdf.loc[own, "key"].to_numpy(), pdf.loc[own, "class"].to_numpy()
        depth = np.arange(top, BITS + 1)
        lo, hi = stretch(keys, np.repeat(key, len(depth)), np.tile(depth, len(key)))
        return pd.DataFrame({"class": np.repeat(who, len(depth)), "depth": np.tile(depth, len(key)).astype("int32"), "n": hi - lo})

    deep = inner.groupBy(*place).applyInPandas(counts, "class long, depth int, n long")
    # above the cells: a prefix of each depth has the strings of its cells
    levels = cells.select(*own, "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(top - 1)), lambda d: F.call_function("shiftright", F.col("cell"), F.lit(top) - d))).alias("depth", "prefix"))
    levels = levels.groupBy(*own, "depth", "prefix").agg(F.sum("n").alias("n"))
    wide = table.where("ask").select(*own, "class", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(top - 1)), lambda d: F.call_function("shiftright", F.col("cell"), F.lit(top) - d))).alias("depth", "prefix"))
    shallow = wide.join(levels, [*own, "depth", "prefix"]).select("class", "depth", "n")
    shared = work.write(deep.unionByName(shallow).groupBy("class", "depth").agg(F.sum("n").alias("n")), "counts")

    def tried() -> int:
        """``wanted`` from the true neighbours of some queries."""
        some = classes.where("ask").orderBy(F.xxhash64("class", F.lit(seed)), "class").limit(TRIED).select("class", "size", "v").collect()  # TRIED rows
        if not some:
            return 1
        sent = spark.sparkContext.broadcast([(r["class"], np.array(r["v"])) for r in some])

        def truth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for size, part in pdf.groupby("size"):
                    ask = [(c, q) for c, q in sent.value if len(q) == size]
                    if not ask:
                        continue
                    x, who = np.stack(part["v"].to_numpy()), part["class"].to_numpy()
                    far = (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ np.stack([q / np.sqrt(q @ q) for _, q in ask]).T
                    for j, (c, _) in enumerate(ask):
                        best = np.argsort(-far[:, j], kind="stable")[: k + 1]
                        yield pd.DataFrame({"class": c, "found": who[best], "score": far[best, j], "v": [part["v"].iloc[b] for b in best]})

        near = classes.select("class", "size", "v").mapInPandas(truth, "class long, found long, score double, v array<double>")
        near = near.where("class != found").withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("score"), "found"))).where(F.col("r") <= k)
        true = near.select("class", "v").collect()  # at most k for each of the tried
        known = {r["class"]: np.array(r["v"]) for r in some}
        found_at: dict[int, list[int]] = {}
        for r in true:
            pair = strings(np.stack([known[r["class"]], np.array(r["v"])]), trees, seed)
            found_at.setdefault(r["class"], []).append(max(BITS - int(x).bit_length() for x in pair[0] ^ pair[1]))
        held = {c: np.zeros(BITS + 1, np.int64) for c in known}
        for r in shared.join(F.broadcast(spark.createDataFrame([(c,) for c in known], "class long")), "class").collect():  # TRIED x depths rows
            held[r["class"]][r["depth"]] = r["n"]
        return effort(held, found_at, n * trees, recall)

    goal = wanted or tried()
    reached = shared.groupBy("class").agg(F.max(F.when(F.col("n") >= goal, F.col("depth"))).alias("depth"))
    reached = work.write(reached.select("class", F.coalesce("depth", F.lit(0)).alias("depth")), "depths")

    # each query goes to every part of every block that its stretch reaches into
    full = dealt.join(classes.select("class", "v"), "class").select(*place, "key", "class", "v", F.lit(None).cast("int").alias("depth"))
    listed = blocks.groupBy(*own).agg(F.collect_list(F.struct("block", "first", "last", "parts")).alias("blocks"))
    asks = table.where("ask").join(reached, "class").join(listed, own)
    lift = F.greatest(F.lit(top) - F.col("depth"), F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", F.col("cell"), lift), lift)
    high = low + F.call_function("shiftleft", F.lit(1), lift) - 1
    asks = asks.withColumns({"low": low, "high": high}).withColumn("b", F.explode(F.filter("blocks", lambda b: (b["last"] >= F.col("low")) & (b["first"] <= F.col("high")))))
    asks = asks.select(*own, F.col("b.block").alias("block"), F.explode(F.sequence(F.lit(0), F.col("b.parts") - 1)).alias("part"), "key", "class", "depth")
    asks = asks.join(classes.select("class", "v"), "class").select(*place, "key", "class", "v", "depth")
    turns = -(-n_asked // block) or 1
    asks = asks.withColumn("turn", F.pmod(F.xxhash64("class"), F.lit(turns)).cast("int"))
    both = full.withColumn("turn", F.explode(F.array(*[F.lit(t) for t in range(turns)]))).unionByName(asks)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["depth"].notna()
        held, mine = pdf[~own].sort_values(["key", "class"], ignore_index=True), pdf[own]
        if not len(held) or not len(mine):
            return pd.DataFrame({"class": [], "found": [], "score": []}).astype({"class": "int64", "found": "int64", "score": float})
        keys, who = held["key"].to_numpy(), held["class"].to_numpy()
        x = np.stack(held["v"].to_numpy())
        unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
        lo, hi = stretch(keys, mine["key"].to_numpy(), mine["depth"].to_numpy().astype(np.int64))
        a, b, s = [], [], []
        for c, q, i, j in zip(mine["class"].to_numpy(), mine["v"], lo, hi):
            if i == j:
                continue
            q = np.asarray(q)
            rough = unit[i:j] @ (q / np.sqrt(q @ q))
            top = np.arange(i, j) if j - i <= 4 * (k + 1) else i + np.argpartition(-rough, 4 * (k + 1))[: 4 * (k + 1)]
            score = precise(x[top], q)
            best = np.lexsort((who[top], -score))[: k + 1]
            a.append(np.full(len(best), c))
            b.append(who[top[best]])
            s.append(score[best])
        cat = lambda z, kind: np.concatenate(z) if z else np.empty(0, kind)
        return pd.DataFrame({"class": cat(a, np.int64), "found": cat(b, np.int64), "score": cat(s, float)})

    hits = both.groupBy(*place, "turn").applyInPandas(search, "class long, found long, score double").distinct()
    order = Window.partitionBy("class").orderBy(F.desc("score"), "found")
    hits = hits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    members = classes.select(F.col("class").alias("found"), "ids")
    listed = hits.join(members, "found").select("class", "score", F.explode("ids").alias("id"))
    listed = listed.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1)
    listed = listed.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("best"))
    by_vector = classes.where("ask").select("class", F.col("v").alias("w")).join(listed, "class")
    answered = queries.join(by_vector, queries["v"] == by_vector["w"]).select("query_id", F.filter("best", lambda x: x["id"] != F.col("query_id")).alias("best"))
    return answered.select("query_id", F.posexplode(F.slice("best", 1, k))).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias("vec_id"), F.col("col.score").alias("score")
    )
