"""Hard negatives by the threshold algorithm of Fagin, Lotem and Naor.

For each anchor: its best rows of the same label (positives), and for each positive the best rows of other labels whose score lies in a window
below the positive's.  Scores are inner products of whole numbers, so ties and comparisons are exact.

Rows are cut into blocks of at most ``BLOCK``.  A block holds one sorted candidate list per dimension.  For an anchor the lists are read from
the top where its component is positive and from the bottom where it is negative (sorted access, doubling the depth); each row met for the
first time is scored in full (random access).  The threshold is the anchor's product with the values just read, and no unseen row can
score more.  A block is left when the threshold is strictly below the k-th score of every window (strictly, as ties go to the smaller id), or
below the windows' lower ends.  The k best of earlier blocks of a task count, so later blocks stop sooner; the lists of tasks are merged by rank.

How it is spread: the anchors are a stated query set and meet all rows, in blocks.  Rows are dealt evenly by a hash of the whole row, whatever their label, and
stay where they are.  Anchors come in rounds of about ``ROUND`` (a bound, not a share), each sent to all tasks; a round reads the slim
table of whole numbers once for positives and once for negatives.

Rows without an id or label, and vectors that are null, empty or hold null or non-finite components take no part, nor do rows whose scores
could not be held by a long (components of about 2^28 and more after scaling, for 64 dimensions).  Vectors of different lengths do not meet.
Rows equal in id, label and vector count once; of rows that share an id only, each is a candidate, and none is a positive or negative of an
anchor of the same id.  An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch

BLOCK = 4096
ROUND = 16_384
Best = tuple[np.ndarray, np.ndarray]
"""Scores and ids, the best first."""


class Block:
    """Rows with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids = ids
        names, self.codes = np.unique(labels, return_inverse=True)
        self.names = {v: i for i, v in enumerate(names.tolist())}
        peak = float(np.abs(x).max(initial=0))
        # products are exact as doubles where their sums stay below 2^53 and as whole numbers otherwise
        self.peak, self.x = peak, x.astype(np.float64)
        self.whole = x
        self.up = np.argsort(x, axis=0, kind="stable").astype(np.int32)

    def walk(self, anchor: np.ndarray, seen: np.ndarray, step: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(new rows, their scores, threshold) after each deepening; ``seen`` rows are passed over, and it is changed."""
        n, dims = self.x.shape
        exact = dims * self.peak * float(np.abs(anchor).max(initial=0)) < 2.0**53
        x = self.x if exact else self.whole
        a = anchor.astype(np.float64) if exact else anchor
        plus, minus = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(plus) + len(minus):
            rest = np.flatnonzero(~seen)
            seen[:] = True
            yield rest, np.zeros(len(rest), np.int64), 0
            return
        depth = 0
        while depth < n and not seen.all():
            upto = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.up[n - upto : n - depth, plus].ravel()] = True
            fresh[self.up[depth:upto, minus].ravel()] = True
            fresh &= ~seen
            seen |= fresh
            new = np.flatnonzero(fresh)
            last = (a[plus] * x[self.up[n - upto, plus], plus]).sum() + (a[minus] * x[self.up[upto - 1, minus], minus]).sum()
            yield new, (x[new] @ a).astype(np.int64), int(last)
            depth, step = upto, 2 * (depth + step)


def better(best: Best, scores: np.ndarray, ids: np.ndarray, k: int) -> Best:
    """The k best of both: higher scores first, then smaller ids."""
    if len(best[0]) == k:
        good = scores >= best[0][-1]
        scores, ids = scores[good], ids[good]
    if not len(scores):
        return best
    scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def nothing() -> Best:
    return np.empty(0, np.int64), np.empty(0, np.int64)


def best_same(block: Block, anchor: dict, best: Best, k: int) -> Best:
    """The k best rows of the anchor's label."""
    code = block.names.get(anchor["label"])
    if code is None:
        return best
    seen = (block.codes != code) | (block.ids == anchor["id"])
    for new, scores, threshold in block.walk(anchor["x"], seen):
        best = better(best, scores, block.ids[new], k)
        if len(best[0]) == k and threshold < best[0][-1]:
            break
    return best


def best_inside(block: Block, anchor: dict, best: list[Best], k: int, low: int, high: int) -> list[Best]:
    """For each score p of ``windows`` the k best rows of other labels with low * p <= 100 * score <= high * p."""
    windows = [(low * p, high * p) for p in anchor["windows"]]
    seen = (block.codes == block.names.get(anchor["label"], -1)) | (block.ids == anchor["id"])
    for new, scores, threshold in block.walk(anchor["x"], seen):
        for w, (bottom, top) in enumerate(windows):
            inside = (100 * scores >= bottom) & (100 * scores <= top)
            best[w] = better(best[w], scores[inside], block.ids[new][inside], k)
        if all(top < bottom or 100 * threshold < bottom or (len(b[0]) == k and threshold < b[0][-1]) for b, (bottom, top) in zip(best, windows)):
            break
    return best


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Block]:
    for batch in batches:
        size = batch.column("size").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(size)] if len(size) else []
        for i, j in zip(cuts, cuts[1:]):
            for at in range(i, j, most):
                part = batch.slice(at, min(most, j - at))
                x = part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)
                yield Block(part.column("id").to_numpy(), np.array(part.column("label").to_pylist(), object).astype(str), x)


def whole_rows(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, size, x): the rows that take part, components as floor(scale * component)."""
    v = F.col("v")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("string").alias("label"), vectors[vector_col].cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    peak = F.array_max(F.transform(v, F.abs)) * scale + 1
    rows = rows.where(peak * peak * F.size("v") < float(1 << 61))  # a window's products with 100 are taken on such sums as well
    return rows.select("id", "label", F.size("v").alias("size"), F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("x"))


def mine(
    vectors: DataFrame,
    asked: str,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    block: int = BLOCK,
    at_once: int = ROUND,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors that satisfy the SQL condition ``asked`` on ``id``.

    A negative's score is from ``low`` to ``high`` per cent of its positive's.
    """
    spark = vectors.sparkSession
    work = Scratch(spark, "negatives")
    rows = whole_rows(vectors, scale, id_col, label_col, vector_col).distinct()
    rows = work.write(rows.sortWithinPartitions("size", "label", "id"), "rows")
    anchors = rows.where(asked).withColumn("no", F.monotonically_increasing_id())
    anchors = work.write(anchors, "anchors")
    rounds = max(1, -(-anchors.count() // at_once))

    def each_round(asking: DataFrame, search: Callable[[Iterator[Block], list[dict]], Iterator[dict]], schema: str, name: str) -> DataFrame:
        """Send one round of anchors after the other to all rows; what the rounds found, as one table."""
        paths = []
        for r in range(rounds):
            mine_ = asking.where(F.pmod(F.xxhash64("no"), F.lit(rounds)) == r).toArrow().to_pylist()  # about at_once slim rows, whatever the table holds
            sent = spark.sparkContext.broadcast([a | {"x": np.array(a["x"], np.int64)} for a in mine_])

            def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
                for got in search(blocks(batches, block), sent.value):
                    yield pa.RecordBatch.from_pydict(got)

            work.write(rows.mapInArrow(run, schema), f"{name}{r}")
            sent.destroy()
            paths.append(f"{work.at}/{name}{r}")
        return spark.read.schema(schema).parquet(*paths)

    def listed(found: dict[int, list[tuple[int, Best]]]) -> Iterator[dict]:
        """Record batches of (anchor number, window, id, score)."""
        every = [(no, w, b) for no, got in found.items() for w, b in got if len(b[0])]
        for i in range(0, len(every), 2000):
            part = every[i : i + 2000]
            n = [len(b[0]) for *_, b in part]
            yield {
                "no": pa.array(np.repeat(np.array([p[0] for p in part], np.int64), n)),
                "window": pa.array(np.repeat(np.array([p[1] for p in part], np.int64), n)),
                "id": pa.array(np.concatenate([b[1] for *_, b in part])),
                "score": pa.array(np.concatenate([b[0] for *_, b in part])),
            }

    def same(own: Iterator[Block], asking: list[dict]) -> Iterator[dict]:
        best = {a["no"]: nothing() for a in asking}
        for b in own:
            for a in asking:
                if a["size"] == b.x.shape[1]:
                    best[a["no"]] = best_same(b, a, best[a["no"]], positives)
        yield from listed({no: [(0, b)] for no, b in best.items()})

    def other(own: Iterator[Block], asking: list[dict]) -> Iterator[dict]:
        best = {a["no"]: [nothing() for _ in a["windows"]] for a in asking}
        for b in own:
            for a in asking:
                if a["size"] == b.x.shape[1]:
                    best[a["no"]] = best_inside(b, a, best[a["no"]], negatives, low, high)
        yield from listed({a["no"]: list(zip(a["windows"], best[a["no"]])) for a in asking})

    found = "no long, window long, id long, score long"
    order = [F.desc("score"), F.asc("id")]
    near = each_round(anchors, same, found, "same")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(*order))).where(F.col("rank") <= positives)
    near = work.write(near.select("no", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    asking = anchors.join(near.groupBy("no").agg(F.collect_set("positive_score").alias("windows")), "no")
    asking = work.write(asking, "asking")
    far = each_round(asking, other, found, "other")
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("no", "window").orderBy(*order))).where(F.col("rank") <= negatives)
    far = far.select("no", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(anchors.select("no", F.col("id").alias("anchor_id")), "no")
    return named.join(far, ["no", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
