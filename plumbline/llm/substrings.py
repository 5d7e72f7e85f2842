"""Substring deduplication with prefix-partitioned suffix trees over words.

A window of ``width`` words that also starts in a document with a smaller id is a repeat; every word that a repeat covers is removed.
Windows are judged on the input.  The suffix at each word would be too much to sort at once, so

1. leaves are pruned.  Of the ``anchor``-word heads inside a window the one with the smallest hash stands for it; the same window has the same
   one everywhere.  Anchors are counted in packed form (40 bits and a bucket), combined in each task first.  A window whose anchor
   occurs in one document only is a leaf above depth ``width`` and needs no tree;
2. the suffixes that are left are split by prefixes of variable length: one word, and where more than ``group`` suffixes share it two, four,
   eight words, up to the whole width.  A prefix of full width that is still too frequent is a node by itself: its smallest document is known
   from the count, so its suffixes need no task in common;
3. each group fits one task, which builds its part of the suffix tree (sorted suffixes, nodes at depth ``EDGE`` and ``width``).  The internal nodes
   of depth ``width`` with more than one document are the repeats; overlapping and adjacent windows of one text join to maximal repeats.

Word symbols are 64-bit hashes of the bytes; two suffixes share a node only where 128 bits of prefix hashes agree.  Words are runs of bytes other
than ASCII white space and are compared unchanged.

Null text has no words and stays null.  A row with a null id causes no removal and loses nothing.  Rows that repeat an id are not smaller than each
other; each is cut by itself.  Texts of any length are handled whole.  Input columns ``n_words`` and ``n_removed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, parts, sliced, text_bytes

WIDTH = 13
ANCHOR = 6
EDGE = 4
GROUP = 500_000
FLUSH = 1_000_000
BLOCK = 1 << 18
BASE = 0x9E3779B97F4A7C15
LOW40 = np.uint64((1 << 40) - 1)
_RNG = np.random.default_rng(2025)
BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _RNG.integers(0, 1 << 63, (4, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


def symbols(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every word."""
    b = np.frombuffer(raw, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    h = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # some words at a time, so that the arrays stay small
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK, "right")))
        lo, hi = start[i], end[j - 1]
        size = 1 << int(hi - lo).bit_length()
        up, down = _powers(max(size, 2 * BLOCK))
        total = np.concatenate([[np.uint64(0)], np.cumsum(BYTES[b[lo:hi]] * up[: hi - lo], dtype=np.uint64)])
        s, e = start[i:j] - lo, end[i:j] - lo
        h[i:j] = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return start, end, h


def heads(h: np.ndarray, n: int, kind: int) -> np.ndarray:
    """Hash of the n words from each place on (fewer places than words)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out += h[k : k + m] * FACTORS[kind, k]
    return _mix(out)


def anchors(h: np.ndarray, width: int, anchor: int) -> np.ndarray:
    """The smallest head hash inside the window at each place."""
    out = heads(h, anchor, 0)
    reach, want = 1, width - anchor + 1
    while reach < want:
        step = min(reach, want - reach)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else np.empty(0, np.uint64)
        reach += step
    return out


def packed(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (by the highest bits) and the lowest 40 bits of an anchor."""
    bucket = ((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    return ((bucket << np.uint64(40)) | (keys & LOW40)).astype(np.int64)


def words_with_docs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Words of several texts at once: (text number, start in its text, end in its text, hash)."""
    raw = b"\n".join(texts)
    first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.empty(0, np.int64)
    start, end, h = symbols(raw)
    who = np.searchsorted(first, start, "right") - 1
    return who, start - first[who], end - first[who], h, raw


def _five(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(np.int64)


def _text(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def repeated_anchors(docs: DataFrame, buckets: int, width: int, anchor: int) -> DataFrame:
    """(doc, key): anchors of documents (columns id, text) that occur in more than one document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one bucket each.  kind 0: anchors to be matched; 1: known to repeat, to be passed on; 2: one document for each of those."""
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not keys:
                return
            k, d = np.concatenate(keys), np.concatenate(ids)
            keys.clear()
            ids.clear()
            order = np.lexsort((d, k))
            k, d = k[order], d[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
            k, d = k[new], d[new]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            many = np.diff(np.concatenate([first, [len(k)]])) > 1
            kinds = np.where(np.repeat(many, np.diff(np.concatenate([first, [len(k)]]))), 1, 0)
            groups = [(0, k[kinds == 0], d[kinds == 0]), (1, k[kinds == 1], d[kinds == 1]), (2, k[first[many]], d[first[many]])]
            out: list[tuple] = []
            for kind, kk, dd in groups:
                b = kk >> 40
                cuts = np.flatnonzero(np.diff(b)) + 1
                for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kk)]):
                    if j > i:
                        out.append((int(b[i]), kind, _five(kk[i:j] & ((1 << 40) - 1)), dd[i:j].astype("<i8").tobytes()))
            for i in range(0, len(out), 256):
                part = list(zip(*out[i : i + 256]))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.binary()), pa.array(part[3], pa.binary())], ["bucket", "kind", "keys", "docs"])

        held = 0
        for batch in sliced(batches, "text", 2 << 20):
            who, _, _, h, _ = words_with_docs(_text(batch, "text"))
            key = anchors(h, width, anchor)
            if len(key):
                good = who[: len(key)] == who[width - 1 :]
                key, doc = packed(key[good], buckets), who[: len(key)][good]
                fresh = np.ones(len(key), bool)
                fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                keys.append(key[fresh])
                ids.append(batch.column("id").to_numpy(zero_copy_only=False)[doc[fresh]])
                held += int(fresh.sum())
            if held > FLUSH:
                yield from flush()
                held = 0
        yield from flush()

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        def part(kind: int) -> tuple[np.ndarray, np.ndarray]:
            own = pdf[pdf["kind"] == kind]
            return _from_five(b"".join(own["keys"])), np.frombuffer(b"".join(own["docs"]), "<i8")

        (k, d), (known, known_docs), (more, more_docs) = part(0), part(1), part(2)
        every, docs_, asked = np.concatenate([k, more]), np.concatenate([d, more_docs]), np.arange(len(k) + len(more)) < len(k)
        order = np.argsort(every, kind="stable")
        every, docs_, asked = every[order], docs_[order], asked[order]
        hit = np.zeros(len(every), bool)
        if len(every):
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            size = np.diff(np.concatenate([first, [len(every)]]))
            several = np.minimum.reduceat(docs_, first) != np.maximum.reduceat(docs_, first)
            sure = np.add.reduceat((~asked).astype(np.int64), first) > 0
            hit = np.repeat(several | sure, size) & asked
        bucket = int(pdf["bucket"].iloc[0]) << 40
        return pd.DataFrame({"doc": np.concatenate([docs_[hit], known_docs]), "key": bucket | np.concatenate([every[hit], known])})

    dealt = docs.where("id is not null").mapInArrow(count, "bucket int, kind int, keys binary, docs binary")
    return dealt.groupBy("bucket").applyInPandas(match, "doc long, key long")


def dedup(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeats cut out of ``text``, and ``n_words``, ``n_removed``.

    A cut takes the white space behind it along, so the words that stay are as they were.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "substrings")
    docs = docs.drop("n_words", "n_removed")
    columns = docs.columns
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    _, nbytes = text_bytes(slim)
    buckets = parts(spark, nbytes, 64 << 20)
    found = repeated_anchors(slim, buckets, width, anchor).groupBy(F.col("doc").alias("__doc")).agg(F.collect_list("key").alias("__keys"))
    wide = docs.withColumns({"__id": F.col(f"`{id_col}`").cast("long"), "__text": F.col(f"`{text_col}`").cast("string")}).join(found, F.col("__id") == F.col("__doc"), "left").drop("__doc")
    kept = wide.drop("__keys", "__id", "__text")
    head = kept.schema.simpleString()[len("struct<") : -1]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number the rows, count words, and list the windows that need a tree."""
        row = TaskContext.get().partitionId() << 33
        for batch in sliced(batches, "__text", 2 << 20):
            who, _, _, h, _ = words_with_docs(_text(batch, "__text"))
            first = np.searchsorted(who, np.arange(batch.num_rows + 1))
            key = packed(anchors(h, width, anchor), buckets)
            lists = batch.column("__keys")
            places: list[bytes | None] = []
            for i in range(batch.num_rows):
                own = key[first[i] : max(first[i], first[i + 1] - width + 1)]
                if not lists[i].is_valid or not len(own):
                    places.append(None)
                    continue
                at = np.flatnonzero(np.isin(own, lists[i].values.to_numpy()))
                places.append(at.astype("<i4").tobytes() if len(at) else None)
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(rows), batch.column("__id"), pa.array(np.diff(first)), pa.array(places, pa.binary())], [*columns, "__row", "__id", "__n", "__places"]
            )

    located = work.write(wide.mapInArrow(locate, head + ", __row long, __id long, __n long, __places binary"), "located")
    open_rows = located.where("__places is not null")
    suffixes = open_rows.select("__row", "__id", F.col(f"`{text_col}`").cast("string").alias("text"), "__places")
    total = suffixes.agg(F.sum(F.octet_length("__places"))).first()[0] or 0
    repeats = _repeats(suffixes, total // 4, width, group).groupBy("__row").agg(F.collect_list("place").alias("__at"))
    joined = open_rows.drop("__id", "__places").withColumnRenamed("__row", "__r").join(repeats, F.col("__r") == F.col("__row"), "left").drop("__r", "__row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = columns.index(text_col)
        for batch in sliced(batches, text_col, 2 << 20):
            raw = _text(batch, text_col)
            who, start, _, _, _ = words_with_docs(raw)
            first = np.searchsorted(who, np.arange(batch.num_rows + 1))
            lists = batch.column("__at")
            texts, removed = [], []
            for i, text in enumerate(raw):
                n = first[i + 1] - first[i]
                if not lists[i].is_valid:
                    texts.append(text)
                    removed.append(0)
                    continue
                at = lists[i].values.to_numpy()
                step = np.zeros(n + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + width, -1)
                gone = np.cumsum(step[:n]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                out, last, s = [], 0, start[first[i] : first[i + 1]]
                for a, b in zip(edges[::2], edges[1::2]):
                    out.append(text[last : s[a]])
                    last = s[b] if b < n else len(text)
                out.append(text[last:])
                texts.append(b"".join(out))
                removed.append(int(gone.sum()))
            arrays = [batch.column(c) for c in columns]
            arrays[at_text] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("__n"), pa.array(removed, pa.int64())], [*columns, "n_words", "n_removed"])

    untouched = located.where("__places is null").select(*[F.col(f"`{c}`") for c in columns], F.col("__n").alias("n_words"), F.lit(0).cast("long").alias("n_removed"))
    return untouched.unionByName(joined.mapInArrow(cut, head + ", n_words long, n_removed long"))


def _suffix_heads(batch: pa.RecordBatch, levels: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """(row, id, place) of each listed suffix, and the hashes of its first words for each level."""
    who, _, _, h, _ = words_with_docs(_text(batch, "text"))
    first = np.searchsorted(who, np.arange(batch.num_rows))
    lists = [np.frombuffer(x, "<i4") for x in batch.column("__places").to_pylist()]
    n = np.array([len(x) for x in lists])
    place = np.concatenate([*lists, np.empty(0, np.int32)]).astype(np.int64)
    at = np.repeat(first, n) + place
    rows, ids = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), n) for c in ("__row", "__id"))
    return rows, ids, place, {k: heads(h, k, 1 if k == max(levels) else 2)[at] for k in levels}


def _repeats(suffixes: DataFrame, total: int, width: int, group: int) -> DataFrame:
    """(__row, place) of the windows that also start in a document with a smaller id."""
    levels = [k for k in (1, 2, 4, 8) if k < width] + [width]
    heavy: dict[int, np.ndarray] = {}  # prefixes shared by more than a group's suffixes; at most total / group of them
    least: dict[int, int] = {}  # smallest id of such a prefix of full width

    def inside(got: dict[int, np.ndarray], upto: int, known: dict[int, np.ndarray]) -> np.ndarray:
        """Suffixes all of whose prefixes below level ``upto`` are heavy."""
        out = np.ones(len(got[width]), bool)
        for k in levels[:upto]:
            out &= np.isin(got[k], known.get(k, np.empty(0, np.uint64)))
        return out

    for depth, level in enumerate(levels):
        known = dict(heavy)

        def count(batches: Iterator[pa.RecordBatch], depth: int = depth, level: int = level, known: dict = known) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, "text"):
                _, ids, _, got = _suffix_heads(batch, levels)
                own = inside(got, depth, known)
                head, doc = got[level][own], ids[own]
                order = np.argsort(head, kind="stable")
                head, doc = head[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(head) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head[first].astype(np.int64)), pa.array(np.diff(np.concatenate([first, [len(head)]]))), pa.array(np.minimum.reduceat(doc, first) if len(first) else doc)], ["head", "n", "least"]
                )

        if total <= group:
            break
        counted = suffixes.mapInArrow(count, "head long, n long, least long").groupBy("head").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
        got = counted.where(F.col("n") > group).collect()
        if not got:
            break
        heavy[level] = np.array(sorted(r["head"] for r in got), np.int64).astype(np.uint64)
        if level == width:
            least = {r["head"]: r["least"] for r in got}
    groups = max(1, -(-2 * total // group))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffixes by group, packed; those of a heavy full-width prefix are decided here (group -1 - bucket)."""
        kept: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows, ids, place, edge, full, to = (np.concatenate(x) for x in zip(*kept))
            kept.clear()
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[order])) + 1
            out = []
            for own in np.split(order, cuts):
                out.append((int(to[own[0]]), *(x[own].astype(t).tobytes() for x, t in ((rows, "<i8"), (ids, "<i8"), (place, "<i4"), (edge, "<u8"), (full, "<u8")))))
            for i in range(0, len(out), 256):
                part = list(zip(*out[i : i + 256]))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), *(pa.array(x, pa.binary()) for x in part[1:])], ["group", "rows", "ids", "places", "edge", "full"])

        for batch in sliced(batches, "text"):
            rows, ids, place, got = _suffix_heads(batch, [*levels, EDGE] if EDGE < width else levels)
            edge = got[min(EDGE, width)]
            key, open_ = got[levels[0]].copy(), np.ones(len(rows), bool)
            for k, below in zip(levels, levels[1:]):  # the prefix a suffix is routed by is the first one that is not heavy
                open_ &= np.isin(got[k], heavy.get(k, np.empty(0, np.uint64)))
                key[open_] = got[below][open_]
            to = (_mix(key) % np.uint64(groups)).astype(np.int64)
            hot = open_ & np.isin(got[width], heavy.get(width, np.empty(0, np.uint64)))
            if hot.any():
                smallest = np.array([least[int(x)] for x in got[width][hot].astype(np.int64)], np.int64)
                mine = np.flatnonzero(hot)[ids[hot] > smallest]
                to[hot] = groups  # left out below
                extra = -1 - (rows[mine] % groups)
                kept.append((rows[mine], ids[mine], place[mine], edge[mine], got[width][mine], extra))
            cold = ~hot
            kept.append((rows[cold], ids[cold], place[cold], edge[cold], got[width][cold], to[cold]))
            held += len(rows)
            if held > FLUSH // 4:
                yield from flush()
                held = 0
        if kept:
            yield from flush()

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, ids, place, edge, full = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("rows", "<i8"), ("ids", "<i8"), ("places", "<i4"), ("edge", "<u8"), ("full", "<u8")))
        if pdf["group"].iloc[0] < 0:
            return pd.DataFrame({"__row": rows, "place": place})
        order = np.lexsort((ids, full, edge))  # suffixes in tree order: nodes at EDGE words, below them nodes at full width
        e, f, d = edge[order], full[order], ids[order]
        if not len(e):
            return pd.DataFrame({"__row": rows, "place": place})
        first = np.flatnonzero(np.concatenate([[True], (e[1:] != e[:-1]) | (f[1:] != f[:-1])]))
        smallest = np.repeat(d[first], np.diff(np.concatenate([first, [len(e)]])))  # of each node, as ids are sorted inside it
        own = order[d > smallest]
        return pd.DataFrame({"__row": rows[own], "place": place[own]})

    packed_rows = suffixes.mapInArrow(route, "group long, rows binary, ids binary, places binary, edge binary, full binary")
    return packed_rows.groupBy("group").applyInPandas(tree, "__row long, place int")
