"""Vector best-fit packing of documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths).  Pieces go in
order of falling length, each into the open sequence that can take it under all three capacities and

* ``norm``: has the smallest weighted norm of what stays free, or
* ``dot``: has the largest weighted dot product of its free capacities and the piece's needs;

ties take the oldest sequence, and a new one is opened where none can take it.

Pieces are dealt to groups of about ``group`` pieces by a hash of a stable row number; each group is packed by one task, so that a
sequence never spans groups.  A group wastes less than one sequence, which is about one part in a thousand at the default.
A piece that fills a sequence alone needs no search and stays out of the groups.

Null text is the empty document (its end mark only).  Repeated rows are packed each.  Every row is packed; a document
longer than ``tokens`` is cut, and only such a document.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm.bpe import load_spec
from plumbline.llm.common import Scratch, sliced

TOKENS = 2048
GROUP = 16_384
MEMORY = 600_000

_MEMO: dict[str, Chunks] = {}
_WORD_END = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")  # not the empty string


class Chunks:
    """The ids of chunks seen before: their texts as one array, their ids as another, so that a batch is looked up in one call."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.mark = next(((sign, ids[0]) for sign in "~^|#@" if len(ids := self._encode(sign)) == 1), None)
        self.clear()

    def clear(self) -> None:
        self.texts = pa.array([], pa.string())
        self.ids, self.first, self.size = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(chunks in another order, their ids one after the other, number of ids of each), many chunks to a call: a chunk without the mark (a sign
        that is one token when it stands alone) ends where the mark's token stands."""
        alone = [c for c in chunks if not self.mark or self.mark[0] in c]
        joined = [c for c in chunks if self.mark and self.mark[0] not in c]
        got = [np.array(self._encode(c), "<u4") for c in alone]
        size = [len(x) for x in got]
        for i in range(0, len(joined), 4000):
            sign, token = self.mark
            ids = np.array(self._encode(f" {sign} ".join([*joined[i : i + 4000], ""])), "<u4")
            ends = np.flatnonzero(ids == token)
            size.extend((np.diff(ends, prepend=-1) - 1).tolist())
            got.append(ids[ids != token])
        return alone + joined, np.concatenate([np.empty(0, "<u4"), *got]), np.array(size, np.int64)

    def add(self, texts: pa.Array) -> None:
        """Learn new chunks.  A stop behind a letter or digit at the end of a chunk is cut off, as the tokenizer does in any case."""
        parts = [[c[:-1], c[-1]] if c[-1:] in (".", ",") and c[-2:-1] in _WORD_END else [c] for c in texts.to_pylist()]
        every = [x for p in parts for x in p]
        order, ids, size = self._learn(list(dict.fromkeys(every)))
        place = dict(zip(order, range(len(order))))
        which = np.array([place[x] for x in every], np.int64)
        length, count = size[which], np.array([len(p) for p in parts], np.int64)
        upto = np.cumsum(length)
        flat = ids[np.arange(upto[-1] if len(upto) else 0) + np.repeat((np.cumsum(size) - size)[which] - (upto - length), length)]
        ends = upto[np.cumsum(count) - 1]
        self.texts = pa.concat_arrays([self.texts, texts])
        self.first = np.concatenate([self.first, len(self.ids) + np.append(0, ends[:-1])])
        self.size = np.concatenate([self.size, np.diff(ends, prepend=0)])
        self.ids = np.concatenate([self.ids, flat])

    def numbers(self, texts: pa.Array) -> np.ndarray:
        """The place of each chunk in the memory, which is emptied when full.  Equal chunks are looked up once."""
        coded = texts.dictionary_encode()
        each = coded.dictionary
        got = pc.index_in(each, value_set=self.texts)
        if len(self.texts) + got.null_count > MEMORY and len(self.texts):
            self.clear()
            got = pa.nulls(len(each), pa.int32())
        fresh, place = got.is_null(), got.fill_null(0).to_numpy().astype(np.int64)
        if got.null_count:
            place[fresh.to_numpy(zero_copy_only=False)] = len(self.texts) + np.arange(got.null_count)
            self.add(each.filter(fresh))
        return place[coded.indices.to_numpy()]


def _batch_ids(spec: Broadcast, text: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, number of ids up to the end of each text), an end mark behind each text.

    Ids are those of the tokenizers library: of a text's chunks one after the other, as the tokenizer cuts at ASCII white space in any case.
    Texts are lower-cased (A-Z, as the tokenizer does; not where a special token may stand), split and looked up in one go for the batch."""
    if spec.value not in _MEMO:
        _MEMO.clear()
        _MEMO[spec.value] = Chunks(spec.value)
    known = _MEMO[spec.value]
    text = pc.fill_null(text, "")
    split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(text, "<|"), text, pc.ascii_lower(text)))
    number = known.numbers(split.flatten())
    last = split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()
    # the end mark is one more chunk behind the known ones
    which = np.insert(number, last, len(known.size))
    length = np.append(known.size, 1)[which]
    upto = np.cumsum(length)
    first = np.append(known.first, len(known.ids))[which]
    flat = np.append(known.ids, np.array([end], "<u4"))
    ids = flat[np.arange(upto[-1] if len(upto) else 0) + np.repeat(first - (upto - length), length)]
    return ids, upto[last + np.arange(len(last))]


def token_pieces(docs: DataFrame, path: str, tokens: int = TOKENS, id_col: str = "doc_id", text_col: str = "text", end: int = 0) -> DataFrame:
    """(id, piece, start, length, ids): each document's ids with the end mark, cut where longer than ``tokens``.

    ``ids`` holds little-endian unsigned 32-bit numbers.
    """
    spec = load_spec(docs.sparkSession, path)
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            row, piece, start, length, ids = [], [], [], [], []
            every, upto = _batch_ids(spec, batch.column("text"), end)
            for r, (i, j) in enumerate(zip([0, *upto[:-1].tolist()], upto.tolist())):
                for k, at in enumerate(range(i, j, tokens)):
                    cut = every[at : min(j, at + tokens)]
                    row.append(r)
                    piece.append(k)
                    start.append(at - i)
                    length.append(len(cut))
                    ids.append(cut.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                ["id", "piece", "start", "length", "ids"],
            )

    return slim.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def best_fit(lengths: np.ndarray, tokens: int, docs: int, attention: float, by: str, weights: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    need = np.stack([lengths / tokens, np.full(len(lengths), 1 / docs), lengths.astype(float) ** 2 / attention], axis=1)
    order = np.argsort(-lengths, kind="stable")
    least = lengths.min() if len(lengths) else 0
    free = np.empty((0, 3))
    names = np.empty(0, np.int64)
    space, used, made = np.empty((256, 3)), 0, 0
    labels, filled = np.empty(256, np.int64), np.zeros(len(lengths) + 1, np.int64)
    w = np.array(weights)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    slack = 1e-12
    for n, i in enumerate(order):
        if n % 512 == 0 and used:  # leave out what can take no piece any more
            keep = (space[:used, 0] + slack >= least / tokens) & (space[:used, 1] + slack >= 1 / docs)
            free, names = space[:used][keep], labels[:used][keep]
            used = len(names)
            space[:used], labels[:used] = free, names
        item = need[i]
        left = space[:used] - item
        fits = (left >= -slack).all(axis=1)
        if fits.any():
            score = (w * left * left).sum(axis=1) if by == "norm" else -(space[:used] * (w * item)).sum(axis=1)
            at = int(np.where(fits, score, np.inf).argmin())
        else:
            if used == len(labels):
                space, labels = np.concatenate([space, np.empty_like(space)]), np.concatenate([labels, np.empty_like(labels)])
            at, space[used], labels[used] = used, 1.0, made
            used, made = used + 1, made + 1
        space[at] -= item
        sequence[i] = labels[at]
        offset[i] = filled[sequence[i]]
        filled[sequence[i]] += lengths[i]
    return sequence, offset


def pack(
    pieces: DataFrame,
    tokens: int = TOKENS,
    docs: int = TOKENS,
    attention: float | None = None,
    by: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001),
    group: int = GROUP,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``tokens``; they replace columns of these names, others pass through.

    The pieces are written to the work folder once, so that row numbers and their number hold for every retry.
    ``attention`` is ``tokens`` squared where not given.
    """
    if by not in ("norm", "dot"):
        raise ValueError("by is norm or dot")
    cost = float(attention or tokens * tokens)
    if cost < tokens * tokens:
        raise ValueError("attention must allow one piece of full length")
    pieces = pieces.drop("sequence_id", "offset")
    held = Scratch(pieces.sparkSession, "packing").write(pieces, "pieces")
    rows = held.withColumn("__row", F.monotonically_increasing_id())
    alone = rows.where(F.col("length") >= tokens).select(*pieces.columns, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    n = held.where(F.col("length") < tokens).count()
    groups = max(1, -(-n // group))
    short = rows.where(F.col("length") < tokens)
    dealt = short.select("__row", "length", F.pmod(F.xxhash64("__row"), F.lit(groups)).alias("__group"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__row", ignore_index=True)
        sequence, offset = best_fit(pdf["length"].to_numpy(), tokens, docs, cost, by, weights)
        return pd.DataFrame({"__row": pdf["__row"], "sequence_id": pdf["__group"] * (1 << 32) + sequence, "offset": offset})

    # lengths alone go to the groups; the other columns meet their places by row
    # groups are few bytes but much work, so small partitions are not put together
    dealt = dealt.repartition(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__group")
    placed = dealt.groupBy("__group").applyInPandas(run, "__row bigint, sequence_id bigint, offset bigint")
    return alone.unionByName(short.join(placed, "__row").select(*pieces.columns, "sequence_id", "offset"))
