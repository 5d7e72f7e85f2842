"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Every node of the tree holds the smallest ``rank * leaves + position`` below it, so the root names the leftmost
pair of the lowest rank.  A merge changes at most three leaves (the pair itself, the pair on its left, the pair that
is used up), each with one climb of ``log2(leaves)`` steps.  The trees of many pieces with the same number of leaves
are kept in one matrix, so a step of all of them is one array operation; a long piece has a tree of its own.

Text is cut at ASCII white space first.  The tokenizer never joins anything across it, therefore the ids of a text are
those of its chunks, and a chunk seen before is looked up.  The memory of chunks is bounded: when it is full it is
emptied, which costs time and changes nothing.

Null text counts as empty: no ids, and the empty string when decoded.  A text of any length is encoded whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from plumbline.llm.common import arrow_map

MEMORY = 200_000
NONE = np.int64(1) << 62


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself where printable, else the next from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (x for x in range(256) if x not in set(plain))
    other = {b: 256 + i for i, b in enumerate(rest)}
    return [chr(other.get(b, b)) for b in range(256)]


class Bpe:
    """A lower-casing word-level BPE model with an end-of-word suffix, read from a tokenizer's JSON text."""

    def __init__(self, spec: str, memory: int = MEMORY):
        at = json.loads(spec)
        model, vocab = at["model"], at["model"]["vocab"]
        self.suffix, self.memory = model["end_of_word_suffix"] or "", memory
        pattern = next(x["pattern"]["Regex"] for x in at["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pieces = regex.compile(pattern)
        self.tokenizer = Tokenizer.from_str(spec)
        added = {x["content"]: x["id"] for x in at["added_tokens"]}
        self.added, self.cut = added, regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.odd = regex.compile("|".join([*map(regex.escape, added), r"[\x1c-\x1f\x85\xa0\u0500-\U0010ffff]"]))
        self.names = [""] * (1 + max([*vocab.values(), *added.values()]))
        for name, i in [*vocab.items(), *added.items()]:
            self.names[i] = name
        letters = byte_letters()
        self.bytes = {c: b for b, c in enumerate(letters)}
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * len(self.names) + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        _, first = np.unique(keys[::-1], return_index=True)  # of a pair listed twice the last counts
        rank = len(keys) - 1 - first
        self.keys, self.rank, self.made = keys[rank], rank.astype(np.int64), made
        self.seen: dict[bytes, bytes] = {}
        self.known: dict[bytes, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it cannot be merged (or one side is -1)."""
        want = left * len(self.names) + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == want), self.rank[at], NONE)

    def merge(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Ids of words of at most ``leaves`` bytes (a power of two), all merged side by side."""
        n = len(words)
        lens = np.array([len(w) for w in words])
        raw = np.zeros((n, leaves), np.uint8)
        flat = np.frombuffer(b"".join(words), np.uint8)
        inside = np.arange(leaves) < lens[:, None]
        raw[inside] = flat
        ids = np.where(inside, self.inner[raw], -1)
        ids[np.arange(n), lens - 1] = self.last[raw[np.arange(n), lens - 1]]
        after = np.tile(np.arange(1, leaves + 1), (n, 1))
        before = np.tile(np.arange(-1, leaves - 1), (n, 1))
        tree = np.full((n, 2 * leaves), NONE, np.int64)
        right = np.concatenate([ids[:, 1:], np.full((n, 1), -1)], axis=1)
        found = self.ranks(ids, right)
        tree[:, leaves:] = np.where(found < NONE, found * leaves + np.arange(leaves), NONE)
        level = leaves
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            """Point update: write leaves, then climb to the root."""
            node = at + leaves
            tree[rows, node] = value
            while leaves > 1 and node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = tree[rows, 1]
            i = best % leaves
            j = after[rows, i]
            ids[rows, i] = self.made[best // leaves]
            ids[rows, j] = -1
            k = after[rows, j]
            after[rows, i] = k
            more = k < leaves
            before[rows[more], k[more]] = i[more]
            put(rows, j, np.full(len(rows), NONE))
            next_id = np.where(more, ids[rows, np.minimum(k, leaves - 1)], -1)
            found = self.ranks(ids[rows, i], next_id)
            put(rows, i, np.where(found < NONE, found * leaves + i, NONE))
            h = before[rows, i]
            has = h >= 0
            if has.any():
                r, h, i = rows[has], h[has], i[has]
                found = self.ranks(ids[r, h], ids[r, i])
                put(r, h, np.where(found < NONE, found * leaves + h, NONE))
            rows = rows[tree[rows, 1] < NONE]
        kept = ids >= 0
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        packed = ids[kept].astype("<u4").tobytes()
        return [packed[i:j] for i, j in zip([0, *ends], ends)]

    def learn(self, words: Iterable[bytes]) -> None:
        """Encode distinct new words; trees of equal size go together, about a million leaves at a time."""
        by: dict[int, list[bytes]] = {}
        for w in words:
            by.setdefault(1 << max(0, len(w) - 1).bit_length(), []).append(w)
        for leaves, group in by.items():
            step = max(1, (1 << 20) // leaves)
            for i in range(0, len(group), step):
                part = group[i : i + step]
                self.known.update(zip(part, self.merge(part, leaves)))

    def plain(self, chunks: list[str]) -> list[list[bytes]]:
        """Pieces of chunks without special tokens, inner white space or letters from U+0500 on."""
        low = unicodedata.normalize("NFC", " ".join(chunks)).replace("Σ", "σ").lower().split(" ")
        find = self.pieces.findall
        return [[c.encode()] if c.isalpha() else [x.encode() for x in find(c)] for c in low]

    def rare(self, chunk: str) -> list[bytes | int]:
        """Pieces of any other chunk, cut by the tokenizer's own normalizer and pattern; ids of special tokens in it."""
        out: list[bytes | int] = []
        for k, part in enumerate(self.cut.split(chunk) if self.cut else [chunk]):
            if k % 2:
                out.append(self.added[part])
            elif part:
                part = self.tokenizer.normalizer.normalize_str(part)
                out.extend(bytes(map(self.bytes.__getitem__, x)) for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [(t or "").encode().split() for t in texts]
        seen = self.seen
        fresh = {c for chunks in cut for c in chunks if c not in seen}
        if len(seen) + len(fresh) > self.memory:
            seen.clear()
            self.known.clear()
            fresh = {c for chunks in cut for c in chunks}
        odd = [c for c in fresh if self.odd.search(c.decode())]
        even = list(fresh.difference(odd))
        todo = [*zip(odd, [self.rare(c.decode()) for c in odd]), *(zip(even, self.plain([c.decode() for c in even])) if even else ())]
        known = self.known
        self.learn({w for _, ws in todo for w in ws if isinstance(w, bytes) and w not in known})
        for c, ws in todo:
            seen[c] = known[ws[0]] if len(ws) == 1 and ws[0] in known else b"".join([known[w] if isinstance(w, bytes) else w.to_bytes(4, "little") for w in ws])
        return [b"".join(map(seen.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids: list[bytes | None]) -> list[str]:
        """Token strings joined by a space, special tokens included, as a tokenizer without a decoder does."""
        name = self.names.__getitem__
        return [" ".join(map(name, np.frombuffer(x or b"", "<u4").tolist())) for x in ids]


def load_spec(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file (a few MB, whatever the data) sent to the executors once."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


_MODELS: dict[str, Bpe] = {}


def _model(spec: Broadcast) -> Bpe:
    """One model for each worker process and tokenizer file."""
    if spec.value not in _MODELS:
        _MODELS.clear()
        _MODELS[spec.value] = Bpe(spec.value)
    return _MODELS[spec.value]


def _lists(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary): the ids of every whole text.  Other columns are left behind; repeated rows stay repeated."""
    spec = load_spec(docs.sparkSession, path)
    slim = docs.select(id_col, text_col).toDF("id", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(_model(spec).encode(_lists(batch, "text")), pa.binary())], ["id", "ids"])

    kind = slim.schema["id"].dataType.simpleString()
    return arrow_map(slim, run, f"id {kind}, ids binary", "text").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded) of what :func:`encode` returned."""
    spec = load_spec(encoded.sparkSession, path)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _lists(batch, "ids")
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary()), pa.array(_model(spec).decode(ids), pa.string())], ["id", "ids", "decoded"])

    slim = encoded.select(encoded[id_col].alias("id"), "ids")
    return arrow_map(slim, run, f"id {kind}, ids binary, decoded string", "ids").withColumnRenamed("id", id_col)
