"""TF-IDF of 1- and 2-grams: counts and norms stay inside the row, only term counts are shuffled."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: a token has two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
TOKENS_AT_ONCE = 1 << 20


def token_rows(df: DataFrame, id_col: str, text: str, stop_words: Sequence[str]) -> DataFrame:
    """(id, words): lower-case tokens of each text, without stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(list(stop_words)))
    return df.select(F.col(f"`{id_col}`").alias("id"), words.alias("words"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with about TOKENS_AT_ONCE tokens together; a longer text stays whole."""
    for batch in batches:
        ends = batch.column("words").offsets.to_numpy()
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + TOKENS_AT_ONCE, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def _coded(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each token, row of each token)."""
    lists = batch.column("words")
    coded = lists.flatten().dictionary_encode()
    rows = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), rows


def _pairs(code: np.ndarray, rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of neighbouring tokens of one row; the key holds both codes."""
    same = rows[1:] == rows[:-1]
    return (code[:-1] * words + code[1:])[same], rows[1:][same]


def term_counts(tokens: DataFrame) -> DataFrame:
    """(term, df, total): rows that hold each 1- or 2-gram and its occurrences; each slice of rows is counted before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words, code, rows = _coded(batch)
            some = max(len(words), 1)
            for grams, at, pair in ((code, rows, False), (*_pairs(code, rows, some), True)):
                each, times = np.unique(grams * max(batch.num_rows, 1) + at, return_counts=True)
                term, first, held = np.unique(each // max(batch.num_rows, 1), return_index=True, return_counts=True)
                total = np.add.reduceat(times, first) if len(first) else times
                text = words.take(pa.array(term // some if pair else term))
                if pair:
                    text = pc.binary_join_element_wise(text, words.take(pa.array(term % some)), " ")
                yield pa.RecordBatch.from_arrays([text, pa.array(held.astype(np.int64)), pa.array(total.astype(np.int64))], ["term", "df", "total"])

    counted = tokens.select("words").mapInArrow(count, "term string, df long, total long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def tfidf_features(df: DataFrame, id_col: str, text: str, min_df: int = 2, max_features: int = 15_000, stop_words: Sequence[str] = ()) -> DataFrame:
    """Sparse rows ``(id, term, weight)`` of 1- and 2-grams with smooth idf ln((1 + n) / (1 + df)) + 1 and unit length.

    Terms in fewer than ``min_df`` rows are dropped, then the ``max_features`` most frequent are kept (ties by term).  ``stop_words`` go before 2-grams are formed.
    A row is a document.  The table is read twice; the only shuffle is that of term counts, and the vocabulary, which is bounded by its parameter, is sent to all tasks.
    """
    tokens = token_rows(df, id_col, text, stop_words)
    n = tokens.count()
    vocab = term_counts(tokens).where(F.col("df") >= min_df).orderBy(F.col("total").desc(), "term").limit(max_features).collect()
    terms = [r["term"] for r in vocab]
    one = [(k, t) for k, t in enumerate(terms) if " " not in t]
    two = [(k, *t.split(" ")) for k, t in enumerate(terms) if " " in t]
    idf = np.log((1 + n) / (1 + np.array([r["df"] for r in vocab], float))) + 1
    sent = df.sparkSession.sparkContext.broadcast((terms, one, two, idf))
    kind = tokens.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, single, double, known = sent.value
        every = pa.array(every, pa.string())
        names, number = pa.array([t for _, t in single], pa.string()), np.append([k for k, _ in single], -1).astype(np.int64)
        left, right = (pa.array([p[i] for p in double], pa.string()) for i in (1, 2))
        number2 = np.array([p[0] for p in double], np.int64)
        for batch in _slices(batches):
            words, code, rows = _coded(batch)
            some = max(len(words), 1)
            own = number[pc.fill_null(pc.index_in(words, value_set=names), len(single)).to_numpy()][code] if len(words) else code
            a, b = (pc.fill_null(pc.index_in(x, value_set=words), -1).to_numpy().astype(np.int64) for x in (left, right))
            here = (a >= 0) & (b >= 0)
            keys = (a * some + b)[here]
            order = np.argsort(keys)
            keys, values = keys[order], number2[here][order]
            grams, at = _pairs(code, rows, some)
            place = np.searchsorted(keys, grams)
            hit = np.zeros(len(grams), bool)
            inside = place < len(keys)
            hit[inside] = keys[place[inside]] == grams[inside]
            term = np.concatenate([own[own >= 0], values[place[hit]]])
            row = np.concatenate([rows[own >= 0], at[hit]])
            cell, times = np.unique(row * max(len(every), 1) + term, return_counts=True)
            row, term = cell // max(len(every), 1), cell % max(len(every), 1)
            w = times * known[term]
            norm = np.sqrt(np.bincount(row, w * w, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), every.take(pa.array(term)), pa.array(w / norm[row])], ["id", "term", "weight"])

    return tokens.mapInArrow(weigh, f"id {kind}, term string, weight double").withColumnRenamed("id", id_col)
