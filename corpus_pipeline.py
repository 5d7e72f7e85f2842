"""From raw documents to packed training sequences: toxicity, near copies, repeated passages, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the documents of the next.
All but the last return the columns of ``documents``.  No stage samples, caps or skips documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import packing, simhash, substrings, toxicity
from plumbline.llm.common import Scratch, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not hold for toxic."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.corpus_categories())
    names = {c: f"column{k}" for k, c in enumerate(docs.columns)}  # so that no name clashes with a score
    scored = chain.score(docs.toDF(*names.values()), names["text"])
    return scored.where(F.col("p_toxic") < toxicity.REJECT).select(*[F.col(new).alias(old) for old, new in names.items()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has; ``n_chars`` follows the text."""
    cut = substrings.dedup(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document by pieces, each with its place in a sequence of at most 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substrings", cut_repeats),
    ("packing", pack),
]

ORACLE_SQL = None  # classifier and fingerprints have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), name)
        if k:
            work.drop(STAGES[k - 1][0])
    return docs
