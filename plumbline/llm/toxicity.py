"""Toxicity by a classifier chain.

The categories are predicted one after another by linear models on hashed words; a later model also gets the probabilities of the earlier
categories.  While training, these are out-of-fold predictions: rows are dealt to folds by a hash of their text, and a row's probability comes
from a model that has not seen its fold, so later models see earlier probabilities as uncertain as they will be on new text.
The models that score the corpus are then fitted on all training rows.

Training uses about ``sample`` labelled rows at most: labels whose hash lies below a threshold set by the number of labels.  The fits of a
category (one for each fold, one on all rows) are separate tasks, each over no more than that sample.  Every row of the corpus is
scored, over its whole text; only the models (categories x features numbers) are sent to the executors.

Null text counts as empty and gets the models' base rate.  A row with a null id is scored like any other.  Labels without an id, with a null
category or without a document are left out of training; of labels that repeat an id the largest of each category counts.  Repeated rows are
scored each.  A category whose training rows are all of one kind gets that kind's value as constant probability, and 0 without any training row, so that an
untrained chain rejects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch

SAMPLE = 20_000
FEATURES = 1 << 16
FOLDS = 3
RARE = 4
REJECT = 0.35  # on held-out rows 1 of 1000 clean texts lies above
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def slots(text: Column, features: int) -> Column:
    """Which hashed words occur: lower-case runs of digits, letters and non-ASCII characters."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BREAK), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int")))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def margins(who: np.ndarray, at: np.ndarray, n: int, dense: np.ndarray, w: np.ndarray) -> np.ndarray:
    """w: weights of the slots, then of the dense columns, then the constant."""
    f = len(w) - dense.shape[1] - 1
    return np.bincount(who, weights=w[at], minlength=n) + dense @ w[f:-1] + w[-1]


def fit(who: np.ndarray, at: np.ndarray, dense: np.ndarray, y: np.ndarray, features: int, penalty: float, rounds: int) -> np.ndarray:
    """Logistic regression with squared-weight penalty by L-BFGS.  ``who``/``at``: row and slot of every word.

    Slots of fewer than ``RARE`` rows keep weight 0: they would only memorise single rows.
    """
    n, size = len(y), features + dense.shape[1] + 1
    common = np.bincount(at, minlength=features)[at] >= RARE
    who, at = who[common], at[common]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = margins(who, at, n, dense, w)
        d = (sigmoid(z) - y) / n
        g = np.concatenate([np.bincount(at, weights=d[who], minlength=features), dense.T @ d, [d.sum()]])
        g[:-1] += penalty * w[:-1]
        return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean() + penalty / 2 * (w[:-1] ** 2).sum()), g

    w = np.zeros(size)
    value, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        d = g.copy()
        used = []
        for s, t, r in reversed(past):
            a = r * (s @ d)
            used.append(a)
            d -= a * t
        if past:
            s, t, _ = past[-1]
            d *= (s @ t) / (t @ t)
        for (s, t, r), a in zip(past, reversed(used)):
            d += (a - r * (t @ d)) * s
        step, slope = 1.0 if past else 1 / max(1e-12, float(np.abs(g).sum())), float(g @ d)
        while True:
            new = w - step * d
            new_value, new_g = loss(new)
            if new_value <= value - 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, t = new - w, new_g - g
        if s @ t > 1e-14:
            past = [*past[-7:], (s, t, 1 / float(s @ t))]
        done = value - new_value < 1e-7 * max(1.0, value)
        w, value, g = new, new_value, new_g
        if done:
            break
    return w


@dataclass
class Chain:
    """Weights of each category's model, in the order of the chain."""

    categories: list[str]
    weights: list[np.ndarray]
    features: int

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """Every row with ``p_<category>`` for each category; columns of these names are replaced."""
        names, features = self.categories, self.features
        docs = docs.drop(*[f"p_{c}" for c in names])
        sent = docs.sparkSession.sparkContext.broadcast(self.weights)
        kept = docs.schema.simpleString()[len("struct<") : -1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("__slots")
                who = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                at = lists.flatten().to_numpy()
                dense = np.empty((batch.num_rows, 0))
                for w in sent.value:
                    p = sigmoid(margins(who, at, batch.num_rows, dense, w))
                    dense = np.concatenate([dense, p[:, None]], axis=1)
                columns = [c for c in batch.schema.names if c != "__slots"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *(pa.array(dense[:, k]) for k in range(len(names)))], [*columns, *(f"p_{c}" for c in names)])

        rows = docs.withColumn("__slots", slots(F.col(f"`{text_col}`"), features))
        return rows.mapInArrow(run, kept + "".join(f", p_{c} double" for c in names))


def training_rows(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int, features: int, folds: int, id_col: str, text_col: str) -> DataFrame:
    """(slots, fold, categories as 0/1) of about ``sample`` labelled documents at most."""
    known = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), *[c.cast("double").alias(n) for n, c in categories.items()]).dropna()
    known = known.groupBy("__id").agg(*[F.max(n).alias(n) for n in categories])
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1 << 20)) < int(sample / n * (1 << 20)))
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    rows = rows.join(F.broadcast(known), "__id")  # its size is the parameter's, whatever the data
    return rows.select(slots(F.col("__text"), features).alias("slots"), F.pmod(F.xxhash64("__text"), F.lit(folds)).cast("int").alias("fold"), *categories)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    sample: int = SAMPLE,
    features: int = FEATURES,
    folds: int = FOLDS,
    rounds: int = 60,
    penalty: float = 1e-4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """Fit the chain.  ``categories`` names columns over ``labels`` that are 1 where a category holds, in the order of the chain."""
    work = Scratch(docs.sparkSession, "toxicity")
    names = list(categories)
    rows = work.write(training_rows(docs, labels, categories, sample, features, folds, id_col, text_col), "rows").withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("earlier", F.array().cast("array<double>"))
    weights: list[np.ndarray] = []
    for k, name in enumerate(names):
        last = k + 1 == len(names)

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            """Fit without the rows of fold ``task`` and predict them; task -1 fits all rows."""
            pdf = pdf.sort_values("row", ignore_index=True)
            held = (pdf["fold"] == pdf["task"]).to_numpy()
            lens = pdf["slots"].map(len).to_numpy()
            who, at = np.repeat(np.arange(len(pdf)), lens), np.concatenate([*pdf["slots"], np.empty(0, np.int32)]).astype(np.int64)
            dense = np.stack(pdf["earlier"].to_numpy()) if len(pdf) else np.empty((0, 0))
            y = pdf["y"].to_numpy(float)
            into = ~held
            number = np.cumsum(into) - 1
            seen = into[who]
            if into.any() and len(np.unique(y[into])) == 2:
                w = fit(number[who[seen]], at[seen], dense[into], y[into], features, penalty, rounds)
            else:
                w = np.zeros(features + dense.shape[1] + 1)
                w[-1] = 40.0 if into.any() and y[into][0] > 0 else -40.0
            if pdf["task"].iloc[0] < 0:
                return pd.DataFrame({"row": [-1], "p": [0.0], "w": [w]})
            p = sigmoid(margins(who, at, len(pdf), dense, w))
            return pd.DataFrame({"row": pdf["row"][held], "p": p[held], "w": None})

        tasks = [-1] if last else [-1, *range(folds)]
        dealt = rows.select("slots", "fold", "row", "earlier", F.col(name).alias("y")).withColumn("task", F.explode(F.array(*[F.lit(t) for t in tasks])))
        fitted = work.write(dealt.groupBy("task").applyInPandas(one, "row long, p double, w array<double>"), f"fit_{k}")
        got = fitted.where("row = -1").select("w").first()
        none = np.zeros(features + k + 1)
        none[-1] = -40.0
        weights.append(none if got is None else np.array(got["w"]))
        if not last:
            rows = rows.join(fitted.where("row >= 0").select("row", "p"), "row").withColumn("earlier", F.concat("earlier", F.array("p"))).drop("p")
    work.drop("")
    return Chain(names, weights, features)


def corpus_categories() -> dict[str, Column]:
    """The chain over the ``labels`` table: first whether a text is of low quality, then, knowing that, whether it is toxic."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
