"""Baselines and tuning as Spark ML jobs.

Boosted libraries of the single-machine form are replaced by Spark's trees, and attribution by permutation; quantile boosting is built here on
Spark's trees, boosting of several classes on sums by bins.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from plumbline.functions.core import h32, ratio, rnd
from plumbline.operators.binary import curve_areas
from plumbline.operators.ordering import MAX_BUCKETS, exact_quantiles, rank_rows
from plumbline.operators.prep import class_weights_balanced
from plumbline.session import ensure_checkpoint_dir, remove_folder, shared_folder, written


def _assemble(features: Sequence[str], scale: bool) -> list:
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw_features" if scale else "features", handleInvalid="skip")]
    return stages + ([StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)] if scale else [])


def logistic(features: Sequence[str], label: str, weight: str | None = None, **kw) -> Pipeline:
    est = LogisticRegression(labelCol=label, **kw)
    return Pipeline(stages=[*_assemble(features, True), est.setWeightCol(weight) if weight else est])


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, balanced: bool = True) -> tuple[PipelineModel, DataFrame]:
    """Weighted logistic baseline, and its coefficients on the standardised features as rows."""
    data = class_weights_balanced(df, label) if balanced else df
    model = logistic(features, label, "weight" if balanced else None).fit(data)
    lr = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients)] + [("(intercept)", float(lr.intercept))]
    return model, df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> tuple[PipelineModel, DataFrame]:
    model = Pipeline(stages=[*_assemble(features, False), LinearRegression(labelCol=label)]).fit(df)
    lr = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients)] + [("(intercept)", float(lr.intercept))]
    return model, df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def _early(validation: str | None) -> dict[str, str]:
    return {"validationIndicatorCol": validation} if validation else {}


ROWS_PER_TASK = 1_000_000


def _fine(df: DataFrame) -> DataFrame:
    """At most about ROWS_PER_TASK rows in a part: trees keep their rows in memory as objects, many times the size of a file's."""
    want = -(-df.count() // ROWS_PER_TASK)
    return df.repartition(want) if want > df.rdd.getNumPartitions() else df


def fit_boosted_binary(df: DataFrame, features: Sequence[str], label: str, validation: str | None = None, **kw) -> PipelineModel:
    """Boosted trees with balanced weights; boosting ends early when the rows marked by the boolean ``validation`` stop improving."""
    data = _fine(class_weights_balanced(df, label))
    return Pipeline(stages=[*_assemble(features, False), GBTClassifier(labelCol=label, weightCol="weight", seed=1, **_early(validation), **kw)]).fit(data)


BINS = 64
ROWS_IN_DRIVER = 100_000


def _cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Where the bins of each feature begin, but the first: at every value where a feature has at most ``bins`` of them, else at quantiles from a sketch."""
    names = range(len(features))

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0) for _ in names]
        for batch in batches:
            for i in names:
                if len(seen[i]) <= bins:
                    seen[i] = np.unique(np.append(seen[i], batch.column(i).to_numpy()))[: bins + 1]
        for i in names:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen[i]), i, np.int32)), pa.array(seen[i])], names=["i", "v"])

    found = df.mapInArrow(few, "i int, v double").distinct().collect()  # at most bins + 1 values of a feature and task
    values = [np.unique([r["v"] for r in found if r["i"] == i]) for i in names]
    many = [i for i in names if len(values[i]) > bins]
    if many:
        levels = F.array(*[F.lit(j / bins) for j in range(1, bins)])
        got = df.agg(*[F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(features[i], 32 * bins), levels).alias(f"q{i}") for i in many]).first()
        for i in many:
            values[i] = np.append(-np.inf, np.unique(got[f"q{i}"]))
    return [v[1:].tolist() for v in values]


@dataclass
class _Binned:
    """Distinct rows of bins: weight of each class and margins so far."""

    codes: np.ndarray
    weight: np.ndarray
    margin: np.ndarray

    @staticmethod
    def of(rows: Sequence[Sequence[float]], width: int, classes: int) -> _Binned:
        m = np.array(rows, dtype=float).reshape(-1, width + classes)
        return _Binned(m[:, :width].astype(np.int64), m[:, width:], np.zeros((len(m), classes)))

    def chance(self) -> np.ndarray:
        up = np.exp(self.margin - self.margin.max(axis=1, keepdims=True))
        return up / up.sum(axis=1, keepdims=True)

    def node(self, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
        """The node of one tree each row has come to after ``levels`` steps."""
        codes, start, at = self.codes.ravel(), np.arange(len(self.codes)) * self.codes.shape[1], np.zeros(len(self.codes), np.int64)
        for _ in range(levels if len(at) else 0):
            f = feature.take(at)
            at = np.where(f >= 0, 2 * at + 1 + (codes.take(start + f, mode="wrap") >= cut.take(at)), at)
        return at

    def histogram(self, feature: np.ndarray, cut: np.ndarray, first: int) -> np.ndarray:
        """Sums of gradient and curvature by class, node from ``first`` on (a level of the trees), feature and bin."""
        p, total, width = self.chance(), self.weight.sum(axis=1, keepdims=True), self.codes.shape[1]
        slopes = (total * p - self.weight, 2 * total * p * (1 - p))
        out = np.zeros((2, len(feature), first + 1, width, BINS))
        place = np.arange(width) * BINS + self.codes
        for k in range(len(feature)):
            at = self.node(feature[k], cut[k], (first + 1).bit_length() - 1) - first
            here = np.flatnonzero(at >= 0)  # the others stay in a leaf above
            where = (place.take(here, axis=0) + (at.take(here) * (width * BINS))[:, None]).ravel()
            for j, v in enumerate(slopes):
                out[j, k] = np.bincount(where, np.repeat(v[here, k], width), out[j, k].size).reshape(out[j, k].shape)
        return out

    def moved(self, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> _Binned:
        """The same rows with the margins of one more round."""
        return _Binned(self.codes, self.weight, self.margin + np.stack([v[self.node(f, c, len(v).bit_length() - 1)] for f, c, v in zip(feature, cut, value)], axis=1))


Trees = tuple[np.ndarray, np.ndarray, np.ndarray]


def _round(histogram: Callable[[np.ndarray, np.ndarray, int], np.ndarray], classes: int, depth: int, rate: float, ridge: float) -> Trees:
    """One tree for each class, all grown level by level from one set of sums: feature (-1 for a leaf), cut and value of node i, whose children are 2i + 1 and 2i + 2."""
    feature, cut, value = (np.full((classes, 2 ** (depth + 1) - 1), x) for x in (-1, 0, 0.0))
    for level in range(depth):
        first = 2**level - 1
        g, h = histogram(feature, cut, first)
        left, right = ([x.cumsum(axis=-1)[..., :-1] for x in (g, h)], [x[..., ::-1].cumsum(axis=-1)[..., -2::-1] for x in (g, h)])
        whole = [x[:, :, :1].sum(axis=-1, keepdims=True) for x in (g, h)]
        score = lambda s: s[0] * s[0] / (s[1] + ridge)
        gain = np.where((left[1] >= 1) & (right[1] >= 1), score(left) + score(right) - score(whole), 0.0).reshape(classes, first + 1, -1)
        best = gain.argmax(axis=-1)[..., None]
        won = np.take_along_axis(gain, best, -1)[..., 0] > 1e-6
        at = first + np.arange(first + 1)
        if level == 0:
            value[:, :1] = -rate * (whole[0] / (whole[1] + ridge))[:, :, 0, 0]
        feature[:, at] = np.where(won, best[..., 0] // (BINS - 1), -1)
        cut[:, at] = best[..., 0] % (BINS - 1) + 1
        for child, side in ((2 * at + 1, left), (2 * at + 2, right)):
            up, down = (np.take_along_axis(x.reshape(gain.shape), best, -1)[..., 0] for x in side)
            value[:, child] = np.where(won, -rate * up / (down + ridge), 0.0)
        if not won.any():
            break
    return feature, cut, value


@dataclass
class ClassBoost:
    """Boosted trees for several classes: one tree a class and round on binned features; the most probable class wins."""

    features: list[str]
    classes: list
    cuts: list[list[float]]
    rounds: list[Trees]

    def coded(self, df: DataFrame) -> DataFrame:
        """Add the bins ``__c0..`` of the features; rows with a NULL or NaN feature are left out."""
        ends = [[-np.inf, *(c or [0.0]), np.inf] for c in self.cuts]
        return Bucketizer(splitsArray=ends, inputCols=self.features, outputCols=[f"__c{i}" for i in range(len(ends))], handleInvalid="skip").transform(df)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (an array, in the order of ``classes``) and ``prediction``; equal rows of bins are scored once."""
        names, rounds, classes = [f"__c{i}" for i in range(len(self.cuts))], self.rounds, np.array(self.classes, dtype=float)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _Binned.of(np.stack([batch.column(i).to_numpy() for i in range(len(names))] + [np.zeros(batch.num_rows)] * len(classes), axis=1), len(names), len(classes))
                for trees in rounds:
                    rows = rows.moved(*trees)
                p = rows.chance()
                sure = pa.ListArray.from_arrays(np.arange(0, p.size + 1, len(classes), dtype=np.int32), p.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, sure, pa.array(classes[p.argmax(axis=1)])], names=[*names, "probability", "prediction"])

        rows = self.coded(df)
        scored = rows.select(*names).distinct().mapInArrow(score, "".join(f"{c} double, " for c in names) + "probability array<double>, prediction double")
        return rows.join(scored, names).drop(*names)


def fit_boosted_multiclass(df: DataFrame, features: Sequence[str], label: str, rounds: int = 300, depth: int = 5, rate: float = 0.05, ridge: float = 1.0, keep_every: int = 10) -> ClassBoost:
    """Boosted trees of the softmax loss with balanced weights, as many and as deep as the reference's; every round sees all rows.

    Trees split between bins of the features, so rows are added up once by bins and class, and rounds run on the distinct rows of bins.  Up to ``ROWS_IN_DRIVER`` of
    them (the bins to the power of the features at most) a round is arithmetic on arrays in the driver; more are kept in parts by the executors, which return the sums of a
    level, and are written to the checkpoint folder every ``keep_every`` rounds.
    """
    spark = df.sparkSession
    known = df.where(F.col(label).isNotNull())
    classes = sorted(r[label] for r in known.select(label).distinct().collect())  # one tree a round for each
    model = ClassBoost(list(features), classes, [], [])
    model.cuts = _cuts(known.select(*[F.col(f).cast("double").alias(f) for f in features]).dropna(), features)
    codes = [f"__c{i}" for i in range(len(features))]
    sums = [F.sum(F.when(F.col(label) == F.lit(c), F.col("weight")).otherwise(0.0)).alias(f"__w{k}") for k, c in enumerate(classes)]
    rows = model.coded(class_weights_balanced(known, label)).groupBy(*codes).agg(*sums).persist()
    try:
        n, width, count = rows.count(), len(features), len(classes)
        if not n:
            raise ValueError("no row has a label and all features")
        if n <= ROWS_IN_DRIVER:
            binned = _Binned.of(rows.orderBy(*codes).collect(), width, count)
            for _ in range(rounds):
                model.rounds.append(_round(binned.histogram, count, depth, rate, ridge))
                binned = binned.moved(*model.rounds[-1])
            return model
        ensure_checkpoint_dir(spark)
        parts = rows.repartition(max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK)), *codes).rdd.mapPartitions(lambda part: [_Binned.of(list(part), width, count)]).persist()
        for number in range(1, rounds + 1):
            model.rounds.append(_round(lambda *level: parts.map(lambda b: b.histogram(*level)).treeReduce(np.add), count, depth, rate, ridge))  # noqa: B023
            trees, last = model.rounds[-1], parts
            parts = last.map(lambda b: b.moved(*trees)).persist()  # noqa: B023
            if number % keep_every == 0:
                parts.checkpoint()
            parts.count()
            last.unpersist()
        parts.unpersist()
        return model
    finally:
        rows.unpersist()


def fit_forest_multiclass(df: DataFrame, features: Sequence[str], label: str, **kw) -> PipelineModel:
    """Random forest with balanced weights."""
    data = _fine(class_weights_balanced(df, label))
    return Pipeline(stages=[*_assemble(features, False), RandomForestClassifier(labelCol=label, weightCol="weight", seed=1, **kw)]).fit(data)


def fit_boosted_regression(df: DataFrame, features: Sequence[str], label: str, validation: str | None = None, **kw) -> PipelineModel:
    """Boosted trees; ``lossType='absolute'`` fits the median, ``validation`` ends boosting early."""
    return Pipeline(stages=[*_assemble(features, False), GBTRegressor(labelCol=label, seed=1, **_early(validation), **kw)]).fit(_fine(df))


@dataclass
class QuantileBoost:
    """Boosted trees for one quantile of the label: a constant, then one tree a round with a shift for each of its leaves."""

    level: float
    start: float
    rate: float
    trees: list[tuple[DecisionTreeRegressionModel, list[float]]]

    def predict(self, assembled: DataFrame, name: str, since: int = 0, onto: str | None = None) -> DataFrame:
        """Add column ``name`` to rows with ``features``: the sum from round ``since`` on, above column ``onto`` or the constant."""
        out = assembled.withColumn(name, F.col(onto) if onto else F.lit(self.start))
        for tree, shifts in self.trees[since:]:
            leaves = F.array(*[F.lit(self.rate * v) for v in shifts])  # at most 2^depth of them
            out = tree.transform(out).withColumn(name, F.col(name) + F.get(leaves, F.col("__leaf").cast("int"))).drop("__leaf", "__sign_hat")
        return out


def fit_quantile_boost(assembled: DataFrame, label: str, levels: Sequence[float], rounds: int = 20, rate: float = 0.3, depth: int = 4, keep_every: int = 5, least_rows: int = 20) -> list[QuantileBoost]:
    """Gradient boosting of the pinball loss, one model for each level, on rows with ``features`` and ``label``.

    The loss falls by ``level`` where the label lies above the prediction and by ``1 - level`` where it lies below, so a round fits a regression tree to that sign and then moves each
    leaf by its rows' quantile of label minus prediction, times ``rate``.  A round costs a tree and one aggregate with a sketch for each leaf.  The predictions so far
    are kept in the checkpoint folder every ``keep_every`` rounds, so a round applies few trees and a lost executor repeats few.
    """
    ensure_checkpoint_dir(assembled.sparkSession)
    names = [f"__m{k}" for k in range(len(levels))]
    y = F.col(label).cast("double")
    rows = assembled.where(y.isNotNull() & ~F.isnan(y)).select("features", y.alias("__y"))
    start = exact_quantiles(rows, ["__y"], levels)
    models = [QuantileBoost(p, v, rate, []) for p, v in zip(levels, start[("__y",)] if ("__y",) in start else [0.0] * len(levels)) if v is not None]
    if not models:
        raise ValueError("no row has a label")
    rows = rows.withColumns({n: F.lit(m.start) for n, m in zip(names, models)}).checkpoint()
    kept = 0
    for number in range(1, rounds + 1):
        now = rows
        for name, m in zip(names, models):
            now = m.predict(now, name, kept, name)
        if number > 1 and (number - 1) % keep_every == 0:
            rows, kept = now.checkpoint(), number - 1
            now = rows
        for name, m in zip(names, models):
            signed = now.withColumn("__sign", F.when(F.col("__y") > F.col(name), m.level).otherwise(m.level - 1.0))
            tree = DecisionTreeRegressor(labelCol="__sign", predictionCol="__sign_hat", leafCol="__leaf", maxDepth=depth, minInstancesPerNode=least_rows, seed=number).fit(signed)
            shift = F.percentile_approx(F.col("__y") - F.col(name), m.level, 10_000)
            got = {int(r["__leaf"]): r["v"] for r in tree.transform(now).groupBy("__leaf").agg(shift.alias("v")).collect()}  # at most 2^depth rows
            m.trees.append((tree, [got.get(k, 0.0) for k in range(2**depth)]))
    return models


def fit_quantile_bounds(train: DataFrame, df: DataFrame, features: Sequence[str], label: str, low: float = 0.05, high: float = 0.95, **kw) -> DataFrame:
    """Add ``lo`` and ``hi`` to ``df``: boosted estimates of two quantiles of the label, fitted on ``train``; where they cross, the lower one is ``lo``.

    Rows with a NULL or NaN feature are left out, as in the other fits.
    """
    assembler = _assemble(features, False)[0]
    first, second = fit_quantile_boost(assembler.transform(train), label, [low, high], **kw)
    out = second.predict(first.predict(assembler.transform(df), "__lo"), "__hi").drop("lo", "hi", "features")
    return out.withColumns({"lo": F.least("__lo", "__hi"), "hi": F.greatest("__lo", "__hi")}).drop("__lo", "__hi")


def probability(df: DataFrame, name: str = "score") -> DataFrame:
    """Probability of class 1 as a plain column."""
    return df.withColumn(name, vector_to_array("probability")[1])


def fit_multi_output(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> dict[str, PipelineModel]:
    """One model per label over one cached table."""
    data = df.select(*features, *labels).persist()
    try:
        return {label: logistic(features, label, maxIter=20).fit(data) for label in labels}
    finally:
        data.unpersist()


def predict_multi_output(models: dict[str, PipelineModel], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    out = df
    for label, m in models.items():
        out = probability(m.transform(out), f"p_{label}").drop("raw_features", "features", "rawPrediction", "probability", "prediction")
    return out.select(*keep, *[f"p_{label}" for label in models])


def fit_classifier_chain(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Label i also sees the predictions of the labels before it."""
    out, seen = df, list(features)
    for label in labels:
        m = logistic(seen, label, maxIter=20).fit(out)
        out = probability(m.transform(out), f"p_{label}").drop("raw_features", "features", "rawPrediction", "probability", "prediction")
        seen.append(f"p_{label}")
    return out


def oof_probabilities(df: DataFrame, fold: str, k: int, fit: Callable[[DataFrame], PipelineModel]) -> DataFrame:
    """Every row scored by a model that did not see its fold."""
    out = None
    for i in range(k):
        part = probability(fit(df.where(F.col(fold) != i)).transform(df.where(F.col(fold) == i))).select(*df.columns, "score")
        out = part if out is None else out.unionByName(part)
    return out


def cv_score(df: DataFrame, label: str, fold: str, k: int, fit: Callable[[DataFrame], PipelineModel]) -> DataFrame:
    """Mean and sample standard deviation of the exact ROC area over the folds."""
    scored = oof_probabilities(df, fold, k, fit).select(F.col(label).alias("y"), "score", F.col(fold).alias("fold"))
    return curve_areas(scored, ["fold"]).agg(F.count(F.lit(1)).alias("folds"), rnd(F.avg("roc_auc")).alias("mean_roc_auc"), rnd(F.stddev_samp("roc_auc")).alias("std_roc_auc"))


ROWS_PER_RANGE = 2_000_000


def _score_curves(df: DataFrame, rows_per_range: int) -> DataFrame:
    """Counts of rows ``(fold, y, scores)`` from the top score down, one row for each fold, candidate (place in ``scores``) and range ``r`` of scores.

    ``keys``, ``pos`` and ``neg`` are the range's distinct scores and its rows of each class; ``cum_pos`` and ``cum_neg`` have the counts through each of its scores.  Equal scores
    meet in the tasks that read them, and only arrays of scores and counts are dealt.  Ranges rise with ``r``; results do not depend on where they are cut.
    """
    want = min(MAX_BUCKETS, -(-df.count() // rows_per_range))
    cuts = np.empty(0)
    if want > 1:
        number, levels = F.nanvl("score", F.lit(None).cast("double")), F.array(*[F.lit(i / want) for i in range(1, want)])
        sketch = F.kll_sketch_agg_double(number, min(65_535, max(200, 32 * want)))
        got = df.select(F.explode("scores").alias("score")).agg(F.when(F.count(number) > 0, F.kll_sketch_get_quantile_double(sketch, levels)).alias("q")).first()["q"]
        cuts = np.unique(np.array(got or [], dtype=float))

    def distinct(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, ...]:
        """The distinct scores in ascending order, NaN last, and the sums of their counts."""
        order = np.argsort(score, kind="stable")
        score = score[order]
        first = np.flatnonzero(np.append(True, (score[1:] != score[:-1]) & ~np.isnan(score[:-1])))
        return score[first], np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)

    def dealt(fold: int, parts: list) -> Iterator[pa.RecordBatch]:
        pos, scores = (np.concatenate(a) for a in zip(*parts))
        for candidate, score in enumerate(scores.T):
            values = distinct(score, pos, 1 - pos)
            ends = [0, *np.searchsorted(values[0], cuts), len(values[0])]
            for r, (a, b) in enumerate(zip(ends, ends[1:])):
                if a < b:
                    yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (fold, candidate, r, *(v[a:b].tobytes() for v in values))))], kind)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        rows = 0
        for batch in batches:
            fold, pos, scores = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy()
            for i in np.unique(fold):
                held.setdefault(int(i), []).append((pos[fold == i], scores.reshape(len(fold), -1)[fold == i]))
            rows += len(fold)
            if rows >= rows_per_range:
                for i in held:
                    yield from dealt(i, held[i])
                held, rows = {}, 0
        for i in held:
            yield from dealt(i, held[i])

    def merged(pieces: pa.Table) -> pa.Table:
        _, pos, neg = distinct(*(np.frombuffer(b"".join(pieces.column(c).to_pylist()), t) for c, t in (("score", float), ("pos", np.int64), ("neg", np.int64))))
        pos, neg = np.cumsum(pos[::-1]), np.cumsum(neg[::-1])
        own = pieces.select(place).slice(0, 1)
        for c, v in (("keys", len(pos)), ("pos", pos[-1]), ("neg", neg[-1])):
            own = own.append_column(c, pa.array([v], pa.int64()))
        for c, v in (("cum_pos", pos), ("cum_neg", neg)):
            own = own.append_column(c, pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)))
        return own

    place = ["fold", "candidate", "r"]
    head = "".join(f"{c} int, " for c in place)
    kind = pa.schema([*[(c, pa.int32()) for c in place], *[(c, pa.binary()) for c in ("score", "pos", "neg")]])
    met = df.select("fold", (F.col("y") == 1).cast("long"), "scores").mapInArrow(pieces, head + "score binary, pos binary, neg binary").groupBy(*place)
    return met.applyInArrow(merged, head + "keys long, pos long, neg long, cum_pos array<long>, cum_neg array<long>")


def _binned_areas(df: DataFrame, bins: int = 1000, rows_per_range: int = ROWS_PER_RANGE) -> list[Row]:
    """ROC area of each fold and candidate of rows ``(fold, y, scores)`` as ``BinaryClassificationEvaluator`` takes it: good for choosing, not for reporting.

    Thresholds are every n-th distinct score from the top and the last, n being their number divided by ``bins``.  The evaluator counts them anew in each task, so that its
    areas move with the way rows are dealt; here they are counted through a fold, as it does in one task.
    """
    by, counts = ["fold", "candidate"], ("keys", "pos", "neg")
    curve = _score_curves(df, rows_per_range).persist()
    try:
        down = Window.partitionBy(*by).orderBy(F.desc("r"))  # at most MAX_BUCKETS rows of a group
        whole = Window.partitionBy(*by)
        ends = curve.select(*by, "r", *[(F.sum(c).over(down) - F.col(c)).alias(f"{c}_above") for c in counts], *[F.sum(c).over(whole).alias(f"all_{c}") for c in counts])
        step, last = F.greatest(F.floor(F.col("all_keys") / bins), F.lit(1)), F.col("keys_above") + F.col("keys")
        first = (F.floor(F.col("keys_above") / step) + 1) * step
        none = F.array().cast("array<long>")
        at = F.array_union(F.when(first <= last, F.sequence(first, last, step)).otherwise(none), F.when(last == F.col("all_keys"), F.array(last)).otherwise(none))

        def through(c: str, k: Column) -> Column:
            return ratio(F.col(f"{c}_above") + F.element_at(f"cum_{c}", (k - F.col("keys_above")).cast("int")), F.col(f"all_{c}"))

        points = F.transform(at, lambda k: F.struct(k.alias("k"), through("neg", k).alias("x"), through("pos", k).alias("t")))
        kept = curve.join(F.broadcast(ends), [*by, "r"]).select(*by, F.inline(points))
        w = Window.partitionBy(*by).orderBy("k")  # less than 2 * bins rows of a group
        part = (F.col("x") - F.lag("x", 1, 0.0).over(w)) * (F.col("t") + F.lag("t", 1, 0.0).over(w)) / 2
        last = (1 - F.max("x")) * (1 + F.max("t")) / 2
        return kept.withColumn("part", part).groupBy(*by).agg((F.sum("part") + last).alias("area")).collect()
    finally:
        curve.unpersist()


PARALLEL_FITS = 4


def _search(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, grid: list, pipe: Pipeline) -> tuple[PipelineModel, DataFrame]:
    """The best candidate of ``grid`` fitted on all rows, and every candidate's mean ROC area over the folds.

    The work is that of ``CrossValidator``.  The grid varies the last stage only, so the stages before it are fitted once a fold.  Rows are computed once, dealt
    evenly and kept before the candidates start: candidates that run side by side would wait for each other's parts of a table that is still being filled.
    The candidates of a fold score its rows in one pass; the areas of all are taken from one set of counts.
    """
    spark, f = df.sparkSession, F.col(fold)
    wrong = F.raise_error(F.format_string(f"Fold number must be in range [0, {k}), but got %s", f))
    rows = df.select(*dict.fromkeys([*features, label, fold])).withColumn(fold, F.when((f >= 0) & (f < k), f).otherwise(wrong))
    rows = rows.repartition(max(spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())).persist()
    *before, last = pipe.getStages()
    path = shared_folder(spark, "scores")
    try:
        total, *sizes = rows.agg(F.count(F.lit(1)), *[F.count_if(f == i) for i in range(k)]).first()
        for i, size in enumerate(sizes):
            if size in (0, total):
                raise ValueError(f"The {'training' if size else 'validation'} data at fold {i} is empty.")
        with ThreadPool(min(PARALLEL_FITS, len(grid))) as pool:
            for i in range(k):
                scaled = Pipeline(stages=before).fit(rows.where(f != i)).transform(rows).select(f.alias("__fold"), F.col(label), last.getFeaturesCol()).persist()
                try:
                    scaled.count()
                    fits = last.fitMultiple(scaled.where(F.col("__fold") != i), grid)

                    def fit(_: int) -> tuple:
                        j, model = next(fits)  # noqa: B023
                        if model.numClasses != 2:
                            raise ValueError(f"two classes are needed, {model.numClasses} found")
                        return j, model.setRawPredictionCol(f"__raw_{j}").setProbabilityCol("").setPredictionCol("")

                    held = scaled.where(F.col("__fold") == i)
                    for _, model in pool.map(inheritable_thread_target(spark)(fit), range(len(grid)), 1):
                        held = model.transform(held)
                    raw = F.array(*[vector_to_array(f"__raw_{j}")[1] for j in range(len(grid))])
                    held.select((F.col(label) > 0.5).cast("int").alias("y"), raw.alias("scores")).write.parquet(f"{path}/fold={i}")
                finally:
                    scaled.unpersist()
        scores = spark.read.schema("y int, scores array<double>, fold int").parquet(path)
        areas = [[0.5] * len(grid) for _ in range(k)]
        for r in _binned_areas(scores):
            areas[r["fold"]][r["candidate"]] = r["area"]
        means = [float(m) for m in np.mean(areas, axis=0)]
        best = max(range(len(grid)), key=lambda i: (means[i], -i))
        model = pipe.fit(rows, grid[best])
    finally:
        rows.unpersist()
        remove_folder(spark, path)
    table = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda e: e[0].name)), m, i == best) for i, (g, m) in enumerate(zip(grid, means))]
    return model, spark.createDataFrame(table, "candidate int, params string, score double, best boolean")


def grid_search(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, reg: Sequence[float], mix: Sequence[float]) -> DataFrame:
    pipe = logistic(features, label, maxIter=20)
    lr = pipe.getStages()[-1]
    return _search(df, features, label, fold, k, ParamGridBuilder().addGrid(lr.regParam, list(reg)).addGrid(lr.elasticNetParam, list(mix)).build(), pipe)[1]


def random_search(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, draws: int = 4, seed: int = 1) -> DataFrame:
    """Log-uniform regularisation and uniform mixing, drawn ``draws`` times."""
    pipe = logistic(features, label, maxIter=20)
    lr, rng = pipe.getStages()[-1], random.Random(seed)
    grid = [{lr.regParam: 10 ** rng.uniform(-4, 0), lr.elasticNetParam: rng.random()} for _ in range(draws)]
    return _search(df, features, label, fold, k, grid, pipe)[1]


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, row_id: str) -> DataFrame:
    """Loss of ROC area when one feature is taken from another row.

    One hash permutation gives every row a partner; all features are tried against the same partner table.
    """
    base = df.select(row_id, label, *features)
    a = rank_rows(base.withColumn("__h", h32(F.lit("own"), row_id)), "__h", row_id, name="__pos").drop("__h")
    b = rank_rows(base.withColumn("__h", h32(F.lit("other"), row_id)), "__h", row_id, name="__pos").select("__pos", *[F.col(f).alias(f"__o_{f}") for f in features])
    pairs = a.join(b, "__pos")
    variants = [F.struct(F.lit(name).alias("__variant"), *[F.col(f"__o_{g}" if g == name else g).alias(g) for g in features]) for name in ("(none)", *features)]
    tried = model.transform(pairs.select(label, F.inline(F.array(*variants))))
    # partners are met and rows scored once: the curves read the scores several times
    scores, _ = written(probability(tried).select(F.col("__variant").alias("feature"), F.col(label).alias("y"), "score"), "scores")
    auc = curve_areas(scores, ["feature"]).select("feature", "roc_auc")
    whole = F.max(F.when(F.col("feature") == "(none)", F.col("roc_auc"))).over(Window.partitionBy(F.lit(0)))  # one row per feature
    return auc.withColumn("__whole", whole).where("feature <> '(none)'").select("feature", rnd(F.col("__whole") - F.col("roc_auc")).alias("importance"))


def batch_predict(path: str, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Score a table with a saved pipeline."""
    return probability(PipelineModel.load(path).transform(df)).withColumn("yhat", (F.col("score") >= threshold).cast("int"))
