"""What is wrong with this table?  Detectors over one table, each one or two aggregate passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.core import (
    NUMERIC, agg_per_column, as_number, bin_index, h32, ratio, rnd, sample_skew, unpivot_numbers,
)
from plumbline.operators.ordering import bracket_accuracy, bracket_aggregates, exact_quantiles
from plumbline.session import written

# Limits of the findings report.
LEAKAGE_LIMIT = 0.95
LEAKAGE_CERTAIN = 0.99
REDUNDANT_LIMIT = 0.95
NEAR_CONSTANT_LIMIT = 0.98
CARDINALITY_LIMIT = 50
SKEW_LIMIT = 1.0
OUTLIER_LIMIT = 0.01
MAX_CLASSES = 20
QUARTILES = (0.25, 0.5, 0.75)

FINDING_SCHEMA = "issue string, feature string, metric string, value double"


@dataclass(frozen=True)
class Roles:
    numeric: list[str]
    categorical: list[str]
    target: str | None

    @property
    def features(self) -> list[str]:
        return [c for c in self.numeric if c != self.target]


def roles(df: DataFrame, target: str | None = None) -> Roles:
    """Numeric (booleans included) and string columns by type; dates are neither."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]
    categorical = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return Roles(numeric, categorical, target)


def profile_shape(df: DataFrame) -> DataFrame:
    r = roles(df)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"),
        F.lit(len(r.numeric)).alias("n_numeric"), F.lit(len(r.categorical)).alias("n_categorical"))


def _missing(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def profile_missing(df: DataFrame) -> DataFrame:
    """Per column: missing cells and share.  ``total_missing`` sums them."""
    out = agg_per_column(df, {
        c: {"n_missing": F.count_if(_missing(df, c)), "n_rows": F.count(F.lit(1))} for c in df.columns})
    return out.select("column", "n_missing", rnd(ratio(F.col("n_missing"), F.col("n_rows"))).alias("missing_share"))


def total_missing(df: DataFrame) -> DataFrame:
    """Missing cells over the whole table and their share of all cells."""
    cells = None
    for c in df.columns:
        e = _missing(df, c).cast("int")
        cells = e if cells is None else cells + e
    n_cells = F.count(F.lit(1)) * F.lit(len(df.columns))
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("missing_cells"), n_cells.alias("n_cells")).select(
        "missing_cells", "n_cells", rnd(ratio(F.col("missing_cells"), F.col("n_cells"))).alias("missing_share"))


def infer_target_type(df: DataFrame, target: str) -> DataFrame:
    """binary / multiclass / regression / categorical, by type first and distinct count second."""
    dtype = df.schema[target].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        kind = F.lit("regression")
    elif isinstance(dtype, NUMERIC):
        kind = (F.when(F.col("n_unique") == 2, "binary")
                .when(F.col("n_unique") <= MAX_CLASSES, "multiclass").otherwise("regression"))
    else:
        kind = F.lit("categorical")
    return df.agg(F.count_distinct(F.col(target)).alias("n_unique")).select(
        F.lit(target).alias("target"), "n_unique", kind.alias("target_type"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    total = df.where(F.col(target).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return (df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("share", rnd(ratio(F.col("n"), total))))


def profile_skew(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = columns if columns is not None else roles(df).numeric
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, skew double, flagged boolean")
    out = unpivot_numbers(df, columns).groupBy("column").agg(sample_skew(F.col("x")).alias("skew"))
    return out.select("column", rnd(F.col("skew"), 4).alias("skew"),
                      F.coalesce(F.abs("skew") > SKEW_LIMIT, F.lit(False)).alias("flagged"))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column (two numbers per column on the driver)."""
    row = df.agg(*[f(as_number(df, c).cast("double")).alias(f"{k}{i}")
                   for i, c in enumerate(columns) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns) if row[f"lo{i}"] is not None}


def _binned(df: DataFrame, ranges: dict[str, tuple[float, float]], bins: int, keep: Sequence[str] = ()) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), bin_index(as_number(df, c), lo, hi, bins).alias("bin"))
             for c, (lo, hi) in ranges.items()]
    return df.select(*keep, F.inline(F.array(*cells))).where(F.col("bin").isNotNull())


def _bin_frame(df: DataFrame, ranges: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """All bins of all columns with their left edge and width."""
    rows = []
    for c, (lo, hi) in ranges.items():
        low, width = (lo - 0.5, 1.0) if lo == hi else (lo, hi - lo)
        rows += [(c, b, low + width * b / bins, width / bins) for b in range(bins)]
    return df.sparkSession.createDataFrame(rows, "column string, bin int, left double, width double")


def profile_histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 40) -> DataFrame:
    """Equal-width bins per column; empty bins are kept."""
    ranges = column_ranges(df, columns or roles(df).numeric)
    counts = _binned(df, ranges, bins).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    return (_bin_frame(df, ranges, bins).join(counts, ["column", "bin"], "left")
            .select("column", "bin", rnd(F.col("left")).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n")))


def class_histograms(df: DataFrame, target: str, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Density per class and feature over common bins: count / (class rows x bin width)."""
    ranges = column_ranges(df, columns)
    binned = _binned(df, ranges, bins, keep=[F.col(target).alias("class")])
    counts = binned.groupBy("class", "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    per_class = counts.groupBy(F.col("class"), F.col("column")).agg(F.sum("n").alias("n_class"))
    edges = _bin_frame(df, ranges, bins)
    return (counts.join(per_class, ["class", "column"]).join(edges, ["column", "bin"])
            .select("class", "column", "bin", "n",
                    rnd(F.col("n") / (F.col("n_class") * F.col("width"))).alias("density")))


def profile_cardinality(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
                        limit: int = CARDINALITY_LIMIT) -> DataFrame:
    columns = columns or roles(df).categorical
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, n_unique bigint, n_rows bigint, flagged boolean")
    distinct = (lambda c: F.count_distinct(F.col(c))) if exact else (lambda c: F.approx_count_distinct(c))
    out = agg_per_column(df, {c: {"n_unique": distinct(c), "n_rows": F.count(F.lit(1))} for c in columns})
    return out.withColumn("flagged", F.col("n_unique") > limit)


def _plain_columns(df: DataFrame) -> list[Column]:
    """The columns that can be near constant, as values that compare and travel to the driver; NaN is missing."""
    usable = [f for f in df.schema if isinstance(f.dataType, (*NUMERIC, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))]

    def plain(f: T.StructField) -> Column:
        x = as_number(df, f.name) if isinstance(f.dataType, NUMERIC) else F.col(f.name)
        x = x.cast("string") if isinstance(f.dataType, (T.TimestampNTZType, T.DecimalType)) else x
        return x.alias(f.name)

    return [plain(f) for f in usable]


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*_plain_columns(df))


def _top_values(columns: Sequence[str]) -> list[Column]:
    """A frequent-items sketch of each column."""
    return [F.expr(f"approx_top_k(`{c}`, 2, 1000)").alias(f"t{i}") for i, c in enumerate(columns)]


def _candidates(top: Row, columns: Sequence[str]) -> dict[str, object]:
    """The most frequent non-null item of each column by its sketch."""
    out = {}
    for i, c in enumerate(columns):
        items = [x for x in (top[f"t{i}"] or []) if x["item"] is not None]
        if items:
            out[c] = items[0]["item"]
    return out


def find_near_constant(df: DataFrame, limit: float = NEAR_CONSTANT_LIMIT) -> DataFrame:
    """Columns whose most frequent value covers more than ``limit`` (at least one half) of the non-null rows.

    A value that frequent among the non-null rows is one of the two top entries of a frequent-items sketch, which counts NULL as
    an item too.  So the sketch only proposes one candidate per column and a second pass counts it exactly; values are never shuffled.
    """
    if limit < 0.5:
        raise ValueError("a candidate is only certain for shares of at least one half")
    named = _plain(df)
    candidates = _candidates(named.agg(*_top_values(named.columns)).first(), named.columns)
    if not candidates:
        return df.sparkSession.createDataFrame([], "feature string, top_value_freq double")
    out = agg_per_column(named, {
        c: {"n_top": F.count_if(F.col(c) == F.lit(v)), "n_valid": F.count(F.col(c))} for c, v in candidates.items()},
        key="feature")
    share = ratio(F.col("n_top"), F.col("n_valid"))
    return out.where(share > limit).select("feature", rnd(share, 4).alias("top_value_freq"))


def dup_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; NULL equals NULL."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def _pair_corrs(df: DataFrame, pairs: Sequence[tuple[str, str]], middle: dict[str, float | None] | None = None) -> DataFrame:
    """(a, b, pearson) for each pair over pairwise-complete rows; NULL when a side is constant.

    Hundreds of pair aggregates in one ``agg`` overflow the generated code, and unpivoting pairs multiplies
    the rows, so every Arrow batch adds to six moment matrices by matrix products and each task emits one
    small row per pair.  Values are shifted by an actual value near the median, which keeps the sums
    precise and makes a constant column exactly zero; ``middle`` passes such values where the caller has them.
    """
    cols = sorted({c for pair in pairs for c in pair})
    numbers = df.select(*[as_number(df, c).cast("double").alias(c) for c in cols])
    mid = middle or numbers.agg(*[F.percentile_approx(c, 0.5, 100).alias(c) for c in cols]).first()
    shift = np.array([mid[c] if mid[c] is not None else 0.0 for c in cols])
    pos = {c: i for i, c in enumerate(cols)}
    left = np.array([pos[a] for a, _ in pairs])
    right = np.array([pos[b] for _, b in pairs])

    def moments(batches):
        k = len(cols)
        total = np.zeros((6, k, k))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(float) - shift
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0), m.astype(float)
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
        picked = total[:, left, right]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(left), dtype=np.int32)), *[pa.array(picked[i]) for i in range(6)]],
            names=["p", "n", "sa", "sb", "saa", "sbb", "sab"])

    parts = numbers.mapInArrow(moments, "p int, n double, sa double, sb double, saa double, sbb double, sab double")
    s = parts.groupBy("p").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    var_a = F.col("n") * F.col("saa") - F.col("sa") * F.col("sa")
    var_b = F.col("n") * F.col("sbb") - F.col("sb") * F.col("sb")
    cov = F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")
    spread = F.sqrt(F.when(var_a > 0, var_a)) * F.sqrt(F.when(var_b > 0, var_b))
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    pair = F.element_at(names, F.col("p") + 1)
    return s.select(pair["a"].alias("a"), pair["b"].alias("b"), F.try_divide(cov, spread).alias("pearson"))


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson matrix in long form, one row per unordered pair (diagonal left out)."""
    columns = list(columns or roles(df).numeric)
    return _pair_corrs(df, list(combinations(columns, 2))).select(
        F.col("a").alias("col_a"), F.col("b").alias("col_b"), rnd(F.col("pearson")).alias("pearson"))


def target_corr(df: DataFrame, target: str) -> DataFrame:
    return _pair_corrs(df, [(c, target) for c in roles(df, target).features]).select(
        F.col("a").alias("feature"), "pearson")


def find_leakage(df: DataFrame, target: str, limit: float = LEAKAGE_LIMIT) -> DataFrame:
    """Features whose signed Pearson to the target exceeds ``limit`` in size; above 0.99 leakage is certain."""
    if target not in roles(df).numeric:
        return df.sparkSession.createDataFrame([], "feature string, pearson double, certain boolean")
    hit = F.abs("pearson")
    if not roles(df, target).features:
        return df.sparkSession.createDataFrame([], "feature string, pearson double, certain boolean")
    return target_corr(df, target).where(hit > limit).select(
        "feature", rnd(F.col("pearson"), 4).alias("pearson"), (hit > LEAKAGE_CERTAIN).alias("certain"))


def find_redundant_pairs(df: DataFrame, target: str | None = None, limit: float = REDUNDANT_LIMIT) -> DataFrame:
    """Pairs of features whose absolute Pearson exceeds ``limit``."""
    pairs = list(combinations(roles(df, target).features, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, pearson double")
    return _pair_corrs(df, pairs).where(F.abs("pearson") > limit).select(
        F.col("a").alias("col_a"), F.col("b").alias("col_b"), rnd(F.abs("pearson"), 4).alias("pearson"))


def iqr_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float, float, float]]:
    """q1, median, q3 and the two 1.5 IQR fences per column (five numbers per column on the driver)."""
    clean = df.select(*[as_number(df, c).cast("double").alias(c) for c in columns])
    return _fences(exact_quantiles(clean, columns, QUARTILES), columns)


def _fences(got: dict[tuple, list[float | None]], columns: Sequence[str]) -> dict[str, tuple[float, float, float, float, float]]:
    out = {}
    for c in columns:
        q1, q2, q3 = got.get((c,), [None] * 3)
        if q1 is not None:
            out[c] = (q1, q2, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    return out


def find_outliers_iqr(df: DataFrame, columns: Sequence[str] | None = None, limit: float = OUTLIER_LIMIT) -> DataFrame:
    """Rows outside the IQR fences per column; the share is over non-null rows."""
    columns = columns if columns is not None else roles(df).numeric
    bounds = iqr_bounds(df, columns) if columns else {}
    if not bounds:
        return df.sparkSession.createDataFrame([], "feature string, n_outliers bigint, outlier_pct double, flagged boolean")
    out = agg_per_column(df, {
        c: {"n_outliers": F.count_if((as_number(df, c) < lo) | (as_number(df, c) > hi)), "n_valid": F.count(as_number(df, c))}
        for c, (_, _, _, lo, hi) in bounds.items()}, key="feature")
    share = ratio(F.col("n_outliers"), F.col("n_valid"))
    return out.select("feature", "n_outliers", rnd(share, 4).alias("outlier_pct"), (share > limit).alias("flagged"))


def box_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, whiskers (furthest rows inside the fences) and outlier count per column."""
    bounds = iqr_bounds(df, columns or roles(df).numeric)
    exprs = {}
    for c, (q1, q2, q3, lo, hi) in bounds.items():
        x = as_number(df, c).cast("double")
        inside = F.when((x >= lo) & (x <= hi), x)
        exprs[c] = {"q1": F.max(F.lit(q1)), "median": F.max(F.lit(q2)), "q3": F.max(F.lit(q3)),
                    "whisker_lo": F.min(inside), "whisker_hi": F.max(inside),
                    "n_outliers": F.count_if((x < lo) | (x > hi))}
    out = agg_per_column(df, exprs)
    return out.select("column", *[rnd(F.col(k)).alias(k) for k in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                      "n_outliers")


def find_scale_mismatch(df: DataFrame, columns: Sequence[str] | None = None, orders: float = 2.0) -> DataFrame:
    """Spread of each feature against the median spread; flagged when ``orders`` powers of ten apart."""
    columns = columns or roles(df).numeric
    spread = unpivot_numbers(df, columns).groupBy("column").agg(F.stddev_samp("x").alias("spread"))
    mid = spread.agg(F.percentile("spread", 0.5)).scalar()  # one value per column: bounded by the schema
    r = F.try_divide(F.col("spread"), mid)
    return spread.select("column", rnd(F.col("spread"), 4).alias("spread"), rnd(r, 4).alias("ratio_to_median"),
                         F.coalesce(F.abs(F.log10(F.when(r > 0, r))) >= orders, F.lit(True)).alias("flagged"))


def _bin_counts(filled: DataFrame, target: str, feats: Sequence[str], edges: dict[tuple, list[float]]) -> DataFrame:
    """(feature, bin, y, n): rows of each class by the number of edges below the feature's value; each Arrow batch counts its own."""
    cuts = [np.array(edges[(c,)], dtype=float) for c in feats]

    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            named = batch.column(target).dictionary_encode()
            code, size = named.indices.to_numpy().astype(np.int64), len(named.dictionary)
            for name, cut in zip(feats, cuts):
                n = np.bincount(np.searchsorted(cut, batch.column(name).to_numpy()) * size + code)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some)), pa.array(some // size, pa.int32()), named.dictionary.take(pa.array(some % size)), pa.array(n[some])], ["feature", "bin", "y", "n"])

    kind = T.StructType([T.StructField("feature", T.StringType()), T.StructField("bin", T.IntegerType()), T.StructField("y", filled.schema[target].dataType), T.StructField("n", T.LongType())])
    return filled.mapInArrow(count, kind).groupBy("feature", "bin", "y").agg(F.sum("n").alias("n"))


def mutual_information(df: DataFrame, target: str, bins: int = 10) -> DataFrame:
    """MI (nats) of each numeric feature, cut at its quantiles, with a discrete target.

    Missing values take the median; a feature without any value and rows without a target take no part.  A contingency table replaces the nearest-neighbour estimator of the
    single-machine form, so the numbers differ; the ranking serves the same use.
    """
    feats = roles(df, target).features
    clean = df.where(F.col(target).isNotNull()).select(F.col(target).alias("__y"), *[as_number(df, c).cast("double").alias(c) for c in feats])
    levels = [i / bins for i in range(1, bins)]
    n, *held = clean.agg(F.count(F.lit(1)), *[F.count(c) for c in feats]).first()
    held = dict(zip(feats, held))
    feats = [c for c in feats if held[c]]
    if not feats:
        return df.sparkSession.createDataFrame([], "feature string, mi double")
    holes = [c for c in feats if held[c] < n]  # only these need their median, and edges of their filled values
    medians = exact_quantiles(clean, holes, [0.5]) if holes else {}
    filled = clean.select("__y", *[F.coalesce(F.col(c), F.lit(medians[(c,)][0])).alias(c) if c in holes else F.col(c) for c in feats])
    edges = exact_quantiles(filled, feats, levels)
    cont, _ = written(_bin_counts(filled, "__y", feats, edges), "counts")  # read four times
    # the contingency table has features x bins x classes rows
    tot = cont.groupBy("feature").agg(F.sum("n").alias("t"))
    fb = cont.groupBy("feature", "bin").agg(F.sum("n").alias("nb"))
    fy = cont.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    joined = cont.join(fb, ["feature", "bin"]).join(fy, ["feature", "y"]).join(tot, "feature")
    term = F.col("n") / F.col("t") * F.ln(F.col("n") * F.col("t") / (F.col("nb").cast("double") * F.col("ny")))
    return joined.groupBy("feature").agg(rnd(F.greatest(F.sum(term), F.lit(0.0))).alias("mi"))


def mi_vs_pearson_gap(df: DataFrame, target: str, top: int = 5) -> DataFrame:
    """The features with the highest MI; ``gap`` marks a strong non-linear signal Pearson misses."""
    mi = mutual_information(df, target)
    p = target_corr(df, target).select("feature", F.coalesce(F.abs("pearson"), F.lit(0.0)).alias("p"))
    return (mi.join(p, "feature").orderBy(F.col("mi").desc(), "feature").limit(top)
            .select("feature", "mi", rnd(F.col("p")).alias("abs_pearson"),
                    ((F.col("mi") > 0.05) & (F.col("p") < 0.1)).alias("gap")))


def eda_findings(df: DataFrame, target: str) -> DataFrame:
    """All detectors as one table ``(issue, feature, metric, value)``.

    The detectors share their passes: one aggregate holds missing cells and skew, one frequent items and quartile brackets; one Arrow pass the moments
    of all pairs; one the values inside the brackets; one aggregate the counts of candidates and outliers; one the distinct strings.  Only
    a few numbers per column reach the driver.
    """
    spark, columns = df.sparkSession, df.columns
    numeric, feats = roles(df, target).numeric, roles(df, target).features
    plain = _plain(df)
    # one row with every form of a cell that a detector needs: is it missing, its number, its plain value
    number = {c: f"x{i}" for i, c in enumerate(numeric)}
    value = {c: f"v{i}" for i, c in enumerate(plain.columns)}
    cells = df.select(
        *[_missing(df, c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[as_number(df, c).cast("double").alias(x) for c, x in number.items()],
        *[e.alias(v) for e, v in zip(_plain_columns(df), value.values())])
    own = [number[c] for c in feats]
    # one row for each cell, so that holes and skew of all columns share a pass and their code stays small; in one aggregate by column it is too large to be compiled
    cell = [F.struct(F.lit(i).alias("i"), F.col(f"m{i}").alias("m"), (F.col(number[c]) if c in feats else F.lit(None).cast("double")).alias("x")) for i, c in enumerate(columns)]
    shape = {r["i"]: r for r in cells.select(F.inline(F.array(*cell))).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.count_if("m").alias("m"), sample_skew(F.col("x")).alias("skew")).collect()}
    n = shape[0]["n"] if shape else 0
    sketched = own + [x for x in number.values() if x not in own]
    state = cells.agg(
        F.count(F.lit(1)).alias("n"), *_top_values(list(value.values())),
        *bracket_aggregates([F.col(x) for x in sketched], QUARTILES, bracket_accuracy(n))).first()

    rows = [("missing data", c, "missing_pct", shape[i]["m"] / n) for i, c in enumerate(columns) if n and shape[i]["m"]]
    skews = [(c, shape[columns.index(c)]["skew"]) for c in feats if n]
    rows += [("skewed distribution", c, "skew", s) for c, s in skews if s is not None]
    known = spark.createDataFrame(rows, FINDING_SCHEMA).withColumn("value", rnd(F.col("value"), 4)).where(
        (F.col("issue") != "skewed distribution") | (F.abs("value") > SKEW_LIMIT))

    candidates = _candidates(state, list(value.values()))
    quartiles = exact_quantiles(cells, own, QUARTILES, first=[state]) if own else {}
    fences = _fences(quartiles, own)
    counts = {}
    for v, top in candidates.items():
        counts["near constant", v] = {"k": F.count_if(F.col(v) == F.lit(top)), "n": F.count(v)}
    for x, (_, _, _, lo, hi) in fences.items():
        counts["outliers", x] = {"k": F.count_if((F.col(x) < lo) | (F.col(x) > hi)), "n": F.count(x)}
    parts = [known]
    if counts:
        back = {v: c for c, v in (*number.items(), *value.items())}
        long = agg_per_column(cells, {f"{issue}|{x}": e for (issue, x), e in counts.items()}, key="at")
        names = spark.createDataFrame(
            [(f"{issue}|{x}", issue, back[x], *{"near constant": ("top_value_freq", NEAR_CONSTANT_LIMIT), "outliers": ("outlier_pct", OUTLIER_LIMIT)}[issue])
             for issue, x in counts], "at string, issue string, feature string, metric string, most double")
        share = ratio(F.col("k"), F.col("n"))
        parts.append(long.join(F.broadcast(names), "at").where(share > F.col("most")).select("issue", "feature", "metric", rnd(share, 4).alias("value")))

    pairs = [(c, target) for c in feats if target in numeric] + list(combinations(feats, 2))
    if pairs:
        leak, size = F.col("b") == target, F.abs("pearson")
        near = {x: state[f"s__{i}"] for i, x in enumerate(sketched)}
        corr = _pair_corrs(df, pairs, {c: near[x][len(near[x]) // 2] if near[x] else None for c, x in number.items()})
        corr = corr.where(size > F.when(leak, LEAKAGE_LIMIT).otherwise(REDUNDANT_LIMIT))
        parts.append(corr.select(
            F.when(leak, "target leakage").otherwise("redundant pair").alias("issue"),
            F.when(leak, F.col("a")).otherwise(F.concat_ws(" <-> ", "a", "b")).alias("feature"),
            F.lit("pearson").alias("metric"), rnd(F.when(leak, F.col("pearson")).otherwise(size), 4).alias("value")))
    parts.append(profile_cardinality(df).where("flagged").select(
        F.lit("high cardinality").alias("issue"), F.col("column").alias("feature"), F.lit("n_unique").alias("metric"), F.col("n_unique").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def findings_diff(old: DataFrame, new: DataFrame, digits: int = 4) -> DataFrame:
    """Compare two reports: new, gone, changed or same per (issue, feature)."""
    a = old.select("issue", "feature", F.col("value").alias("old_value"), F.lit(True).alias("__a"))
    b = new.select("issue", "feature", F.col("value").alias("new_value"), F.lit(True).alias("__b"))
    change = (F.when(F.col("__a").isNull(), "new").when(F.col("__b").isNull(), "gone")
              .when(F.round("old_value", digits).eqNullSafe(F.round("new_value", digits)), "same").otherwise("changed"))
    return a.join(b, ["issue", "feature"], "full_outer").select("issue", "feature", "old_value", "new_value", change.alias("change"))


# What to do about each kind of finding.
ACTIONS = [
    ("target leakage", "drop"),
    ("high cardinality", "encode"),
    ("near constant", "drop"),
    ("redundant pair", "drop one"),
    ("missing data", "impute"),
    ("skewed distribution", "log transform"),
    ("outliers", "robust scale or winsorize"),
]


def suggest_actions(findings: DataFrame) -> DataFrame:
    table = findings.sparkSession.createDataFrame(ACTIONS, "issue string, action string")
    return findings.join(F.broadcast(table), "issue", "left").select("issue", "feature", "action")  # seven rows


def dataset_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-free fingerprint: row count, sum and bit-xor of 32-bit row hashes.

    NULL cells hash as a marker of their own, so NULL and the empty string differ.
    """
    columns = list(columns or df.columns)
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]
    h = h32(*cells)
    return df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("h"), F.lit(0)).alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")).alias("hash_xor"))


def feature_target_grid(df: DataFrame, feature: str, target: str, bins: int = 20) -> DataFrame:
    """Feature against target as a bins x bins count grid with the mean target per cell."""
    ranges = column_ranges(df, [feature, target])
    x, y = as_number(df, feature), as_number(df, target)
    return (df.where(x.isNotNull() & y.isNotNull())
            .groupBy(bin_index(x, *ranges[feature], bins).alias("x_bin"), bin_index(y, *ranges[target], bins).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(y.cast("double")), 4).alias("mean_target")))


def project_pca2(df: DataFrame, columns: Sequence[str], id_col: str, k: int = 2) -> DataFrame:
    """Standardise, keep ``k`` principal components: ``(id, pc1, .., explained)``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="__x", handleInvalid="skip"),
        StandardScaler(inputCol="__x", outputCol="__z", withMean=True, withStd=True),
        PCA(k=k, inputCol="__z", outputCol="__p"),
    ]
    model = Pipeline(stages=stages).fit(df)
    share = float(sum(model.stages[-1].explainedVariance.toArray()[:k]))
    arr = vector_to_array("__p")
    return model.transform(df).select(
        id_col, *[rnd(arr[i]).alias(f"pc{i + 1}") for i in range(k)], rnd(F.lit(share)).alias("explained"))
