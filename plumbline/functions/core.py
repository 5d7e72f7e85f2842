"""Column helpers shared by all operators: hashing, rounding, safe ratios, moments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType,
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def h32(*cols: str | Column, part: int = 0) -> Column:
    """Unsigned 32-bit hash: the ``part``-th (0..3) eight hex digits of the md5 of the parts joined by ``|``."""
    digest = F.md5(F.concat_ws("|", *[col(c).cast("string") for c in cols]).cast("binary"))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("long")


def unit(*cols: str | Column, part: int = 0) -> Column:
    """Deterministic uniform number in [0, 1)."""
    return h32(*cols, part=part) / F.lit(4294967296.0)


PRIME = 2147483647


def mix_factors(k: int) -> tuple[int, int]:
    """Multipliers of the k-th member of a family of hash functions modulo PRIME."""
    return pow(48271, k + 1, PRIME), pow(16807, k + 1, PRIME)


def mixed(h0: Column, h1: Column, k: int) -> Column:
    """The k-th independent number in [0, PRIME) from two hashes below PRIME: many numbers from one digest."""
    a, b = mix_factors(k)
    return F.pmod(h0 * F.lit(a) + h1 * F.lit(b), F.lit(PRIME))


def hash_bucket(k: int, *cols: str | Column) -> Column:
    return F.pmod(h32(*cols), F.lit(k)).cast("int")


def rnd(c: Column, digits: int = 6) -> Column:
    """Round, and turn -0.0 into 0.0 so equal numbers compare equal."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def ratio(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """a / b with a chosen value (0 by default) where b is zero or missing."""
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def f1_of(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a number usable in moments: booleans become 0/1, NaN becomes NULL."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN means missing in the inputs; store it as NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson over pairwise-complete rows; NULL when either side is constant."""
    a, b = a.cast("double"), b.cast("double")
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def sample_skew(c: Column) -> Column:
    """Bias-corrected skewness (G1); NULL below three values."""
    c = c.cast("double")
    n = F.count(c).cast("double")
    g1 = F.when(F.stddev_pop(c) > 0, F.skewness(c)).otherwise(F.lit(0.0))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def bin_index(x: Column, lo: Column | float, hi: Column | float, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the last edge is inclusive; a zero-width range is widened by 0.5 each side."""
    lo, hi = (v if isinstance(v, Column) else F.lit(float(v)) for v in (lo, hi))
    flat = lo == hi
    low = F.when(flat, lo - 0.5).otherwise(lo)
    width = F.when(flat, F.lit(1.0)).otherwise(hi - lo)
    raw = F.floor((x.cast("double") - low) / width * bins).cast("int")
    return F.when(x.isNotNull(), F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))


def long_from_one_row(row: DataFrame, labels: Iterable[str], fields: list[str], key: str = "column") -> DataFrame:
    """Turn one aggregate row holding ``{field}__{i}`` into one row per label."""
    structs = [
        F.struct(F.lit(label).alias(key), *[F.col(f"{f}__{i}").alias(f) for f in fields])
        for i, label in enumerate(labels)
    ]
    return row.select(F.inline(F.array(*structs)))


def agg_per_column(df: DataFrame, exprs: dict[str, dict[str, Column]], key: str = "column", block: int = 48) -> DataFrame:
    """One aggregate pass over many columns, returned one row per column.

    ``exprs`` maps a label to its named aggregates.  Wide tables are cut into blocks so
    that the generated code of one aggregate stays small.
    """
    labels = list(exprs)
    out = None
    for start in range(0, len(labels), block):
        part = labels[start:start + block]
        fields = list(exprs[part[0]])
        row = df.agg(*[exprs[label][f].alias(f"{f}__{i}") for i, label in enumerate(part) for f in fields])
        piece = long_from_one_row(row, part, fields, key)
        out = piece if out is None else out.unionByName(piece)
    if out is None:
        raise ValueError("no columns to aggregate")
    return out


def unpivot_numbers(df: DataFrame, columns: Iterable[str], keep: Iterable[str] = (), key: str = "column", value: str = "x") -> DataFrame:
    """Non-missing numbers of many columns as rows ``(*keep, key, value)``, from one scan."""
    cells = [F.struct(F.lit(c).alias(key), as_number(df, c).cast("double").alias(value)) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells))).where(F.col(value).isNotNull())
