"""Plant known problems in a clean table, so that detectors can be tested for recovery.

Everything is driven by the md5 of a row key: no shuffle, no seed, same result on every engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.core import PRIME, h32, mixed, unit


# Which member of the hash family feeds which planted column.
ISSUE_HASHES = ("leak_a", "leak_b", "user", "rare", "miss", "skew_a", "skew_b", "spike", "level", "lat_a", "lat_b",
                "copy_a", "copy_b", "area")


def inject_issues(df: DataFrame, key: Sequence[str], target: str, feature: str, n_ids: int = 666) -> DataFrame:
    """Add one column per known issue: leakage, id-like category, near-constant, missing, skewed, outlier, redundant.

    ``target`` is 0/1, ``feature`` a numeric column that the missing and the redundant column copy.
    One digest per row feeds all columns.
    """
    base = df.withColumn("__d", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]).cast("binary")))
    base = base.withColumns({f"__h{i}": F.pmod(F.conv(F.substring("__d", 1 + 8 * i, 8), 16, 10).cast("long"), F.lit(PRIME))
                             for i in (0, 1)})

    def number(tag: str) -> Column:
        return mixed(F.col("__h0"), F.col("__h1"), ISSUE_HASHES.index(tag))

    def u(tag: str) -> Column:
        return number(tag) / F.lit(float(PRIME))

    def normal(tag: str) -> Column:
        """Standard normal number (Box-Muller)."""
        u1 = (number(f"{tag}_a") + F.lit(1.0)) / F.lit(float(PRIME))
        return F.sqrt(-2.0 * F.ln(u1)) * F.cos(F.lit(2 * math.pi) * u(f"{tag}_b"))

    # fixed values: the shares and scales below define the planted truth
    return base.withColumns({
        "leak_after_event": F.col(target) * 100.0 + normal("leak"),
        "session_user": F.concat(F.lit("user_"), F.pmod(number("user"), F.lit(n_ids)).cast("string")),
        "rare_flag": (u("rare") < 0.01).cast("int"),
        "feature_missing": F.when(u("miss") >= 0.30, F.col(feature)),
        "skewed_amount": F.exp(5.0 + 2.0 * normal("skew")),
        "latency_ms": F.when(u("spike") < 0.02, 1500.0 + 3500.0 * u("level")).otherwise(100.0 + 20.0 * normal("lat")),
        "feature_copy": F.col(feature) + 0.01 * normal("copy"),
        "area": F.element_at(F.array(*[F.lit(x) for x in ("north", "south", "east", "west")]),
                             (F.pmod(number("area"), F.lit(4)) + 1).cast("int")),
    }).drop("__d", "__h0", "__h1")


def planted_issues(spark, feature: str) -> DataFrame:
    """The truth sidecar of :func:`inject_issues`: which finding must appear for which column."""
    rows = [
        ("target leakage", "leak_after_event"),
        ("high cardinality", "session_user"),
        ("near constant", "rare_flag"),
        ("missing data", "feature_missing"),
        ("skewed distribution", "skewed_amount"),
        ("outliers", "latency_ms"),
        ("redundant pair", f"{feature} <-> feature_copy"),
    ]
    return spark.createDataFrame(rows, "issue string, feature string")


# The kinds of label corruption, in the order their hash ranges are laid out.
NOISE_KINDS = ("off_by_one", "random_flip", "systematic", "structural_null", "structural_dup", "structural_enum")


def inject_label_noise(
    df: DataFrame,
    row_id: str,
    text: str,
    label: str,
    labels: Sequence[str],
    swap: tuple[str, str],
    rates: dict[str, float],
    unknown: str = "MISC",
    copy_cells: int | None = None,
) -> DataFrame:
    """Corrupt labels and text on disjoint hash ranges of rows; the truth is kept.

    ``rates`` gives the share of rows per kind: next label in list order, another label by hash, two labels
    swapped, empty text, text copied from another row with a different label, a label outside the list.
    Returns ``(row_id, data, untrustworthy_label, label_true, corruption)``.
    """
    # as many source texts as the planted copies call for, 64 at least
    copy_cells = copy_cells or max(64, int(df.count() * rates.get("structural_dup", 0.0) / 16))
    n = len(labels)
    names = F.array(*[F.lit(x) for x in labels])
    u = unit(F.lit("noise"), row_id)

    def kind_at(v: Column) -> Column:
        kind, low = F.lit("clean"), 0.0
        for name in NOISE_KINDS:
            high = low + rates.get(name, 0.0)
            hit = (v >= low) & (v < high)
            if name == "systematic":
                hit = hit & F.col(label).isin(*swap)
            kind = F.when(hit, F.lit(name)).otherwise(kind)
            low = high
        return kind

    kind = F.get(F.transform(F.array(u), kind_at), 0)  # the hash is computed once and bound, not once for each comparison

    def shifted(start: Column, by: Column | int) -> Column:
        pos = F.array_position(names, start)  # counts from 1
        return F.element_at(names, (F.pmod(pos - 1 + by, F.lit(n)) + 1).cast("int"))

    flip_by = 1 + F.pmod(h32(F.lit("flip"), row_id), F.lit(n - 1))
    base = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("data"), F.col(label).alias("label_true"),
                     kind.alias("corruption"), flip_by.alias("__by"))
    c, truth = F.col("corruption"), F.col("label_true")
    base = base.select(
        "row_id", "label_true", "corruption",
        F.when(c == "structural_null", "").otherwise(F.col("data")).alias("data"),
        F.when(c == "off_by_one", shifted(truth, 1)).when(c == "random_flip", shifted(truth, F.col("__by")))
        .when(c == "systematic", F.when(truth == swap[0], swap[1]).otherwise(swap[0]))
        .when(c == "structural_enum", unknown).otherwise(truth).alias("noisy"),
        F.pmod(h32(F.lit("cell"), "row_id"), F.lit(copy_cells)).alias("cell"))
    # One source row per hash cell: an equi-join finds the copied text, no global sort is needed.
    source = (base.where((c == "clean") & (F.length("data") > 0)).groupBy("cell")
              .agg(F.min_by(F.struct("data", "noisy"), "row_id").alias("src")).withColumnRenamed("cell", "__cell"))
    # only the rows that copy are joined; all others keep what they have
    copying = c.eqNullSafe("structural_dup")
    found = F.col("src").isNotNull()
    copies = base.where(copying).join(source, F.col("cell") == F.col("__cell"), "left").select(
        "row_id", F.when(found, F.col("src.data")).otherwise(F.col("data")).alias("data"),
        F.when(found & (F.col("noisy") == F.col("src.noisy")), shifted(F.col("src.noisy"), 1)).otherwise(F.col("noisy")).alias("untrustworthy_label"),
        "label_true", "corruption")
    others = base.where(~copying).select("row_id", "data", F.col("noisy").alias("untrustworthy_label"), "label_true", "corruption")
    return others.unionByName(copies)
