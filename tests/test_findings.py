"""The fused report against its detectors one by one."""

from collections.abc import Iterator

import pyarrow as pa
import pytest

from plumbline.operators import profile
from plumbline.plans.fixtures import profiled

SMALL = "/root/testdata/sf0.001"


def one_by_one(df, target):
    """Findings from the separate detectors."""
    feats = profile.roles(df, target).features
    out = {("target leakage", r["feature"]): r["pearson"] for r in profile.find_leakage(df, target).collect()}
    out |= {("high cardinality", r["column"]): r["n_unique"] for r in profile.profile_cardinality(df).where("flagged").collect()}
    out |= {("near constant", r["feature"]): r["top_value_freq"] for r in profile.find_near_constant(df).collect()}
    out |= {("redundant pair", f"{r['col_a']} <-> {r['col_b']}"): r["pearson"] for r in profile.find_redundant_pairs(df, target).collect()}
    out |= {("missing data", r["column"]): r["missing_share"] for r in profile.profile_missing(df).where("n_missing > 0").collect()}
    out |= {("skewed distribution", r["column"]): r["skew"] for r in profile.profile_skew(df, feats).where("flagged").collect()}
    out |= {("outliers", r["feature"]): r["outlier_pct"] for r in profile.find_outliers_iqr(df, feats).where("flagged").collect()}
    return out


def fused(df, target):
    return {(r["issue"], r["feature"]): r["value"] for r in profile.eda_findings(df, target).collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1.01e-4), k


def test_report_equals_its_detectors(spark):
    df = profiled(spark, SMALL)
    got = fused(df, "is_returned")
    assert len({k[0] for k in got}) >= 6
    same(got, one_by_one(df, "is_returned"))


def test_report_on_odd_tables(spark):
    data = [(i, None if i % 4 else float("nan"), 7, "a" if i else None, i % 2 == 0, float(i == 3) * 1e6, f"s{i}", None) for i in range(120)]
    df = spark.createDataFrame(data, "`a b` long, nan double, const int, mostly string, flag boolean, spike double, x0 string, empty string")
    for target in ("flag", "mostly", "const"):
        same(fused(df, target), one_by_one(df, target))
    assert fused(df.limit(0), "flag") == {}
    words = df.select("mostly", "x0")
    same(fused(words, "mostly"), one_by_one(words, "mostly"))


def test_report_reads_the_table_few_times(spark):
    df = profiled(spark, SMALL)
    seen = spark.sparkContext.accumulator(0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = df.count()
    kinds = df.drop("l_shipdate")
    profile.eda_findings(kinds.mapInArrow(count, kinds.schema), "is_returned").collect()
    assert seen.value <= 6 * rows  # five passes and a count, which reads no column of a Parquet table
