"""Registered queries: shape of the registry, plans, and results against SQL at the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SAMPLE = ["eda_findings", "profile_missing", "join_left", "rank_in_group", "running_median", "threshold_sweep", "roc_auc", "roc_ovr", "ml_f1_averages",
          "interval_coverage", "find_label_issues", "audit_eval", "parse_json_prediction", "encode_target", "hdi_interval", "adjusted_rand", "dedupe_events_stream", "scan_tsv_lenient",
          "recalibrate_isotonic", "dbscan_8_columns", "kmeans_fit", "window_udf_long_frame", "log_run"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, con, name):
    problem, _ = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 180


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scans_read_only_what_they_need(spark):
    text = QUERIES["scan_parquet"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,10.0)" in text and "l_comment" not in text and "l_extendedprice" not in text


@pytest.mark.parametrize("name", ["group_agg", "join_left", "threshold_sweep", "per_class_prf", "hamming_loss", "route_events", "trust_score", "value_counts"])
def test_no_python_and_no_cross_join(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "Python" not in p and "MapInPandas" not in p and "Join Cross" not in p
