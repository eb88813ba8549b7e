"""Plan-shape checks: pushdown, pruning, partial aggregation, bounded top-k,
no Python UDFs, and the driver contract."""

import datetime as dt
import tempfile

import pytest

import __spark_entry__ as E
from conftest import SF, row
from vigil.operators import alerts as A
from vigil.operators import detect
from vigil.sources import logs as L


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log_table(spark):
    out = tempfile.mkdtemp(prefix="vigil-test-plan-")
    rows = [row(ts=dt.datetime(2024, 1, 1, 0, 0, i), proto=p) for i in range(20) for p in ("TCP", "HTTP")]
    L.write_logs(spark.createDataFrame(rows, L.S.LOG_SCHEMA), out)
    return out


def test_port_scan_pushes_filter_and_prunes_columns(spark, log_table):
    plan = _plan(detect.detect_port_scan(L.read_logs(spark, log_table)))
    assert "EqualTo(protocol,TCP)" in plan.split("PushedFilters: [")[1].split("]")[0]
    read_schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "user_agent" not in read_schema and "bytes_transferred" not in read_schema
    assert "partial_count" in plan  # map-side partial aggregation before the shuffle


def test_brute_force_partial_aggregation(spark, log_table):
    plan = _plan(detect.detect_brute_force(L.read_logs(spark, log_table)))
    assert "partial_count" in plan and "partial_min(" in plan and "partial_min_by" in plan
    assert "EqualTo(action,blocked)" in plan


def test_recent_alerts_uses_window_group_limit(spark):
    q = E.queries()["recent_alerts_per_ip"](spark, SF)
    assert "WindowGroupLimit" in _plan(q)


@pytest.mark.parametrize("name", [n for n in E.catalog.queries() if not n.startswith("stream_")])
def test_no_python_udf_or_cross_join_in_any_query(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name} uses {bad}"


def test_oracles_cover_registered_queries():
    q, o = E.catalog.queries(), E.catalog.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"ip", "recommendation", "confidence"} <= set(df.columns)


def test_active_alerts_scalar_subquery_not_collected(spark):
    al = A.all_alerts(E.catalog.detect_logs(spark, SF))
    assert "Subquery" in _plan(A.within_ttl(al)) or "subquery" in _plan(A.within_ttl(al)).lower()


@pytest.mark.parametrize("name", ["ip_reputation_all", "top_malicious_ips", "reputation_snapshot", "timeline",
                                  "malicious_counts", "attack_flags"])
def test_single_scan_analyses(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert plan.count("FileScan parquet") == 1, name


@pytest.mark.parametrize("name", ["port_scan", "reputation_snapshot", "ip_reputation_all"])
def test_distinct_counts_spread_hot_sources(spark, name):
    """The shuffle nearest the scan is keyed by the source *and* the
    destination, so one source holding a large share of all rows is spread
    over all reducers before the (already de-duplicated) per-source count."""
    plan = _plan(E.queries()[name](spark, SF))
    lines = plan.splitlines()
    scan = max(i for i, l in enumerate(lines) if "FileScan parquet" in l)
    nearest = next(lines[i] for i in range(scan, -1, -1) if "Exchange hashpartitioning" in lines[i])
    assert "source_ip" in nearest and "dest_ip" in nearest, nearest


@pytest.mark.parametrize("detector", [detect.detect_brute_force, detect.detect_volume_anomaly, detect.window_rollup,
                                      detect.detect_in_windows])
def test_raw_rows_are_aggregated_by_hash(spark, log_table, detector):
    """The aggregates nearest the scan keep longs only, so no raw row is sorted."""
    for logs in (L.read_logs(spark, log_table), E.catalog.detect_logs(spark, SF)):
        lines = _plan(detector(logs)).splitlines()
        scan = next(i for i, l in enumerate(lines) if "FileScan parquet" in l)
        exchange = max(i for i in range(scan) if "Exchange" in lines[i])
        below = [l for l in lines[exchange:scan] if "Aggregate(" in l]
        assert len(below) == 1 and "HashAggregate(" in below[0] and "partial_count(1)" in below[0]
        assert not any("Sort [" in l for l in lines[exchange:scan])
        assert sum("FileScan parquet" in l for l in lines) == 1


def test_live_alerts_prune_days_and_rows(spark, log_table):
    logs = L.read_logs(spark, log_table, keep_partitions=True)
    plan = _plan(A.live_alerts(logs, dt.datetime(2024, 1, 2, 0, 0, 30)))
    parts = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in parts and ">= 20231231" in parts  # a day and the longest window before
    assert "GreaterThan(timestamp" in plan


def test_building_a_view_starts_no_job(spark):
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "building only")
    try:
        for name in ("alerts_all", "active_alerts", "recent_alerts_per_ip", "speed_summary", "severity_metrics", "top_alert_ips",
                     "alert_type_counts", "alert_list", "alerts_of_last_minute", "threat_profiles", "observed_ip_profiles"):
            E.queries()[name](spark, SF)
        assert list(status.getJobIdsForGroup("views")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
