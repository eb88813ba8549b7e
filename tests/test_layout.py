"""Served tables in buckets of the IP: no shuffle between them, one bucket for one IP."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF
from vigil.operators import alerts as A
from vigil.operators import serving as V
from vigil.plans.catalog import detect_logs
from vigil.plans.layout import SIDES, _table, open_layout, write_layout


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    logs = detect_logs(spark, SF)
    return V.reputation_snapshot(logs), V.attack_types_by_ip(V.attack_type_index(logs)), A.speed_summary(A.all_alerts(logs))


@pytest.fixture(scope="module")
def layout(spark, sides):
    return write_layout(spark, tempfile.mkdtemp(prefix="vigil-test-layout-") + "/t", *sides)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_profiles_join_without_exchange(layout, no_broadcast):
    plan = _plan(layout.profiles())
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan


def test_only_requests_are_shuffled(spark, layout, no_broadcast):
    plan = _plan(layout.lookup(spark.range(10).select(F.col("id").cast("string").alias("ip"))))
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_ip_reads_one_bucket(layout, no_broadcast):
    ip = layout.table("ips").first()["ip"]
    plan = _plan(layout.profile_of(ip))
    assert plan.count(f"SelectedBucketsCount: 1 out of {layout.buckets}") == 4
    assert [r.ip for r in layout.profile_of(f" {ip} ").collect()] == [ip] and layout.profile_of("no such").count() == 0


def test_equals_the_fused_profiles(layout, sides):
    assert sorted(map(str, layout.profiles().collect())) == sorted(map(str, V.threat_profiles(*sides).collect()))


def test_opened_by_a_catalog_that_does_not_know_it(spark, layout):
    want = sorted(map(str, layout.profiles().collect()))
    for name in (*SIDES, "ips"):
        spark.sql(f"DROP TABLE {_table(layout.root, name)}")
    again = open_layout(spark, layout.root)
    assert again.buckets == layout.buckets and sorted(map(str, again.profiles().collect())) == want


def test_null_ips_empty_sides_and_more_buckets(spark, sides):
    snapshot, types, live = sides
    root = tempfile.mkdtemp(prefix="vigil-test-layout-") + "/t"
    nameless = live.limit(1).withColumn("ip", F.lit(None).cast("string"))
    t = write_layout(spark, root, snapshot, types.limit(0), live.limit(0).union(nameless), rows_per_bucket=10)
    n = snapshot.count()
    assert t.buckets == max(8, -(-n // 10)) and t.profiles().count() == n
    assert t.profiles().where("active_alerts > 0 or size(attack_types_detected) > 0").count() == 0
