import os
import tempfile

import pytest

from vigil.plans import jobs
from vigil.sources.events import load_logs

SF = "/root/testdata/sf0.001"


def test_run_all_persists_every_result(spark):
    out = tempfile.mkdtemp(prefix="vigil-test-jobs-")
    status = jobs.run_all(spark, load_logs(spark, SF, 10000), out)
    assert status == {k: "ok" for k, _ in jobs.JOBS}
    for t in ["ip_reputation", "ip_reputation_by_type", "top_malicious_ips", "port_scans", "attack_patterns",
              "attack_category_counts", "attack_index", "volume_analysis", "threat_timeline"]:
        assert os.path.isdir(os.path.join(out, t)), t
    assert spark.read.parquet(f"{out}/top_malicious_ips").count() == 10
    assert spark.read.parquet(f"{out}/port_scans").count() == 14  # distinct targets over 20 in 5 minutes, sf0.001
    assert spark.read.parquet(f"{out}/volume_analysis").count() == 27


def test_failed_job_does_not_stop_the_rest(spark):
    out = tempfile.mkdtemp(prefix="vigil-test-jobs-")
    bad = spark.range(3)  # not a log frame: every job fails, each is reported
    status = jobs.run_all(spark, bad, out)
    assert set(status) == {k for k, _ in jobs.JOBS}
    assert {k: v.split(":")[0] for k, v in status.items()} == {
        "top_malicious_ips": "failed", "port_scan": "failed", "attack_patterns": "skipped", "volume_analysis": "failed"}


def test_a_failed_job_leaves_the_tables_of_its_dependants(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="vigil-test-jobs-")
    logs = load_logs(spark, SF, 10000)
    assert set(jobs.run_all(spark, logs, out, ["port_scan", "attack_patterns"]).values()) == {"ok"}
    before = spark.read.parquet(f"{out}/attack_index").count()

    def broken(*_):
        raise RuntimeError("no port scans today")

    monkeypatch.setattr(jobs, "JOBS", [(n, broken if n == "port_scan" else f) for n, f in jobs.JOBS])
    status = jobs.run_all(spark, logs.limit(50), out, ["port_scan", "attack_patterns"])
    assert status["attack_patterns"].startswith("skipped")
    assert spark.read.parquet(f"{out}/attack_index").count() == before


def test_serving_jobs_match_live_plan(spark):
    from vigil.plans.queries_serving import profiles_for

    out = tempfile.mkdtemp(prefix="vigil-test-jobs-")
    logs = load_logs(spark, SF, 10000)
    status = jobs.run_all(spark, logs, out, serving=True)
    assert status["alerts"] == "ok" and status["threat_profiles"] == "ok"
    served = spark.read.parquet(f"{out}/threat_profiles")
    live = profiles_for(logs)
    assert sorted(map(str, served.collect())) == sorted(map(str, live.select(*served.columns).collect()))


def test_serve_requests_from_written_tables(spark):
    from pyspark.sql import functions as F

    from vigil.plans import serve

    out = tempfile.mkdtemp(prefix="vigil-test-serve-")
    jobs.run_all(spark, load_logs(spark, SF, 10000), out, serving=True)
    some_ip = spark.read.parquet(f"{out}/threat_profiles").orderBy("ip").first()["ip"]
    prof = serve.profile_document(spark, out, f" {some_ip} ")
    assert prof["ip"] == some_ip and prof["recommendation"] in ("BLOCK", "MONITOR")
    unknown = serve.profile_document(spark, out, "203.0.113.9")
    assert unknown["recommendation"] == "ALLOW" and unknown["reputation_score"] == 0
    with pytest.raises(ValueError):
        serve.profile_document(spark, out, "x" * 46)
    many = serve.lookup_many(spark, out, spark.createDataFrame([(some_ip,), ("203.0.113.9",)], "ip string"))
    assert sorted(r["recommendation"] for r in many.collect())[0] == "ALLOW"
    plan = serve.profile_of(spark, out, some_ip)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ip," in plan
    assert serve.active_alerts_of(spark, out).count() == 200
    t = serve.ServedTables(spark, out)
    assert t.profile(some_ip) == prof and t.profile("203.0.113.9") == unknown
    assert sorted(map(str, t.active_alerts().collect())) == sorted(map(str, serve.active_alerts_of(spark, out).collect()))
    assert t.global_stats().first() == serve.global_stats_of(spark, out).first()
    assert serve.global_stats_of(spark, out).first()["total_ips_analyzed"] == 15
    assert serve.timeline_of(spark, out).agg(F.sum("malicious")).first()[0] > 0
    keys = [(r["date"], r["hour"]) for r in t.timeline().collect()]
    assert keys == sorted(keys) and len(keys) > 0
