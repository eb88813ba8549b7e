import datetime as dt

from pyspark.sql import functions as F

from conftest import TS, row
from vigil import schema as S
from vigil.operators import alerts as A
from vigil.operators import detect


def _alerts(mk, rows):
    return A.all_alerts(mk(rows))


def test_envelope_schema_and_defaults(mk):
    rows = [row(agent="")] * 6 + [row(src="10.9.9.9", agent="sqlmap", nbytes=None)]
    al = _alerts(mk, rows)
    assert al.columns == S.ALERT_COLUMNS
    got = {r["alert_type"]: r for r in al.collect()}
    bf = got["BRUTE_FORCE"]
    assert bf["user_agents"] == ["unknown"] and bf["attack_types"] == ["BRUTE_FORCE"]
    assert bf["bucket_time"] == TS + dt.timedelta(minutes=1) == bf["last_seen"]
    sig = got["KNOWN_ATTACK_TOOL"]
    assert sig["bytes_total"] == 0 and sig["window_start"] is None and sig["event_count"] == 1


def test_alert_id_is_deterministic(mk):
    rows = [row()] * 7
    a = sorted(r["alert_id"] for r in _alerts(mk, rows).collect())
    b = sorted(r["alert_id"] for r in _alerts(mk, rows).collect())
    assert a == b and len(set(a)) == len(a)


def test_latest_revision(spark):
    base = dict(ip_source="x", bucket_time=TS, last_seen=TS, attack_types=["BRUTE_FORCE"], alert_type="BRUTE_FORCE",
                severity="HIGH", bytes_total=0, user_agents=["u"], log_sources=["firewall"], window_start=TS,
                window_end=TS)
    rows = [dict(base, alert_id="a", threat_score=72, event_count=6, batch_id=0),
            dict(base, alert_id="a", threat_score=78, event_count=9, batch_id=1),
            dict(base, alert_id="b", threat_score=74, event_count=7, batch_id=0)]
    schema = S.ALERT_SCHEMA.simpleString()[len("struct<"):-1] + ",batch_id:bigint"
    df = spark.createDataFrame([tuple(r[c] for c in S.ALERT_COLUMNS + ["batch_id"]) for r in rows],
                               schema.replace(":", " "))
    got = {r["alert_id"]: r["event_count"] for r in A.latest_revision(df).collect()}
    assert got == {"a": 9, "b": 7}


def test_ttl_active_and_recent(mk):
    old = [row(ts=TS - dt.timedelta(days=2), src="10.0.0.5", agent="nikto", path="/")]
    new = [row(ts=TS + dt.timedelta(seconds=i), src="10.0.0.5", agent="nikto", path="/") for i in range(12)]
    al = _alerts(mk, old + new)
    live = A.within_ttl(al).collect()
    assert all(r["bucket_time"] > TS - dt.timedelta(days=1) for r in live)
    recent = A.recent_alerts_per_ip(al).collect()
    assert len(recent) == 10 and max(r["alert_rank"] for r in recent) == 10
    assert min(r["bucket_time"] for r in recent) >= TS + dt.timedelta(seconds=2)
    top = A.active_alerts(al, limit=3).collect()
    assert [r["threat_score"] for r in top] == sorted([r["threat_score"] for r in top], reverse=True)
    assert len(top) == 3


def test_speed_summary(mk):
    rows = [row(src="10.0.0.5", agent="hydra", path="/etc/passwd", nbytes=100)] * 6
    s = A.speed_summary(_alerts(mk, rows)).collect()[0]
    # six signature alerts (tool) + one brute-force window; newest 10 of 7
    assert s["active_alerts"] == 7 and s["current_threat_score"] == 95
    assert s["recent_attack_types"] == ["BRUTE_FORCE", "KNOWN_ATTACK_TOOL"]
    assert s["bytes_recent_alerts"] == 6 * 100 + 600


def test_rollups(mk, spark):
    rows = [row(src="a")] * 11 + [row(src="b", agent="Mozilla", path="<script>")] + \
           [row(src="c", agent="Mozilla", path="/etc/passwd")]
    al = _alerts(mk, rows)
    m = A.severity_metrics(al).first()
    assert (m["critical_alerts"], m["high_alerts"], m["total_alerts"]) == (14, 0, 14)
    c = A.alert_type_counts(al).first().asDict()
    assert c["brute_force"] == 1 and c["known_attack_tool"] == 11 and c["other"] == 2
    top = A.top_alert_ips(al).collect()
    assert [r["ip_source"] for r in top] == ["a", "b", "c"] and top[0]["bar_pct"] == 100.0
    assert top[2]["bar_pct"] == 70 * 100.0 / 95


def test_severity_filter_and_display(mk):
    al = _alerts(mk, [row()] * 11)
    assert A.severity_filter(al, "CRITICAL").count() == al.filter(F.col("severity") == "CRITICAL").count()
    assert A.severity_filter(al, "ALL").count() == al.count()
    d = A.alert_display(detect.detect_brute_force(mk([row()] * 11)).transform(A.to_alerts)).first()
    assert d["score_band"] == "crit" and d["bytes_display"] == "5.5 KB"


def test_all_alerts_with_persisted_rollup_equals_direct(spark, mk):
    import tempfile

    rows = [row(ts=TS + dt.timedelta(seconds=i), nbytes=3 * 1048576) for i in range(12)]
    rows += [row(src="10.0.0.2", agent="nikto", path="/", ts=TS + dt.timedelta(seconds=5))]
    logs = mk(rows)
    path = tempfile.mkdtemp(prefix="vigil-test-rollup-") + "/r"
    detect.window_rollup(logs).write.parquet(path)
    via_rollup = A.all_alerts(logs, rollup=spark.read.parquet(path))
    direct = A.all_alerts(logs)
    assert sorted(map(str, via_rollup.collect())) == sorted(map(str, direct.collect()))
    assert {r["alert_type"] for r in direct.collect()} == {"BRUTE_FORCE", "VOLUME_ANOMALY", "KNOWN_ATTACK_TOOL"}


def test_port_scan_rows_map_to_alerts(mk):
    rows = [row(src="s", dst=f"10.0.0.{i}", proto="TCP") for i in range(25)]
    al = A.to_alerts(detect.detect_port_scan(mk(rows))).collect()
    assert len(al) == 1 and al[0]["alert_type"] == "PORT_SCAN" and al[0]["event_count"] == 25
    assert al[0]["bytes_total"] == 0 and al[0]["user_agents"] == ["unknown"]
