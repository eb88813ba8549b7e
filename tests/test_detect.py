import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import TS, row
from vigil.functions import patterns as P
from vigil.operators import alerts as A
from vigil.operators import detect


# --- brute force (golden cases G-2..G-5 and thresholds) ----------------------
def test_six_blocked_is_high_72(mk):
    out = detect.detect_brute_force(mk([row()] * 6)).collect()
    assert len(out) == 1
    assert out[0]["severity"] == "HIGH" and out[0]["threat_score"] == 72
    assert out[0]["event_count"] == 6 and out[0]["bytes_total"] == 6 * 512


def test_four_and_five_blocked_no_alert(mk):
    assert detect.detect_brute_force(mk([row()] * 4)).count() == 0
    assert detect.detect_brute_force(mk([row()] * 5)).count() == 0


@pytest.mark.parametrize("n,severity,score", [(10, "HIGH", 80), (11, "CRITICAL", 82), (30, "CRITICAL", 100)])
def test_brute_force_severity_boundaries(mk, n, severity, score):
    out = detect.detect_brute_force(mk([row()] * n)).collect()
    assert (out[0]["severity"], out[0]["threat_score"]) == (severity, score)


def test_only_blocked_counts(mk):
    rows = [row(nbytes=100, agent="curl", path="/")] * 3 + [row(action="allowed", label="benign")] * 5
    assert detect.detect_brute_force(mk(rows)).count() == 0


def test_brute_force_window_split(mk):
    # 6 events straddling a minute boundary are two windows of 3: no alert
    rows = [row(ts=TS + dt.timedelta(seconds=57 + i)) for i in range(6)]
    assert detect.detect_brute_force(mk(rows)).count() == 0


def test_demo_brute_force_hydra(mk):
    rows = [row(src="10.10.10.1", agent="hydra/9.4", path="/admin/login")] * 8
    bf = detect.detect_brute_force(mk(rows)).collect()[0]
    assert (bf["threat_score"], bf["severity"], bf["event_count"], bf["bytes_total"]) == (76, "HIGH", 8, 4096)
    sig = detect.detect_signatures(mk(rows)).collect()
    assert len(sig) == 8 and {r["alert_type"] for r in sig} == {"KNOWN_ATTACK_TOOL"}
    assert {r["threat_score"] for r in sig} == {95}


def test_first_value_is_earliest_event(mk):
    rows = [row(ts=TS + dt.timedelta(seconds=i), agent=f"agent{i}", log_type=lt)
            for i, lt in zip(range(6), ["ids", "firewall", "ids", "ids", "ids", "ids"])]
    out = detect.detect_brute_force(mk(list(reversed(rows)))).collect()[0]
    assert out["user_agent"] == "agent0" and out["log_type"] == "ids"


# --- signatures (G-6, D-7) ----------------------------------------------------
@pytest.mark.parametrize(
    "agent,path,expected",
    [
        ("sqlmap/1.7.8#stable", "/", "KNOWN_ATTACK_TOOL"),
        ("nikto/2.1.6", "/", "KNOWN_ATTACK_TOOL"),
        ("Mozilla", "/p?id=1 UNION SELECT user,pass FROM users--", "SQLI_DETECTED"),
        ("Mozilla", "/s?q=<script>alert(1)</script>", "XSS_DETECTED"),
        ("Mozilla", "/../../etc/passwd", "LFI_DETECTED"),
        ("sqlmap/1.7.8#stable", "/product.php?id=1' OR '1'='1", "KNOWN_ATTACK_TOOL"),
    ],
)
def test_signature_precedence(mk, agent, path, expected):
    out = detect.detect_signatures(mk([row(agent=agent, path=path)])).collect()
    assert [r["alert_type"] for r in out] == [expected]


def test_normal_traffic_not_flagged(mk):
    rows = [row(agent="Mozilla/5.0 (Windows NT 10.0) Chrome/118.0", path="/home")]
    assert detect.detect_signatures(mk(rows)).count() == 0
    assert detect.detect_attack_patterns(mk(rows)).count() == 0


def test_plain_dotdot_is_not_lfi(mk):
    assert detect.detect_attack_patterns(mk([row(agent="Mozilla", path="/../../x")])).count() == 0
    assert detect.detect_attack_patterns(mk([row(agent="Mozilla", path="/a/../.../x")])).count() == 1


def test_batch_only_patterns(mk):
    rows = [row(agent="Mozilla", path="/x?q=1; INSERT INTO t"), row(agent="Mozilla", path="/proc/self/environ")]
    assert detect.detect_attack_patterns(mk(rows)).count() == 2
    assert detect.detect_signatures(mk(rows)).count() == 0


def test_null_agent_and_path(mk):
    rows = [row(agent=None, path=None), row(agent=None, path="/etc/passwd")]
    out = detect.detect_attack_patterns(mk(rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["is_tool"] is None and r["is_lfi"] is True and r["attack_category"] == "LFI"


def test_attack_pattern_categories(mk):
    rows = [row(agent="nmap", path="/"), row(agent="x", path="1=1--"), row(agent="x", path="onload=1"),
            row(agent="x", path="%2e%2e%2f")]
    got = {r["attack_category"]: r["threat_score"] for r in detect.detect_attack_patterns(mk(rows)).collect()}
    assert got == {"TOOL_DETECTED": 95, "SQLI": 85, "XSS": 75, "LFI": 70}
    assert P.BATCH_FALLBACK == ("UNKNOWN", 60)


def test_signature_null_bytes_kept_as_zero(mk):
    out = detect.detect_signatures(mk([row(agent="sqlmap", nbytes=None)])).collect()
    assert out[0]["bytes_total"] == 0


# --- port scan (G-7 and thresholds) ---------------------------------------------
def _scan(n, proto="TCP"):
    return [row(src="192.168.1.99", dst=f"10.0.0.{i}", proto=proto, label="suspicious") for i in range(1, n + 1)]


def test_port_scan_25_targets(mk):
    out = detect.detect_port_scan(mk(_scan(25))).collect()
    assert len(out) == 1 and out[0]["distinct_targets"] == 25
    assert out[0]["threat_score"] == 65 and out[0]["severity"] == "MEDIUM"


@pytest.mark.parametrize("n,hit", [(5, False), (20, False), (21, True)])
def test_port_scan_threshold(mk, n, hit):
    assert (detect.detect_port_scan(mk(_scan(n))).count() == 1) == hit


@pytest.mark.parametrize("n,severity,score", [(50, "MEDIUM", 90), (51, "HIGH", 91), (100, "HIGH", 100),
                                              (101, "CRITICAL", 100)])
def test_port_scan_severity(mk, n, severity, score):
    out = detect.detect_port_scan(mk(_scan(n))).collect()[0]
    assert (out["severity"], out["threat_score"]) == (severity, score)


def test_port_scan_tcp_only_and_distinct(mk):
    rows = _scan(25, proto="HTTP") + _scan(10) + _scan(10)
    assert detect.detect_port_scan(mk(rows)).count() == 0


# --- volume anomaly ------------------------------------------------------------
@pytest.mark.parametrize(
    "total,expected",
    [(10485760, None), (10485761, ("HIGH", 85)), (15728640, ("HIGH", 85)), (104857600, ("HIGH", 90)),
     (104857601, ("CRITICAL", 90)), (10**12, ("CRITICAL", 100))],
)
def test_volume_thresholds(mk, total, expected):
    out = detect.detect_volume_anomaly(mk([row(nbytes=total)])).collect()
    if expected is None:
        assert out == []
    else:
        assert (out[0]["severity"], out[0]["threat_score"]) == expected


def test_volume_sums_within_ten_seconds(mk):
    rows = [row(ts=TS + dt.timedelta(seconds=s), nbytes=6 * 1048576) for s in (0, 9, 10)]
    out = detect.detect_volume_anomaly(mk(rows)).collect()
    assert len(out) == 1 and out[0]["bytes_total"] == 12 * 1048576 and out[0]["event_count"] == 2


def test_rollup_detectors_equal_direct(spark, mk):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(400):
        rows.append(row(ts=TS + dt.timedelta(seconds=rnd.randint(0, 300)), src=f"10.0.0.{rnd.randint(1, 3)}",
                        action=rnd.choice(["blocked", "blocked", "allowed"]), nbytes=rnd.choice([None, 10**6, 3 * 10**6]),
                        agent=rnd.choice([None, "a", "b"]), log_type=rnd.choice(["ids", "firewall"])))
    logs = mk(rows)
    rollup = detect.window_rollup(logs)
    key = lambda r: str(tuple(r))
    assert sorted(detect.brute_force_from_rollup(rollup).collect(), key=key) == \
        sorted(detect.detect_brute_force(logs).collect(), key=key)
    assert sorted(detect.volume_from_rollup(rollup).collect(), key=key) == \
        sorted(detect.detect_volume_anomaly(logs).collect(), key=key)
    assert detect.detect_brute_force(logs).count() > 0 and detect.detect_volume_anomaly(logs).count() > 0


def test_rollup_equals_direct_without_event_id_and_with_ties(mk):
    import random

    rnd = random.Random(11)
    rows = [row(ts=TS + dt.timedelta(seconds=rnd.randint(0, 120)), src="10.0.0.1",
                action=rnd.choice(["blocked", "allowed"]), nbytes=rnd.choice([None, 4 * 10**6]),
                agent=rnd.choice([None, "a", "b", "c"]), log_type=rnd.choice(["ids", "firewall", "application"]))
            for _ in range(300)]  # 300 events on ~120 distinct seconds: many exact ties
    logs = mk(rows, with_id=False)
    rollup = detect.window_rollup(logs)
    key = lambda r: str(tuple(r))
    assert sorted(detect.brute_force_from_rollup(rollup).collect(), key=key) == \
        sorted(detect.detect_brute_force(logs).collect(), key=key)
    assert sorted(detect.volume_from_rollup(rollup).collect(), key=key) == \
        sorted(detect.detect_volume_anomaly(logs).collect(), key=key)


def test_first_value_of_equal_times_goes_by_the_whole_event_number(mk):
    """Numbers beyond the packed low bits, negative ones and none: the least decides, none first."""
    def first(ids):
        rows = [row(agent=f"agent{i}", log_type=f"type{i}", nbytes=3_000_000) for i in range(len(ids))]
        # one event apart from the others in every field that is a key
        df = mk(rows * 3, with_id=False)
        number = F.create_map(*[x for i, n in enumerate(ids) for x in (F.lit(f"agent{i}"), F.lit(n).cast("long"))])
        return df.withColumn("event_id", number[F.col("user_agent")])

    big = detect.ID_BITS
    for ids, want in [([3 << big, (1 << big) + 5, (1 << big) + 4], 2), ([1 << 40, -(1 << 40), 7], 1), ([5, 4, None], 2),
                      ([(2 << big) + 1, (1 << big) + 9, 3 << big], 1)]:
        logs = first(ids)
        brute, volume = detect.detect_brute_force(logs).collect(), detect.detect_volume_anomaly(logs).collect()
        assert [r.user_agent for r in brute] == [f"agent{want}"] and [r.log_type for r in brute] == [f"type{want}"]
        assert [r.user_agent for r in volume] == [f"agent{want}"] and brute[0].blocked_count == 9


def test_text_numbers_keep_the_one_level_form(mk):
    logs = mk([row(agent=f"a{i}") for i in range(7)], with_id=False).withColumn("event_id", F.col("user_agent"))
    assert [r.user_agent for r in detect.detect_brute_force(logs).collect()] == ["a0"]


def test_live_alerts_equal_the_live_part_of_all(mk):
    rows = [row(ts=TS + dt.timedelta(seconds=s), src=f"10.0.0.{k}", nbytes=9_000_000 * (1 + k % 2), agent="sqlmap" if s % 50 == 0 else "x")
            for k in range(3) for s in range(0, 240, 5)]
    logs = mk(rows + [row(ts=None, agent="sqlmap"), row(ts=TS + dt.timedelta(days=400), agent="sqlmap")])
    now = TS + dt.timedelta(seconds=185)
    for ttl in (dt.timedelta(seconds=20), dt.timedelta(seconds=65), dt.timedelta(hours=24)):
        want = A.within_ttl(A.all_alerts(logs), now, f"{int(ttl.total_seconds())} SECONDS")
        assert sorted(map(str, A.live_alerts(logs, now, ttl).collect())) == sorted(map(str, want.collect()))
