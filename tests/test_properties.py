"""Detectors and analyses against plain-Python brute force on random inputs."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import TS
from vigil.operators import analyze, detect
from vigil.operators import serving as V

EPOCH = dt.datetime(1970, 1, 1)

log_rows = st.lists(
    st.tuples(
        st.integers(0, 600),                      # seconds after TS
        st.sampled_from(["10.0.0.1", "10.0.0.2", "10.0.0.3"]),
        st.integers(0, 40),                       # dest host
        st.sampled_from(["TCP", "HTTP", "SSH"]),
        st.sampled_from(["blocked", "allowed"]),
        st.sampled_from(["malicious", "suspicious", "benign"]),
        st.sampled_from(["firewall", "ids", "application"]),
        st.one_of(st.none(), st.integers(0, 4 * 1048576)),
    ),
    min_size=0, max_size=120,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(mk, rows):
    return mk([(TS + dt.timedelta(seconds=s), src, f"192.168.0.{d}", proto, act, lab, lt, b, "ua", "/")
               for s, src, d, proto, act, lab, lt, b in rows])


def _bucket(t, seconds):
    us = int((t - EPOCH).total_seconds() * 1_000_000)
    start = us - us % (seconds * 1_000_000)
    return EPOCH + dt.timedelta(microseconds=start)


@SETTINGS
@given(rows=log_rows)
def test_port_scan_brute_force(mk, rows):
    groups = defaultdict(set)
    for s, src, d, proto, *_ in rows:
        if proto == "TCP":
            groups[(src, _bucket(TS + dt.timedelta(seconds=s), 300))].add(d)
    want = {k: len(v) for k, v in groups.items() if len(v) > 3}
    got = {(r["source_ip"], r["window_start"]): r["distinct_targets"]
           for r in detect.detect_port_scan(_frame(mk, rows), threshold=3).collect()}
    assert got == want


@SETTINGS
@given(rows=log_rows)
def test_brute_force_and_volume_brute_force(mk, rows):
    bf, vol = defaultdict(lambda: [0, 0]), defaultdict(int)
    for s, src, d, proto, act, lab, lt, b in rows:
        t = TS + dt.timedelta(seconds=s)
        if act == "blocked":
            bf[(src, _bucket(t, 60))][0] += 1
            bf[(src, _bucket(t, 60))][1] += b or 0
        vol[(src, _bucket(t, 10))] += b or 0
    want_bf = {k: (n, nb, min(100, 70 + (n - 2) * 2)) for k, (n, nb) in bf.items() if n > 2}
    got_bf = {(r["source_ip"], r["window_start"]): (r["blocked_count"], r["bytes_total"], r["threat_score"])
              for r in detect.detect_brute_force(_frame(mk, rows), threshold=2).collect()}
    assert got_bf == want_bf
    want_vol = {k: min(100, int(80 + math.log(v / 1048576.0) / math.log(10) * 5))
                for k, v in vol.items() if v > 4 * 1048576}
    got_vol = {(r["source_ip"], r["window_start"]): r["threat_score"]
               for r in detect.detect_volume_anomaly(_frame(mk, rows), threshold_bytes=4 * 1048576).collect()}
    assert got_vol == want_vol


@SETTINGS
@given(rows=log_rows)
def test_snapshot_and_timeline_brute_force(mk, rows):
    snap = defaultdict(lambda: {"n": 0, "m": 0, "s": 0, "dest": set(), "types": set()})
    hours = defaultdict(lambda: [0, 0, 0])
    for s, src, d, proto, act, lab, lt, b in rows:
        t = TS + dt.timedelta(seconds=s)
        hours[(t.strftime("%Y%m%d"), t.hour)][["malicious", "suspicious", "benign"].index(lab)] += 1
        if lab != "benign":
            e = snap[src]
            e["n"] += 1
            e["m" if lab == "malicious" else "s"] += 1
            e["dest"].add(d)
            e["types"].add(lt)
    logs = _frame(mk, rows)
    got = {r["source_ip"]: (r["total_events"], r["unique_targets"], r["reputation_score_norm"], r["log_types"])
           for r in V.reputation_snapshot(logs).collect()}
    want = {ip: (e["n"], len(e["dest"]), min(100, int((10 * e["m"] + 5 * e["s"]) / (e["m"] + e["s"]) * 10)),
                 sorted(e["types"])) for ip, e in snap.items()}
    assert got == want
    got_tl = {(r["event_date"], r["event_hour"]): [r["malicious_count"], r["suspicious_count"], r["benign_count"]]
              for r in analyze.threat_timeline(logs).collect()}
    assert got_tl == dict(hours)


text = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40))  # any text but lone surrogates


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(text, text, st.one_of(st.none(), st.integers(0, 2**40))), min_size=1, max_size=20))
def test_json_codec_round_trip(mk, values):
    from vigil.sources import messages as M

    rows = [(TS + dt.timedelta(seconds=i), "10.0.0.1", "192.168.0.1", "TCP", "allowed", "benign", "ids", b, ua, p)
            for i, (ua, p, b) in enumerate(values)]
    logs = mk(rows)
    back = M.parse_json_logs(M.encode_messages(logs))
    cols = ["user_agent", "request_path", "bytes_transferred", "timestamp"]
    assert sorted(map(tuple, back.select(*cols).collect()), key=str) == \
        sorted(map(tuple, logs.select(*cols).collect()), key=str)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(text, text), min_size=1, max_size=20))
def test_csv_codec_round_trip(mk, values):
    from vigil.sources import logs as L

    # an empty string and NULL share one CSV spelling (empty field); the
    # reader maps it to NULL, as for files
    rows = [(TS + dt.timedelta(seconds=i), "10.0.0.1", "192.168.0.1", "TCP", "allowed", "benign", "ids", 7,
             ua or None, p or None) for i, (ua, p) in enumerate(values)]
    logs = mk(rows, with_id=False)
    good, bad = L.parse_csv_lines(L.to_csv_lines(logs))
    assert bad.count() == 0
    assert sorted(map(tuple, good.collect()), key=str) == sorted(map(tuple, logs.collect()), key=str)
