"""Live data must not lose alerts: identities, forged times, absent times, open bounds."""

import datetime as dt

import pytest
from conftest import TS, row
from pyspark.sql import functions as F

from vigil import schema as S
from vigil import session
from vigil.operators import alerts as A
from vigil.operators import analyze, detect
from vigil.operators import serving as V
from vigil.plans import serve
from vigil.sources.messages import normalize_logs, parse_json_logs

FAR = dt.datetime(2099, 1, 1)
TOOL = dict(agent="sqlmap/1.7", path="/x")


def test_parsed_messages_without_event_id_have_their_own_alert_ids(spark):
    one = '{"timestamp":"2024-01-01T00:00:0%d","source_ip":"1.1.1.1","user_agent":"sqlmap","request_path":"/%s"}'
    lines = [(one % (1, "a"),), (one % (1, "b"),), (one % (2, "a"),), (one % (1, "a"),)]  # the last repeats the first
    raw = spark.createDataFrame(lines, "value string")
    ids = [r.alert_id for r in A.to_alerts(detect.detect_signatures(parse_json_logs(raw))).collect()]
    assert len(set(ids)) == len(ids) == 4
    again = [r.alert_id for r in A.to_alerts(detect.detect_signatures(parse_json_logs(raw.repartition(3)))).collect()]
    assert sorted(again) == sorted(ids)


def test_place_in_the_source_names_a_message(spark):
    value = '{"timestamp":"2024-01-01T00:00:01","source_ip":"1.1.1.1","user_agent":"sqlmap"}'
    raw = spark.createDataFrame([("t", 0, 5, value), ("t", 1, 5, value)], "topic string, partition int, offset long, value string")
    parsed = parse_json_logs(raw)
    assert sorted(r.source_offset for r in parsed.collect()) == ["t:0:5", "t:1:5"]
    assert A.to_alerts(detect.detect_signatures(parsed)).select("alert_id").distinct().count() == 2


def test_one_future_alert_hides_no_others(mk):
    al = A.to_alerts(detect.detect_signatures(mk([row(**TOOL), row(src="10.0.0.2", **TOOL), row(ts=FAR, src="9.9.9.9", **TOOL)])))
    assert {r.ip_source for r in A.active_alerts(al).collect()} == {"10.0.0.1", "10.0.0.2", "9.9.9.9"}


def test_alerts_without_a_time_stay(mk):
    al = A.to_alerts(detect.detect_signatures(mk([row(**TOOL), row(ts=None, src="10.0.0.3", **TOOL)])))
    assert A.active_alerts(al).count() == 2
    assert A.active_alerts(al, as_of=TS + dt.timedelta(days=9)).select("ip_source").collect()[0][0] == "10.0.0.3"


def test_ttl_and_summary_bounds_bind(mk):
    rows = [row(ts=TS - dt.timedelta(hours=30), src="10.0.0.9", **TOOL)] + [
        row(ts=TS - dt.timedelta(minutes=i), **TOOL) for i in range(12)]
    al = A.to_alerts(detect.detect_signatures(mk(rows)))
    assert "10.0.0.9" not in {r.ip_source for r in A.within_ttl(al).collect()}
    assert A.speed_summary(al).first().active_alerts == 10 and A.speed_summary(al, n=None).first().active_alerts == 12


def test_first_value_is_fixed_without_event_ids(mk):
    rows = [row(agent=a) for a in "fbdaec"] * 2
    logs = mk(rows, with_id=False).withColumn("event_id", F.lit(None).cast("long"))
    assert {detect.detect_brute_force(logs.repartition(n)).first().user_agent for n in (1, 3, 5)} == {"a"}


def test_timeline_is_open_unless_bounded(mk):
    t = analyze.threat_timeline(mk([row(), row(ts=dt.datetime(2031, 5, 6)), row(ts=dt.datetime(2001, 5, 6))]))
    assert V.timeline_range(t).count() == 3
    assert V.timeline_range(t, "20230101").count() == 2 and V.timeline_range(t, "20230101", "20240101").count() == 1


def test_unpadded_times_are_normalised(spark):
    raw = spark.createDataFrame([("2024-1-2 3:4:5",), ("2024-13-2 3:4:5",), ("2024-01-02T03:04:05Z",)], "timestamp string")
    got = [r.timestamp for r in normalize_logs(raw).collect()]
    assert got == ["2024-01-02T03:04:05Z", "2024-13-2 3:4:5", "2024-01-02T03:04:05Z"]


def test_invalid_request_gets_no_recommendation(spark):
    empty = spark.createDataFrame([], "ip string, reputation_score int, total_historical_events long, attack_types_detected "
                                      "array<string>, active_alerts int, current_threat_score int, recent_attack_types array<string>, "
                                      "bytes_recent_alerts long, recommendation string, confidence double")
    got = {r.ip: r.recommendation for r in V.lookup_profiles(empty, spark.createDataFrame([(" ",), ("1.1.1.1",), ("9" * 46,)], "ip string")).collect()}
    assert got == {"": None, "1.1.1.1": "ALLOW", "9" * 46: None}


def test_alert_response_fields():
    got = serve.alert_response({"ip_source": "1.1.1.1", "bucket_time": TS, "threat_score": None, "user_agents": None})
    assert got["ipSource"] == "1.1.1.1" and got["threatScore"] == 0 and got["userAgents"] == []
    assert got["bucketTime"] == TS.isoformat() and len(got) == len(S.ALERT_COLUMNS) - 2


def test_cluster_needs_a_shared_checkpoint_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_a_forged_alert_is_served_as_well(mk):
    al = A.to_alerts(detect.detect_signatures(mk([row(**TOOL), row(ts=FAR, src="9.9.9.9", **TOOL)])))
    for as_of in (None, TS, TS + dt.timedelta(hours=1)):
        assert "9.9.9.9" in {r.ip_source for r in A.active_alerts(al, as_of=as_of).collect()}
