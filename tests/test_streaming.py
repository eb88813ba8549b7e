import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import TS, row
from vigil import schema as S
from vigil.operators import alerts as A
from vigil.streaming import detectors as D

SCHEMA = T.StructType(S.LOG_SCHEMA.fields + [T.StructField("event_id", T.LongType(), True)])


def _write_files(spark, batches):
    """One Parquet file per batch, written in order (file source order)."""
    d = tempfile.mkdtemp(prefix="vigil-test-stream-")
    eid = 0
    for i, rows in enumerate(batches):
        data = []
        for r in rows:
            data.append(tuple(r) + (eid,))
            eid += 1
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(os.path.join(d, f"part{i:03d}"))
    return d


def _source(spark, d, **kw):
    return D.parquet_log_source(spark, f"{d}/part*", schema=SCHEMA, **kw)


def _mixed_rows():
    rows = [row(ts=TS + dt.timedelta(seconds=i)) for i in range(8)]
    rows += [row(src="10.0.0.2", agent="Mozilla", path="/s?q=<script>", ts=TS + dt.timedelta(seconds=3))]
    rows += [row(src="10.0.0.3", action="allowed", nbytes=11 * 1048576, agent="", ts=TS + dt.timedelta(seconds=1))]
    return rows


def test_stream_equals_static(spark):
    d = _write_files(spark, [_mixed_rows()[:5], _mixed_rows()[5:]])
    sinks = D.run_until_caught_up(spark, _source(spark, d, max_files_per_trigger=1), watermark=None)
    static = A.all_alerts(spark.read.schema(SCHEMA).parquet(f"{d}/part*"))
    streamed = None
    for name, path in sinks.items():
        part = D.read_alerts(spark, path)
        streamed = part if streamed is None else streamed.unionByName(part)
    key = lambda r: r["alert_id"]
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, static.collect()), key=str)
    assert {r["alert_type"] for r in streamed.collect()} == {"BRUTE_FORCE", "KNOWN_ATTACK_TOOL", "XSS_DETECTED",
                                                            "VOLUME_ANOMALY"}
    del key


def test_update_mode_revisions_keep_latest(spark):
    d = _write_files(spark, [[row(ts=TS + dt.timedelta(seconds=i)) for i in range(6)],
                             [row(ts=TS + dt.timedelta(seconds=10 + i)) for i in range(3)]])
    sinks = D.run_until_caught_up(spark, _source(spark, d, max_files_per_trigger=1), ["brute_force"], watermark=None)
    raw = spark.read.parquet(sinks["brute_force"]).collect()
    assert sorted(r["event_count"] for r in raw) == [6, 9]  # two revisions of one window
    latest = D.read_alerts(spark, sinks["brute_force"]).collect()
    assert len(latest) == 1 and latest[0]["event_count"] == 9 and latest[0]["threat_score"] == 78


def test_late_rows_dropped_only_with_watermark(spark):
    late = [row(ts=TS + dt.timedelta(seconds=i)) for i in range(7)]
    # the detector's filter is pushed below the watermark, so only blocked
    # events advance event time: batch 0 moves it 30 minutes ahead.  Late
    # rows are filtered with the previous batch's watermark, hence the
    # extra batch before the late one.
    ahead = [row(src="10.9.9.9", ts=TS + dt.timedelta(minutes=30))]
    batches = [ahead, [row(src="10.9.9.8", ts=TS + dt.timedelta(minutes=31))], late]
    d = _write_files(spark, batches)
    with_wm = D.run_until_caught_up(spark, _source(spark, d, max_files_per_trigger=1), ["brute_force"],
                                    watermark="1 minute")
    assert D.read_alerts(spark, with_wm["brute_force"]).count() == 0
    without = D.run_until_caught_up(spark, _source(spark, d, max_files_per_trigger=1), ["brute_force"],
                                    watermark=None)
    assert D.read_alerts(spark, without["brute_force"]).count() == 1


def test_batch_writer_is_idempotent(spark, mk):
    from vigil.operators import detect

    out = tempfile.mkdtemp(prefix="vigil-test-sink-")
    w = D.AlertBatchWriter(out)
    batch = detect.detect_brute_force(mk([row()] * 7))
    w(batch, 0)
    w(batch, 0)  # retried micro-batch
    assert spark.read.parquet(out).count() == 1
    assert D.read_alerts(spark, out).first()["event_count"] == 7


def test_read_alerts_empty_sink(spark):
    assert D.read_alerts(spark, tempfile.mkdtemp(prefix="vigil-test-empty-") + "/none").count() == 0


def test_json_file_stream(spark):
    d = tempfile.mkdtemp(prefix="vigil-test-json-")
    lines = ['{"timestamp":"2024-01-01T00:00:0%dZ","source_ip":"1.1.1.1","action":"blocked","log_type":"ids",'
             '"bytes_transferred":1}' % i for i in range(7)] + ["junk"]
    with open(os.path.join(d, "m.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    sinks = D.run_until_caught_up(spark, D.json_file_source(spark, d), ["brute_force"], watermark=None)
    got = D.read_alerts(spark, sinks["brute_force"]).collect()
    assert len(got) == 1 and got[0]["event_count"] == 7 and got[0]["log_sources"] == ["ids"]
    assert got[0]["window_start"] == dt.datetime(2024, 1, 1)
    assert F is not None


def test_stream_port_scan_exact_distinct_across_batches(spark):
    from vigil.operators import detect

    scan = [row(src="192.168.1.99", dst=f"10.0.0.{i}", proto="TCP", label="suspicious",
                ts=TS + dt.timedelta(seconds=i)) for i in range(15)]
    more = [row(src="192.168.1.99", dst=f"10.0.0.{i}", proto="TCP", label="suspicious",
                ts=TS + dt.timedelta(seconds=30 + i)) for i in range(10, 25)]  # 5 repeats, 10 new
    d = _write_files(spark, [scan, more])
    sinks = D.run_until_caught_up(spark, _source(spark, d, max_files_per_trigger=1), ["port_scan"], watermark=None)
    got = D.read_detections(spark, sinks["port_scan"]).collect()
    static = detect.detect_port_scan(spark.read.schema(SCHEMA).parquet(f"{d}/part*")).collect()
    assert len(got) == 1 and got[0]["distinct_targets"] == 25 == static[0]["distinct_targets"]
    assert got[0]["threat_score"] == static[0]["threat_score"] == 65


def test_port_scan_flood_on_one_window_spreads_over_the_state(spark):
    """One source in one window: the targets seen are state of all partitions,
    and what meets by (source, window) is one partial count a partition."""
    from vigil.operators import detect

    flood = [row(src="192.168.1.99", dst=f"10.{i % 7}.{i // 250}.{i % 250}", proto="TCP", ts=TS) for i in range(2000)]
    d = _write_files(spark, [flood, flood[:500] + flood])
    sink, checkpoint = (tempfile.mkdtemp(prefix="vigil-test-flood-") for _ in range(2))
    counted = detect.detect_port_scan_stream(_source(spark, d, max_files_per_trigger=1))
    query = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True) \
        .foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{sink}/b={n}")).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    query.stop()
    counts = [r["distinct_targets"] for r in spark.read.parquet(sink).orderBy("b").collect()]
    targets = len({r[1] for r in [(x["source_ip"], x["dest_ip"]) for x in spark.read.parquet(f"{d}/part*").collect()]})
    assert counts and counts[-1] == targets
    assert "partial_count" in plan  # counted where the targets lie, before the exchange by source and window
    stores = spark.read.format("statestore").load(checkpoint, operatorId=1)
    if "dest_ip" not in stores.select("key.*").columns:
        stores = spark.read.format("statestore").load(checkpoint, operatorId=0)
    held = sorted(r["count"] for r in stores.groupBy("partition_id").count().collect())
    assert sum(held) == targets and len(held) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert held[-1] <= 2 * held[len(held) // 2]


def test_published_messages_replay_through_json_stream(spark, mk):
    from vigil.operators import detect
    from vigil.sources import messages as M

    logs = mk([row(ts=TS + dt.timedelta(seconds=i), log_type=lt) for i, lt in
               enumerate(["ids", "firewall"] * 4)])
    out = tempfile.mkdtemp(prefix="vigil-test-pub-") + "/topic"
    M.write_messages(M.encode_messages(logs), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("partition=")) == ["partition=0", "partition=1"]
    sinks = D.run_until_caught_up(spark, D.json_file_source(spark, f"{out}/partition=*"), ["brute_force"],
                                  watermark=None)
    got = D.read_alerts(spark, sinks["brute_force"]).collect()
    want = A.to_alerts(detect.detect_brute_force(logs)).collect()
    assert [(r["event_count"], r["threat_score"], r["window_start"]) for r in got] == \
        [(r["event_count"], r["threat_score"], r["window_start"]) for r in want] == [(8, 76, TS)]


def test_compact_alerts_keeps_latest(spark):
    d = _write_files(spark, [[row(ts=TS + dt.timedelta(seconds=i)) for i in range(6)],
                             [row(ts=TS + dt.timedelta(seconds=10 + i)) for i in range(3)]])
    sinks = D.run_until_caught_up(spark, _source(spark, d, max_files_per_trigger=1), ["brute_force"], watermark=None)
    out = tempfile.mkdtemp(prefix="vigil-test-compact-") + "/alerts"
    got = D.compact_alerts(spark, sinks["brute_force"], out).collect()
    assert len(got) == 1 and got[0]["event_count"] == 9 and str(got[0]["alert_date"]) == "2023-10-15"


def test_concurrent_detectors_stop_on_any_termination(spark):
    d = _write_files(spark, [_mixed_rows()])
    work = tempfile.mkdtemp(prefix="vigil-test-conc-")
    qs = D.start_all(_source(spark, d), f"{work}/sink", f"{work}/ck", {"processingTime": "200 milliseconds"},
                     watermark=None)
    assert len(qs) == 3 and all(q.isActive for q in qs.values())
    for q in qs.values():
        q.processAllAvailable()
    qs["signatures"].stop()  # one query ends ...
    D.await_any(spark, qs)   # ... so the others are stopped too
    spark.streams.resetTerminated()
    assert not any(q.isActive for q in qs.values())
    assert D.read_alerts(spark, f"{work}/sink/brute_force").count() == 1


def test_restart_resumes_from_checkpoint(spark):
    from vigil.operators import detect

    d = tempfile.mkdtemp(prefix="vigil-test-restart-")
    first = [row(ts=TS + dt.timedelta(seconds=i)) for i in range(4)]
    second = [row(ts=TS + dt.timedelta(seconds=20 + i)) for i in range(4)]
    spark.createDataFrame([tuple(r) + (i,) for i, r in enumerate(first)], SCHEMA).coalesce(1) \
        .write.parquet(os.path.join(d, "part000"))
    work = tempfile.mkdtemp(prefix="vigil-test-restart-work-")

    def drain():
        q = D.start_detector(_source(spark, d), "brute_force", f"{work}/sink", f"{work}/ck",
                             {"availableNow": True}, watermark=None)
        q.awaitTermination()
        return q

    drain()
    assert D.read_alerts(spark, f"{work}/sink").count() == 0  # 4 blocked: below the threshold
    spark.createDataFrame([tuple(r) + (10 + i,) for i, r in enumerate(second)], SCHEMA).coalesce(1) \
        .write.parquet(os.path.join(d, "part001"))
    q = drain()  # same checkpoint: only the new file is read, the window state carries the first 4
    assert q.lastProgress["numInputRows"] == 4
    got = D.read_alerts(spark, f"{work}/sink").collect()
    static = detect.detect_brute_force(spark.read.schema(SCHEMA).parquet(f"{d}/part*")).collect()
    assert len(got) == 1 and got[0]["event_count"] == 8 == static[0]["event_count"]


def test_stream_port_scan_approximate_option(spark):
    from vigil.operators import detect

    scan = [row(src="192.168.1.99", dst=f"10.0.0.{i}", proto="TCP", label="suspicious",
                ts=TS + dt.timedelta(seconds=i)) for i in range(30)]
    d = _write_files(spark, [scan])
    q = (detect.detect_port_scan_stream(_source(spark, d), exact=False)
         .writeStream.outputMode("update").format("memory").queryName("approx_scan_test")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT distinct_targets, severity FROM approx_scan_test").collect()
    assert len(got) == 1 and abs(got[0]["distinct_targets"] - 30) <= 1 and got[0]["severity"] == "MEDIUM"


def test_read_detections_empty_sink(spark):
    assert D.read_detections(spark, tempfile.mkdtemp(prefix="vigil-test-empty-") + "/none").count() == 0


def test_duplicate_messages_give_one_alert_each(spark):
    d = tempfile.mkdtemp(prefix="vigil-test-dup-")
    line = ('{"timestamp":"2024-01-01T00:00:01Z","source_ip":"1.1.1.1","action":"allowed",'
            '"log_type":"ids","user_agent":"sqlmap/1.7","bytes_transferred":5}')
    with open(os.path.join(d, "m.json"), "w") as f:
        f.write(line + "\n" + line + "\n")
    sinks = D.run_until_caught_up(spark, D.json_file_source(spark, d), ["signatures"], watermark=None)
    got = D.read_alerts(spark, sinks["signatures"]).collect()
    assert len(got) == 2 and len({r["alert_id"] for r in got}) == 2
    assert {r["alert_type"] for r in got} == {"KNOWN_ATTACK_TOOL"}
