import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from conftest import TS, row
from vigil import schema as S
from vigil.sources import logs as L
from vigil.sources import messages as M

HEADER = ",".join(S.LOG_COLUMNS)


def _csv(lines):
    d = tempfile.mkdtemp(prefix="vigil-test-csv-")
    p = os.path.join(d, "logs.csv")
    with open(p, "w") as f:
        f.write(HEADER + "\n" + "\n".join(lines) + "\n")
    return p


def test_csv_quarantine(spark):
    p = _csv([
        "2024-01-02 03:04:05,10.0.0.1,192.168.0.1,TCP,blocked,malicious,firewall,512,\"Mozilla/5.0 (X11; Linux)\",/a",
        "2023-13-45 00:00:00,10.0.0.2,192.168.0.1,TCP,blocked,malicious,firewall,1,x,/b",
        "2024-01-02 03:04:05,10.0.0.3,192.168.0.1,TCP,blocked,malicious,firewall,abc,x,/c",
        "2024-01-02 03:04:05,,192.168.0.1,TCP,blocked,malicious,firewall,5,x,/d",
        "2024-01-02 03:04:06,10.0.0.5,192.168.0.1,TCP,allowed,benign,ids,,,",
    ])
    good, bad = L.read_csv_logs(spark, p)
    g = sorted(good.collect(), key=lambda r: r["source_ip"])
    assert [r["source_ip"] for r in g] == ["10.0.0.1", "10.0.0.5"]
    assert g[0]["user_agent"] == "Mozilla/5.0 (X11; Linux)" and g[0]["timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert g[1]["bytes_transferred"] is None and g[1]["request_path"] is None
    reasons = sorted(r["reject_reason"] for r in bad.collect())
    assert reasons == ["malformed", "malformed", "missing:source_ip"]


def test_partitioned_roundtrip_and_pruning(spark, mk):
    rows = [row(ts=dt.datetime(2024, 1, d, 5)) for d in (1, 2, 3, 9)]
    out = tempfile.mkdtemp(prefix="vigil-test-parquet-")
    L.write_logs(L.add_date_partitions(mk(rows, with_id=False)), out)
    assert sorted(os.listdir(os.path.join(out, "year=2024", "month=01"))) == [
        "day=01", "day=02", "day=03", "day=09"]
    back = L.read_logs(spark, out, "20240102", "20240103")
    assert back.columns == S.LOG_COLUMNS and back.count() == 2
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    keep = L.read_logs(spark, out, keep_partitions=True)
    assert dict(keep.dtypes)["month"] == "string"
    assert sorted(r["month"] + r["day"] for r in keep.collect()) == ["0101", "0102", "0103", "0109"]


def test_replace_days_keeps_history(spark, mk):
    out = tempfile.mkdtemp(prefix="vigil-test-parquet-")
    L.write_logs(mk([row(ts=dt.datetime(2024, 1, 1, 5)), row(ts=dt.datetime(2024, 1, 2, 5))], with_id=False), out)
    L.write_logs(mk([row(ts=dt.datetime(2024, 1, 2, 6))] * 3, with_id=False), out, replace="days")
    assert L.read_logs(spark, out).count() == 4


def test_csv_lines_roundtrip(mk):
    logs = mk([row(agent='a,"b"', path=None), row(nbytes=None)], with_id=False)
    good, bad = L.parse_csv_lines(L.to_csv_lines(logs))
    assert bad.count() == 0
    assert sorted(map(tuple, good.collect()), key=str) == sorted(map(tuple, logs.collect()), key=str)


def test_json_parse_junk_and_bad_field(spark):
    raw = spark.createDataFrame([
        ('{"timestamp":"2024-01-01T00:00:07Z","source_ip":"1.1.1.1","bytes_transferred":12}',),
        ("not json",),
        ('{"timestamp":"2024-01-01 00:00:08","source_ip":"2.2.2.2","bytes_transferred":"x"}',),
        ('{"timestamp":"2024-01-01T00:00:09.250Z","source_ip":"3.3.3.3"}',),
        ('{"dest_ip":"9.9.9.9"}',),
    ], "value string")
    got = {r["source_ip"]: r for r in M.parse_json_logs(raw).collect()}
    assert set(got) == {"1.1.1.1", "2.2.2.2", "3.3.3.3"}
    assert got["1.1.1.1"]["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 7) and got["1.1.1.1"]["bytes_transferred"] == 12
    assert got["2.2.2.2"]["bytes_transferred"] is None
    assert got["3.3.3.3"]["timestamp"] == dt.datetime(2024, 1, 1, 0, 0, 9, 250000)


def test_normalize(spark):
    raw = spark.createDataFrame([
        ("2024-01-01 00:00:07", "12", None, "/x"),
        ("2024-01-01T00:00:08", "1.5", "", ""),
        ("bad time", " 7 ", "curl", None),
        ("", "", "a", "b"),
        ("2024-01-01 00:00:09", "+1_000", "x", "/y"),
        ("2024-01-01 00:00:10", "1__0", "x", "/y"),
    ], "timestamp string, bytes_transferred string, user_agent string, request_path string")
    now = F.lit("2030-05-06 07:08:09").cast("timestamp")
    got = M.normalize_logs(raw, now=now).collect()
    assert [r["timestamp"] for r in got][:4] == ["2024-01-01T00:00:07Z", "2024-01-01T00:00:08Z", "bad time",
                                                 "2030-05-06T07:08:09Z"]
    assert [r["bytes_transferred"] for r in got] == [12, 0, 7, 0, 1000, 0]
    assert [r["user_agent"] for r in got][:4] == ["", "", "curl", "a"]
    assert [r["request_path"] for r in got][:4] == ["/x", "/", "/", "b"]
    assert {r["source_ip"] for r in got} == {"0.0.0.0"} and {r["log_type"] for r in got} == {"firewall"}


def test_encode_messages_roundtrip(mk):
    logs = mk([row(log_type="ids"), row(log_type="application", agent=None), row(log_type="vpn")])
    enc = M.encode_messages(logs).collect()
    assert sorted((r["key"], r["partition"]) for r in enc) == [("application", 2), ("ids", 1), ("vpn", 0)]
    assert '"timestamp":"2023-10-15T14:00:00Z"' in enc[0]["value"] and '"user_agent":null' in enc[1]["value"]
    back = M.parse_json_logs(M.encode_messages(logs))
    assert back.count() == 3 and back.filter(F.col("timestamp") == F.lit(TS)).count() == 3


def test_split_messages_stay_by_type_and_source(mk):
    types = ["firewall", "ids", "application"]
    logs = mk([row(log_type=types[i % 3], src=f"10.0.0.{i % 40}", dst=f"10.1.0.{i}") for i in range(240)])
    sent = M.encode_messages(logs, split=8).select("key", "partition", F.get_json_object("value", "$.source_ip").alias("ip")).collect()
    assert {r["key"] for r in sent} == set(types) and len({r["partition"] for r in sent}) > 15
    assert all(r["partition"] // 8 == S.MESSAGE_PARTITIONS[r["key"]] for r in sent)
    assert len({(r["key"], r["ip"], r["partition"]) for r in sent}) == len({(r["key"], r["ip"]) for r in sent})
    flood = mk([row(log_type="ids", src="10.0.0.1", dst=f"10.1.0.{i}") for i in range(200)])
    spread = M.encode_messages(flood, split=8, split_by=("source_ip", "dest_ip")).groupBy("partition").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 2 * 200 / 8


def test_files_per_day_bounds_files(spark, mk):
    out = tempfile.mkdtemp(prefix="vigil-test-parquet-")
    rows = [row(ts=dt.datetime(2024, 1, 1 + i % 2, 5), src=f"10.0.{i % 7}.{i}") for i in range(200)]
    L.write_logs(mk(rows, with_id=False), out, files_per_day=3)
    for day in ("day=01", "day=02"):
        files = [f for f in os.listdir(os.path.join(out, "year=2024", "month=01", day)) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 3
    assert L.read_logs(spark, out).count() == 200


def test_csv_inferred_schema_binds_by_name(spark):
    d = tempfile.mkdtemp(prefix="vigil-test-csv-")
    p = os.path.join(d, "logs.csv")
    cols = ["source_ip", "timestamp", "dest_ip", "protocol", "action", "threat_label", "log_type",
            "bytes_transferred"]  # reordered, no agent/path columns
    with open(p, "w") as f:
        f.write(",".join(cols) + "\n")
        f.write("10.0.0.1,2024-01-02 03:04:05,192.168.0.1,TCP,blocked,malicious,firewall,512\n")
        f.write("10.0.0.2,2024-01-02 03:04:06,192.168.0.1,TCP,blocked,malicious,firewall,x12\n")
    good, bad = L.read_csv_logs(spark, p, infer_schema=True)
    g = good.collect()
    assert good.columns == S.LOG_COLUMNS and len(g) == 1
    assert g[0]["source_ip"] == "10.0.0.1" and g[0]["timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert g[0]["bytes_transferred"] == 512 and g[0]["user_agent"] is None
    assert [r["reject_reason"] for r in bad.collect()] == ["malformed"]


def test_compress_time_integral_micros(spark):
    from vigil.functions.timecols import compress_time

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0),), (dt.datetime(2024, 1, 2, 0, 0, 0, 999),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(compress_time("ts", "2024-01-01 00:00:00", 10000)).collect()]
    # one day + 999 us = 86,400,000,999 us -> 8,640,000 us after integer division
    assert got == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 8, 640000)]


def test_ingest_parses_once_and_rebalances_days(spark, tmp_path, mk):
    from vigil.sources import logs as L

    src = tmp_path / "in.csv"
    good = "2024-01-0{d} 00:00:0{i},1.1.1.{i},2.2.2.2,TCP,allowed,benign,ids,5,agent,/p"
    lines = [good.format(d=d, i=i) for d in (1, 2) for i in range(5)] + ["bad time,1.1.1.1,2.2.2.2,TCP,allowed,benign,ids,5,a,/p"]
    src.write_text("\n".join([",".join(S.LOG_COLUMNS), *lines]))
    done = L.ingest_csv(spark, str(src), str(tmp_path / "logs"))
    assert (done["accepted"], done["rejected"]) == (10, 1)
    days = sorted(p for p in (tmp_path / "logs").rglob("*.parquet"))
    assert len(days) == 2  # a small day is one file
    assert L.read_logs(spark, str(tmp_path / "logs")).count() == 10
    assert [r.reject_reason for r in spark.read.parquet(done["quarantine"]).collect()] == ["malformed"]
    plan = mk([row()]).transform(L.add_date_partitions).hint("rebalance", *S.PARTITION_COLUMNS)._jdf.queryExecution().toString()
    assert "RebalancePartitions" in plan
