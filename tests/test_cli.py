import json
import os
import tempfile

from conftest import row

from vigil.__main__ import run
from vigil.sources import logs as L
from vigil.sources.events import load_logs

SF = "/root/testdata/sf0.001"


def test_cli_ingest_batch_publish_stream_profile(spark):
    work = tempfile.mkdtemp(prefix="vigil-test-cli-")
    # CSV produced from the driver data, then the whole command chain
    L.to_csv_lines(load_logs(spark, SF, 10000)).coalesce(1).write.text(f"{work}/csv")
    csv = [f for f in os.listdir(f"{work}/csv") if f.endswith(".txt")][0]
    with open(os.path.join(work, "csv", csv)) as f, open(f"{work}/logs.csv", "w") as g:
        g.write(",".join(L.S.LOG_COLUMNS) + "\n" + f.read())

    assert run(["ingest", "--csv", f"{work}/logs.csv", "--out", f"{work}/logs", "--quarantine", f"{work}/q"],
               spark)["dest"] == f"{work}/logs"
    assert L.read_logs(spark, f"{work}/logs").count() == 1000
    status = run(["batch", "--logs", f"{work}/logs", "--out", f"{work}/out", "--serving"], spark)
    assert set(status.values()) == {"ok"}
    run(["publish", "--logs", f"{work}/logs", "--out", f"{work}/topic"], spark)
    sinks = run(["stream", "--json-dir", f"{work}/topic/partition=*", "--sink", f"{work}/sink",
                 "--checkpoint", f"{work}/ck", "--watermark", "none", "--available-now"], spark)
    assert set(sinks) == {"brute_force", "signatures", "volume_anomaly"}
    ip = spark.read.parquet(f"{work}/out/threat_profiles").orderBy("ip").first()["ip"]
    doc = run(["profile", "--tables", f"{work}/out", "--ip", ip], spark)
    assert doc["ip"] == ip and json.dumps(doc)  # plain JSON types only
    assert set(doc) == {"ip", "batchLayer", "speedLayer", "recommendation", "confidence"}
    assert set(doc["speedLayer"]) == {"activeAlerts", "lastSeen", "currentThreatScore", "recentAttackTypes",
                                      "bytesLastHour"}
    unknown = run(["profile", "--tables", f"{work}/out", "--ip", "203.0.113.9"], spark)
    assert unknown["recommendation"] == "ALLOW" and unknown["batchLayer"]["reputationScore"] == 0

    alerts = run(["alerts", "--tables", f"{work}/out", "--limit", "5"], spark)
    assert len(alerts) == 5 and json.dumps(alerts)
    assert [a["threatScore"] for a in alerts] == sorted((a["threatScore"] for a in alerts), reverse=True)
    stats = run(["stats", "--tables", f"{work}/out"], spark)
    assert stats["total_ips_analyzed"] == 15 and stats["source"] == "batch_layer"
    tl = run(["timeline", "--tables", f"{work}/out"], spark)
    assert tl and [(t["date"], t["hour"]) for t in tl] == sorted((t["date"], t["hour"]) for t in tl)


def test_batch_atomic_is_served(spark, tmp_path, mk):
    from vigil.sources import logs as L

    L.write_logs(mk([row(action="blocked") for _ in range(8)], with_id=False), str(tmp_path / "logs"))
    status = run(["batch", "--logs", str(tmp_path / "logs"), "--out", str(tmp_path / "out"), "--serving", "--atomic"], spark)
    assert set(status.values()) == {"ok"} and not (tmp_path / "out" / "threat_profiles").exists()
    assert run(["profile", "--tables", str(tmp_path / "out"), "--ip", "10.0.0.1"], spark)["speedLayer"]["activeAlerts"] > 0
