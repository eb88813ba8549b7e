"""Batch job driver: the four history jobs, each result persisted once.

Jobs run in order and a failing job does not stop the others (the status
of each is returned).  Derived tables (snapshot, attack index, timeline
range) are computed from the *written* outputs, which cuts lineage: a lost
executor re-runs tasks of the current stage only, never the whole history.
Writes use overwrite with Spark's commit protocol, so a job retried after a
failure replaces its partial output.
"""

from __future__ import annotations

import logging
import traceback

from pyspark.sql import DataFrame, SparkSession

from vigil.operators import analyze, detect
from vigil.operators import serving as V
from vigil.session import materialize

log = logging.getLogger(__name__)


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def job_reputation(spark: SparkSession, logs: DataFrame, out: str) -> None:
    _write(analyze.reputation_by_ip_logtype(logs), f"{out}/ip_reputation_by_type")
    _write(analyze.top_of(spark.read.parquet(f"{out}/ip_reputation_by_type")), f"{out}/top_malicious_ips")
    _write(V.reputation_snapshot(logs), f"{out}/ip_reputation")


def job_port_scan(spark: SparkSession, logs: DataFrame, out: str) -> None:
    _write(detect.detect_port_scan(logs), f"{out}/port_scans")


def job_attack_patterns(spark: SparkSession, logs: DataFrame, out: str) -> None:
    _write(detect.detect_attack_patterns(logs), f"{out}/attack_patterns")
    patterns = spark.read.parquet(f"{out}/attack_patterns")
    _write(analyze.attack_category_counts(patterns), f"{out}/attack_category_counts")
    _write(V.index_from_detections(patterns, spark.read.parquet(f"{out}/port_scans")), f"{out}/attack_index")


def job_volume_analysis(spark: SparkSession, logs: DataFrame, out: str) -> None:
    _write(analyze.volume_stats(logs), f"{out}/volume_analysis")
    _write(analyze.threat_timeline(logs), f"{out}/threat_timeline")


def job_alerts(spark: SparkSession, logs: DataFrame, out: str) -> None:
    """Alerts recomputed from history; both windowed detectors read one
    persisted 10-second rollup."""
    from vigil.operators import alerts as A

    _write(detect.window_rollup(logs), f"{out}/window_rollup")
    _write(A.all_alerts(logs, rollup=spark.read.parquet(f"{out}/window_rollup")), f"{out}/alerts")


def job_profiles(spark: SparkSession, logs: DataFrame, out: str) -> None:
    """The served profile table, derived from the written tables only.

    Range-partitioned and sorted by IP, so a lookup of one IP (``ip = x``,
    pushed to the scan) skips every file and row group whose min/max
    statistics exclude it."""
    # written first: range partitioning samples its input, which would run the joins twice
    fused = materialize(profiles_from_tables(spark, out), "profiles")
    _write(fused.repartitionByRange("ip").sortWithinPartitions("ip"), f"{out}/threat_profiles")


def profiles_from_tables(spark: SparkSession, out: str, score_col: str = "reputation_score") -> DataFrame:
    """Fused profiles from persisted snapshot, attack index and alerts."""
    from vigil.operators import alerts as A

    snap = spark.read.parquet(f"{out}/ip_reputation")
    types = V.attack_types_by_ip(spark.read.parquet(f"{out}/attack_index"))
    speed = A.speed_summary(spark.read.parquet(f"{out}/alerts"))
    return V.threat_profiles(snap, types, speed, score_col)


JOBS = [
    ("top_malicious_ips", job_reputation),
    ("port_scan", job_port_scan),
    ("attack_patterns", job_attack_patterns),
    ("volume_analysis", job_volume_analysis),
]
# serving-side tables, after the four history jobs (profiles need their output)
SERVING_JOBS = [
    ("alerts", job_alerts),
    ("threat_profiles", job_profiles),
]


#: Jobs whose tables of the same run a job reads.
NEEDS = {"attack_patterns": ("port_scan",), "threat_profiles": ("top_malicious_ips", "attack_patterns", "alerts")}


def run_all(spark: SparkSession, logs: DataFrame, out: str, jobs=None, serving: bool = False) -> dict[str, str]:
    """Run the jobs in order; returns ``{job: "ok" | "skipped: ..." | error text}``.

    A job runs only if the jobs that it needs succeeded in this run, so it
    never mixes in tables of an earlier run; its own earlier tables then stay
    as they were.  Jobs left out by ``jobs`` count as done before."""
    status = {}
    for name, fn in JOBS + (SERVING_JOBS if serving else []):
        if jobs and name not in jobs:
            continue
        missing = [n for n in NEEDS.get(name, ()) if status.get(n, "ok") != "ok"]
        if missing:
            status[name] = f"skipped: {', '.join(missing)} did not succeed"
            continue
        try:
            fn(spark, logs, out)
            status[name] = "ok"
        except Exception as e:  # noqa: BLE001 - keep going with the next job
            log.error("job %s failed: %s", name, e)
            status[name] = f"failed: {e}\n{traceback.format_exc(limit=3)}"
    return status
