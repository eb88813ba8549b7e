"""Read-side requests over the tables written by ``jobs.run_all(serving=True)``.

Each function answers one request of the original service (profile of an IP,
active alerts, global stats, timeline) from persisted tables, so the cost is
a pruned scan of a small table rather than a recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schema as S
from vigil.operators import alerts as A
from vigil.operators import serving as V


ZERO_PROFILE = {
    "reputation_score": 0, "total_historical_events": 0, "attack_types_detected": [], "first_seen": None,
    "last_batch_update": None, "active_alerts": 0, "last_seen": None, "current_threat_score": 0,
    "recent_attack_types": [], "bytes_recent_alerts": 0, "recommendation": "ALLOW", "confidence": 0.0,
}


def _iso(v):
    return v.isoformat() if hasattr(v, "isoformat") else v


def service_response(profile: dict) -> dict:
    """A flat profile row in the original service's response shape (nested
    ``batchLayer`` / ``speedLayer``; ``bytes_recent_alerts`` is served under
    its original key ``bytesLastHour``)."""
    p = profile
    return {
        "ip": p["ip"],
        "batchLayer": {
            "reputationScore": p["reputation_score"],
            "totalHistoricalEvents": p["total_historical_events"],
            "attackTypesDetected": list(p["attack_types_detected"] or []),
            "firstSeen": _iso(p["first_seen"]),
            "lastBatchUpdate": _iso(p["last_batch_update"]),
        },
        "speedLayer": {
            "activeAlerts": p["active_alerts"],
            "lastSeen": _iso(p["last_seen"]),
            "currentThreatScore": p["current_threat_score"],
            "recentAttackTypes": list(p["recent_attack_types"] or []),
            "bytesLastHour": p["bytes_recent_alerts"],
        },
        "recommendation": p["recommendation"],
        "confidence": p["confidence"],
    }


def _served(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table of the run that is published now."""
    from vigil.plans.publish import served_folder

    return spark.read.parquet(f"{served_folder(spark, out)}/{table}")


def profile_of(spark: SparkSession, out: str, ip: str) -> DataFrame:
    """Rows of the served profile table for one IP (0 or 1 row).  The equality
    is pushed to the scan; the table is range-partitioned and sorted by IP."""
    return _served(spark, out, "threat_profiles").filter(F.col("ip") == ip.strip())


def profile_document(spark: SparkSession, out: str, ip: str) -> dict:
    """One request: the profile of ``ip`` as a dict, zero-filled when unknown.
    Text that is empty or longer than 45 characters is rejected."""
    ip = ip.strip()
    if not ip or len(ip) > S.MAX_IP_TEXT_LENGTH:
        raise ValueError("invalid IP address")
    rows = profile_of(spark, out, ip).limit(1).collect()  # at most one row
    return rows[0].asDict(recursive=True) if rows else dict(ZERO_PROFILE, ip=ip)


def lookup_many(spark: SparkSession, out: str, requests: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Batch of requests (a DataFrame of IPs) answered with one join."""
    return V.lookup_profiles(_served(spark, out, "threat_profiles"), requests, ip_col)


def active_alerts_of(spark: SparkSession, out: str, limit: int = S.ACTIVE_ALERTS_LIMIT) -> DataFrame:
    return A.active_alerts(_served(spark, out, "alerts"), limit=limit)


def global_stats_of(spark: SparkSession, out: str, score_col: str = "reputation_score") -> DataFrame:
    return V.global_stats(_served(spark, out, "ip_reputation"), score_col)


def timeline_of(spark: SparkSession, out: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Hourly rows in key order (date, then hour)."""
    return V.timeline_range(_served(spark, out, "threat_timeline"), date_from, date_to).orderBy("date", "hour")


class ServedTables:
    """Open handles on the served tables, as a long-running service keeps them.

    Opening lists the files once (later requests reuse the file index) and
    fixes "now" for the alert TTL: ``as_of`` when given, else the newest
    believable alert time (one scalar, see ``alerts.within_ttl``).
    The tables are those of one published run (``publish``); re-open to see a
    later one.
    """

    def __init__(self, spark: SparkSession, out: str, as_of=None):
        from vigil.plans.publish import served_folder

        self.spark = spark
        out = served_folder(spark, out)  # the run that is published now, until re-opened
        self.profiles = spark.read.parquet(f"{out}/threat_profiles")
        self.alerts = spark.read.parquet(f"{out}/alerts")
        self.snapshot = spark.read.parquet(f"{out}/ip_reputation")
        self.timeline_table = spark.read.parquet(f"{out}/threat_timeline")
        limit = (F.current_timestamp() + F.expr(f"INTERVAL {S.CLOCK_TOLERANCE}")).cast("timestamp_ntz")
        self.as_of = as_of or self.alerts.filter(F.col("bucket_time") <= limit).agg(F.max("bucket_time")).first()[0]

    def profile(self, ip: str) -> dict:
        ip = ip.strip()
        if not ip or len(ip) > S.MAX_IP_TEXT_LENGTH:
            raise ValueError("invalid IP address")
        rows = self.profiles.filter(F.col("ip") == ip).limit(1).collect()
        return rows[0].asDict(recursive=True) if rows else dict(ZERO_PROFILE, ip=ip)

    def active_alerts(self, limit: int = S.ACTIVE_ALERTS_LIMIT) -> DataFrame:
        return A.active_alerts(self.alerts, as_of=self.as_of, limit=limit)

    def global_stats(self, score_col: str = "reputation_score") -> DataFrame:
        return V.global_stats(self.snapshot, score_col)

    def timeline(self, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        """Hourly rows in key order (date, then hour), as a range scan returns them."""
        return V.timeline_range(self.timeline_table, date_from, date_to).orderBy("date", "hour")


def _service_name(column: str) -> str:
    """Column name in the service's spelling: words joined, all but the first capitalised."""
    head, *rest = column.split("_")
    return head + "".join(w.capitalize() for w in rest)


def _service_value(field: T.StructField, value):
    if isinstance(field.dataType, T.ArrayType):
        return [] if value is None else [*value]
    if isinstance(field.dataType, T.IntegralType):
        return 0 if value is None else value
    return _iso(value)


#: The window bounds are internal to the detectors and not part of the service's record.
_SERVED_ALERT = [f for f in S.ALERT_SCHEMA.fields if not f.name.startswith("window_")]


def alert_response(alert: dict) -> dict:
    """An alert row as the service spells it: every served field by its type's rule for absent values."""
    return {_service_name(f.name): _service_value(f, alert.get(f.name)) for f in _SERVED_ALERT}


def stats_response(stats: dict) -> dict:
    return {"source": "batch_layer", **{k: stats[k] for k in ("total_ips_analyzed", "high_risk_ips")}}


def timeline_response(row: dict) -> dict:
    return {k: row[k] for k in ("date", "hour", "malicious", "suspicious", "benign")}
