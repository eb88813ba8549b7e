"""Served tables and the fused threat profile.

The original system keeps three key/value tables filled by per-row puts from
the driver and answers one IP at a time.  Here each table is a keyed
DataFrame computed for *all* keys at once (one row per key, "last write
wins" replaced by a real aggregation), and the profile is one plan over all
IPs that a caller filters by IP.  Nothing is collected to the driver.

Every per-IP input of the profile is already aggregated to one row per IP,
so the full outer joins below move at most (#IPs x few columns) and reuse
the hash partitioning of the aggregations that produced them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import schema as S
from vigil.functions import scoring
from vigil.operators import detect


def _empty_strings():
    return F.array().cast("array<string>")


def reputation_snapshot(logs: DataFrame) -> DataFrame:
    """One row per source IP over its malicious and suspicious events."""
    lab = F.col("threat_label")
    return (
        logs.filter(lab.isin("malicious", "suspicious"))
        .groupBy("source_ip")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("dest_ip").alias("unique_targets"),
            F.sum("bytes_transferred").alias("total_bytes"),
            F.count_if(lab == "malicious").alias("malicious_count"),
            F.count_if(lab == "suspicious").alias("suspicious_count"),
            F.array_sort(F.collect_set("log_type")).alias("log_types"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
        .withColumns(
            {
                "reputation_score": scoring.reputation_score(),
                "reputation_score_norm": scoring.reputation_score_norm(),
            }
        )
    )


def attack_type_index(logs: DataFrame) -> DataFrame:
    """``(attack_type, source_ip) -> count, last_seen`` over the batch detectors.

    Signature matches are indexed under their real category with their event
    count; port scans keep the largest number of targets over all windows.
    """
    return index_from_detections(detect.detect_attack_patterns(logs), detect.detect_port_scan(logs))


def index_from_detections(attack_patterns: DataFrame, port_scans: DataFrame) -> DataFrame:
    """The attack index from already computed (e.g. persisted) detector outputs."""
    patterns = (
        attack_patterns
        .groupBy(F.col("attack_category").alias("attack_type"), "source_ip")
        .agg(F.count(F.lit(1)).alias("count"), F.max("timestamp").alias("last_seen"))
    )
    scans = (
        port_scans
        .groupBy("source_ip")
        .agg(F.max("distinct_targets").alias("count"), F.max("window_end").alias("last_seen"))
        .select(F.lit("PORT_SCAN").alias("attack_type"), "source_ip", "count", "last_seen")
    )
    return patterns.unionByName(scans)


def attack_types_by_ip(index: DataFrame, known=None) -> DataFrame:
    """Sorted set of recognised attack types per IP (at most len(known) items)."""
    known = known or S.KNOWN_ATTACK_TYPES
    return (
        index.filter(F.col("attack_type").isin(*known))
        .groupBy(F.col("source_ip").alias("ip"))
        .agg(F.array_sort(F.collect_set("attack_type")).alias("attack_types"))
    )


def timeline_range(timeline: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Hourly rows of whole days ``date_from``..``date_to`` (both inclusive, an
    absent bound is open), two-digit hours and a ``"yyyyMMdd HHh"`` chart label."""
    hour = F.lpad(F.col("event_hour").cast("string"), 2, "0")
    if date_from:
        timeline = timeline.filter(F.col("event_date") >= date_from)
    if date_to:
        timeline = timeline.filter(F.col("event_date") <= date_to)
    return timeline.select(
        F.col("event_date").alias("date"),
        hour.alias("hour"),
        F.coalesce(F.col("malicious_count"), F.lit(0)).alias("malicious"),
        F.coalesce(F.col("suspicious_count"), F.lit(0)).alias("suspicious"),
        F.coalesce(F.col("benign_count"), F.lit(0)).alias("benign"),
        F.concat(F.col("event_date"), F.lit(" "), hour, F.lit("h")).alias("label"),
    )


def global_stats(snapshot: DataFrame, score_col: str = "reputation_score",
                 threshold: int = S.HIGH_RISK_SCORE) -> DataFrame:
    """One row: IPs analysed and IPs whose score exceeds ``threshold``."""
    return snapshot.agg(
        F.count(F.lit(1)).alias("total_ips_analyzed"),
        F.count_if(F.col(score_col) > threshold).alias("high_risk_ips"),
    )


def threat_profiles(snapshot: DataFrame, types_by_ip: DataFrame, speed: DataFrame,
                    score_col: str = "reputation_score", ips: DataFrame | None = None) -> DataFrame:
    """Batch reputation + batch attack types + live alert summary for every
    IP known to either side; missing sides are zero-filled.  With ``ips``, a
    list of all of them, the sides are joined to it, which keeps its partitioning."""
    batch = snapshot.select(
        F.col("source_ip" if "source_ip" in snapshot.columns else "ip").alias("ip"),
        F.col(score_col).cast("int").alias("_score"),
        F.col("total_events").alias("_events"),
        F.col("first_seen"),
        F.col("last_seen").alias("last_batch_update"),
    )
    if ips is None:
        fused = batch.join(types_by_ip, "ip", "full").join(speed, "ip", "full")
    else:
        fused = ips.join(batch, "ip", "left").join(types_by_ip, "ip", "left").join(speed, "ip", "left")
    score = F.coalesce(F.col("_score"), F.lit(0))
    alerts_n = F.coalesce(F.col("active_alerts"), F.lit(0))
    speed_score = F.coalesce(F.col("current_threat_score"), F.lit(0))
    return fused.select(
        "ip",
        score.alias("reputation_score"),
        F.coalesce(F.col("_events"), F.lit(0).cast("long")).alias("total_historical_events"),
        F.coalesce(F.col("attack_types"), _empty_strings()).alias("attack_types_detected"),
        "first_seen",
        "last_batch_update",
        alerts_n.alias("active_alerts"),
        "last_seen",
        speed_score.alias("current_threat_score"),
        F.coalesce(F.col("recent_attack_types"), _empty_strings()).alias("recent_attack_types"),
        F.coalesce(F.col("bytes_recent_alerts"), F.lit(0).cast("long")).alias("bytes_recent_alerts"),
        scoring.recommendation(score, alerts_n).alias("recommendation"),
        scoring.confidence(score, speed_score).alias("confidence"),
    )


def profile_documents(profiles: DataFrame) -> DataFrame:
    """Nested document form: ``batch_layer`` and ``speed_layer`` structs."""
    return profiles.select(
        "ip",
        F.struct(
            F.col("reputation_score").alias("reputationScore"),
            F.col("total_historical_events").alias("totalHistoricalEvents"),
            F.col("attack_types_detected").alias("attackTypesDetected"),
            F.col("first_seen").alias("firstSeen"),
            F.col("last_batch_update").alias("lastBatchUpdate"),
        ).alias("batch_layer"),
        F.struct(
            F.col("active_alerts").alias("activeAlerts"),
            F.col("last_seen").alias("lastSeen"),
            F.col("current_threat_score").alias("currentThreatScore"),
            F.col("recent_attack_types").alias("recentAttackTypes"),
            F.col("bytes_recent_alerts").alias("bytesRecentAlerts"),
        ).alias("speed_layer"),
        "recommendation",
        "confidence",
    )


def lookup_profiles(profiles: DataFrame, requests: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Answer a table of requested IPs: trimmed text, ``valid`` when 1..45
    characters, unknown IPs get the zero-filled profile (ALLOW, 0.0); an
    invalid request gets no recommendation."""
    req = requests.select(F.trim(F.col(ip_col)).alias("ip")).withColumn(
        "valid", (F.length("ip") > 0) & (F.length("ip") <= S.MAX_IP_TEXT_LENGTH)
    )
    joined = req.join(profiles, "ip", "left")
    zero = {
        "reputation_score": F.lit(0),
        "total_historical_events": F.lit(0).cast("long"),
        "attack_types_detected": _empty_strings(),
        "active_alerts": F.lit(0),
        "current_threat_score": F.lit(0),
        "recent_attack_types": _empty_strings(),
        "bytes_recent_alerts": F.lit(0).cast("long"),
        "recommendation": F.lit("ALLOW"),
        "confidence": F.lit(0.0),
    }
    filled = {k: F.coalesce(F.col(k), v) for k, v in zero.items()}
    filled["recommendation"] = F.when(F.col("valid"), filled["recommendation"])
    return joined.withColumns(filled)
