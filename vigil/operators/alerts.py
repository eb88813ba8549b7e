"""Alert envelope and the read-side views over alerts.

``to_alerts`` turns any detector output into the common alert record.  The
alert id is a SHA-256 over (type, source, window start or event id), so a
re-run or a retried micro-batch produces the same id (idempotent upserts),
and revisions of one streaming window share the id.

Read-side views (active alerts, newest per IP, per-IP summary, dashboard
rollups) are ordinary aggregations and ranking windows.  Per-IP "newest N"
uses ``row_number() <= N``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so a hot IP ships at most N rows per
map task.  "Now" is a parameter (``as_of``); by default it is the newest
alert time, evaluated as a scalar subquery, never collected to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import schema as S
from vigil.functions import scoring
from vigil.functions.timecols import epoch_micros

LIVE = dt.timedelta(hours=24)  # S.ALERT_TTL
LONGEST_WINDOW = dt.timedelta(minutes=1)  # of the live detectors


def _or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))


def event_identity(events: DataFrame) -> Column:
    """Identity of an event as text: its event id, else its place in the source
    (``source_offset``), else a hash of its fields with an occurrence number,
    so that identical messages stay different alerts.

    The number needs a window, which streams don't allow; there the micro-batch
    writer maps each batch as a static frame."""
    cols = set(events.columns)
    own = [F.col(c).cast("string") for c in ("event_id", "source_offset") if c in cols]
    fields = F.sha2(F.to_json(F.struct(*[F.col(c) for c in S.LOG_COLUMNS if c in cols])), 256)
    known = F.coalesce(*own, F.lit(None).cast("string"))
    if events.isStreaming:
        return F.coalesce(known, fields)
    # events with an identity are their own group, so only equal nameless ones are numbered together
    number = F.row_number().over(Window.partitionBy(F.coalesce(known, fields)).orderBy("timestamp"))
    return F.coalesce(known, F.concat_ws("#", fields, number.cast("string")))


def to_alerts(detected: DataFrame) -> DataFrame:
    """Map detector rows (windowed or per-event) to the alert record."""
    cols = set(detected.columns)
    windowed = "window_start" in cols
    if windowed:
        bucket = F.col("window_end")
        identity = epoch_micros("window_start").cast("string")
        w_start, w_end = F.col("window_start"), F.col("window_end")
    else:
        bucket = F.col("timestamp")
        identity = event_identity(detected)
        w_start = w_end = F.lit(None).cast("timestamp_ntz")
    alert_type = F.col("alert_type") if "alert_type" in cols else F.col("attack_type")
    agent = F.col("user_agent") if "user_agent" in cols else F.lit(None).cast("string")
    log_type = F.col("log_type") if "log_type" in cols else F.lit(None).cast("string")
    # port scans count targets; a per-event alert counts one event
    count = next((F.col(c) for c in ("event_count", "distinct_targets") if c in cols), F.lit(1))
    nbytes = F.col("bytes_total") if "bytes_total" in cols else F.lit(0)
    return detected.select(
        F.col("source_ip").alias("ip_source"),
        bucket.alias("bucket_time"),
        F.sha2(F.concat_ws("|", alert_type, F.col("source_ip"), identity), 256).alias("alert_id"),
        bucket.alias("last_seen"),
        F.col("threat_score").cast("int").alias("threat_score"),
        F.array(alert_type).alias("attack_types"),
        alert_type.alias("alert_type"),
        F.col("severity"),
        count.cast("int").alias("event_count"),
        F.coalesce(nbytes.cast("long"), F.lit(0).cast("long")).alias("bytes_total"),
        F.array(_or_unknown(agent)).alias("user_agents"),
        F.array(_or_unknown(log_type)).alias("log_sources"),
        w_start.alias("window_start"),
        w_end.alias("window_end"),
    )


def all_alerts(logs: DataFrame, watermark: str | None = None, rollup: DataFrame | None = None) -> DataFrame:
    """Alerts of the three live detectors (brute force, signatures, volume).

    On a static table both windowed detectors come from one scan
    (``detect.detect_in_windows``), or from ``rollup``, a persisted
    ``detect.window_rollup`` of the same logs; on streams each detector runs
    on its own."""
    from vigil.operators import detect

    signatures = to_alerts(detect.detect_signatures(logs))
    if not logs.isStreaming and rollup is None:
        return to_alerts(detect.detect_in_windows(logs)).unionByName(signatures)
    if rollup is not None and not logs.isStreaming:
        brute = detect.brute_force_from_rollup(rollup)
        volume = detect.volume_from_rollup(rollup)
    else:
        brute = detect.detect_brute_force(logs, watermark=watermark)
        volume = detect.detect_volume_anomaly(logs, watermark=watermark)
    return to_alerts(brute).unionByName(signatures).unionByName(to_alerts(volume))


def latest_revision(alert_rows: DataFrame, order_col: str = "batch_id") -> DataFrame:
    """Newest revision per ``alert_id`` (streaming update mode re-emits a
    window each time it changes).  ``max_by`` is a declarative aggregate,
    combined map-side."""
    payload = [c for c in alert_rows.columns if c not in ("alert_id", order_col)]
    newest = F.max_by(F.struct(*payload), F.col(order_col))
    return alert_rows.groupBy("alert_id").agg(newest.alias("_a")).select("alert_id", "_a.*").select(
        *[c for c in S.ALERT_COLUMNS if c in alert_rows.columns]
    )


def _as_of(alerts: DataFrame, as_of) -> Column:
    if as_of is None:
        limit = (F.current_timestamp() + F.expr(f"INTERVAL {S.CLOCK_TOLERANCE}")).cast("timestamp_ntz")
        return alerts.filter(F.col("bucket_time") <= limit).select(F.max("bucket_time")).scalar()
    return F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of


def within_ttl(alerts: DataFrame, as_of=None, ttl: str = S.ALERT_TTL) -> DataFrame:
    """Alerts still alive at ``as_of`` under a time-to-live of ``ttl``.

    The default "now" is the newest alert time that is not ahead of the run
    time by more than ``CLOCK_TOLERANCE`` (one scalar subquery); pass the run
    time as ``as_of`` where it is known.  Alerts without a time have no age and
    stay alive, and so does an alert ahead of "now" (a forged time must not hide
    it); without any believable time all alerts are alive."""
    now = _as_of(alerts, as_of)
    bt = F.col("bucket_time")
    alive = bt > now - F.expr(f"INTERVAL {ttl}")
    return alerts.filter(F.coalesce(alive, F.lit(True)))


def live_alerts(logs: DataFrame, as_of: dt.datetime, ttl: dt.timedelta = LIVE) -> DataFrame:
    """Alerts of ``logs`` alive at ``as_of``, detected in the logs that can hold one only.

    A live alert ends its window after ``as_of - ttl``, so its events are later
    than that less the longest window.  The bound is a literal, so it prunes the
    days of a partitioned log table (``year``, ``month``, ``day`` kept) and is
    pushed to the scan.  Windows cut by the bound end before ``as_of - ttl``.
    Events ahead of ``as_of`` and those without a time are read as well."""
    first = as_of - ttl - LONGEST_WINDOW
    when = F.col("timestamp")
    recent = logs.filter((when > F.lit(first).cast("timestamp_ntz")) | when.isNull())
    if set(S.PARTITION_COLUMNS) <= set(logs.columns):
        day = F.concat(*[F.col(c) for c in S.PARTITION_COLUMNS])
        recent = recent.filter((day >= first.strftime("%Y%m%d")) | day.isNull()).drop(*S.PARTITION_COLUMNS)
    return within_ttl(all_alerts(recent), as_of, f"{ttl // dt.timedelta(microseconds=1)} MICROSECONDS")


def active_alerts(alerts: DataFrame, as_of=None, ttl: str = S.ALERT_TTL,
                  limit: int = S.ACTIVE_ALERTS_LIMIT) -> DataFrame:
    """Top ``limit`` live alerts by score (newest first, then id, on ties)."""
    return within_ttl(alerts, as_of, ttl).orderBy(
        F.col("threat_score").desc(), F.col("bucket_time").desc(), F.col("alert_id")
    ).limit(limit)


def severity_filter(alerts: DataFrame, severity: str | None) -> DataFrame:
    return alerts if severity in (None, "ALL") else alerts.filter(F.col("severity") == severity)


def recent_alerts_per_ip(alerts: DataFrame, n: int | None = S.RECENT_ALERTS_PER_IP, as_of=None,
                         ttl: str = S.ALERT_TTL) -> DataFrame:
    """Newest ``n`` live alerts of every IP (``bucket_time`` desc, then id); all of them for ``n=None``."""
    w = Window.partitionBy("ip_source").orderBy(F.col("bucket_time").desc(), F.col("alert_id"))
    return (
        within_ttl(alerts, as_of, ttl)
        .withColumn("alert_rank", F.row_number().over(w))
        .filter(F.col("alert_rank") <= n if n is not None else F.lit(True))
    )


def speed_summary(alerts: DataFrame, n: int | None = S.RECENT_ALERTS_PER_IP, as_of=None,
                  ttl: str = S.ALERT_TTL) -> DataFrame:
    """Per IP over its newest ``n`` live alerts: count, newest time, max score,
    bytes, and the sorted union of attack types.

    ``n=10`` is the original's view, in which ten lesser alerts hide an older
    severe one; ``n=None`` summarises all live alerts without ranking them."""
    recent = within_ttl(alerts, as_of, ttl) if n is None else recent_alerts_per_ip(alerts, n, as_of, ttl)
    types = F.array_union(F.col("attack_types"), F.array(F.col("alert_type")))
    return recent.groupBy(F.col("ip_source").alias("ip")).agg(
        F.count(F.lit(1)).cast("int").alias("active_alerts"),
        F.max("last_seen").alias("last_seen"),
        F.max("threat_score").alias("current_threat_score"),
        F.sum("bytes_total").alias("bytes_recent_alerts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(types)))).alias("recent_attack_types"),
    )


def severity_metrics(alerts: DataFrame) -> DataFrame:
    """One row: number of CRITICAL, HIGH and all alerts."""
    return alerts.agg(
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts"),
        F.count_if(F.col("severity") == "HIGH").alias("high_alerts"),
        F.count(F.lit(1)).alias("total_alerts"),
    )


def top_alert_ips(alerts: DataFrame, k: int = 10) -> DataFrame:
    """IPs with the highest alert score, and their share of the top score."""
    per_ip = alerts.filter(F.col("ip_source").isNotNull()).groupBy("ip_source").agg(
        F.max(F.coalesce(F.col("threat_score"), F.lit(0))).alias("max_score")
    )
    top = per_ip.orderBy(F.col("max_score").desc(), F.col("ip_source")).limit(k)
    # the frame is at most k rows here, so the global window is a k-row sort
    w = Window.orderBy(F.col("max_score").desc(), F.col("ip_source"))
    return top.select(
        F.row_number().over(w).alias("rank"),
        "ip_source",
        "max_score",
        (F.col("max_score") * 100.0 / F.max("max_score").over(Window.partitionBy())).alias("bar_pct"),
        scoring.score_band("max_score").alias("score_band"),
    )


def alert_type_counts(alerts: DataFrame) -> DataFrame:
    """One row of counts: the charted alert types and OTHER for the rest."""
    t = F.coalesce(F.col("alert_type"), F.lit("OTHER"))
    known = S.CHART_ALERT_TYPES
    return alerts.agg(
        *[F.count_if(t == k).alias(k.lower()) for k in known],
        F.count_if(~t.isin(*known)).alias("other"),
    )


def alert_display(alerts: DataFrame) -> DataFrame:
    """Presentation columns of an alert list: score band and readable bytes."""
    return alerts.withColumns(
        {
            "score_band": scoring.score_band("threat_score"),
            "bytes_display": scoring.human_bytes("bytes_total"),
        }
    )
