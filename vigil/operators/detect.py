"""Detectors: port scan, attack patterns, brute force, signatures, volume anomaly.

Each detector is a pure ``DataFrame -> DataFrame`` function built only from
built-in expressions, so the same function runs on a static table and on a
Structured Streaming frame (port scan excepted: exact distinct counts are not
supported on streams).

Scale notes
-----------
* All windowed detectors group by ``(source_ip, window)``: Spark plans a
  partial (map-side) aggregate before the shuffle, so a hot source IP
  contributes one partial row per map task and window, not its raw rows.
* The port-scan distinct count is planned as aggregate-by ``(ip, window,
  dest_ip)`` first, which spreads even a single hot ``(ip, window)`` over
  all reducers by destination before the final, already-deduplicated count.
* "First value" in a group is made deterministic with ``min_by`` over
  ``(timestamp, event identity)``; it is an ordinary declarative aggregate,
  so it combines map-side like ``count``.
* On static tables the windowed detectors aggregate in two levels
  (``window_counts``): the raw rows meet a hash aggregation whose buffers have
  a fixed width, and only its few rows reach the ``min_by`` of strings, which
  Spark plans as a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import schema as S
from vigil.functions import patterns as P
from vigil.functions import scoring


def event_order(df: DataFrame, column: str) -> Column:
    """Order used to pick ``column``'s first value: time, then the event
    identity when the frame has one, then the value itself (so that events
    without an identity are ordered too, and the scan reads no extra column)."""
    ties = ["event_id"] if "event_id" in df.columns else []
    return F.struct(F.col("timestamp"), *[F.col(c) for c in (*ties, column)])


def first_value(df: DataFrame, column: str) -> Column:
    """Value of the group's earliest event (see ``event_order``)."""
    return F.min_by(F.col(column), event_order(df, column))


def _with_watermark(df: DataFrame, watermark: str | None) -> DataFrame:
    """Event-time watermark on streams.  Spark requires a ``TIMESTAMP`` event
    time, so an NTZ wall clock is read in the session zone; window bounds are
    cast back to NTZ by the detectors (the same zone, so the same wall clock).

    A time further ahead than ``CLOCK_TOLERANCE`` is taken as that limit, so one
    forged time stamp cannot move the watermark past all real events."""
    if not (watermark and df.isStreaming):
        return df
    if dict(df.dtypes).get("timestamp") == "timestamp_ntz":
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    limit = F.current_timestamp() + F.expr(f"INTERVAL {S.CLOCK_TOLERANCE}")
    return df.withColumn("timestamp", F.least("timestamp", limit)).withWatermark("timestamp", watermark)


def _window_bounds() -> list[Column]:
    return [
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
    ]


#: Low bits of an event number that are packed behind the time in the window
#: (the higher bits are grouping keys); windows may last 2**39 microseconds, six days.
ID_BITS = 24
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def window_counts(events: DataFrame, window: str, firsts: tuple[str, ...], split: dict[str, Column] | None = None) -> DataFrame:
    """The fixed-width level: one row for each window, source and values of ``firsts`` (and ``split``),
    with ``n``, ``nbytes`` and the order of its earliest event (``at``, and its number if events have one).

    All buffers are longs, so the raw rows are aggregated by hash, map-side, whatever the width of the
    strings; a source that floods one window is spread by those values.  The earliest event by
    ``(time, number)`` is exact for every number: its high bits are a key, and its low bits stand behind
    the microseconds since the window's start in one interval."""
    keys = [F.col("window"), F.col("source_ip"), *[F.col(c) for c in firsts]]
    keys += [c.alias(name) for name, c in (split or {}).items()]
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("bytes_transferred").alias("nbytes"), F.min("timestamp").alias("at")]
    if "event_id" in events.columns:
        low = F.coalesce(F.col("event_id").bitwiseAND((1 << ID_BITS) - 1), F.lit(0)).cast("long")
        since = F.col("timestamp") - F.col("window.start")
        keys.append(F.shiftright("event_id", ID_BITS).alias("id_high"))
        aggs.append(F.min(since * F.lit(1 << ID_BITS) + F.expr("INTERVAL '0.000001' SECOND") * low).alias("id_low"))
    return events.withColumn("window", F.window("timestamp", window)).groupBy(*keys).agg(*aggs)


def _counted_order(counts: DataFrame, column: str) -> Column:
    """``event_order`` of the earliest event of a row of ``window_counts``."""
    return F.struct("at", *[c for c in ("id_high", "id_low") if c in counts.columns], column)


def _two_levels(events: DataFrame) -> bool:
    """Streams allow one aggregation only (update mode), and an order by text has no fixed width."""
    return not events.isStreaming and dict(events.dtypes).get("event_id", "int") in _WHOLE


def window_totals(events: DataFrame, window: str, firsts: tuple[str, ...]) -> DataFrame:
    """Per ``(window, source_ip)``: ``n`` events, their ``nbytes``, and the values of ``firsts`` in the earliest one."""
    if _two_levels(events):
        counts = window_counts(events, window, firsts)
        picked = [F.min_by(F.col(c), _counted_order(counts, c)).alias(c) for c in firsts]
        return counts.groupBy("window", "source_ip").agg(F.sum("n").alias("n"), F.sum("nbytes").alias("nbytes"), *picked)
    return events.groupBy(F.window("timestamp", window).alias("window"), F.col("source_ip")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes_transferred").alias("nbytes"),
        *[first_value(events, c).alias(c) for c in firsts])


# ---------------------------------------------------------------------------
# Port scan (batch)
# ---------------------------------------------------------------------------
def detect_port_scan(
    logs: DataFrame,
    threshold: int = S.PORT_SCAN_THRESHOLD,
    window: str = S.PORT_SCAN_WINDOW,
) -> DataFrame:
    """TCP sources that reach more than ``threshold`` distinct targets in a window."""
    return (
        logs.filter(F.col("protocol") == "TCP")
        .groupBy(F.col("source_ip"), F.window("timestamp", window).alias("window"))
        .agg(
            F.count_distinct("dest_ip").alias("distinct_targets"),
            F.count(F.lit(1)).alias("event_count"),
            first_value(logs, "log_type").alias("log_type"),
        )
        .filter(F.col("distinct_targets") > threshold)
        .select(
            "source_ip",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "distinct_targets",
            "event_count",
            "log_type",
            F.lit("PORT_SCAN").alias("attack_type"),
            scoring.port_scan_score("distinct_targets", threshold).alias("threat_score"),
            scoring.port_scan_severity("distinct_targets").alias("severity"),
        )
    )


# ---------------------------------------------------------------------------
# Attack patterns (batch) and signatures (live)
# ---------------------------------------------------------------------------
def with_signature_flags(logs: DataFrame, patterns: P.PatternSet = P.BATCH_PATTERNS) -> DataFrame:
    """Adds ``is_sqli``, ``is_xss``, ``is_lfi``, ``is_tool`` (NULL for NULL text)."""
    return logs.withColumns(P.flag_columns(patterns))


def detect_attack_patterns(logs: DataFrame, patterns: P.PatternSet = P.BATCH_PATTERNS) -> DataFrame:
    """Events matching any signature, with flags, category, score and severity."""
    return (
        with_signature_flags(logs, patterns)
        .filter(P.any_flag())
        .withColumns(
            {
                "attack_category": P.by_precedence(P.BATCH_CATEGORIES, P.BATCH_FALLBACK, 1),
                "threat_score": P.by_precedence(P.BATCH_CATEGORIES, P.BATCH_FALLBACK, 2),
                "severity": F.lit("CRITICAL"),
            }
        )
    )


def detect_signatures(logs: DataFrame, patterns: P.PatternSet = P.STREAM_PATTERNS) -> DataFrame:
    """Stateless per-event alerts (one per matching event)."""
    return (
        with_signature_flags(logs, patterns)
        .filter(P.any_flag())
        .withColumns(
            {
                "alert_type": P.by_precedence(P.STREAM_CATEGORIES, P.STREAM_FALLBACK, 1),
                "threat_score": P.by_precedence(P.STREAM_CATEGORIES, P.STREAM_FALLBACK, 2),
                "severity": F.lit("CRITICAL"),
                "event_count": F.lit(1),
                "bytes_total": F.coalesce(F.col("bytes_transferred").cast("long"), F.lit(0).cast("long")),
            }
        )
        .drop(*P.FLAG_COLUMNS)
    )


# ---------------------------------------------------------------------------
# Brute force and volume anomaly (same code for static and streaming frames)
# ---------------------------------------------------------------------------
FIRSTS = ("user_agent", "log_type")


def _brute_force_fields(threshold: int) -> dict[str, Column]:
    """Brute-force alert of a row with ``blocked_count`` and ``blocked_bytes``."""
    return {
        "user_agent": F.col("user_agent"),
        "log_type": F.col("log_type"),
        "bytes_total": F.coalesce(F.col("blocked_bytes"), F.lit(0).cast("long")),
        "alert_type": F.lit("BRUTE_FORCE"),
        "threat_score": scoring.brute_force_score("blocked_count", threshold),
        "severity": scoring.brute_force_severity("blocked_count"),
        "event_count": F.col("blocked_count").cast("int"),
    }


def _volume_fields(critical_bytes: int) -> dict[str, Column]:
    """Volume alert of a row with ``bytes_total`` and ``event_count``."""
    return {
        "bytes_total": F.col("bytes_total"),
        "event_count": F.col("event_count"),
        "log_type": F.col("log_type"),
        "user_agent": F.col("user_agent"),
        "alert_type": F.lit("VOLUME_ANOMALY"),
        "threat_score": scoring.volume_score("bytes_total"),
        "severity": scoring.volume_severity("bytes_total", critical_bytes),
    }


def _named(fields: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in fields.items()]


def detect_brute_force(
    logs: DataFrame,
    threshold: int = S.BRUTE_FORCE_THRESHOLD,
    window: str = S.BRUTE_FORCE_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """Sources with more than ``threshold`` blocked events in a window."""
    blocked = _with_watermark(logs, watermark).filter(F.col("action") == "blocked")
    totals = window_totals(blocked, window, FIRSTS)
    return _brute_force_output(totals.withColumnsRenamed({"n": "blocked_count", "nbytes": "blocked_bytes"}), threshold)


def _brute_force_output(agg: DataFrame, threshold: int) -> DataFrame:
    return agg.filter(F.col("blocked_count") > threshold).select(
        *_window_bounds(), "source_ip", "blocked_count", *_named(_brute_force_fields(threshold)))


def detect_volume_anomaly(
    logs: DataFrame,
    threshold_bytes: int = S.VOLUME_THRESHOLD_BYTES,
    critical_bytes: int = S.VOLUME_CRITICAL_BYTES,
    window: str = S.VOLUME_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """Sources sending more than ``threshold_bytes`` within a window."""
    totals = window_totals(_with_watermark(logs, watermark), window, FIRSTS)
    return _volume_output(totals.withColumnsRenamed({"n": "event_count", "nbytes": "bytes_total"}), threshold_bytes, critical_bytes)


def _volume_output(agg: DataFrame, threshold_bytes: int, critical_bytes: int) -> DataFrame:
    return agg.filter(F.col("bytes_total") > threshold_bytes).select(
        *_window_bounds(), "source_ip", *_named(_volume_fields(critical_bytes)))


# ---------------------------------------------------------------------------
# Shared rollup: both windowed live detectors from one scan (static frames)
# ---------------------------------------------------------------------------
def window_rollup(logs: DataFrame, grain: str = S.VOLUME_WINDOW) -> DataFrame:
    """Per ``(grain window, source_ip)``: all-event and blocked-only totals and
    the earliest event's values, each with its ordering key so that coarser
    aligned windows (1 minute = six 10-second windows) re-aggregate exactly
    like the direct detectors."""
    if _two_levels(logs):
        rows = window_counts(logs, grain, FIRSTS, {"blocked": F.coalesce(F.col("action") == "blocked", F.lit(False))})
        order = {c: _counted_order(rows, c) for c in FIRSTS}
        blocked, n, nbytes = F.col("blocked"), F.col("n"), F.col("nbytes")
        grouped = rows.groupBy("window", "source_ip")
    else:
        order = {c: event_order(logs, c) for c in FIRSTS}
        blocked, n, nbytes = F.col("action") == "blocked", F.lit(1).cast("long"), F.col("bytes_transferred")
        grouped = logs.groupBy(F.window("timestamp", grain).alias("window"), F.col("source_ip"))
    aggs = [
        F.sum(nbytes).alias("bytes_total"),
        F.sum(n).alias("event_count"),
        F.coalesce(F.sum(F.when(blocked, n)), F.lit(0).cast("long")).alias("blocked_count"),
        F.sum(F.when(blocked, nbytes)).alias("blocked_bytes"),
    ]
    for c, key in order.items():
        aggs += [
            F.min_by(F.col(c), key).alias(c),
            # NULL ordering keys are skipped, so these see blocked events only
            F.min_by(F.when(blocked, F.col(c)), F.when(blocked, key)).alias(f"blocked_{c}"),
            F.min(F.when(blocked, key)).alias(f"blocked_{c}_key"),
        ]
    return grouped.agg(*aggs)


def _blocked_totals() -> list[Column]:
    """Blocked-only totals and first values of finer windows, merged."""
    return [F.sum("blocked_count").alias("blocked_count"), F.sum("blocked_bytes").alias("blocked_bytes"),
            *[F.min_by(F.col(f"blocked_{c}"), F.col(f"blocked_{c}_key")).alias(c) for c in FIRSTS]]


def volume_from_rollup(rollup: DataFrame, threshold_bytes: int = S.VOLUME_THRESHOLD_BYTES,
                       critical_bytes: int = S.VOLUME_CRITICAL_BYTES) -> DataFrame:
    """Volume anomaly (10-second windows) read off the rollup."""
    return _volume_output(rollup, threshold_bytes, critical_bytes)


def brute_force_from_rollup(rollup: DataFrame, threshold: int = S.BRUTE_FORCE_THRESHOLD,
                            window: str = S.BRUTE_FORCE_WINDOW) -> DataFrame:
    """Brute force re-aggregated from the finer rollup (window must be a
    multiple of the rollup grain; both are epoch-aligned)."""
    agg = (
        rollup.filter(F.col("blocked_count") > 0)
        .groupBy(F.window(F.col("window.start"), window).alias("window"), F.col("source_ip"))
        .agg(*_blocked_totals())
    )
    return _brute_force_output(agg, threshold)


def detect_in_windows(logs: DataFrame) -> DataFrame:
    """Brute force and volume anomalies of a static table from one scan and one chain of aggregations,
    with nothing written: a minute keeps its volume anomalies (six at most) beside its blocked
    totals, and both kinds are then listed as rows of one shape."""
    shape = ("user_agent", "log_type", "bytes_total", "event_count", "alert_type", "threat_score", "severity")

    def row(start: str, fields: dict[str, Column]) -> Column:
        typed = fields | {"event_count": fields["event_count"].cast("int"), "threat_score": fields["threat_score"].cast("int")}
        bounds = [F.col(f"{start}.{end}").cast("timestamp_ntz").alias(f"window_{end}") for end in ("start", "end")]
        return F.struct(*bounds, "source_ip", *[typed[c].alias(c) for c in shape])

    heavy = F.when(F.col("bytes_total") > S.VOLUME_THRESHOLD_BYTES, row("window", _volume_fields(S.VOLUME_CRITICAL_BYTES)))
    minutes = (
        window_rollup(logs)
        .groupBy(F.window(F.col("window.start"), S.BRUTE_FORCE_WINDOW).alias("minute"), F.col("source_ip"))
        .agg(*_blocked_totals(), F.collect_list(heavy).alias("heavy"))
    )
    brute = F.when(F.col("blocked_count") > S.BRUTE_FORCE_THRESHOLD, row("minute", _brute_force_fields(S.BRUTE_FORCE_THRESHOLD)))
    return minutes.select(F.inline(F.array_compact(F.array_append("heavy", brute))))


def detect_port_scan_stream(
    logs: DataFrame,
    threshold: int = S.PORT_SCAN_THRESHOLD,
    window: str = S.PORT_SCAN_WINDOW,
    watermark: str | None = None,
    exact: bool = True,
    rsd: float = 0.01,
) -> DataFrame:
    """Port scan on a stream with an *exact* distinct count.

    Spark rejects ``count_distinct`` on streams; dropping duplicate
    ``(source_ip, window, dest_ip)`` rows (state keyed by that triple, bounded
    by the watermark when one is set) and then counting rows per
    ``(source_ip, window)`` is exact and runs in update mode.  Event count and
    first log type are not available after the de-duplication, so this
    variant reports the targets, score and severity only.

    ``exact=False`` keeps one HyperLogLog sketch per ``(source_ip, window)``
    instead (``approx_count_distinct`` with relative error ``rsd``): state no
    longer grows with the number of targets, at the price of estimates.
    """
    src = _with_watermark(logs, watermark).filter(F.col("protocol") == "TCP")
    if exact:
        counted = (
            src.withColumn("window", F.window("timestamp", window))
            .dropDuplicates(["source_ip", "window", "dest_ip"])
            .groupBy("source_ip", "window")
            .agg(F.count(F.lit(1)).alias("distinct_targets"))
        )
    else:
        counted = src.groupBy("source_ip", F.window("timestamp", window).alias("window")).agg(
            F.approx_count_distinct("dest_ip", rsd).alias("distinct_targets")
        )
    return (
        counted
        .filter(F.col("distinct_targets") > threshold)
        .select(
            "source_ip",
            *_window_bounds(),
            "distinct_targets",
            F.lit("PORT_SCAN").alias("attack_type"),
            scoring.port_scan_score("distinct_targets", threshold).alias("threat_score"),
            scoring.port_scan_severity("distinct_targets").alias("severity"),
        )
    )
