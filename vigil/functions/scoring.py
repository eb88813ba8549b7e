"""Score, severity, recommendation and display expressions (all built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import schema as S

# ---------------------------------------------------------------------------
# Scores, severity cut-offs, weights and bands.
# ---------------------------------------------------------------------------
MAX_SCORE = 100
PORT_SCAN_BASE = 60            # + targets above the threshold
PORT_SCAN_HIGH = 50            # targets > 50 -> HIGH
PORT_SCAN_CRITICAL = 100       # targets > 100 -> CRITICAL
BRUTE_FORCE_BASE = 70          # + 2 per blocked event above the threshold
BRUTE_FORCE_STEP = 2
BRUTE_FORCE_CRITICAL = 10      # blocked events > 10 -> CRITICAL
VOLUME_BASE = 80               # + 5 * log10(MiB)
VOLUME_LOG_FACTOR = 5
REPUTATION_WEIGHTS = (10, 5)   # malicious, suspicious
BLOCK_SCORE = 80               # score > 80 with an active alert -> BLOCK
MONITOR_SCORE = 50             # score >= 50 -> MONITOR
CONFIDENCE_WEIGHTS = (0.4, 0.6)  # batch score, live score
SCORE_BANDS = (80, 60, 40)     # crit, high, med (else low)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def port_scan_score(distinct_targets="distinct_targets", threshold: int = S.PORT_SCAN_THRESHOLD) -> Column:
    """``least(100, 60 + targets - threshold)`` as INT."""
    return F.least(F.lit(MAX_SCORE), (F.lit(PORT_SCAN_BASE) + _c(distinct_targets) - F.lit(threshold)).cast("int"))


def port_scan_severity(distinct_targets="distinct_targets") -> Column:
    d = _c(distinct_targets)
    return F.when(d > PORT_SCAN_CRITICAL, "CRITICAL").when(d > PORT_SCAN_HIGH, "HIGH").otherwise("MEDIUM")


def brute_force_score(blocked_count="blocked_count", threshold: int = S.BRUTE_FORCE_THRESHOLD) -> Column:
    """``least(100, 70 + 2 * (count - threshold))`` as INT."""
    steps = (_c(blocked_count) - F.lit(threshold)) * BRUTE_FORCE_STEP
    return F.least(F.lit(MAX_SCORE), (F.lit(BRUTE_FORCE_BASE) + steps).cast("int"))


def brute_force_severity(blocked_count="blocked_count") -> Column:
    return F.when(_c(blocked_count) > BRUTE_FORCE_CRITICAL, "CRITICAL").otherwise("HIGH")


def volume_score(bytes_total="bytes_total") -> Column:
    """``least(100, int(80 + 5 * log10(bytes / MiB)))``; log taken as ln(x)/ln(10)."""
    mib = _c(bytes_total) / F.lit(1048576.0)
    return F.least(F.lit(MAX_SCORE), (F.lit(VOLUME_BASE) + F.log(10.0, mib) * VOLUME_LOG_FACTOR).cast("int"))


def volume_severity(bytes_total="bytes_total", critical: int = S.VOLUME_CRITICAL_BYTES) -> Column:
    return F.when(_c(bytes_total) > critical, "CRITICAL").otherwise("HIGH")


def reputation_score(malicious="malicious_count", suspicious="suspicious_count", total="total_events") -> Column:
    """Historical score: ``least(100, long((10m + 5s) / total * 100))``."""
    wm, ws = REPUTATION_WEIGHTS
    weighted = _c(malicious) * wm + _c(suspicious) * ws
    return F.least(F.lit(MAX_SCORE).cast("long"), (weighted / _c(total) * 100).cast("long"))


def reputation_score_norm(malicious="malicious_count", suspicious="suspicious_count") -> Column:
    """Per-IP score on a 50..100 scale: ``least(100, int((10m + 5s) / (m + s) * 10))``."""
    m, s = _c(malicious), _c(suspicious)
    wm, ws = REPUTATION_WEIGHTS
    return F.least(F.lit(MAX_SCORE), ((m * wm + s * ws) / (m + s) * 10).cast("int"))


def recommendation(batch_score="reputation_score", active_alerts="active_alerts") -> Column:
    b, a = _c(batch_score), _c(active_alerts)
    return (
        F.when((b > BLOCK_SCORE) & (a >= 1), "BLOCK")
        .when(b >= MONITOR_SCORE, "MONITOR")
        .when(a > 0, "MONITOR")
        .otherwise("ALLOW")
    )


def confidence(batch_score="reputation_score", speed_score="current_threat_score") -> Column:
    wb, ws = CONFIDENCE_WEIGHTS
    weighted = _c(batch_score) * F.lit(wb) + _c(speed_score) * F.lit(ws)
    return F.round(F.least(F.lit(1.0), weighted / F.lit(100.0)), 2)


def score_band(score="threat_score") -> Column:
    """Display band of a 0..100 score: crit >= 80, high >= 60, med >= 40, else low."""
    s = F.coalesce(_c(score), F.lit(0))
    crit, high, med = SCORE_BANDS
    return F.when(s >= crit, "crit").when(s >= high, "high").when(s >= med, "med").otherwise("low")


def human_bytes(b="bytes_total") -> Column:
    """``0 B`` / ``x.y KB`` ...: divide by 1024 while >= 1024, at most up to GB."""
    v = _c(b).cast("double")
    k = F.lit(1024.0)
    unit_idx = (
        F.when(v >= k * k * k, 3).when(v >= k * k, 2).when(v >= k, 1).otherwise(0)
    )
    scaled = v / F.pow(k, unit_idx)
    unit = F.element_at(F.array(*[F.lit(u) for u in ["B", "KB", "MB", "GB"]]), unit_idx + 1)
    return F.when(F.coalesce(_c(b), F.lit(0)) == 0, F.lit("0 B")).otherwise(
        F.concat(F.format_string("%.1f", scaled), F.lit(" "), unit)
    )
