"""Batch detection and history-analysis queries (sections I, B, D, E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import detect
from vigil.plans import oracle as O
from vigil.plans.catalog import DETECT_SPEEDUP, detect_logs, history_logs, register
from vigil.session import materialize, scratch_path


@register("port_scan", O.with_logs(O.port_scan_sql(), DETECT_SPEEDUP))
def port_scan(spark, sf_dir):
    return detect.detect_port_scan(detect_logs(spark, sf_dir))


@register("attack_patterns", O.with_logs(O.attack_patterns_sql(), 1))
def attack_patterns(spark, sf_dir):
    return detect.detect_attack_patterns(history_logs(spark, sf_dir))


@register("signature_alerts", O.with_logs(O.signatures_sql(), 1))
def signature_alerts(spark, sf_dir):
    return detect.detect_signatures(history_logs(spark, sf_dir))


@register("brute_force", O.with_logs(O.brute_force_sql(), DETECT_SPEEDUP))
def brute_force(spark, sf_dir):
    return detect.detect_brute_force(detect_logs(spark, sf_dir))


@register("volume_anomaly", O.with_logs(O.volume_anomaly_sql(), DETECT_SPEEDUP))
def volume_anomaly(spark, sf_dir):
    return detect.detect_volume_anomaly(detect_logs(spark, sf_dir))


# --- history analyses --------------------------------------------------------
from vigil.operators import analyze  # noqa: E402


@register("filter_label", O.with_logs(f"SELECT {O.LOG_COLS} FROM logs WHERE threat_label = 'malicious'", 1))
def filter_label(spark, sf_dir):
    return analyze.filter_label(history_logs(spark, sf_dir), "malicious")


@register("malicious_counts", O.with_logs(O.label_counts_sql("malicious"), 1))
def malicious_counts(spark, sf_dir):
    return analyze.label_counts(history_logs(spark, sf_dir), "malicious")


@register("suspicious_counts", O.with_logs(O.label_counts_sql("suspicious"), 1))
def suspicious_counts(spark, sf_dir):
    return analyze.label_counts(history_logs(spark, sf_dir), "suspicious")


@register("ip_reputation_all", O.with_logs(O.reputation_sql(), 1))
def ip_reputation_all(spark, sf_dir):
    return analyze.reputation_by_ip_logtype(history_logs(spark, sf_dir))


@register("top_malicious_ips", O.with_logs(O.top_malicious_sql(), 1))
def top_malicious_ips(spark, sf_dir):
    return analyze.top_malicious_ips(history_logs(spark, sf_dir))


@register("volume_stats", O.with_logs(O.volume_stats_sql(), 1))
def volume_stats(spark, sf_dir):
    # the oracle is exact, so its query is too; the sketch differs from it on large groups
    return analyze.volume_stats(history_logs(spark, sf_dir), p95="exact")


@register("volume_stats_sketch", O.with_logs(O.P95_RANK_BODY, 1))
def volume_stats_sketch(spark, sf_dir):
    """The batch job's statistics with the sketched percentile, and whether its rank is within a thousandth."""
    logs, keys = history_logs(spark, sf_dir), ["threat_label", "log_type", "protocol"]
    stats = analyze.volume_stats(logs)
    b, p = F.col("bytes_transferred"), F.col("p95_bytes")
    ranks = logs.join(stats.select(*keys, "p95_bytes"), keys).groupBy(*keys).agg(
        F.count(b).alias("n"), F.count_if(b < p).alias("below"), F.count_if(b <= p).alias("upto"))
    wanted = F.ceil(F.col("n") * 0.95)
    off = F.greatest(F.col("below") + 1 - wanted, wanted - F.col("upto"), F.lit(0))
    return stats.join(ranks, keys).withColumn("p95_within", off <= F.col("n") / 1000).select(
        *keys, "avg_bytes", "max_bytes", "event_count", "total_bytes", "p95_within")


@register("volume_stats_exact", O.with_logs(O.volume_stats_sql(), 1))
def volume_stats_exact(spark, sf_dir):
    return analyze.volume_stats(history_logs(spark, sf_dir), p95="exact")


@register("timeline", O.with_logs(O.timeline_sql(), 1))
def timeline(spark, sf_dir):
    return analyze.threat_timeline(history_logs(spark, sf_dir))


_AP = f"ap AS ({O.attack_patterns_sql()})"


@register("attack_category_counts", O.with_logs(O.ATTACK_CATEGORY_COUNTS_BODY, 1, _AP))
def attack_category_counts(spark, sf_dir):
    return analyze.attack_category_counts(detect.detect_attack_patterns(history_logs(spark, sf_dir)))


@register("attack_flags", O.with_logs(O.ATTACK_FLAGS_BODY, 1))
def attack_flags(spark, sf_dir):
    return analyze.flag_summary(history_logs(spark, sf_dir))


@register("top_attack_patterns", O.with_logs(O.TOP_ATTACK_PATTERNS_BODY, 1, _AP))
def top_attack_patterns(spark, sf_dir):
    return analyze.top_attack_patterns(detect.detect_attack_patterns(history_logs(spark, sf_dir)))


@register("port_scans_ranked", O.with_logs(
    f"SELECT * FROM ({O.port_scan_sql()}) p ORDER BY distinct_targets DESC, source_ip, window_start LIMIT 100", DETECT_SPEEDUP))
def port_scans_ranked(spark, sf_dir):
    scans = detect.detect_port_scan(detect_logs(spark, sf_dir))
    return analyze.ranked(scans, "distinct_targets", "source_ip", "window_start", k=100)


@register("volume_ranked", O.with_logs(
    f"SELECT * FROM ({O.volume_stats_sql()}) v ORDER BY total_bytes DESC, threat_label, log_type, protocol LIMIT 20", 1))
def volume_ranked(spark, sf_dir):
    stats = analyze.volume_stats(history_logs(spark, sf_dir), p95="exact")
    return analyze.ranked(stats, "total_bytes", "threat_label", "log_type", "protocol", k=20)


@register("volume_quantiles_range", O.with_logs(O.QUANTILES_RANGE_BODY, 1))
def volume_quantiles_range(spark, sf_dir):
    """95th percentile over two weeks from stored hourly sketches, and whether its rank is within half a percent."""
    from vigil.operators import sketches as K

    logs = history_logs(spark, sf_dir)
    first, last = (F.lit(d).cast("timestamp_ntz") for d in O.QUANTILE_DAYS)
    found = K.quantiles(materialize(K.hourly_sketches(logs), "sketches"), 0.95, first, last)
    error = K.rank_error(logs.where((F.col("timestamp") >= first) & (F.col("timestamp") < last)), found)
    return found.join(error, list(K.KEYS)).select(*K.KEYS, "n", "largest", "total", (F.col("error") <= 0.005).alias("within"))


@register("published_timeline", O.with_logs(O.timeline_sql(), 1))
def published_timeline(spark, sf_dir):
    """The timeline as served after a published run, and a later run that fails."""
    from vigil.plans import publish

    logs, root = history_logs(spark, sf_dir), scratch_path(spark, "published")
    publish.publish_all(spark, logs, root, ["volume_analysis"])
    publish.publish_all(spark, logs.withColumn("threat_label", F.raise_error(F.lit("broken input"))), root, ["volume_analysis"])
    return spark.read.parquet(f"{publish.served_folder(spark, root)}/threat_timeline")
