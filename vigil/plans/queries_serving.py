"""Served tables and fused threat profiles (sections A12-A14, C3, C4, J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import alerts as A
from vigil.operators import analyze
from vigil.operators import serving as V
from vigil.plans import oracle as O
from vigil.plans.catalog import DETECT_SPEEDUP, detect_logs, history_logs, register
from vigil.plans.layout import write_layout
from vigil.session import scratch_path


def profiles_for(logs, score_col="reputation_score"):
    snap = V.reputation_snapshot(logs)
    types = V.attack_types_by_ip(V.attack_type_index(logs))
    speed = A.speed_summary(A.all_alerts(logs))
    return V.threat_profiles(snap, types, speed, score_col)


@register("reputation_snapshot", O.with_serving("SELECT * FROM snap", DETECT_SPEEDUP))
def reputation_snapshot(spark, sf_dir):
    return V.reputation_snapshot(detect_logs(spark, sf_dir))


@register("attack_type_index", O.with_serving("SELECT * FROM idx", DETECT_SPEEDUP))
def attack_type_index(spark, sf_dir):
    return V.attack_type_index(detect_logs(spark, sf_dir))


@register("attack_types_by_ip", O.with_serving("SELECT * FROM types", DETECT_SPEEDUP))
def attack_types_by_ip(spark, sf_dir):
    return V.attack_types_by_ip(V.attack_type_index(detect_logs(spark, sf_dir)))


@register("timeline_range", O.with_logs(O.TIMELINE_RANGE_BODY, 1))
def timeline_range(spark, sf_dir):
    return V.timeline_range(analyze.threat_timeline(history_logs(spark, sf_dir)), "20240105", "20240119")


@register("global_stats", O.with_serving(O.GLOBAL_STATS_BODY, DETECT_SPEEDUP))
def global_stats(spark, sf_dir):
    return V.global_stats(V.reputation_snapshot(detect_logs(spark, sf_dir)))


@register("global_stats_norm", O.with_serving(O.GLOBAL_STATS_NORM_BODY, DETECT_SPEEDUP))
def global_stats_norm(spark, sf_dir):
    return V.global_stats(V.reputation_snapshot(detect_logs(spark, sf_dir)), "reputation_score_norm")


@register("threat_profiles", O.with_serving("SELECT * FROM fused", DETECT_SPEEDUP))
def threat_profiles(spark, sf_dir):
    return profiles_for(detect_logs(spark, sf_dir))


@register("threat_profiles_norm",
          O.with_serving("SELECT * FROM fused", DETECT_SPEEDUP, "reputation_score_norm"))
def threat_profiles_norm(spark, sf_dir):
    return profiles_for(detect_logs(spark, sf_dir), "reputation_score_norm")


@register("threat_profile_docs", O.with_serving(O.PROFILE_DOCS_BODY, DETECT_SPEEDUP))
def threat_profile_docs(spark, sf_dir):
    return V.profile_documents(profiles_for(detect_logs(spark, sf_dir)))


@register("observed_ip_profiles", O.with_serving(O.OBSERVED_IP_PROFILES_BODY, DETECT_SPEEDUP))
def observed_ip_profiles(spark, sf_dir):
    """Profile of every IP seen on the network (as source or destination);
    IPs without history get the zero-filled ALLOW profile."""
    logs = detect_logs(spark, sf_dir)
    requests = logs.select(F.explode(F.array("source_ip", "dest_ip")).alias("ip")).distinct()  # one scan
    return V.lookup_profiles(profiles_for(logs), requests)


@register("profile_requests", O.with_serving(O.PROFILE_REQUESTS_BODY, DETECT_SPEEDUP))
def profile_requests(spark, sf_dir):
    """Requests as clients send them: padded, unknown, empty and overlong texts among them."""
    logs = detect_logs(spark, sf_dir)
    n = F.col("event_id") % 4
    text = (F.when(n == 0, F.concat(F.lit("  "), "source_ip")).when(n == 1, F.col("dest_ip")).when(n == 2, F.lit(" "))
            .otherwise(F.repeat("source_ip", F.lit(5))))
    requests = logs.select(F.trim(text).alias("ip")).distinct()
    return V.lookup_profiles(profiles_for(logs), requests).select(
        "ip", "valid", "reputation_score", "active_alerts", "recommendation", "confidence")


def _layout(spark, sf_dir):
    logs = detect_logs(spark, sf_dir)
    return write_layout(spark, scratch_path(spark, "layout"), V.reputation_snapshot(logs),
                        V.attack_types_by_ip(V.attack_type_index(logs)), A.speed_summary(A.all_alerts(logs)))


@register("bucketed_profiles", O.with_serving("SELECT * FROM fused", DETECT_SPEEDUP))
def bucketed_profiles(spark, sf_dir):
    """Profiles joined bucket by bucket from the served tables."""
    return _layout(spark, sf_dir).profiles()


@register("bucketed_requests", O.with_serving(O.OBSERVED_IP_PROFILES_BODY, DETECT_SPEEDUP))
def bucketed_requests(spark, sf_dir):
    """Profile of every IP seen on the network, looked up in the bucketed tables."""
    logs = detect_logs(spark, sf_dir)
    return _layout(spark, sf_dir).lookup(logs.select(F.explode(F.array("source_ip", "dest_ip")).alias("ip")).distinct())
