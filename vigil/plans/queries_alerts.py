"""Alert queries: envelope over the live detectors and read-side views."""

from __future__ import annotations

import datetime as dt

from vigil.operators import alerts as A
from vigil.plans import oracle as O
from vigil.plans.catalog import DETECT_SPEEDUP, detect_logs, register


def _alerts(spark, sf_dir):
    """The alerts of all logs, as a plan: building a view writes nothing and starts no job."""
    return A.all_alerts(detect_logs(spark, sf_dir))


def _live(spark, sf_dir):
    return A.within_ttl(_alerts(spark, sf_dir))


@register("alerts_all", O.with_alerts("SELECT * FROM alerts", DETECT_SPEEDUP))
def alerts_all(spark, sf_dir):
    return _alerts(spark, sf_dir)


@register("active_alerts", O.with_alerts(O.ACTIVE_ALERTS_BODY, DETECT_SPEEDUP))
def active_alerts(spark, sf_dir):
    return A.active_alerts(_alerts(spark, sf_dir))


@register("recent_alerts_per_ip", O.with_alerts("SELECT * FROM recent", DETECT_SPEEDUP))
def recent_alerts_per_ip(spark, sf_dir):
    return A.recent_alerts_per_ip(_alerts(spark, sf_dir))


@register("speed_summary", O.with_alerts("SELECT * FROM speed", DETECT_SPEEDUP))
def speed_summary(spark, sf_dir):
    return A.speed_summary(_alerts(spark, sf_dir))


@register("severity_metrics", O.with_alerts(O.SEVERITY_METRICS_BODY, DETECT_SPEEDUP))
def severity_metrics(spark, sf_dir):
    return A.severity_metrics(_live(spark, sf_dir))


@register("top_alert_ips", O.with_alerts(O.TOP_ALERT_IPS_BODY, DETECT_SPEEDUP))
def top_alert_ips(spark, sf_dir):
    return A.top_alert_ips(_live(spark, sf_dir))


@register("alert_type_counts", O.with_alerts(O.alert_type_counts_body(), DETECT_SPEEDUP))
def alert_type_counts(spark, sf_dir):
    return A.alert_type_counts(_live(spark, sf_dir))


@register("alert_list", O.with_alerts(O.ALERT_LIST_BODY, DETECT_SPEEDUP))
def alert_list(spark, sf_dir):
    """Alert list filtered by severity, with its score band and readable bytes."""
    return A.alert_display(A.severity_filter(_live(spark, sf_dir), "HIGH"))


@register("alerts_of_last_minute", O.with_alerts(O.LAST_MINUTE_BODY, DETECT_SPEEDUP))
def alerts_of_last_minute(spark, sf_dir):
    """Alerts alive at a given time: the time-to-live binds, and the detectors read only the logs it leaves."""
    now = dt.datetime.fromisoformat(O.LAST_MINUTE_NOW)
    return A.live_alerts(detect_logs(spark, sf_dir), now, dt.timedelta(minutes=1))
