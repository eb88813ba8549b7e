"""Independent DuckDB formulations of every SQL-expressible query.

These are written from the query semantics, not generated from the Spark
plans, so they act as an oracle.  Each string runs against DuckDB views named
after the driver tables (``events`` ...).  The DuckDB dialect differs from
Spark in a few places: casts round (so truncation is written as ``floor``),
``//`` is integer division, ``regexp_matches`` has find semantics like
``rlike``, and ``first(x ORDER BY ..)`` picks the first row's value.
"""

from __future__ import annotations

from vigil import schema as S
from vigil.functions import patterns as P

ORIGIN_US = 1704067200000000  # 2024-01-01 00:00:00 in microseconds


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def logs_cte(speedup: int = 1, name: str = "logs") -> str:
    """The events -> logs mapping (see ``vigil.sources.events``) in DuckDB SQL."""
    if speedup == 1:
        ts = "ts"
    else:
        ts = f"make_timestamp({ORIGIN_US} + (epoch_us(ts) - {ORIGIN_US}) // {speedup})"
    return f"""{name} AS (
  SELECT
    {ts} AS "timestamp",
    printf('10.%d.%d.%d', (user_id // 65536) % 256, (user_id // 256) % 256, user_id % 256) AS source_ip,
    printf('192.0.0.%d', event_id % 61) AS dest_ip,
    CASE event_id % 4 WHEN 2 THEN 'HTTP' WHEN 3 THEN 'SSH' ELSE 'TCP' END AS protocol,
    CASE WHEN event_type IN ('error', 'signup') THEN 'blocked' ELSE 'allowed' END AS action,
    CASE event_type WHEN 'error' THEN 'malicious' WHEN 'signup' THEN 'suspicious' ELSE 'benign' END AS threat_label,
    CASE event_id % 3 WHEN 0 THEN 'firewall' WHEN 1 THEN 'ids' ELSE 'application' END AS log_type,
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) * 2000 END AS bytes_transferred,
    CASE event_id % 41 WHEN 0 THEN 'sqlmap/1.7.8#stable' WHEN 1 THEN 'nikto/2.1.6'
      WHEN 2 THEN 'hydra/9.4' WHEN 3 THEN NULL ELSE 'Mozilla/5.0' END AS user_agent,
    CASE event_id % 37 WHEN 0 THEN {_q("/product.php?id=1' OR '1'='1")}
      WHEN 1 THEN '/p?id=1 UNION SELECT user,pass FROM users--'
      WHEN 2 THEN '/s?q=<script>alert(1)</script>' WHEN 3 THEN '/../../etc/passwd'
      WHEN 4 THEN '/a/../.../x' WHEN 5 THEN NULL
      ELSE '/page/' || CAST(event_id % 100 AS VARCHAR) END AS request_path,
    event_id
  FROM events
)"""


def _flags(p: P.PatternSet) -> str:
    return f"""regexp_matches(request_path, {_q(p.sqli)}) AS is_sqli,
    regexp_matches(request_path, {_q(p.xss)}) AS is_xss,
    regexp_matches(request_path, {_q(p.lfi)}) AS is_lfi,
    regexp_matches(user_agent, {_q(p.tool)}) AS is_tool"""


def _case(categories, fallback, pick: int) -> str:
    arms = " ".join(
        f"WHEN {flag} THEN {_q(label) if pick == 1 else score}" for flag, label, score in categories
    )
    fb = _q(fallback[0]) if pick == 1 else fallback[1]
    return f"CASE {arms} ELSE {fb} END"


LOG_COLS = ", ".join(f'"{c}"' if c == "timestamp" else c for c in S.LOG_COLUMNS) + ", event_id"


# ---------------------------------------------------------------------------
# Detectors
# ---------------------------------------------------------------------------
def port_scan_sql(logs: str = "logs", threshold: int = S.PORT_SCAN_THRESHOLD) -> str:
    return f"""SELECT source_ip, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
    distinct_targets, event_count, log_type, 'PORT_SCAN' AS attack_type,
    CAST(least(100, 60 + distinct_targets - {threshold}) AS INTEGER) AS threat_score,
    CASE WHEN distinct_targets > 100 THEN 'CRITICAL' WHEN distinct_targets > 50 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
  FROM (
    SELECT source_ip, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start,
      count(DISTINCT dest_ip) AS distinct_targets, count(*) AS event_count,
      first(log_type ORDER BY "timestamp", event_id) AS log_type
    FROM {logs} WHERE protocol = 'TCP'
    GROUP BY source_ip, time_bucket(INTERVAL 5 MINUTE, "timestamp")
  ) g
  WHERE distinct_targets > {threshold}"""


def attack_patterns_sql(logs: str = "logs") -> str:
    cat = _case(P.BATCH_CATEGORIES, P.BATCH_FALLBACK, 1)
    score = _case(P.BATCH_CATEGORIES, P.BATCH_FALLBACK, 2)
    return f"""SELECT {LOG_COLS}, is_sqli, is_xss, is_lfi, is_tool,
    {cat} AS attack_category, {score} AS threat_score, 'CRITICAL' AS severity
  FROM (SELECT *, {_flags(P.BATCH_PATTERNS)} FROM {logs}) f
  WHERE is_sqli OR is_xss OR is_lfi OR is_tool"""


def signatures_sql(logs: str = "logs") -> str:
    cat = _case(P.STREAM_CATEGORIES, P.STREAM_FALLBACK, 1)
    score = _case(P.STREAM_CATEGORIES, P.STREAM_FALLBACK, 2)
    return f"""SELECT {LOG_COLS},
    {cat} AS alert_type, {score} AS threat_score, 'CRITICAL' AS severity,
    1 AS event_count, coalesce(bytes_transferred, 0) AS bytes_total
  FROM (SELECT *, {_flags(P.STREAM_PATTERNS)} FROM {logs}) f
  WHERE is_sqli OR is_xss OR is_lfi OR is_tool"""


def brute_force_sql(logs: str = "logs", threshold: int = S.BRUTE_FORCE_THRESHOLD) -> str:
    return f"""SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, source_ip,
    blocked_count, user_agent, log_type, coalesce(bytes_total, 0) AS bytes_total,
    'BRUTE_FORCE' AS alert_type,
    CAST(least(100, 70 + (blocked_count - {threshold}) * 2) AS INTEGER) AS threat_score,
    CASE WHEN blocked_count > 10 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
    CAST(blocked_count AS INTEGER) AS event_count
  FROM (
    SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS window_start, source_ip,
      count(*) AS blocked_count,
      first(user_agent ORDER BY "timestamp", event_id) AS user_agent,
      first(log_type ORDER BY "timestamp", event_id) AS log_type,
      sum(bytes_transferred) AS bytes_total
    FROM {logs} WHERE action = 'blocked'
    GROUP BY 1, 2
  ) g
  WHERE blocked_count > {threshold}"""


def volume_anomaly_sql(logs: str = "logs") -> str:
    return f"""SELECT window_start, window_start + INTERVAL 10 SECOND AS window_end, source_ip,
    bytes_total, event_count, log_type, user_agent, 'VOLUME_ANOMALY' AS alert_type,
    CAST(least(100, floor(80 + ln(bytes_total / 1048576.0) / ln(10.0) * 5)) AS INTEGER) AS threat_score,
    CASE WHEN bytes_total > {S.VOLUME_CRITICAL_BYTES} THEN 'CRITICAL' ELSE 'HIGH' END AS severity
  FROM (
    SELECT time_bucket(INTERVAL 10 SECOND, "timestamp") AS window_start, source_ip,
      sum(bytes_transferred) AS bytes_total, count(*) AS event_count,
      first(log_type ORDER BY "timestamp", event_id) AS log_type,
      first(user_agent ORDER BY "timestamp", event_id) AS user_agent
    FROM {logs}
    GROUP BY 1, 2
  ) g
  WHERE bytes_total > {S.VOLUME_THRESHOLD_BYTES}"""


def with_logs(body: str, speedup: int, extra_ctes: str = "") -> str:
    ctes = logs_cte(speedup)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------------------
# History analyses (join form, as the original jobs compute them)
# ---------------------------------------------------------------------------
def reputation_sql(logs: str = "logs") -> str:
    return f"""SELECT a.source_ip, a.log_type, a.total_events, a.unique_targets, a.total_bytes,
    coalesce(m.malicious_count, 0) AS malicious_count,
    coalesce(s.suspicious_count, 0) AS suspicious_count,
    CAST(least(100, floor((coalesce(m.malicious_count, 0) * 10 + coalesce(s.suspicious_count, 0) * 5)
         / a.total_events * 100)) AS BIGINT) AS reputation_score
  FROM (
    SELECT source_ip, log_type, count(*) AS total_events, count(DISTINCT dest_ip) AS unique_targets,
      CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
    FROM {logs} WHERE threat_label IN ('suspicious', 'malicious') GROUP BY source_ip, log_type
  ) a
  LEFT JOIN (SELECT source_ip, count(*) AS malicious_count FROM {logs}
             WHERE threat_label = 'malicious' GROUP BY source_ip) m USING (source_ip)
  LEFT JOIN (SELECT source_ip, count(*) AS suspicious_count FROM {logs}
             WHERE threat_label = 'suspicious' GROUP BY source_ip) s USING (source_ip)"""


def top_malicious_sql(k: int = S.TOP_MALICIOUS_K) -> str:
    return f"""SELECT * FROM ({reputation_sql()}) r
  ORDER BY total_events DESC, source_ip, log_type LIMIT {k}"""


def volume_stats_sql(logs: str = "logs") -> str:
    return f"""SELECT threat_label, log_type, protocol,
    avg(bytes_transferred) AS avg_bytes, max(bytes_transferred) AS max_bytes,
    quantile_disc(bytes_transferred, 0.95) AS p95_bytes,
    count(*) AS event_count, CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
  FROM {logs} GROUP BY threat_label, log_type, protocol"""


def timeline_sql(logs: str = "logs") -> str:
    # three filtered aggregations joined on the hour key, zeros filled
    def part(label):
        return f"""(SELECT strftime("timestamp", '%Y%m%d') AS event_date,
        CAST(hour("timestamp") AS INTEGER) AS event_hour, count(*) AS {label}_count
      FROM {logs} WHERE threat_label = '{label}' AND "timestamp" IS NOT NULL GROUP BY 1, 2)"""

    return f"""SELECT event_date, event_hour,
    coalesce(malicious_count, 0) AS malicious_count,
    coalesce(suspicious_count, 0) AS suspicious_count,
    coalesce(benign_count, 0) AS benign_count
  FROM {part('malicious')} m
  FULL OUTER JOIN {part('suspicious')} s USING (event_date, event_hour)
  FULL OUTER JOIN {part('benign')} b USING (event_date, event_hour)"""


def label_counts_sql(label: str, logs: str = "logs") -> str:
    return f"""SELECT source_ip, count(*) AS {label}_count FROM {logs}
  WHERE threat_label = '{label}' GROUP BY source_ip"""


# ---------------------------------------------------------------------------
# Alerts (envelope, union of live detectors, read-side views)
# ---------------------------------------------------------------------------
def _envelope_windowed(src: str) -> str:
    return f"""SELECT source_ip AS ip_source, window_end AS bucket_time,
    sha256(alert_type || '|' || source_ip || '|' || CAST(epoch_us(window_start) AS VARCHAR)) AS alert_id,
    window_end AS last_seen, CAST(threat_score AS INTEGER) AS threat_score, [alert_type] AS attack_types,
    alert_type, severity, CAST(event_count AS INTEGER) AS event_count,
    CAST(coalesce(bytes_total, 0) AS BIGINT) AS bytes_total,
    [coalesce(nullif(user_agent, ''), 'unknown')] AS user_agents,
    [coalesce(nullif(log_type, ''), 'unknown')] AS log_sources,
    window_start, window_end
  FROM {src}"""


def _envelope_event(src: str) -> str:
    return f"""SELECT source_ip AS ip_source, "timestamp" AS bucket_time,
    sha256(alert_type || '|' || source_ip || '|' || CAST(event_id AS VARCHAR)) AS alert_id,
    "timestamp" AS last_seen, CAST(threat_score AS INTEGER) AS threat_score, [alert_type] AS attack_types,
    alert_type, severity, CAST(event_count AS INTEGER) AS event_count,
    CAST(coalesce(bytes_total, 0) AS BIGINT) AS bytes_total,
    [coalesce(nullif(user_agent, ''), 'unknown')] AS user_agents,
    [coalesce(nullif(log_type, ''), 'unknown')] AS log_sources,
    CAST(NULL AS TIMESTAMP) AS window_start, CAST(NULL AS TIMESTAMP) AS window_end
  FROM {src}"""


def alert_ctes(which=("bf", "sig", "vol")) -> str:
    """CTEs ``bf``, ``sig``, ``vol`` (detector rows) and ``alerts`` (envelope union)."""
    parts = {
        "bf": (brute_force_sql(), _envelope_windowed("bf")),
        "sig": (signatures_sql(), _envelope_event("sig")),
        "vol": (volume_anomaly_sql(), _envelope_windowed("vol")),
    }
    ctes = [f"{k} AS ({parts[k][0]})" for k in which]
    union = "\n  UNION ALL\n".join(parts[k][1] for k in which)
    ctes.append(f"alerts AS ({union})")
    ctes.append(
        """live AS (SELECT * FROM alerts
    WHERE bucket_time > (SELECT max(bucket_time) FROM alerts) - INTERVAL 24 HOUR
      AND bucket_time <= (SELECT max(bucket_time) FROM alerts))"""
    )
    ctes.append(
        """recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ip_source
      ORDER BY bucket_time DESC, alert_id)::INTEGER AS alert_rank FROM live) r WHERE alert_rank <= 10)"""
    )
    ctes.append(
        """speed AS (SELECT ip_source AS ip, CAST(count(*) AS INTEGER) AS active_alerts,
      max(last_seen) AS last_seen, max(threat_score) AS current_threat_score,
      CAST(sum(bytes_total) AS BIGINT) AS bytes_recent_alerts,
      list_sort(list_distinct(flatten(list(list_concat(attack_types, [alert_type])))))
        AS recent_attack_types
    FROM recent GROUP BY ip_source)"""
    )
    return ",\n".join(ctes)


def with_alerts(body: str, speedup: int, which=("bf", "sig", "vol")) -> str:
    return with_logs(body, speedup, alert_ctes(which))


ACTIVE_ALERTS_BODY = f"""SELECT * FROM live
  ORDER BY threat_score DESC, bucket_time DESC, alert_id LIMIT {S.ACTIVE_ALERTS_LIMIT}"""

LAST_MINUTE_NOW = "2024-01-01 00:03:00"
LAST_MINUTE_BODY = "SELECT * FROM alerts WHERE bucket_time > TIMESTAMP '2024-01-01 00:02:00'"

SEVERITY_METRICS_BODY = """SELECT count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
    count(*) FILTER (WHERE severity = 'HIGH') AS high_alerts, count(*) AS total_alerts FROM live"""

TOP_ALERT_IPS_BODY = """SELECT CAST(row_number() OVER (ORDER BY max_score DESC, ip_source) AS INTEGER) AS rank,
    ip_source, max_score, max_score * CAST(100.0 AS DOUBLE) / max(max_score) OVER () AS bar_pct,
    CASE WHEN max_score >= 80 THEN 'crit' WHEN max_score >= 60 THEN 'high'
         WHEN max_score >= 40 THEN 'med' ELSE 'low' END AS score_band
  FROM (SELECT ip_source, max(coalesce(threat_score, 0)) AS max_score FROM live
        WHERE ip_source IS NOT NULL GROUP BY ip_source
        ORDER BY max_score DESC, ip_source LIMIT 10) t"""


def alert_type_counts_body() -> str:
    t = "coalesce(alert_type, 'OTHER')"
    arms = ", ".join(f"count(*) FILTER (WHERE {t} = '{k}') AS {k.lower()}" for k in S.CHART_ALERT_TYPES)
    known = ", ".join(f"'{k}'" for k in S.CHART_ALERT_TYPES)
    return f"SELECT {arms}, count(*) FILTER (WHERE {t} NOT IN ({known})) AS other FROM live"


# ---------------------------------------------------------------------------
# Served tables and fused profiles
# ---------------------------------------------------------------------------
def snapshot_sql(logs: str = "logs") -> str:
    m = "count(*) FILTER (WHERE threat_label = 'malicious')"
    s = "count(*) FILTER (WHERE threat_label = 'suspicious')"
    return f"""SELECT source_ip, count(*) AS total_events, count(DISTINCT dest_ip) AS unique_targets,
    CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
    {m} AS malicious_count, {s} AS suspicious_count,
    list_sort(list_distinct(list(log_type))) AS log_types,
    min("timestamp") AS first_seen, max("timestamp") AS last_seen,
    CAST(least(100, floor(({m} * 10 + {s} * 5) / count(*) * 100)) AS BIGINT) AS reputation_score,
    CAST(least(100, floor(({m} * 10 + {s} * 5) / ({m} + {s}) * 10)) AS INTEGER) AS reputation_score_norm
  FROM {logs} WHERE threat_label IN ('malicious', 'suspicious') GROUP BY source_ip"""


def serving_ctes(score_col: str = "reputation_score") -> str:
    known = ", ".join(f"'{k}'" for k in S.KNOWN_ATTACK_TYPES)
    return ",\n".join(
        [
            alert_ctes(),
            f"snap AS ({snapshot_sql()})",
            f"ap AS ({attack_patterns_sql()})",
            f"ps AS ({port_scan_sql()})",
            """idx AS (
    SELECT attack_category AS attack_type, source_ip, count(*) AS count, max("timestamp") AS last_seen
    FROM ap GROUP BY attack_category, source_ip
    UNION ALL
    SELECT 'PORT_SCAN' AS attack_type, source_ip, max(distinct_targets) AS count, max(window_end) AS last_seen
    FROM ps GROUP BY source_ip)""",
            f"""types AS (SELECT source_ip AS ip, list_sort(list_distinct(list(attack_type))) AS attack_types
    FROM idx WHERE attack_type IN ({known}) GROUP BY source_ip)""",
            f"""prof AS (
    SELECT ip,
      coalesce(CAST(b.{score_col} AS INTEGER), 0) AS reputation_score,
      coalesce(b.total_events, 0) AS total_historical_events,
      coalesce(t.attack_types, []::VARCHAR[]) AS attack_types_detected,
      b.first_seen, b.last_seen AS last_batch_update,
      coalesce(s.active_alerts, 0) AS active_alerts, s.last_seen,
      coalesce(s.current_threat_score, 0) AS current_threat_score,
      coalesce(s.recent_attack_types, []::VARCHAR[]) AS recent_attack_types,
      coalesce(s.bytes_recent_alerts, 0) AS bytes_recent_alerts
    FROM (SELECT source_ip AS ip, * EXCLUDE (source_ip) FROM snap) b
    FULL OUTER JOIN types t USING (ip)
    FULL OUTER JOIN speed s USING (ip))""",
            """fused AS (
    SELECT *,
      CASE WHEN reputation_score > 80 AND active_alerts >= 1 THEN 'BLOCK'
           WHEN reputation_score >= 50 THEN 'MONITOR'
           WHEN active_alerts > 0 THEN 'MONITOR' ELSE 'ALLOW' END AS recommendation,
      round(least(1.0, (reputation_score * CAST(0.4 AS DOUBLE) + current_threat_score * CAST(0.6 AS DOUBLE))
                       / CAST(100.0 AS DOUBLE)), 2) AS confidence
    FROM prof)""",
        ]
    )


def with_serving(body: str, speedup: int, score_col: str = "reputation_score") -> str:
    return with_logs(body, speedup, serving_ctes(score_col))


TIMELINE_RANGE_BODY = f"""SELECT event_date AS date, lpad(CAST(event_hour AS VARCHAR), 2, '0') AS hour,
    malicious_count AS malicious, suspicious_count AS suspicious, benign_count AS benign,
    event_date || ' ' || lpad(CAST(event_hour AS VARCHAR), 2, '0') || 'h' AS label
  FROM ({timeline_sql()}) t
  WHERE event_date BETWEEN '20240105' AND '20240119'"""

ALERT_LIST_BODY = """SELECT *, CASE WHEN threat_score >= 80 THEN 'crit' WHEN threat_score >= 60 THEN 'high'
    WHEN threat_score >= 40 THEN 'med' ELSE 'low' END AS score_band,
    CASE WHEN bytes_total = 0 THEN '0 B' WHEN bytes_total >= 1073741824 THEN printf('%.1f GB', bytes_total / 1073741824.0)
      WHEN bytes_total >= 1048576 THEN printf('%.1f MB', bytes_total / 1048576.0)
      WHEN bytes_total >= 1024 THEN printf('%.1f KB', bytes_total / 1024.0) ELSE printf('%.1f B', bytes_total / 1.0) END AS bytes_display
  FROM live WHERE severity = 'HIGH'"""

PROFILE_REQUESTS_BODY = """SELECT r.ip, length(r.ip) BETWEEN 1 AND 45 AS valid,
    coalesce(f.reputation_score, 0) AS reputation_score, coalesce(f.active_alerts, 0) AS active_alerts,
    CASE WHEN length(r.ip) BETWEEN 1 AND 45 THEN coalesce(f.recommendation, 'ALLOW') END AS recommendation,
    coalesce(f.confidence, 0.0) AS confidence
  FROM (SELECT DISTINCT trim(CASE event_id % 4 WHEN 0 THEN '  ' || source_ip WHEN 1 THEN dest_ip WHEN 2 THEN ' '
        ELSE repeat(source_ip, 5) END) AS ip FROM logs) r
  LEFT JOIN fused f ON f.ip = r.ip"""

GLOBAL_STATS_BODY = f"""SELECT count(*) AS total_ips_analyzed,
    count(*) FILTER (WHERE reputation_score > {S.HIGH_RISK_SCORE}) AS high_risk_ips FROM snap"""

GLOBAL_STATS_NORM_BODY = f"""SELECT count(*) AS total_ips_analyzed,
    count(*) FILTER (WHERE reputation_score_norm > {S.HIGH_RISK_SCORE}) AS high_risk_ips FROM snap"""

PROFILE_DOCS_BODY = """SELECT ip,
    {'reputationScore': reputation_score, 'totalHistoricalEvents': total_historical_events,
     'attackTypesDetected': attack_types_detected, 'firstSeen': first_seen,
     'lastBatchUpdate': last_batch_update} AS batch_layer,
    {'activeAlerts': active_alerts, 'lastSeen': last_seen, 'currentThreatScore': current_threat_score,
     'recentAttackTypes': recent_attack_types, 'bytesRecentAlerts': bytes_recent_alerts} AS speed_layer,
    recommendation, confidence
  FROM fused"""


# ---------------------------------------------------------------------------
# Ingestion and message codec
# ---------------------------------------------------------------------------
LOG_COLS_SECONDS = LOG_COLS.replace('"timestamp"', 'date_trunc(\'second\', "timestamp") AS "timestamp"')

DATE_PARTITIONS_BODY = f"""SELECT {LOG_COLS}, strftime("timestamp", '%Y') AS year,
    strftime("timestamp", '%m') AS month, strftime("timestamp", '%d') AS day FROM logs"""

INGEST_CSV_BODY = f"SELECT {LOG_COLS_SECONDS.replace(', event_id', '')} FROM logs"

# every 53rd row has a broken time, every 59th no source address
INGEST_FILES_BODY = f"""SELECT {LOG_COLS_SECONDS.replace(', event_id', '').replace(' source_ip,', ' if(event_id % 59 = 0, NULL, source_ip) AS source_ip,').replace('date_trunc(', 'if(event_id % 53 = 0, NULL, date_trunc(').replace(') AS "timestamp"', ')) AS "timestamp"')},
    CASE WHEN event_id % 53 = 0 THEN 'malformed' WHEN event_id % 59 = 0 THEN 'missing:source_ip' END AS reject_reason FROM logs"""

# the sketch may be off by a thousandth of the group's rows, in rank
P95_RANK_BODY = """SELECT threat_label, log_type, protocol, avg(bytes_transferred) AS avg_bytes, max(bytes_transferred) AS max_bytes,
    count(*) AS event_count, CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, true AS p95_within
  FROM logs GROUP BY threat_label, log_type, protocol"""

QUANTILE_DAYS = ("2024-01-05 00:00:00", "2024-01-19 00:00:00")
QUANTILES_RANGE_BODY = """SELECT threat_label, log_type, protocol, count(bytes_transferred) AS n, max(bytes_transferred) AS largest,
    CAST(sum(bytes_transferred) AS BIGINT) AS total, true AS within
  FROM logs WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-19' GROUP BY ALL"""

PARSE_JSON_BODY = f"SELECT {LOG_COLS_SECONDS} FROM logs"


def _json_str(expr: str) -> str:
    return f"coalesce(CAST(to_json({expr}) AS VARCHAR), 'null')"


PUBLISH_PARTITIONS_BODY = """SELECT log_type AS key,
    CAST(CASE log_type WHEN 'firewall' THEN 0 WHEN 'ids' THEN 1 WHEN 'application' THEN 2 ELSE 0 END * 8
      + CAST('0x' || substr(md5(coalesce(source_ip, '') || '|' || coalesce(dest_ip, '')), 1, 8) AS BIGINT) % 8 AS INTEGER)
      AS partition, count(*) AS messages
  FROM logs GROUP BY ALL"""


def encode_messages_body() -> str:
    parts = []
    for c in S.LOG_COLUMNS + ["event_id"]:
        if c == "timestamp":
            v = _json_str("""strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ')""")
        elif c in ("bytes_transferred", "event_id"):
            v = f"coalesce(CAST({c} AS VARCHAR), 'null')"
        else:
            v = _json_str(c)
        parts.append(f"""'"{c}":' || {v}""")
    value = " || ',' || ".join(parts)
    part = " ".join(f"WHEN '{t}' THEN {p}" for t, p in S.MESSAGE_PARTITIONS.items())
    return f"""SELECT 'cybersecurity-logs' AS topic, log_type AS key, '{{' || {value} || '}}' AS value,
    CAST(CASE log_type {part} ELSE 0 END AS INTEGER) AS partition FROM logs"""


NORMALIZE_BODY = f"""SELECT
    CASE WHEN event_id % 4 = 3 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f')
         ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
    source_ip, dest_ip, protocol, action, threat_label, log_type, coalesce(bytes_transferred, 0) AS bytes_transferred,
    coalesce(nullif(user_agent, ''), '') AS user_agent,
    coalesce(nullif(request_path, ''), '/') AS request_path, event_id
  FROM logs"""

ATTACK_CATEGORY_COUNTS_BODY = "SELECT attack_category, count(*) AS count FROM ap GROUP BY attack_category"

ATTACK_FLAGS_BODY = f"""SELECT is_sqli, is_xss, is_lfi, is_tool, count(*) AS event_count
  FROM (SELECT {_flags(P.BATCH_PATTERNS)} FROM logs) f GROUP BY ALL"""

TOP_ATTACK_PATTERNS_BODY = f"""SELECT * FROM ap
  ORDER BY threat_score DESC, "timestamp" DESC, event_id LIMIT {S.TOP_ATTACK_PATTERNS_K}"""


STREAM_PORT_SCAN_BODY = """SELECT source_ip, window_start, window_end, distinct_targets, attack_type,
    threat_score, severity FROM ps"""

OBSERVED_IP_PROFILES_BODY = """SELECT r.ip, length(r.ip) BETWEEN 1 AND 45 AS valid,
    coalesce(f.reputation_score, 0) AS reputation_score,
    coalesce(f.total_historical_events, 0) AS total_historical_events,
    coalesce(f.attack_types_detected, []::VARCHAR[]) AS attack_types_detected,
    f.first_seen, f.last_batch_update,
    coalesce(f.active_alerts, 0) AS active_alerts, f.last_seen,
    coalesce(f.current_threat_score, 0) AS current_threat_score,
    coalesce(f.recent_attack_types, []::VARCHAR[]) AS recent_attack_types,
    coalesce(f.bytes_recent_alerts, 0) AS bytes_recent_alerts,
    coalesce(f.recommendation, 'ALLOW') AS recommendation,
    coalesce(f.confidence, 0.0) AS confidence
  FROM (SELECT trim(source_ip) AS ip FROM logs UNION SELECT trim(dest_ip) FROM logs) r
  LEFT JOIN fused f ON f.ip = r.ip"""


# -- streams with several micro-batches ------------------------------------------------------------

ARRIVALS = 5
STORE_SPEEDUP = 10
# turn in which an event arrives, in SQL that both engines read: by its time, by its number, or by time with stragglers
ARRIVAL_BY_ID = "floor((event_id % 35) / 7)"
ARRIVAL_BY_TIME = f"least({ARRIVALS - 1}, floor((day(ts) - 1) / 6))"
ARRIVAL_LATE = f"least({ARRIVALS - 1}, floor((day(ts) - 1) / 6) + CASE WHEN event_id % 97 = 0 THEN 2 ELSE 0 END)"
ADMISSION_DELAY = "10 SECONDS"
FORGED_TIME = "CASE WHEN event_id % 89 = 5 THEN timestamp + INTERVAL 200 YEAR ELSE timestamp END"


def with_admission(body: str, speedup: int = 10000) -> str:
    """CTEs ``judged`` (all rows with their verdict) and ``bf`` / ``alerts`` over the admitted ones."""
    turn = ARRIVAL_LATE.replace("(ts)", "(e.ts)").replace("event_id", "e.event_id")
    return f"""WITH {logs_cte(speedup, "told")},
  arrived AS (SELECT t.* REPLACE (CASE WHEN t.event_id % 89 = 5 THEN t."timestamp" + INTERVAL 200 YEAR ELSE t."timestamp" END
      AS "timestamp"), t.event_id % 89 = 5 AS forged, {turn} AS turn FROM told t JOIN events e ON e.event_id = t.event_id),
  highs AS (SELECT x.turn, max(a."timestamp") AS high FROM (SELECT DISTINCT turn FROM arrived) x
    JOIN arrived a ON a.turn < x.turn AND NOT a.forged GROUP BY x.turn),
  judged AS (SELECT a.*, CASE WHEN forged THEN 'ahead' WHEN a."timestamp" < h.high - INTERVAL 10 SECOND THEN 'late'
      ELSE 'admitted' END AS verdict FROM arrived a LEFT JOIN highs h ON h.turn = a.turn),
  logs AS (SELECT * FROM judged WHERE verdict = 'admitted'),
  {alert_ctes(("bf",))}
{body}"""


ADMITTED_ALERTS_BODY = """SELECT 'alert' AS kind, alert_id AS name, CAST(event_count AS BIGINT) AS n FROM alerts
  UNION ALL SELECT 'rows', v.verdict, count(judged.event_id) FROM (VALUES ('admitted'), ('late'), ('ahead')) v(verdict)
    LEFT JOIN judged ON judged.verdict = v.verdict GROUP BY v.verdict"""
