"""Typed data model: log events, live messages, alerts, served tables.

Every schema is a plain ``StructType`` so the same definitions drive file
sources (CSV, JSON, Parquet), ``from_json``/``from_csv`` and tests.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of one security-log event, in file order.
LOG_COLUMNS = [
    "timestamp",
    "source_ip",
    "dest_ip",
    "protocol",
    "action",
    "threat_label",
    "log_type",
    "bytes_transferred",
    "user_agent",
    "request_path",
]

# Columns that the CSV layout declares NOT NULL.  File sources do not enforce
# nullability, so ingestion enforces it with an explicit filter.
REQUIRED_LOG_COLUMNS = LOG_COLUMNS[:7]

# Timestamps carry no zone: wall-clock time as written by the log producer.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("source_ip", T.StringType(), True),
        T.StructField("dest_ip", T.StringType(), True),
        T.StructField("protocol", T.StringType(), True),
        T.StructField("action", T.StringType(), True),
        T.StructField("threat_label", T.StringType(), True),
        T.StructField("log_type", T.StringType(), True),
        T.StructField("bytes_transferred", T.LongType(), True),
        T.StructField("user_agent", T.StringType(), True),
        T.StructField("request_path", T.StringType(), True),
    ]
)

# Date-partitioned log table: three zero-padded string partition columns.
PARTITION_COLUMNS = ["year", "month", "day"]
PARTITIONED_LOG_SCHEMA = T.StructType(
    LOG_SCHEMA.fields + [T.StructField(c, T.StringType(), True) for c in PARTITION_COLUMNS]
)

# Live JSON message: the ten log fields, all nullable, timestamp kept as text
# so that several layouts can be accepted; ``event_id`` is an optional
# identity carried by producers that have one.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType(), True)]
    + LOG_SCHEMA.fields[1:]
    + [T.StructField("event_id", T.LongType(), True)]
)

# Alert envelope written by every detector (one row per alert revision).
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("ip_source", T.StringType(), True),
        T.StructField("bucket_time", T.TimestampNTZType(), True),
        T.StructField("alert_id", T.StringType(), True),
        T.StructField("last_seen", T.TimestampNTZType(), True),
        T.StructField("threat_score", T.IntegerType(), True),
        T.StructField("attack_types", T.ArrayType(T.StringType()), True),
        T.StructField("alert_type", T.StringType(), True),
        T.StructField("severity", T.StringType(), True),
        T.StructField("event_count", T.IntegerType(), True),
        T.StructField("bytes_total", T.LongType(), True),
        T.StructField("user_agents", T.ArrayType(T.StringType()), True),
        T.StructField("log_sources", T.ArrayType(T.StringType()), True),
        T.StructField("window_start", T.TimestampNTZType(), True),
        T.StructField("window_end", T.TimestampNTZType(), True),
    ]
)
ALERT_COLUMNS = [f.name for f in ALERT_SCHEMA.fields]

# ---------------------------------------------------------------------------
# Fixed values that must equal the original system's for equal results.
# ---------------------------------------------------------------------------
PORT_SCAN_THRESHOLD = 20
PORT_SCAN_WINDOW = "5 minutes"
BRUTE_FORCE_THRESHOLD = 5
BRUTE_FORCE_WINDOW = "1 minute"
VOLUME_THRESHOLD_BYTES = 10 * 1024 * 1024
VOLUME_CRITICAL_BYTES = 100 * 1024 * 1024
VOLUME_WINDOW = "10 seconds"
ALERT_TTL = "24 hours"
# Event times further ahead of the run time than this are not believed: they neither
# move a watermark nor the "now" of a time-to-live (not a value of the original).
CLOCK_TOLERANCE = "1 hour"
RECENT_ALERTS_PER_IP = 10
ACTIVE_ALERTS_LIMIT = 200
TOP_MALICIOUS_K = 10
TOP_ATTACK_PATTERNS_K = 200
HIGH_RISK_SCORE = 70
MAX_IP_TEXT_LENGTH = 45

# Attack types a profile lookup recognises in the batch index.
KNOWN_ATTACK_TYPES = ["PORT_SCAN", "SQLI", "XSS", "LFI", "TOOL_DETECTED", "BRUTE_FORCE", "INJECTION"]

# Alert types with their own slot in the alert-type breakdown; others -> OTHER.
CHART_ALERT_TYPES = ["BRUTE_FORCE", "SQLI_DETECTED", "PORT_SCAN", "KNOWN_ATTACK_TOOL", "VOLUME_ANOMALY"]

# Live-message partition per log type (unknown types go to partition 0).
MESSAGE_PARTITIONS = {"firewall": 0, "ids": 1, "application": 2}

# Defaults applied by message normalisation when a field is missing.
MESSAGE_DEFAULTS = {
    "source_ip": "0.0.0.0",
    "dest_ip": "0.0.0.0",
    "protocol": "HTTP",
    "action": "allowed",
    "threat_label": "benign",
    "log_type": "firewall",
}

# Timestamp layouts accepted from producers (Spark datetime patterns), in
# the order they are tried, and the layout that normalisation emits.
ACCEPTED_TIMESTAMP_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss"]
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
