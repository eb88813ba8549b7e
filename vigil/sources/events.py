"""Derive security-log rows from the generic ``events`` table.

The mapping is a pure projection (no shuffle), so it runs on static and
streaming frames alike and its cost grows linearly with ``events``.
``speedup`` compresses time around ``ORIGIN`` so that windowed detectors see
realistic event density: 1 keeps history as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigil.functions.timecols import compress_time_sql

ORIGIN = "2024-01-01 00:00:00"

# ---------------------------------------------------------------------------
# Fixed values of the events -> logs mapping (FIXTURES.md section 3).
# ---------------------------------------------------------------------------
USER_AGENTS = {0: "sqlmap/1.7.8#stable", 1: "nikto/2.1.6", 2: "hydra/9.4", 3: None}
USER_AGENT_MODULUS = 41
USER_AGENT_DEFAULT = "Mozilla/5.0"
REQUEST_PATHS = {
    0: "/product.php?id=1' OR '1'='1",
    1: "/p?id=1 UNION SELECT user,pass FROM users--",
    2: "/s?q=<script>alert(1)</script>",
    3: "/../../etc/passwd",
    4: "/a/../.../x",
    5: None,
}
REQUEST_PATH_MODULUS = 37
PROTOCOLS = {2: "HTTP", 3: "SSH"}  # event_id % 4, else TCP
LOG_TYPES = ["firewall", "ids", "application"]  # event_id % 3
TARGETS = 61  # distinct destinations, so that targets repeat within a window
NO_BYTES_MODULUS = 43  # events without a byte count
BLOCKED_TYPES = ["error", "signup"]
LABELS = {"error": "malicious", "signup": "suspicious"}  # else benign


def _sql_str(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_case(key: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {_sql_str(k) if isinstance(k, str) else k} THEN {_sql_str(v)}" for k, v in table.items())
    return f"CASE {key} {arms} ELSE {default} END"


def _sql_dotted(prefix: str, n: str) -> str:
    return f"format_string('{prefix}.%d.%d.%d', ({n} div 65536) % 256, ({n} div 256) % 256, {n} % 256)"


def logs_from_events(events: DataFrame, speedup: int = 1) -> DataFrame:
    """Map ``events`` rows to the log model plus ``event_id`` (row identity).

    Written as one SQL projection (a single call into the JVM) rather than
    dozens of column-builder calls; Catalyst sees the same expressions.
    """
    blocked = ", ".join(_sql_str(t) for t in BLOCKED_TYPES)
    log_types = ", ".join(_sql_str(t) for t in LOG_TYPES)
    agent = _sql_case(f"event_id % {USER_AGENT_MODULUS}", USER_AGENTS, _sql_str(USER_AGENT_DEFAULT))
    path = _sql_case(f"event_id % {REQUEST_PATH_MODULUS}", REQUEST_PATHS,
                     "'/page/' || CAST(event_id % 100 AS STRING)")
    return events.selectExpr(
        f"{compress_time_sql('ts', ORIGIN, speedup)} AS timestamp",
        f"{_sql_dotted('10', 'user_id')} AS source_ip",
        f"{_sql_dotted('192', f'(event_id % {TARGETS})')} AS dest_ip",
        f"{_sql_case('event_id % 4', PROTOCOLS, _sql_str('TCP'))} AS protocol",
        f"CASE WHEN event_type IN ({blocked}) THEN 'blocked' ELSE 'allowed' END AS action",
        f"{_sql_case('event_type', LABELS, _sql_str('benign'))} AS threat_label",
        f"element_at(array({log_types}), CAST(event_id % 3 + 1 AS INT)) AS log_type",
        f"CASE WHEN event_id % {NO_BYTES_MODULUS} = 0 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) * 2000 END "
        "AS bytes_transferred",
        f"{agent} AS user_agent",
        f"{path} AS request_path",
        "event_id",
    )


EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_events(spark, sf_dir: str) -> DataFrame:
    """The ``events`` table, read with its declared schema (no footer inference)."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def load_logs(spark, sf_dir: str, speedup: int = 1) -> DataFrame:
    return logs_from_events(read_events(spark, sf_dir), speedup)
