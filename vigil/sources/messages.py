"""Live-message codec: JSON decode, producer-side normalisation, keyed encode.

Everything is column expressions, so it runs on a static frame, a file
stream or a Kafka stream (``value`` column) unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import schema as S
from vigil.functions.timecols import parse_timestamp_any

TOPIC = "cybersecurity-logs"


def parse_json_logs(raw: DataFrame, column: str = "value") -> DataFrame:
    """Decode JSON messages into log rows; rows without ``source_ip`` are dropped.

    Undecodable JSON yields an all-NULL row (dropped); a bad field yields
    NULL in that field only.  The timestamp text is accepted in the producer
    layouts, then in any ISO-8601 layout Spark's cast understands.
    """
    msg = F.from_json(F.col(column).cast("string"), S.MESSAGE_SCHEMA)
    # decode once: as a Generate output the fields cannot be re-derived
    # (re-parsed) inside pushed-down filters
    # the place in the source names messages that carry no event id
    place = ["topic", "partition", "offset"]
    if set(place) <= set(raw.columns):
        msg = msg.withField("source_offset", F.concat_ws(":", *[F.col(c).cast("string") for c in place]))
    parsed = raw.select(F.inline(F.array(msg)))
    ts_text = F.col("timestamp")
    ts = F.coalesce(parse_timestamp_any(ts_text), F.try_to_timestamp(ts_text).cast("timestamp_ntz"))
    return parsed.withColumn("timestamp", ts).filter(F.col("source_ip").isNotNull())


def _text(c: str, cols: set) -> Column:
    return F.col(c).cast("string") if c in cols else F.lit(None).cast("string")


def normalize_logs(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Producer normalisation of raw text rows.

    * timestamp: first accepted layout -> ``yyyy-MM-ddTHH:mm:ssZ``; text that
      parses in none of them is kept as is; empty -> ``now``.
    * bytes_transferred: integer text -> BIGINT, anything else -> 0.
    * source/dest IP, protocol, action, label, log type: default only when the
      column is absent (present-but-empty values pass through).
    * user_agent: NULL or empty -> ''; request_path: NULL or empty -> '/'.
    """
    cols = set(raw.columns)
    now = now if now is not None else F.current_timestamp()
    ts_text = _text("timestamp", cols)
    parsed = parse_timestamp_any(ts_text)
    timestamp = (
        F.when(ts_text.isNull() | (ts_text == ""), F.date_format(now, S.ISO_Z_FORMAT))
        .when(parsed.isNotNull(), F.date_format(parsed, S.ISO_Z_FORMAT))
        .otherwise(ts_text)
    )
    out = {"timestamp": timestamp}
    for c, default in S.MESSAGE_DEFAULTS.items():
        out[c] = _text(c, cols) if c in cols else F.lit(default)
    # integer text as a producer's int() reads it: surrounding blanks, a sign
    # and digit-group underscores ("1_000") are accepted; anything else is 0
    digits = F.regexp_replace(F.trim(_text("bytes_transferred", cols)), r"(?<=\d)_(?=\d)", "")
    out["bytes_transferred"] = F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))
    out["user_agent"] = F.coalesce(F.nullif(_text("user_agent", cols), F.lit("")), F.lit(""))
    out["request_path"] = F.coalesce(F.nullif(_text("request_path", cols), F.lit("")), F.lit("/"))
    extra = [F.col(c) for c in raw.columns if c not in out]
    return raw.select(*[out[c].alias(c) for c in S.LOG_COLUMNS], *extra)


def message_partition(log_type: Column, split: int = 1, split_by: tuple[str, ...] = ("source_ip",)) -> Column:
    """Topic partition of a log type; with ``split`` each type has that many
    partitions in a row, dealt by a digest of the columns ``split_by``."""
    expr = None
    for t, p in S.MESSAGE_PARTITIONS.items():
        expr = F.when(log_type == t, p) if expr is None else expr.when(log_type == t, p)
    own = expr.otherwise(0)
    if split == 1:
        return own
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in split_by]))
    place = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(split))
    return (own * split + place).cast("int")


def encode_messages(logs: DataFrame, topic: str = TOPIC, split: int = 1,
                    split_by: tuple[str, ...] = ("source_ip",)) -> DataFrame:
    """Kafka-shaped rows: ``key`` = log type, ``value`` = JSON of the log
    fields (all keys present, timestamp as ISO ``Z``), fixed ``partition``
    per log type.  Works with ``write.format("kafka")`` where the connector
    is available, or any file sink.

    ``split`` gives every log type that many partitions (type 1 of 8 has 8 to
    15), so publishing and reading grow with the topic.  Dealt by source, a
    source's messages of a type stay in order in one partition; add
    ``dest_ip`` to ``split_by`` where one source sends much of the traffic."""
    fields = [c for c in S.LOG_COLUMNS + ["event_id"] if c in logs.columns]
    value = F.to_json(
        F.struct(*[F.col(c) for c in fields]),
        {"timestampNTZFormat": S.ISO_Z_FORMAT, "timestampFormat": S.ISO_Z_FORMAT, "ignoreNullFields": "false"},
    )
    return logs.select(
        F.lit(topic).alias("topic"),
        F.col("log_type").alias("key"),
        value.alias("value"),
        message_partition(F.col("log_type"), split, split_by).alias("partition"),
    )


def write_messages(encoded: DataFrame, path: str | None = None, bootstrap: str | None = None,
                   mode: str = "append") -> None:
    """Publish ``encode_messages`` rows.

    With ``bootstrap`` the rows go to Kafka (``topic``/``key``/``value``/
    ``partition`` columns; needs the spark-sql-kafka connector).  Otherwise
    the JSON values are written as text files under ``path``, one folder per
    partition, which ``streaming.detectors.json_file_source`` replays.
    """
    if bootstrap:
        encoded.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()
        return
    if not path:
        raise ValueError("path or bootstrap is required")
    encoded.select("value", "partition").write.mode(mode).partitionBy("partition").text(path)
