"""Ingestion and message-codec queries (section A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil import schema as S
from vigil.plans import oracle as O
from vigil.plans.catalog import history_logs, register
from vigil.session import scratch_path
from vigil.sources import logs as L
from vigil.sources import messages as M


def raw_text_logs(logs):
    """Logs as a producer sends them: all text, timestamps in the three
    accepted layouts plus one unaccepted (fractional) layout."""
    ts, sel = F.col("timestamp"), F.col("event_id") % 4
    text_ts = (
        F.when(sel == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(sel == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(sel == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return logs.select(
        text_ts.alias("timestamp"),
        *[F.col(c) for c in ["source_ip", "dest_ip", "protocol", "action", "threat_label", "log_type"]],
        F.col("bytes_transferred").cast("string").alias("bytes_transferred"),
        "user_agent",
        "request_path",
        "event_id",
    )


@register("date_partitions", O.with_logs(O.DATE_PARTITIONS_BODY, 1))
def date_partitions(spark, sf_dir):
    return L.add_date_partitions(history_logs(spark, sf_dir))


@register("ingest_csv_files", O.with_logs(O.INGEST_FILES_BODY, 1))
def ingest_csv_files(spark, sf_dir):
    """CSV files with broken times and missing addresses, ingested: the log table and the quarantine together."""
    work, event = scratch_path(spark, "csv"), F.col("event_id")
    told = history_logs(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) if c != "timestamp" else F.when(
        event % 53 == 0, F.lit("no time")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss")).alias(c)
        if c != "source_ip" else F.col(c) for c in S.LOG_COLUMNS], "event_id")
    told = told.withColumn("source_ip", F.when(event % 59 != 0, F.col("source_ip")))
    told.select(*S.LOG_COLUMNS).write.option("header", "true").csv(f"{work}/in")
    done = L.ingest_csv(spark, f"{work}/in", f"{work}/logs")
    good = L.read_logs(spark, done["dest"]).withColumn("reject_reason", F.lit(None).cast("string"))
    return good.unionByName(spark.read.parquet(done["quarantine"]).drop("raw_record"))


@register("ingest_csv", O.with_logs(O.INGEST_CSV_BODY, 1))
def ingest_csv(spark, sf_dir):
    good, _rejected = L.parse_csv_lines(L.to_csv_lines(history_logs(spark, sf_dir)))
    return good


@register("parse_json", O.with_logs(O.PARSE_JSON_BODY, 1))
def parse_json(spark, sf_dir):
    return M.parse_json_logs(M.encode_messages(history_logs(spark, sf_dir)))


@register("publish_partitions", O.with_logs(O.PUBLISH_PARTITIONS_BODY, 1))
def publish_partitions(spark, sf_dir):
    """Load of each topic partition when every log type has eight, dealt by source and target."""
    sent = M.encode_messages(history_logs(spark, sf_dir), split=8, split_by=("source_ip", "dest_ip"))
    return sent.groupBy("key", "partition").agg(F.count(F.lit(1)).alias("messages"))


@register("encode_messages", O.with_logs(O.encode_messages_body(), 1))
def encode_messages(spark, sf_dir):
    return M.encode_messages(history_logs(spark, sf_dir))


@register("normalize_logs", O.with_logs(O.NORMALIZE_BODY, 1))
def normalize_logs(spark, sf_dir):
    return M.normalize_logs(raw_text_logs(history_logs(spark, sf_dir)))
