"""Live detection with Structured Streaming.

One parsed log stream feeds three concurrent queries (brute force and volume
anomaly in update mode, signatures in append mode).  Each micro-batch is
mapped to alert records and written by ``foreachBatch`` as Parquet into its
own ``batch_id=N`` folder with overwrite, so a retried batch replaces its own
output (at-least-once delivery becomes idempotent).  Update mode re-emits a
window each time it changes; readers keep the newest revision per
``alert_id`` (``read_alerts``).

State: windowed counts live in the state store (RocksDB when the session
selects it).  ``watermark`` (default none) bounds that state and drops events
later than it; with none, every window stays open, which is what the original
detectors did, and no late event is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigil import schema as S
from vigil.operators import alerts as A
from vigil.operators import detect
from vigil.session import scratch_path
from vigil.sources.events import logs_from_events
from vigil.sources.messages import parse_json_logs

# Windows stay open, as in the original detectors; a watermark bounds the state but drops later rows.
DEFAULT_WATERMARK = None
DEFAULT_TRIGGER = "500 milliseconds"


@dataclass(frozen=True)
class Detector:
    name: str
    output_mode: str
    alerts: bool = True  # sink writes alert records (else the detector rows)

    def build(self, logs: DataFrame, watermark: str | None) -> DataFrame:
        if self.name == "port_scan":
            return detect.detect_port_scan_stream(logs, watermark=watermark)
        if self.name == "brute_force":
            return detect.detect_brute_force(logs, watermark=watermark)
        if self.name == "volume_anomaly":
            return detect.detect_volume_anomaly(logs, watermark=watermark)
        if self.name == "signatures":
            return detect.detect_signatures(logs)
        raise ValueError(self.name)


DETECTORS = {
    "brute_force": Detector("brute_force", "update"),
    "signatures": Detector("signatures", "append"),
    "volume_anomaly": Detector("volume_anomaly", "update"),
}
# Optional live port-scan detector (not started by default, like the original).
OPTIONAL_DETECTORS = {"port_scan": Detector("port_scan", "update", alerts=False)}


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
def kafka_source(spark: SparkSession, bootstrap: str, topic: str = "cybersecurity-logs",
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = 10000,
                 fail_on_data_loss: bool = True) -> DataFrame:
    """Parsed log stream from Kafka (needs the spark-sql-kafka connector).

    Offsets that retention deleted before they were read stop the query unless
    ``fail_on_data_loss`` is off; ``max_offsets_per_trigger=None`` reads all."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return parse_json_logs(reader.load())


def json_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parsed log stream from files of JSON messages (one per line)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_json_logs(reader.load(path))


def parquet_log_source(spark: SparkSession, path: str, schema=None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Log stream from Parquet files laid out like the log table."""
    reader = spark.readStream.schema(schema or S.LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def events_log_source(spark: SparkSession, path: str, speedup: int,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Log stream derived from the ``events`` table at ``path`` (a file, a
    folder of Parquet files or a pattern), a replay with time compression
    ``speedup``."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # a plain path must be a folder for stream sources, a pattern may match a file as well
    pattern = path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"
    return logs_from_events(reader.parquet(pattern), speedup)


# ---------------------------------------------------------------------------
# Sink
# ---------------------------------------------------------------------------
def alerts_of_batch(batch: DataFrame, batch_id: int) -> DataFrame:
    """Alert rows of a micro-batch of detector rows.

    The rule of ``alerts.event_identity``; an event without an own identity is
    numbered among its like in this batch, so the batch is part of its name (a
    retried batch gives the same names)."""
    if "window_start" not in batch.columns:
        names = [F.col(c).cast("string") for c in ("event_id", "source_offset") if c in batch.columns]
        nameless = F.concat_ws("-", F.lit(f"b{batch_id}"), A.event_identity(batch))
        batch = batch.withColumn("event_id", F.coalesce(*names, nameless))
    return A.to_alerts(batch)


class AlertBatchWriter:
    """``foreachBatch`` function: micro-batch -> alert rows -> Parquet under
    ``{path}/batch_id={id}`` (overwrite, hence idempotent on retry)."""

    def __init__(self, path: str, as_alerts: bool = True):
        self.path = path.rstrip("/")
        self.as_alerts = as_alerts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = alerts_of_batch(batch, batch_id) if self.as_alerts else batch
        out.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def start_detector(stream: DataFrame, detector: str, sink_path: str, checkpoint: str,
                   trigger: dict | None = None, watermark: str | None = DEFAULT_WATERMARK,
                   query_name: str | None = None, writer=None) -> StreamingQuery:
    """``writer`` takes the micro-batches in place of the folder sink (a ``store.StoreWriter``)."""
    det = DETECTORS.get(detector) or OPTIONAL_DETECTORS[detector]
    trigger = trigger or {"processingTime": DEFAULT_TRIGGER}
    return (
        det.build(stream, watermark)
        .writeStream.outputMode(det.output_mode)
        .option("checkpointLocation", checkpoint)
        .queryName(query_name or f"vigil_{detector}")
        .trigger(**trigger)
        .foreachBatch(writer or AlertBatchWriter(sink_path, det.alerts))
        .start()
    )


def start_all(stream: DataFrame, sink_root: str, checkpoint_root: str, trigger: dict | None = None,
              watermark: str | None = DEFAULT_WATERMARK, detectors=None) -> dict[str, StreamingQuery]:
    """Start the detectors concurrently over one parsed stream."""
    out = {}
    for name in detectors or DETECTORS:
        out[name] = start_detector(stream, name, f"{sink_root}/{name}", f"{checkpoint_root}/{name}",
                                   trigger, watermark, query_name=f"vigil_{name}_{abs(hash(sink_root)) % 10**8}")
    return out


def await_any(spark: SparkSession, queries: dict[str, StreamingQuery]) -> None:
    """Block until any detector terminates, then stop the rest."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries.values():
            if q.isActive:
                q.stop()


def _nothing_written(e: AnalysisException) -> bool:
    """The sink folder is missing or empty: no micro-batch has been written yet."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_alerts(spark: SparkSession, sink_path: str) -> DataFrame:
    """Alerts written by a detector sink, newest revision per ``alert_id``."""
    schema = T.StructType(S.ALERT_SCHEMA.fields + [T.StructField("batch_id", T.LongType(), True)])
    try:
        rows = spark.read.schema(schema).parquet(sink_path)
    except AnalysisException as e:
        if not _nothing_written(e):
            raise
        rows = spark.createDataFrame([], schema)
    return A.latest_revision(rows, "batch_id")


def read_detections(spark: SparkSession, sink_path: str, keys=("source_ip", "window_start")) -> DataFrame:
    """Raw detector rows written by a sink, newest revision per ``keys``."""
    try:
        rows = spark.read.parquet(sink_path)
    except AnalysisException as e:
        if not _nothing_written(e):
            raise
        return detect.detect_port_scan_stream(spark.createDataFrame([], S.LOG_SCHEMA))
    payload = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*payload), F.col("batch_id")).alias("_r")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_r.*")


def compact_alerts(spark: SparkSession, sink_path: str, out_path: str) -> DataFrame:
    """Fold a detector sink (one folder per micro-batch) into its newest
    revisions, written once as Parquet partitioned by alert date; returns the
    compacted table.  Run periodically; readers then scan few large files."""
    latest = read_alerts(spark, sink_path).withColumn("alert_date", F.to_date("bucket_time"))
    latest.write.mode("overwrite").partitionBy("alert_date").parquet(out_path)
    return spark.read.parquet(out_path)


def run_until_caught_up(spark: SparkSession, stream: DataFrame, detectors=None,
                        watermark: str | None = DEFAULT_WATERMARK, work_dir: str | None = None) -> dict[str, str]:
    """Process everything available now, stop, and return the sink folders.

    Uses ``Trigger.AvailableNow`` (admission limits still split the input
    into several micro-batches), so it serves tests and catch-up jobs.
    """
    work = work_dir or scratch_path(spark, "stream")
    queries = start_all(stream, f"{work}/sink", f"{work}/checkpoint", {"availableNow": True},
                        watermark, detectors)
    for q in queries.values():
        q.awaitTermination()
    return {name: f"{work}/sink/{name}" for name in queries}


def stream_alerts(spark: SparkSession, stream: DataFrame, detector: str,
                  watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    sinks = run_until_caught_up(spark, stream, [detector], watermark)
    return read_alerts(spark, sinks[detector])
