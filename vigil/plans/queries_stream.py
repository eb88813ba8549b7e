"""Streaming detector queries (section H).

Each runs the live detector as a Structured Streaming query over the
``events`` Parquet source (mapped to logs and time-compressed in the
stream), drains it with ``availableNow`` into the idempotent alert sink, and
returns the newest revision of every alert.  The result must equal the
static twin, so the oracle is the same SQL as the batch alert envelope.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.plans import oracle as O
from vigil.plans.catalog import DETECT_SPEEDUP, register
from vigil.session import scratch_path
from vigil.sources.events import logs_from_events, read_events
from vigil.streaming import admission as AD
from vigil.streaming import detectors as D
from vigil.streaming.store import AlertStore, StoreWriter


def _stream(spark, sf_dir, detector):
    src = D.events_log_source(spark, f"{sf_dir}/events.parquet", DETECT_SPEEDUP)
    return D.stream_alerts(spark, src, detector)


@register("stream_brute_force", O.with_alerts("SELECT * FROM alerts", DETECT_SPEEDUP, ("bf",)))
def stream_brute_force(spark, sf_dir):
    return _stream(spark, sf_dir, "brute_force")


@register("stream_signatures", O.with_alerts("SELECT * FROM alerts", DETECT_SPEEDUP, ("sig",)))
def stream_signatures(spark, sf_dir):
    return _stream(spark, sf_dir, "signatures")


@register("stream_volume_anomaly", O.with_alerts("SELECT * FROM alerts", DETECT_SPEEDUP, ("vol",)))
def stream_volume_anomaly(spark, sf_dir):
    return _stream(spark, sf_dir, "volume_anomaly")


@register("stream_port_scan", O.with_logs(O.STREAM_PORT_SCAN_BODY, DETECT_SPEEDUP, f"ps AS ({O.port_scan_sql()})"))
def stream_port_scan(spark, sf_dir):
    src = D.events_log_source(spark, f"{sf_dir}/events.parquet", DETECT_SPEEDUP)
    sinks = D.run_until_caught_up(spark, src, ["port_scan"], watermark=D.DEFAULT_WATERMARK)
    return D.read_detections(spark, sinks["port_scan"])


# -- several micro-batches -----------------------------------------------------------------------

def _arrivals(spark, sf_dir, order, speedup, change=None):
    """Logs that land in a folder in ``ARRIVALS`` turns, by the number that ``order`` gives a row; yields the folder
    and the logs' schema after each turn, so that a caught-up stream has a micro-batch for each."""
    folder = scratch_path(spark, "arrivals")
    events = read_events(spark, sf_dir).withColumn("turn", F.expr(order))
    for turn in range(O.ARRIVALS):
        logs = logs_from_events(events.where(F.col("turn") == turn), speedup)
        if change:
            logs = logs.selectExpr(*[f"{change} timestamp" if c == "timestamp" else c for c in logs.columns])
        logs.write.mode("append").parquet(folder)
        yield folder, logs.schema


def _caught_up(query):
    query.awaitTermination()
    return query


def _store(spark, sf_dir, detector, order, speedup, every):
    work = scratch_path(spark, "store")
    store = AlertStore(spark, work, replay=True)
    for folder, schema in _arrivals(spark, sf_dir, order, speedup):
        stream = D.parquet_log_source(spark, folder, schema)
        _caught_up(D.start_detector(stream, detector, "", f"{work}/checkpoint", {"availableNow": True},
                                    writer=StoreWriter(store, every)))
    return store


@register("alert_store_live", O.with_alerts("SELECT * FROM live", O.STORE_SPEEDUP, ("sig",)))
def alert_store_live(spark, sf_dir):
    """Alerts of three days stored by five micro-batches and compacted on the way: those of the last 24 hours are alive."""
    from vigil.operators import alerts as A

    return A.within_ttl(_store(spark, sf_dir, "signatures", O.ARRIVAL_BY_TIME, O.STORE_SPEEDUP, 2).read())


@register("alert_store_revisions", O.with_alerts("SELECT * FROM alerts", DETECT_SPEEDUP, ("bf",)))
def alert_store_revisions(spark, sf_dir):
    """Windows whose events are spread over all micro-batches: the store holds the last revision of each."""
    return _store(spark, sf_dir, "brute_force", O.ARRIVAL_BY_ID, DETECT_SPEEDUP, 3).read()


def _admitted(spark, sf_dir):
    work = scratch_path(spark, "admission")
    admission = AD.Admission(spark, work, O.ADMISSION_DELAY)
    for folder, schema in _arrivals(spark, sf_dir, O.ARRIVAL_LATE, DETECT_SPEEDUP, O.FORGED_TIME):
        stream = D.parquet_log_source(spark, folder, schema)
        _caught_up(stream.writeStream.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True)
                   .foreachBatch(admission).start())
    return admission, schema


@register("stream_admission", O.with_admission("SELECT event_id, verdict FROM judged"))
def stream_admission(spark, sf_dir):
    """Verdict of every row of a stream with late and forged rows."""
    admission, schema = _admitted(spark, sf_dir)
    return spark.read.schema(AD.judged_schema(schema)).parquet(f"{admission.path}/rows").select("event_id", "verdict")


@register("stream_admitted_alerts", O.with_admission(O.ADMITTED_ALERTS_BODY))
def stream_admitted_alerts(spark, sf_dir):
    """Alerts over the admitted rows, beside the counts of all verdicts."""
    admission, schema = _admitted(spark, sf_dir)
    alerts = D.stream_alerts(spark, AD.admitted_stream(spark, admission.path, schema), "brute_force", O.ADMISSION_DELAY)
    counts = spark.createDataFrame([("rows", v, n) for v, n in admission.counts().items()], "kind string, name string, n long")
    return counts.unionByName(alerts.select(F.lit("alert").alias("kind"), F.col("alert_id").alias("name"),
                                            F.col("event_count").cast("long").alias("n")))
