"""Admission of live log rows: late and forged times go to a counted side table.

A watermark makes stateful operators drop rows behind it without a trace, and
one time far ahead moves it past all real rows.  Here each micro-batch is
judged before the detectors see it:

* ``ahead``     the time is over ``tolerance`` ahead of the clock,
* ``late``      the time is over ``delay`` behind the newest believable time of
                all earlier micro-batches,
* ``admitted``  all others; rows without a time have no lateness.

All rows are written, in one pass, to ``rows/batch_id=N/verdict=V``, so input
equals admitted rows plus side table.  The newest time and the counts of a
batch go to ``state/N.json``; a retried batch reads the state of the one before
it and so judges its rows alike.  Windowed detectors read the admitted rows
(with the same delay as watermark they drop none); detectors without state can
read all rows, so a forged time hides nothing from them.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schema as S
from vigil.streaming.folder import Folder
from vigil.streaming.store import run_time, span

ADMITTED, LATE, AHEAD = "admitted", "late", "ahead"
VERDICTS = (ADMITTED, LATE, AHEAD)


def verdict(ts: Column, high: dt.datetime | None, delay: str, limit: dt.datetime) -> Column:
    out = F.when(ts > F.lit(limit), AHEAD)
    if high is not None:
        out = out.when(ts < F.lit(high - span(delay)), LATE)
    return out.otherwise(ADMITTED)


class Admission:
    """``foreachBatch`` function over a parsed log stream."""

    def __init__(self, spark: SparkSession, path: str, delay: str = "10 MINUTES", tolerance: str = S.CLOCK_TOLERANCE,
                 clock=run_time):
        self.spark, self.path, self.delay, self.tolerance, self.clock = spark, path.rstrip("/"), delay, tolerance, clock
        self.folder = Folder(spark, path)

    def states(self) -> dict[int, dict]:
        return {int(n[:-5]): json.loads(self.folder.read(f"state/{n}")) for n in self.folder.names("state") if n.endswith(".json")}

    def _before(self, batch_id: int) -> dict:
        """State after the batch before this one; only the newest few files are looked at."""
        ids = [int(n[:-5]) for n in self.folder.names("state") if n.endswith(".json")]
        last = max((i for i in ids if i < batch_id), default=None)
        return json.loads(self.folder.read(f"state/{last:012d}.json")) if last is not None else {"high": None}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._before(batch_id)
        high = dt.datetime.fromisoformat(before["high"]) if before["high"] else None
        ts, limit = F.col("timestamp").cast("timestamp_ntz"), self.clock() + span(self.tolerance)
        seen = Observation(f"admission-{batch_id}")
        rows = batch.withColumn("verdict", verdict(ts, high, self.delay, limit)).observe(
            seen, F.max(F.when(ts <= F.lit(limit), ts)).alias("high"),
            *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS])
        rows.write.mode("overwrite").partitionBy("verdict").parquet(f"{self.path}/rows/batch_id={batch_id}")
        got = seen.get
        newest = max((t for t in (high, got["high"]) if t is not None), default=None)
        state = {"high": newest.isoformat() if newest else None, "counts": {v: got[v] or 0 for v in VERDICTS}}
        name = f"state/{batch_id:012d}.json"
        if f"{batch_id:012d}.json" in self.folder.names("state"):
            self.folder.delete(name)  # a retried batch
        self.folder.publish(name, json.dumps(state))

    def counts(self) -> dict[str, int]:
        """Rows by verdict over all micro-batches."""
        total = dict.fromkeys(VERDICTS, 0)
        for s in self.states().values():
            for v, n in s["counts"].items():
                total[v] += n
        return total


def judged_schema(logs: T.StructType) -> T.StructType:
    return T.StructType([*logs.fields, T.StructField("batch_id", T.LongType()), T.StructField("verdict", T.StringType())])


def admitted_stream(spark: SparkSession, path: str, logs: T.StructType, verdicts=(ADMITTED,)) -> DataFrame:
    """Stream of judged rows in the order of their micro-batches."""
    return (spark.readStream.schema(judged_schema(logs)).parquet(f"{path.rstrip('/')}/rows")
            .where(F.col("verdict").isin(*verdicts)).drop("batch_id", "verdict"))


def side_table(spark: SparkSession, path: str, logs: T.StructType) -> DataFrame:
    """Late and forged rows with their verdict and batch."""
    return spark.read.schema(judged_schema(logs)).parquet(f"{path.rstrip('/')}/rows").where(F.col("verdict") != ADMITTED)
