"""Expiring store of live alerts.

Layout under the store's path::

    log/batch_id=N/alert_date=D/     alert rows of one micro-batch (a window that changes is written again)
    days/vK/alert_date=D/            newest revision of each alert of a day, as compaction K left it
    manifest/00000K.json             which folders make up the store after compaction K

``append`` writes a micro-batch into its own folder, so a retried one replaces
its own rows.  ``compact`` folds the batches since the last compaction into the
days that they touch (other days keep their folders), drops days whose alerts
have all outlived the time to live, and publishes a new manifest by one rename.
Readers take one manifest, so they see the store before or after a compaction
and never between; folders stay until ``keep`` newer manifests exist.

A read lists the live days and the batches since the last compaction, however
many micro-batches there were.  An alert's day is that of its own time, which
no revision changes, so all revisions of an alert meet in one day.

Time to live: a day goes when its end is ``ttl`` old; a day ahead of the clock
(a forged time) goes when it has been in the store for ``ttl`` and a day;
alerts without a time never go.  The clock is the run time, or, for replays of
old data, the newest alert time that is not ahead of the run time.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schema as S
from vigil.operators import alerts as A
from vigil.streaming.folder import Folder

NO_DAY = "none"
_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"
_DAY = T.StructField("alert_date", T.DateType(), True)
_BATCH = T.StructField("batch_id", T.LongType(), True)


def span(text: str) -> dt.timedelta:
    """``24 HOURS`` as a time difference."""
    n, unit = text.split()
    return dt.timedelta(**{f"{unit.lower().rstrip('s')}s": int(n)})


def run_time() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class Manifest:
    version: int = 0
    through: int = -1  # newest batch folded into the days
    clock: str | None = None
    days: dict[str, dict] = field(default_factory=dict)  # day -> {"version": of its folder, "since": first stored}


class AlertStore:
    def __init__(self, spark: SparkSession, path: str, ttl: str = S.ALERT_TTL, keep: int = 2, replay: bool = False):
        self.spark, self.path, self.ttl, self.keep, self.replay = spark, path.rstrip("/"), ttl, keep, replay
        self.folder = Folder(spark, path)

    # -- what the store holds ------------------------------------------------------------------

    def _manifests(self) -> list[str]:
        return [n for n in self.folder.names("manifest") if n.endswith(".json")]

    def manifest(self) -> Manifest:
        names = self._manifests()
        return Manifest(**json.loads(self.folder.read(f"manifest/{names[-1]}"))) if names else Manifest()

    def waiting(self, m: Manifest) -> list[int]:
        """Batches that are not folded into the days of a manifest."""
        ids = [int(n.split("=")[1]) for n in self.folder.names("log") if n.startswith("batch_id=")]
        return sorted(i for i in ids if i > m.through)

    def _log(self, batches: list[int]) -> DataFrame:
        schema = T.StructType([*S.ALERT_SCHEMA.fields, _BATCH, _DAY])
        if not batches:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/log")
                .parquet(*[f"{self.path}/log/batch_id={b}" for b in batches]).select(*schema.names))

    def _days(self, days: dict[str, dict]) -> DataFrame:
        schema = T.StructType([*S.ALERT_SCHEMA.fields, _BATCH, _DAY])
        out = self.spark.createDataFrame([], schema)
        for v in sorted({d["version"] for d in days.values()}):
            base = f"{self.path}/days/v{v}"
            paths = [f"{base}/alert_date={_NULL_DIR if d == NO_DAY else d}" for d, x in days.items() if x["version"] == v]
            out = out.unionByName(self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names))
        return out

    # -- writing -------------------------------------------------------------------------------

    def append(self, alerts: DataFrame, batch_id: int) -> None:
        if batch_id <= self.manifest().through:
            return  # a retried batch that a compaction has taken in already
        (alerts.select(*S.ALERT_COLUMNS).withColumn("alert_date", F.to_date("bucket_time"))
         .write.mode("overwrite").partitionBy("alert_date").parquet(f"{self.path}/log/batch_id={batch_id}"))

    def compact(self, now: dt.datetime | None = None) -> Manifest:
        old = self.manifest()
        batches = self.waiting(old)
        fresh = self._log(batches)
        limit = run_time() + span(S.CLOCK_TOLERANCE)
        # one row for each day touched, a bounded number
        seen = fresh.groupBy("alert_date").agg(F.max(F.when(F.col("bucket_time") <= F.lit(limit), F.col("bucket_time"))).alias("t")).collect()
        newest = max([r["t"] for r in seen if r["t"]] + ([dt.datetime.fromisoformat(old.clock)] if old.clock else []), default=None)
        now = now or (newest if self.replay else run_time()) or run_time()
        touched = {r["alert_date"].isoformat() if r["alert_date"] else NO_DAY for r in seen}
        version = old.version + 1
        days = {d: x for d, x in old.days.items() if d not in touched}
        days |= {d: {"version": version, "since": old.days.get(d, {}).get("since", now.isoformat())} for d in touched}
        expired = {d for d, x in days.items() if self._over(d, x, now)}
        days = {d: x for d, x in days.items() if d not in expired}
        merged = touched - expired
        if merged:
            rows = self._days({d: x for d, x in old.days.items() if d in merged}).unionByName(fresh)
            alive = F.coalesce(F.col("alert_date").cast("string"), F.lit(NO_DAY)).isin(*merged)
            payload = [c for c in rows.columns if c != "alert_id"]
            newest_of = rows.where(alive).groupBy("alert_id").agg(F.max_by(F.struct(*payload), "batch_id").alias("r")).select("alert_id", "r.*")
            # files of a day follow its size: small days one file, large ones several tasks
            newest_of.hint("rebalance", "alert_date").write.mode("overwrite").partitionBy("alert_date").parquet(
                f"{self.path}/days/v{version}")
        out = Manifest(version, max([old.through, *batches]), newest.isoformat() if newest else None, days)
        self.folder.publish(f"manifest/{version:08d}.json", json.dumps(out.__dict__))
        self._sweep()
        return out

    def _over(self, day: str, entry: dict, now: dt.datetime) -> bool:
        if day == NO_DAY:
            return False
        start, ttl = dt.datetime.fromisoformat(day), span(self.ttl)
        if start > now + span(S.CLOCK_TOLERANCE):  # ahead of the clock: by its time in the store
            return dt.datetime.fromisoformat(entry["since"]) + ttl + dt.timedelta(days=1) <= now
        return start + dt.timedelta(days=1) + ttl <= now

    def _sweep(self) -> None:
        """Deletes what only manifests older than the newest ``keep`` refer to."""
        names = self._manifests()
        kept = [Manifest(**json.loads(self.folder.read(f"manifest/{n}"))) for n in names[-self.keep:]]
        for n in names[:-self.keep]:
            self.folder.delete(f"manifest/{n}")
        used = {(x["version"], d) for m in kept for d, x in m.days.items()}
        for v in self.folder.names("days"):
            held = [n for n in self.folder.names(f"days/{v}") if n.startswith("alert_date=")]
            left = [n for n in held if (int(v[1:]), n.split("=")[1].replace(_NULL_DIR, NO_DAY)) in used]
            if int(v[1:]) > kept[-1].version:
                continue  # left by a compaction that failed, or being written
            for n in (set(held) - set(left)) if left else [""]:
                self.folder.delete(f"days/{v}/{n}" if n else f"days/{v}")
        through = min(m.through for m in kept)
        for n in self.folder.names("log"):
            if n.startswith("batch_id=") and int(n.split("=")[1]) <= through:
                self.folder.delete(f"log/{n}")

    # -- reading -------------------------------------------------------------------------------

    def read(self, as_of: dt.datetime | None = None) -> DataFrame:
        """Newest revision of every stored alert; with ``as_of`` those alive then, from the days that can hold them."""
        m = self.manifest()
        days, log = m.days, self._log(self.waiting(m))
        if as_of is not None:
            first = (as_of - span(self.ttl)).date()
            days = {d: x for d, x in days.items() if d == NO_DAY or d >= first.isoformat()}
            log = log.where(F.col("alert_date").isNull() | (F.col("alert_date") >= F.lit(first)))
        rows = A.latest_revision(self._days(days).unionByName(log))
        return rows if as_of is None else A.within_ttl(rows, as_of, self.ttl)


class StoreWriter:
    """``foreachBatch`` function: alerts of a micro-batch into the store, with a compaction every ``every`` batches."""

    def __init__(self, store: AlertStore, every: int = 50):
        self.store, self.every = store, every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from vigil.streaming.detectors import alerts_of_batch

        self.store.append(alerts_of_batch(batch, batch_id), batch_id)
        if (batch_id + 1) % self.every == 0:
            self.store.compact()
