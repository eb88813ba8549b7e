"""Expiring alert store and admission of live rows."""

import datetime as dt

import pytest
from conftest import TS, row
from pyspark.sql import functions as F

from vigil.operators import alerts as A
from vigil.operators import detect
from vigil.streaming import admission as AD
from vigil.streaming import detectors as D
from vigil.streaming.store import AlertStore, Manifest, StoreWriter

TOOL = dict(agent="sqlmap/1.7", path="/x")
DAY = dt.timedelta(days=1)


@pytest.fixture
def alerts(mk):
    def make(*times, src="10.0.0.1"):
        return A.to_alerts(detect.detect_signatures(mk([row(ts=t, src=src, **TOOL) for t in times])))
    return make


def held(df):
    return sorted((r.alert_id, r.event_count) for r in df.collect())


def test_reads_list_days_and_waiting_batches_only(spark, tmp_path, alerts):
    store = AlertStore(spark, str(tmp_path / "s"))
    base = alerts(TS).cache()
    now = TS + dt.timedelta(hours=1)
    for b in range(60):
        store.append(base.withColumn("alert_id", F.lit(f"a{b % 7}")).withColumn("event_count", F.lit(b)), b)
        if b % 10 == 9:
            store.compact(now)
        assert len(store.waiting(store.manifest())) <= 10
    assert held(store.read()) == sorted((f"a{k}", max(b for b in range(60) if b % 7 == k)) for k in range(7))
    files = store.read().inputFiles()
    assert len(files) <= 2 and len(store.folder.names("manifest")) == 2 and len(store.folder.names("log")) <= 10


def test_compaction_rewrites_only_days_touched(spark, tmp_path, alerts):
    store = AlertStore(spark, str(tmp_path / "s"))
    now = TS + dt.timedelta(hours=2)
    store.append(alerts(TS - DAY), 0)
    assert store.compact(now).days.keys() == {"2023-10-14"}
    store.append(alerts(TS, src="10.0.0.2"), 1)
    m = store.compact(now)
    assert {d: x["version"] for d, x in m.days.items()} == {"2023-10-14": 1, "2023-10-15": 2}
    assert held(store.read()) == sorted(held(alerts(TS - DAY)) + held(alerts(TS, src="10.0.0.2")))


def test_days_expire_by_partition_and_forged_days_by_their_stay(spark, tmp_path, alerts):
    store = AlertStore(spark, str(tmp_path / "s"))
    forged = dt.datetime(2099, 1, 1)
    store.append(alerts(TS, forged, None), 0)
    assert set(store.compact(TS).days) == {"2023-10-15", "2099-01-01", "none"}
    store.append(alerts(TS + DAY), 1)
    kept = store.compact(TS.replace(hour=0) + 2 * DAY)  # the end of the first day is 24 hours old
    assert set(kept.days) == {"2023-10-16", "2099-01-01", "none"}  # the forged day is not yet two days in the store
    kept = store.compact(TS + 2 * DAY)
    assert set(kept.days) == {"2023-10-16", "none"}
    store.compact(TS + 2 * DAY)
    left = {n for v in store.folder.names("days") for n in store.folder.names(f"days/{v}")}
    assert not any("2023-10-15" in n or "2099" in n for n in left)  # the folders are gone as well


def test_ttl_binds_and_prunes_days(spark, tmp_path, alerts):
    store = AlertStore(spark, str(tmp_path / "s"))
    store.append(alerts(*[TS - i * DAY for i in range(5)]), 0)
    assert store.read().count() == 5
    live = store.read(as_of=TS + dt.timedelta(minutes=1))
    assert [r.bucket_time for r in live.collect()] == [TS]
    assert "PartitionFilters: [" in live._jdf.queryExecution().toString() and "alert_date" in live._jdf.queryExecution().toString()


def test_readers_keep_their_version_and_failures_change_nothing(spark, tmp_path, alerts, monkeypatch):
    store = AlertStore(spark, str(tmp_path / "s"))
    store.append(alerts(TS), 0)
    store.compact(TS)
    before, want = store.read(), held(store.read())
    store.append(alerts(TS, src="10.0.0.2"), 1)
    monkeypatch.setattr(store.folder, "publish", lambda *a: (_ for _ in ()).throw(OSError("no space")))
    with pytest.raises(OSError):
        store.compact(TS)
    monkeypatch.undo()
    assert store.manifest().version == 1 and store.read().count() == 2
    store.compact(TS)
    assert store.manifest().version == 2 and store.read().count() == 2
    assert held(before) == want  # opened before the compaction
    store.append(alerts(TS, src="10.0.0.9"), 1)  # a retry of a batch that is folded in already
    assert store.read().count() == 2


def test_an_empty_store(spark, tmp_path):
    store = AlertStore(spark, str(tmp_path / "s"))
    assert store.manifest() == Manifest() and store.read().count() == 0
    store.compact(TS)
    assert store.read(as_of=TS).count() == 0


def test_a_stream_keeps_the_last_revision(spark, tmp_path, mk):
    src, store = str(tmp_path / "in"), AlertStore(spark, str(tmp_path / "s"), replay=True)
    for turn in range(4):
        mk([row(ts=TS + dt.timedelta(seconds=turn * 4 + i), action="blocked") for i in range(4)]).write.mode("append").parquet(src)
        stream = D.parquet_log_source(spark, src, mk([row()]).schema)
        D.start_detector(stream, "brute_force", "", str(tmp_path / "ck"), {"availableNow": True},
                         writer=StoreWriter(store, 2)).awaitTermination()
    got = store.read().collect()
    assert [r.event_count for r in got] == [16] and store.manifest().through == 3


# -- admission -----------------------------------------------------------------------------------

def judged(spark, adm, schema):
    return sorted((r.source_ip, r.verdict) for r in spark.read.schema(AD.judged_schema(schema)).parquet(f"{adm.path}/rows").collect())


def test_input_is_admitted_rows_plus_side_table(spark, tmp_path, mk):
    adm = AD.Admission(spark, str(tmp_path / "a"), "1 MINUTE")
    at = lambda s, src: row(ts=TS + dt.timedelta(seconds=s), src=src)
    forged = row(ts=dt.datetime(2999, 1, 1), src="forged")
    turns = [[at(0, "a"), at(-500, "old but first"), forged], [at(300, "b"), at(-61, "late"), at(-60, "edge"), row(ts=None, src="none")],
             [at(241, "c"), at(240, "d"), at(239, "late too")]]
    schema = mk(turns[0]).schema
    for i, t in enumerate(turns):
        adm(mk(t), i)
    want = sorted([("a", "admitted"), ("old but first", "admitted"), ("forged", "ahead"), ("b", "admitted"), ("late", "late"),
                   ("edge", "admitted"), ("none", "admitted"), ("c", "admitted"), ("d", "admitted"), ("late too", "late")])
    assert judged(spark, adm, schema) == want
    assert adm.counts() == {"admitted": 7, "late": 2, "ahead": 1}
    assert sorted(r.source_ip for r in AD.side_table(spark, adm.path, schema).collect()) == ["forged", "late", "late too"]
    adm(mk(turns[1]), 1)  # a retried batch is judged by the state before it, and counted once
    assert judged(spark, adm, schema) == want and adm.counts()["late"] == 2
    adm(mk(turns[0]).limit(0), 3)
    assert adm.counts() == {"admitted": 7, "late": 2, "ahead": 1}


def test_windowed_detectors_lose_no_admitted_row(spark, tmp_path, mk):
    adm = AD.Admission(spark, str(tmp_path / "a"), "30 SECONDS")
    src = str(tmp_path / "in")
    schema = mk([row()]).schema
    calm = dict(action="blocked", agent="curl", path="/ok")
    for t in ([row(ts=TS, **calm)] * 3 + [row(ts=dt.datetime(2999, 1, 1), action="blocked", **TOOL)],
              [row(ts=TS + dt.timedelta(seconds=20), **calm)] * 8):
        mk(t).write.mode("append").parquet(src)
        (D.parquet_log_source(spark, src, schema).writeStream.option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).foreachBatch(adm).start().awaitTermination())
    alerts = D.stream_alerts(spark, AD.admitted_stream(spark, adm.path, schema), "brute_force", "30 SECONDS").collect()
    assert [r.event_count for r in alerts] == [11]
    # a forged time does not hide an event from detectors without state
    every = D.stream_alerts(spark, AD.admitted_stream(spark, adm.path, schema, AD.VERDICTS), "signatures")
    assert every.count() == 1
