"""Atomic publishing of runs, and stored quantile sketches."""

import datetime as dt

from conftest import TS, row
from pyspark.sql import functions as F

from vigil.operators import sketches as K
from vigil.plans import publish
from vigil.plans.serve import ServedTables


def test_a_failing_job_leaves_every_served_table(spark, tmp_path, mk):
    root, logs = str(tmp_path / "out"), mk([row(action="blocked") for _ in range(8)])
    assert set(publish.publish_all(spark, logs, root, serving=True).values()) == {"ok"}
    first = publish.served_folder(spark, root)
    open_tables = ServedTables(spark, root)
    want = open_tables.profile("10.0.0.1")
    # only one job meets the broken column; the others would succeed
    broken = logs.withColumn("bytes_transferred", F.raise_error(F.lit("broken input")).cast("long"))
    status = publish.publish_all(spark, broken, root, serving=True)
    assert status["port_scan"] == "ok" and status["volume_analysis"].startswith("failed")
    assert publish.served_folder(spark, root) == first
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 1  # what the failed run wrote is gone
    assert ServedTables(spark, root).profile("10.0.0.1") == want


def test_open_readers_see_one_run(spark, tmp_path, mk):
    root = str(tmp_path / "out")
    only = ["volume_analysis"]
    read = lambda: spark.read.parquet(f"{publish.served_folder(spark, root)}/threat_timeline")
    publish.publish_all(spark, mk([row()]), root, only)
    before = read()
    publish.publish_all(spark, mk([row(), row(ts=TS + dt.timedelta(hours=1))]), root, only)
    assert before.count() == 1 and read().count() == 2
    publish.publish_all(spark, mk([row()]), root, only)
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2
    assert publish.publish_all(spark, mk([row()]), root, ["no such job"]) == {}
    assert read().count() == 1


def test_tables_written_in_place_are_still_served(spark, tmp_path):
    assert publish.served_folder(spark, str(tmp_path)) == str(tmp_path)


def test_sketches_merge_over_ranges(spark, mk):
    hours = [TS + dt.timedelta(hours=h) for h in range(4)]
    logs = mk([row(ts=t, nbytes=i * 10 + h) for h, t in enumerate(hours) for i in range(100)] + [row(ts=TS, nbytes=None, label="x")])
    stored = K.hourly_sketches(logs)
    assert stored.count() == 5
    for a, b in ((0, 4), (1, 3), (3, 4)):
        part = logs.where((F.col("timestamp") >= F.lit(hours[a])) & (F.col("timestamp") < F.lit(hours[a] + dt.timedelta(hours=b - a))))
        got = K.quantiles(stored, 0.95, hours[a], hours[a] + dt.timedelta(hours=b - a)).where("n > 0").first()
        values = sorted(r.bytes_transferred for r in part.collect() if r.bytes_transferred is not None)
        assert (got.n, got.largest, got.total) == (len(values), values[-1], sum(values))
        assert got["quantile"] == values[-(-len(values) * 95 // 100) - 1]  # few rows: exact
        assert K.rank_error(part, K.quantiles(stored, 0.95, hours[a], hours[a] + dt.timedelta(hours=b - a))).agg(F.max("error")).first()[0] in (0, None)
    none = {r.threat_label: r["quantile"] for r in K.quantiles(stored).collect()}
    assert none["x"] is None and K.quantiles(stored.limit(0)).count() == 0
