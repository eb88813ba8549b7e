"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` plus the
matching oracle SQL.  ``__spark_entry__`` exposes both to the driver.

Every query reads the driver tables (``events`` mapped to logs by
``logs_from_events``), so its work grows with the data.  History queries use
``speedup=1``; windowed detectors and everything built on alerts use
``DETECT_SPEEDUP`` so that the detection thresholds fire at realistic density.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.sources.events import load_logs

DETECT_SPEEDUP = 10000

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # query modules register themselves on import
    from vigil.plans import (  # noqa: F401
        queries_alerts, queries_batch, queries_ingest, queries_serving, queries_stream,
    )


def history_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_logs(spark, sf_dir, 1)


def detect_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_logs(spark, sf_dir, DETECT_SPEEDUP)

