import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil import schema as S  # noqa: E402
from vigil.session import local_session  # noqa: E402

TS = dt.datetime(2023, 10, 15, 14, 0, 0)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 8, app="vigil-tests")
    yield s
    s.stop()


def row(ts=TS, src="10.0.0.1", dst="192.168.0.1", proto="HTTP", action="blocked", label="malicious",
        log_type="firewall", nbytes=512, agent="hydra/9.4", path="/login"):
    return (ts, src, dst, proto, action, label, log_type, nbytes, agent, path)


@pytest.fixture
def mk(spark):
    """Build a log frame from row tuples (see ``row``), with an event_id."""

    def build(rows, with_id=True):
        df = spark.createDataFrame(rows, S.LOG_SCHEMA)
        if with_id:
            from pyspark.sql import functions as F
            df = df.withColumn("event_id", F.monotonically_increasing_id())
        return df

    return build
