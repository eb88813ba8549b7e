"""Served per-IP tables in buckets of the IP.

The sides of the threat profile (reputation, attack types, live alerts) and the
list of all IPs known to any of them are written with the same number of buckets
of ``ip``, one sorted file a bucket.  Profiles are then joined bucket by bucket
without a shuffle, requests move to the buckets and not the tables to the
requests, and a lookup of one IP opens one file.

The number of buckets grows with the number of IPs (``rows_per_bucket``) and
stands beside the tables, so another session opens them as they are.  A missing
IP (null) has no profile here.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import serving as V
from vigil.session import materialize
from vigil.streaming.folder import Folder

SIDES = ("reputation", "attack_types", "live")
ROWS_PER_BUCKET = 500_000


def _table(root: str, name: str) -> str:
    return f"vigil_{hashlib.md5(root.encode()).hexdigest()[:16]}_{name}"


def _write(df: DataFrame, root: str, name: str, buckets: int) -> None:
    # dealt by the hash that buckets use, so each task writes the one file of its bucket
    (df.repartition(buckets, "ip").sortWithinPartitions("ip").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "ip").sortBy("ip").option("path", f"{root}/{name}").saveAsTable(_table(root, name)))


def write_layout(spark: SparkSession, root: str, snapshot: DataFrame, types: DataFrame, live: DataFrame,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> BucketedTables:
    """Writes the three sides, keyed by IP, and the list of their IPs below ``root`` (a folder of its own)."""
    sides = dict(zip(SIDES, (snapshot.withColumnRenamed("source_ip", "ip"), types, live)))
    # computed once: the list of IPs and the number of buckets come from the same rows as the tables
    staged = {name: materialize(df.where(F.col("ip").isNotNull()), f"layout-{name}") for name, df in sides.items()}
    ips = None
    for df in staged.values():
        ips = df.select("ip") if ips is None else ips.union(df.select("ip"))
    staged["ips"] = materialize(ips.distinct(), "layout-ips")
    buckets = max(8, -(-staged["ips"].count() // rows_per_bucket))
    for name, df in staged.items():
        _write(df, root, name, buckets)
    Folder(spark, root).publish("layout.json", json.dumps({"buckets": buckets}))  # last: a half-written layout cannot be opened
    return open_layout(spark, root)


def open_layout(spark: SparkSession, root: str) -> BucketedTables:
    """The tables of a layout, made known to the session's catalog where it doesn't have them."""
    buckets = json.loads(Folder(spark, root).read("layout.json"))["buckets"]
    for name in (*SIDES, "ips"):
        if not spark.catalog.tableExists(_table(root, name)):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{root}/{name}").schema)
            spark.sql(f"CREATE TABLE `{_table(root, name)}` ({fields}) USING parquet CLUSTERED BY (ip) SORTED BY (ip) "
                      f"INTO {buckets} BUCKETS LOCATION '{root}/{name}'")
    return BucketedTables(spark, root, buckets)


class BucketedTables:
    """An open layout."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.spark, self.root, self.buckets = spark, root, buckets

    def table(self, name: str) -> DataFrame:
        return self.spark.table(_table(self.root, name))

    def profiles(self, score_col: str = "reputation_score") -> DataFrame:
        """Profiles of all IPs; left joins from the list of IPs keep its buckets, which full joins would not."""
        return V.threat_profiles(*[self.table(n) for n in SIDES], score_col, ips=self.table("ips"))

    def lookup(self, requests: DataFrame, ip_col: str = "ip") -> DataFrame:
        """Profiles of requested IPs (see ``serving.lookup_profiles``); only the requests are shuffled."""
        return V.lookup_profiles(self.profiles(), requests, ip_col)

    def profile_of(self, ip: str) -> DataFrame:
        """The profile of one IP (0 or 1 row), from one bucket of each table."""
        return self.profiles().where(F.col("ip") == ip.strip())
