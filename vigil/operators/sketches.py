"""Stored quantile sketches: one for each group and hour, merged over any range of hours.

A sketch is built once from the rows of its hour; a question about a range
reads sketches, not rows.  The sketches are Spark's KLL quantile sketches: with
``k = 2000`` a quantile's rank is within about 0.2 % of the asked one with 99 %
confidence, whatever the number of rows, and merging keeps that bound; a sketch
has some tens of kilobytes at most, and a group of n < k rows is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("threat_label", "log_type", "protocol")
K = 2000


def hourly_sketches(logs: DataFrame, value: str = "bytes_transferred", keys=KEYS, k: int = K) -> DataFrame:
    """keys, hour, n (values), largest, total, sketch (binary); hours of rows without a time are null."""
    return logs.groupBy(*keys, F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour")).agg(
        F.count(value).alias("n"), F.max(value).alias("largest"), F.sum(value).alias("total"),
        F.expr(f"kll_sketch_agg_bigint({value}, {k}) FILTER (WHERE {value} IS NOT NULL)").alias("sketch"))


def quantiles(sketches: DataFrame, q: float = 0.95, hour_from=None, hour_to=None, keys=KEYS, k: int = K) -> DataFrame:
    """keys, n, largest, total, quantile over the hours from ``hour_from`` to before ``hour_to``; null without values."""
    if hour_from is not None:
        sketches = sketches.where(F.col("hour") >= F.lit(hour_from).cast("timestamp_ntz"))
    if hour_to is not None:
        sketches = sketches.where(F.col("hour") < F.lit(hour_to).cast("timestamp_ntz"))
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("largest").alias("largest"), F.sum("total").alias("total"),
        F.expr(f"kll_merge_agg_bigint(sketch, {k}) FILTER (WHERE n > 0)").alias("sketch"))
    return merged.select(*keys, "n", "largest", "total",
                         F.expr(f"if(n > 0, kll_sketch_get_quantile_bigint(sketch, {q}D), null)").alias("quantile"))


def rank_error(rows: DataFrame, found: DataFrame, value: str = "bytes_transferred", q: float = 0.95, keys=KEYS) -> DataFrame:
    """keys, error: how far, as a share of the group's values, the found quantile's rank is from the asked one."""
    v, x = F.col(value), F.col("quantile")
    ranks = rows.join(found.select(*keys, "quantile"), list(keys)).groupBy(*keys).agg(
        F.count(v).alias("c"), F.count_if(v < x).alias("below"), F.count_if(v <= x).alias("upto"))
    wanted = F.ceil(F.col("c") * q)
    return ranks.select(*keys, F.try_divide(
        F.greatest(F.col("below") + 1 - wanted, wanted - F.col("upto"), F.lit(0)), F.col("c")).alias("error"))
