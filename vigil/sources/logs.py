"""Log ingestion: CSV with quarantine, date partitions, partitioned Parquet.

CSV is parsed against the fixed schema with a strict datetime parser; a row
with an unparseable field or a missing required column is not dropped
silently but routed to a quarantine frame with the raw line and a reason.
The parser runs the same way for files (``read_csv_logs``) and for a column
of CSV lines (``parse_csv_lines``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import schema as S
from vigil.functions.timecols import date_partition_columns
from vigil.session import materialize

CORRUPT = "_corrupt_record"

CSV_OPTIONS = {
    "timestampNTZFormat": S.CSV_TIMESTAMP_FORMAT,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}

_PARSE_SCHEMA = T.StructType(S.LOG_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def _judged(parsed: DataFrame) -> DataFrame:
    """Log columns with ``raw_record`` and ``reject_reason`` (null for a good row)."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in S.REQUIRED_LOG_COLUMNS]
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(
        F.concat(F.lit("missing:"), F.concat_ws(",", *missing))
    )
    bad = F.col(CORRUPT).isNotNull()
    for c in S.REQUIRED_LOG_COLUMNS:
        bad = bad | F.col(c).isNull()
    return parsed.select(*S.LOG_COLUMNS, F.col(CORRUPT).alias("raw_record"), F.when(bad, reason).alias("reject_reason"))


def _split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    bad = F.col("reject_reason").isNotNull()
    return judged.filter(~bad).select(*S.LOG_COLUMNS), judged.filter(bad)


def conform_to_log_schema(df: DataFrame) -> DataFrame:
    """Bind columns *by name* to ``LOG_SCHEMA`` with ``try_cast`` (a value
    that does not convert becomes NULL, a missing column is all NULL) and
    keep the row text of failed conversions as ``_corrupt_record``."""
    cols = set(df.columns)
    typed, failed = [], []
    for f in S.LOG_SCHEMA.fields:
        if f.name not in cols:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if f.name == "timestamp" and dict(df.dtypes)[f.name] == "string":
            from vigil.functions.timecols import parse_timestamp_any
            conv = parse_timestamp_any(src, [S.CSV_TIMESTAMP_FORMAT])
        else:
            conv = src.try_cast(f.dataType)
        typed.append(conv.alias(f.name))
        failed.append(src.isNotNull() & conv.isNull())
    bad = F.lit(False)
    for c in failed:
        bad = bad | c
    raw = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(*typed, F.when(bad, raw).alias(CORRUPT))


def judge_csv_logs(spark: SparkSession, path: str, header: bool = True,
                   options: dict | None = None, infer_schema: bool = False) -> DataFrame:
    """All rows of a header CSV of logs, with a reason for those to be rejected.

    Columns bind by position to ``LOG_SCHEMA``.  All columns are selected in
    both outputs, so every field is parsed and checked.  ``infer_schema=True``
    instead lets Spark infer types (an extra pass over the input) and binds
    columns by their header names (``conform_to_log_schema``); the same
    quarantine rules apply.
    """
    if infer_schema:
        inferred = (
            spark.read.option("header", "true").option("inferSchema", "true")
            .options(**(options or {})).csv(path)
        )
        return _judged(conform_to_log_schema(inferred))
    opts = dict(CSV_OPTIONS)
    opts["header"] = str(header).lower()
    opts.update(options or {})
    return _judged(spark.read.schema(_PARSE_SCHEMA).options(**opts).csv(path))


def read_csv_logs(spark: SparkSession, path: str, header: bool = True,
                  options: dict | None = None, infer_schema: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` frames of a header CSV of logs (see ``judge_csv_logs``)."""
    return _split(judge_csv_logs(spark, path, header, options, infer_schema))


def parse_csv_lines(lines: DataFrame, column: str = "value", options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Same parse and quarantine for a column of CSV text lines (e.g. a stream)."""
    opts = dict(CSV_OPTIONS)
    opts.update(options or {})
    parsed_struct = F.from_csv(F.col(column), _PARSE_SCHEMA.simpleString(), opts)
    # ``inline`` makes the parse a Generate: the quarantine filters refer to
    # its output and cannot be pushed below it, so each line is parsed once
    # (a plain projection would be inlined into every filter predicate).
    return _split(_judged(lines.select(F.inline(F.array(parsed_struct)))))


def to_csv_lines(logs: DataFrame, column: str = "value") -> DataFrame:
    """Render logs as CSV lines in the ingest layout (inverse of ``parse_csv_lines``)."""
    # the CSV writer trims leading/trailing white space by default (the reader
    # does not): keep values exactly as they are
    opts = {"timestampNTZFormat": S.CSV_TIMESTAMP_FORMAT,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return logs.select(F.to_csv(F.struct(*[F.col(c) for c in S.LOG_COLUMNS]), opts).alias(column))


def add_date_partitions(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds ``year``, ``month`` (2 digits), ``day`` (2 digits) strings."""
    return df.withColumns(date_partition_columns(ts))


def write_logs(df: DataFrame, path: str, mode: str = "overwrite", replace: str = "all",
               max_records_per_file: int | None = None, files_per_day: int | None = None) -> None:
    """Write date-partitioned Parquet.

    ``replace="days"`` overwrites only the days present in ``df`` (dynamic
    partition overwrite), so a daily load does not rewrite history.  By
    default no repartition is done (each task writes the days it holds, one
    open file at a time).  ``files_per_day=0`` rebalances by day: small days
    become one file each, and adaptive execution splits a large day into tasks
    of the advisory partition size.  ``files_per_day=k`` shuffles by day plus a
    deterministic hash salt into ``k`` buckets: about ``k`` files per day.  The
    salt is a hash of row values, so a retried task reproduces the same split.
    """
    if not set(S.PARTITION_COLUMNS) <= set(df.columns):
        df = add_date_partitions(df)
    if files_per_day:
        salt = F.pmod(F.xxhash64("source_ip", "dest_ip", "timestamp"), F.lit(files_per_day))
        df = df.repartition(*[F.col(c) for c in S.PARTITION_COLUMNS], salt)
    elif files_per_day == 0:
        df = df.hint("rebalance", *S.PARTITION_COLUMNS)
    w = df.write.mode(mode).partitionBy(*S.PARTITION_COLUMNS)
    if replace == "days":
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def read_logs(spark: SparkSession, path: str, date_from: str | None = None,
              date_to: str | None = None, keep_partitions: bool = False) -> DataFrame:
    """Read the partitioned log table, partitions kept as strings.

    ``date_from``/``date_to`` (``yyyyMMdd``, inclusive) become a filter on the
    partition columns only, which Spark turns into directory pruning.
    """
    df = spark.read.schema(S.PARTITIONED_LOG_SCHEMA).parquet(path)
    day = F.concat(F.col("year"), F.col("month"), F.col("day"))
    if date_from:
        df = df.filter(day >= F.lit(date_from))
    if date_to:
        df = df.filter(day <= F.lit(date_to))
    return df if keep_partitions else df.select(*S.LOG_COLUMNS)


def ingest_csv(spark: SparkSession, src: str, dest: str, quarantine: str | None = None,
               replace: str = "all", files_per_day: int | None = 0) -> dict:
    """CSV -> partitioned Parquet; aborts on empty input.

    The CSV is parsed once, into a staged table with a verdict for each row,
    which also counts both kinds.  Rejected rows are always written (to
    ``quarantine``, by default ``<dest>_rejected``), before anything is
    replaced.  Days are clustered (``files_per_day``, see ``write_logs``)."""
    quarantine = quarantine or f"{dest.rstrip('/')}_rejected"
    seen, bad = Observation("ingest"), F.col("reject_reason").isNotNull()
    staged = materialize(judge_csv_logs(spark, src).observe(
        seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected")), "ingest")
    counts = seen.get
    if not counts["accepted"]:
        raise ValueError(f"no valid log rows in {src}")
    good, rejected = _split(staged)
    rejected.write.mode("overwrite").parquet(quarantine)
    write_logs(good, dest, replace=replace, files_per_day=files_per_day)
    return {"source": src, "dest": dest, "quarantine": quarantine, **counts}
