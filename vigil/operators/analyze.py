"""History analyses: IP reputation, top malicious sources, volume statistics,
hourly threat timeline, per-label counts.

The original jobs compute these as several filtered aggregations joined back
together (three scans, two joins).  Here each is one scan with conditional
aggregation (``count_if``), so the log table is read once and every shuffle
carries map-side partial aggregates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil import schema as S
from vigil.functions import scoring
from vigil.functions.timecols import event_date, event_hour

THREAT_LABELS = ["malicious", "suspicious"]


def filter_label(logs: DataFrame, label: str = "malicious") -> DataFrame:
    """Equality filter on ``threat_label`` (pushed to the Parquet scan)."""
    return logs.filter(F.col("threat_label") == label)


def label_counts(logs: DataFrame, label: str, name: str | None = None) -> DataFrame:
    """``count(*)`` per source IP of one label."""
    return (
        filter_label(logs, label)
        .groupBy("source_ip")
        .agg(F.count(F.lit(1)).alias(name or f"{label}_count"))
    )


def reputation_by_ip_logtype(logs: DataFrame) -> DataFrame:
    """Suspicious+malicious activity per ``(source_ip, log_type)`` with the
    per-IP label counts and the historical ``reputation_score``.

    Per-IP counts come from a window over the already aggregated rows (at
    most one row per IP and log type), not from a second scan and join.
    """
    per_type = (
        logs.filter(F.col("threat_label").isin(*THREAT_LABELS))
        .groupBy("source_ip", "log_type")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("dest_ip").alias("unique_targets"),
            F.sum("bytes_transferred").alias("total_bytes"),
            F.count_if(F.col("threat_label") == "malicious").alias("_m"),
            F.count_if(F.col("threat_label") == "suspicious").alias("_s"),
        )
    )
    by_ip = Window.partitionBy("source_ip")
    return (
        per_type.withColumns(
            {
                "malicious_count": F.sum("_m").over(by_ip),
                "suspicious_count": F.sum("_s").over(by_ip),
            }
        )
        .drop("_m", "_s")
        .withColumn("reputation_score", scoring.reputation_score())
    )


def top_malicious_ips(logs: DataFrame, k: int = S.TOP_MALICIOUS_K) -> DataFrame:
    """Top-k ``(source_ip, log_type)`` rows by ``total_events`` (ties broken by key)."""
    return top_of(reputation_by_ip_logtype(logs), k)


def top_of(by_type: DataFrame, k: int = S.TOP_MALICIOUS_K) -> DataFrame:
    """The k first rows of a reputation table in ``top_malicious_ips`` order."""
    return by_type.orderBy(F.col("total_events").desc(), F.col("source_ip"), F.col("log_type")).limit(k)


def ranked(table: DataFrame, metric: str, *ties: str, k: int | None = None) -> DataFrame:
    """Rows by ``metric`` downwards (ties by the given columns upwards), the first ``k`` or all.

    With ``k`` each task keeps its own k rows; without, a range-partitioned sort."""
    out = table.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties])
    return out if k is None else out.limit(k)


def volume_stats(logs: DataFrame, p95: str = "approx") -> DataFrame:
    """Bytes statistics per ``(threat_label, log_type, protocol)``.

    ``p95="approx"`` (default, the original semantics) uses
    ``percentile_approx``: a bounded sketch merged map-side, safe for a group
    holding a large share of all rows.  ``p95="exact"`` gives the lower
    (discrete) 95th percentile through ``exact_percentile`` (radix selection,
    bounded per-task work for any group size).
    """
    keys = ["threat_label", "log_type", "protocol"]
    aggs = [
        F.avg("bytes_transferred").alias("avg_bytes"),
        F.max("bytes_transferred").alias("max_bytes"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum("bytes_transferred").alias("total_bytes"),
    ]
    if p95 == "approx":
        return logs.groupBy(*keys).agg(
            *aggs[:2], F.percentile_approx("bytes_transferred", 0.95).alias("p95_bytes"), *aggs[2:]
        )
    if p95 == "exact":
        from vigil.session import materialize

        # one scan: (group, value) -> count, written once; both the plain
        # statistics and the percentile passes read that table
        value, n = F.col("bytes_transferred"), F.col("_n")
        counts = materialize(
            logs.groupBy(*keys, "bytes_transferred").agg(F.count(F.lit(1)).alias("_n")), "volume-counts"
        )
        base = counts.groupBy(*keys).agg(
            (F.sum(value * n).cast("double") / F.sum(F.when(value.isNotNull(), n))).alias("avg_bytes"),
            F.max(value).alias("max_bytes"),
            F.sum(n).alias("event_count"),
            F.sum(value * n).alias("total_bytes"),
        )
        pct = percentile_from_counts(counts.filter(value.isNotNull()), keys, "bytes_transferred", 0.95, "p95_bytes")
        return join_on_keys(base, pct, keys)
    raise ValueError(f"p95 must be 'approx' or 'exact', got {p95!r}")


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (group-by keeps a NULL
    group, so joins between aggregates must too); right's keys are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[F.col(c) for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def exact_percentile(df: DataFrame, keys: list[str], value: str, q: float, name: str,
                     bits_per_pass: int = 16) -> DataFrame:
    """Exact discrete percentile per group: the smallest value whose
    cumulative count reaches ``ceil(q * n)``.

    Radix selection on the offset ``value - min(value)`` of each group, in a
    fixed number of passes (64 / ``bits_per_pass``).  Each pass keeps the rows
    of the still-possible range, builds a histogram over the next
    ``bits_per_pass`` bits (an ordinary partial aggregation, so a hot group is
    combined map-side and spread over reducers by bucket) and picks the
    bucket that holds the target rank.  The only per-group window runs over
    at most ``2 ** bits_per_pass`` histogram buckets, never over the group's
    rows or distinct values.  Offsets must fit in a signed 64-bit span.

    The ``(group, value) -> count`` table is written once under the shared
    checkpoint folder and every pass reads it: adaptive execution does not
    reliably reuse the identical exchange across the passes, and recomputing
    it would rescan the input once per pass.
    """
    from vigil.session import materialize

    v = F.col(value)
    counts = materialize(
        df.filter(v.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")), "percentile-counts"
    )
    return percentile_from_counts(counts, keys, value, q, name, bits_per_pass)


def percentile_from_counts(counts: DataFrame, keys: list[str], value: str, q: float, name: str,
                           bits_per_pass: int = 16) -> DataFrame:
    """Radix selection (see ``exact_percentile``) over a ``(keys, value, _n)``
    table of non-NULL values and their counts, ideally a persisted one."""
    v = F.col(value)
    state = counts.groupBy(*keys).agg(F.sum("_n").alias("_tot"), F.min(value).alias("_lo")).select(
        *keys, "_lo", F.ceil(F.col("_tot") * q).cast("long").alias("_need"), F.lit(0).cast("long").alias("_pre")
    )
    mask = (1 << bits_per_pass) - 1
    by_bucket = Window.partitionBy(*keys).orderBy("_d")
    passes = -(-64 // bits_per_pass)
    for p in range(passes):
        shift = max(64 - bits_per_pass * (p + 1), 0)
        off = v - F.col("_lo")
        rows = join_on_keys(counts, state, keys, "inner")
        if p > 0:  # rows whose higher bits equal the prefix chosen so far
            rows = rows.filter(F.shiftrightunsigned(off, shift + bits_per_pass) == F.col("_pre"))
        hist = rows.groupBy(*keys, "_lo", "_need", "_pre",
                            (F.shiftrightunsigned(off, shift).bitwiseAND(mask)).alias("_d")).agg(
            F.sum("_n").alias("_c"))
        hit = hist.withColumn("_cum", F.sum("_c").over(by_bucket)).filter(F.col("_cum") >= F.col("_need"))
        first = F.min_by(F.struct("_d", "_c", "_cum", "_lo", "_need", "_pre"), F.col("_d")).alias("_s")
        state = hit.groupBy(*keys).agg(first).select(
            *keys,
            F.col("_s._lo").alias("_lo"),
            (F.col("_s._need") - (F.col("_s._cum") - F.col("_s._c"))).alias("_need"),
            F.shiftleft(F.col("_s._pre"), bits_per_pass).bitwiseOR(F.col("_s._d")).alias("_pre"),
        )
    return state.select(*keys, (F.col("_lo") + F.col("_pre")).alias(name))


def threat_timeline(logs: DataFrame) -> DataFrame:
    """Hourly counts of malicious, suspicious and benign events.

    Hours holding none of the three labels are absent; rows without a
    timestamp are dropped before grouping.
    """
    lab = F.col("threat_label")
    return (
        logs.filter(F.col("timestamp").isNotNull() & lab.isin("malicious", "suspicious", "benign"))
        .groupBy(event_date().alias("event_date"), event_hour().alias("event_hour"))
        .agg(
            F.count_if(lab == "malicious").alias("malicious_count"),
            F.count_if(lab == "suspicious").alias("suspicious_count"),
            F.count_if(lab == "benign").alias("benign_count"),
        )
    )


def attack_category_counts(patterns: DataFrame) -> DataFrame:
    """Number of matching events per attack category."""
    return patterns.groupBy("attack_category").agg(F.count(F.lit(1)).alias("count"))


def flag_summary(logs: DataFrame) -> DataFrame:
    """Events per combination of the four signature flags (NULL = no text)."""
    from vigil.operators.detect import with_signature_flags

    return with_signature_flags(logs).groupBy("is_sqli", "is_xss", "is_lfi", "is_tool").agg(
        F.count(F.lit(1)).alias("event_count")
    )


def top_attack_patterns(patterns: DataFrame, k: int = S.TOP_ATTACK_PATTERNS_K) -> DataFrame:
    """Highest-scoring matches, newest first, event identity breaking ties."""
    order = [F.col("threat_score").desc(), F.col("timestamp").desc()]
    if "event_id" in patterns.columns:
        order.append(F.col("event_id"))
    else:
        order += [F.col(c) for c in ("source_ip", "dest_ip", "request_path", "user_agent")]
    return patterns.orderBy(*order).limit(k)
