"""Time expressions: zone-free micro arithmetic, hour buckets, date partitions,
multi-layout timestamp parsing.

All arithmetic is on ``TIMESTAMP_NTZ`` through ``timestamp_diff`` and
``timestamp_add``, which ignore the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import schema as S

EPOCH = "1970-01-01 00:00:00"


def ntz_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def epoch_micros(ts="timestamp") -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (zone-free)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", ntz_literal(EPOCH), c)


def compress_time_sql(column: str, origin: str, speedup: int) -> str:
    """SQL of ``origin + (ts - origin) div speedup`` in integral microseconds."""
    if speedup == 1:
        return column
    base = f"TIMESTAMP_NTZ'{origin}'"
    return f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, {base}, {column}) div {speedup}, {base})"


def compress_time(column: str, origin: str, speedup: int) -> Column:
    """Replay-time compression of an NTZ column (see ``compress_time_sql``)."""
    return F.expr(compress_time_sql(column, origin, speedup))


def event_date(ts="timestamp") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyyMMdd")


def event_hour(ts="timestamp") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.hour(c)


def date_partition_columns(ts="timestamp") -> dict[str, Column]:
    """``year`` plus zero-padded ``month`` and ``day`` as strings."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return {
        "year": F.year(c).cast("string"),
        "month": F.lpad(F.month(c).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(c).cast("string"), 2, "0"),
    }


# producers may leave out leading zeros, so two-digit fields take one digit as well
_PATTERN_TOKENS = [("yyyy", r"\d{4}"), ("MM", r"\d{1,2}"), ("dd", r"\d{1,2}"), ("HH", r"\d{1,2}"),
                   ("mm", r"\d{1,2}"), ("ss", r"\d{1,2}")]


def unpadded(fmt: str) -> str:
    """The pattern with single letters, which also parse one-digit fields."""
    return re.sub(r"(?<![A-Za-z'])(MM|dd|HH|mm|ss)", lambda m: m[1][0], re.sub(r"'T'(HH)", r"'T'H", fmt))


def layout_regex(fmt: str) -> str:
    """Anchored regex of the text shape a simple datetime pattern produces."""
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "'":
            j = fmt.index("'", i + 1)
            out += re.escape(fmt[i + 1:j])
            i = j + 1
            continue
        for tok, rx in _PATTERN_TOKENS:
            if fmt.startswith(tok, i):
                out += rx
                i += len(tok)
                break
        else:
            out += re.escape(fmt[i])
            i += 1
    return "^" + out + "$"


def parse_timestamp_any(text: Column, formats=None) -> Column:
    """First accepted layout that parses (strictly) wins; NULL when none does.

    The layout is picked by a cheap shape test (``rlike``) before parsing, so
    the parser never runs on text of another layout (a failed parse is far
    costlier than a regex test).  ``try_to_timestamp`` still rejects
    impossible dates such as month 13.  It reads the wall clock in the
    session zone and the cast to NTZ writes it back in the same zone, so the
    result is the text's wall clock whatever the session zone.
    """
    formats = formats or S.ACCEPTED_TIMESTAMP_FORMATS
    expr = None
    for f in formats:
        parsed = F.try_to_timestamp(text, F.lit(unpadded(f))).cast("timestamp_ntz")
        cond = text.rlike(layout_regex(f))
        expr = F.when(cond, parsed) if expr is None else expr.when(cond, parsed)
    return expr
