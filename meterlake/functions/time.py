"""Time arithmetic as plain column expressions.

Everything here compiles to JVM-side expressions (integer arithmetic on
``unix_micros``), so it stays inside whole-stage codegen and works the same
in batch and streaming plans.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
DAY_MICROS = MICROS["day"]

# Bucket origin of the host's time_bucket (a Monday, so weekly
# buckets start on Mondays) and the origin of partition ranges (the Unix epoch).
BUCKET_ORIGIN = datetime(2000, 1, 3, tzinfo=timezone.utc)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

_WIDTH_RE = re.compile(r"^\s*(\d+)\s*([a-z]+?)s?\s*$")


def width_micros(width: str | timedelta | int) -> int:
    """``"15 minutes"`` / ``"1 hour"`` / ``"1 week"`` / timedelta / int µs -> µs."""
    if isinstance(width, int):
        micros = width
    elif isinstance(width, timedelta):
        micros = (width.days * DAY_MICROS + width.seconds * 1_000_000
                  + width.microseconds)
    else:
        m = _WIDTH_RE.match(width.lower())
        if not m or m.group(2) not in MICROS:
            raise ValueError(f"fixed-width interval expected, got {width!r}")
        micros = int(m.group(1)) * MICROS[m.group(2)]
    if micros <= 0:
        raise ValueError(f"width must be positive: {width!r}")
    return micros


def to_utc(value: str | date | datetime) -> datetime:
    """Literal time bound -> aware UTC datetime (naive values are UTC)."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def _epoch_micros(value: datetime) -> int:
    delta = to_utc(value) - EPOCH
    return delta.days * DAY_MICROS + delta.seconds * 1_000_000 + delta.microseconds


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Expressions over a named column are built as one SQL expression: a single
# call into the JVM instead of one per column function, which is most of the
# driver-side cost of building a query.  The plans are the same.

def sql_name(name: str) -> str:
    """Quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_timestamp(value) -> str:
    """UTC timestamp literal, exact to the microsecond in any session zone."""
    return f"TIMESTAMP '{to_utc(value).strftime('%Y-%m-%d %H:%M:%S.%f')}+00:00'"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unix_date(day_start_micros: Column) -> Column:
    """Midnight-aligned epoch micros -> DATE (exact: the quotient is integral)."""
    return F.date_from_unix_date((day_start_micros / F.lit(DAY_MICROS)).cast("int"))


def time_bucket(width, ts: str | Column = "timestamp",
                origin: datetime = BUCKET_ORIGIN) -> Column:
    """Start of the fixed-width bucket holding ``ts`` (a TIMESTAMP column).

    ``start = ts - pmod(ts - origin, width)`` on epoch microseconds; NULL in,
    NULL out, and times before 1970 floor correctly because ``pmod`` is
    non-negative.
    """
    w = width_micros(width)
    off = _epoch_micros(origin) % w
    if isinstance(ts, str):
        m = f"unix_micros({sql_name(ts)})"
        shifted = f"{m} - {off}" if off else m
        return F.expr(f"timestamp_micros({m} - pmod({shifted}, {w}))")
    m = F.unix_micros(ts)
    shifted = m - F.lit(off) if off else m
    return F.timestamp_micros(m - F.pmod(shifted, F.lit(w)))


def chunk_label(width, ts: str | Column = "timestamp") -> Column:
    """Partition label ``yyyy-MM-dd-HH`` of the epoch-aligned range holding ``ts``.

    Built from integer arithmetic and a date cast, so it does not depend on
    the session time zone; the fixed-width text sorts like time, which lets a
    range predicate on it prune partitions.
    """
    w = width_micros(width)
    if w % MICROS["hour"]:
        raise ValueError("partition widths must be whole hours")
    if isinstance(ts, str):
        m = f"unix_micros({sql_name(ts)})"
        start = f"({m} - pmod({m}, {w}))"
        in_day = f"pmod({start}, {DAY_MICROS})"
        return F.expr(
            f"concat(cast(date_from_unix_date(cast(({start} - {in_day}) / {DAY_MICROS} as int))"
            f" as string), '-', lpad(cast(cast({in_day} / {MICROS['hour']} as int) as string),"
            f" 2, '0'))")
    m = F.unix_micros(ts)
    start = m - F.pmod(m, F.lit(w))
    in_day = F.pmod(start, F.lit(DAY_MICROS))
    return F.concat(
        _unix_date(start - in_day).cast("string"), F.lit("-"),
        F.lpad((in_day / F.lit(MICROS["hour"])).cast("int").cast("string"), 2, "0"))


def floor_to(value, width, origin: datetime = EPOCH) -> datetime:
    """Driver-side floor of a literal bound (used to build partition filters)."""
    w = width_micros(width)
    m = _epoch_micros(to_utc(value))
    o = _epoch_micros(origin) % w
    start = m - ((m - o) % w)
    return EPOCH + timedelta(microseconds=start)


def label_of(value: datetime) -> str:
    """``yyyy-MM-dd-HH`` text of a literal (same format as ``chunk_label``)."""
    return to_utc(value).strftime("%Y-%m-%d-%H")


def parse_label(label: str) -> datetime:
    return datetime.strptime(label, "%Y-%m-%d-%H").replace(tzinfo=timezone.utc)


def day_label(ts: str | Column = "timestamp") -> Column:
    """UTC calendar day of ``ts`` as ``yyyy-MM-dd`` text (rollup partition key)."""
    if isinstance(ts, str):
        m = f"unix_micros({sql_name(ts)})"
        return F.expr(f"cast(date_from_unix_date(cast(({m} - pmod({m}, {DAY_MICROS}))"
                      f" / {DAY_MICROS} as int)) as string)")
    m = F.unix_micros(ts)
    return _unix_date(m - F.pmod(m, F.lit(DAY_MICROS))).cast("string")


def hour_of(ts: str | Column = "timestamp") -> Column:
    return F.hour(_col(ts))


def period_type(hour: str | Column) -> Column:
    """Hour-of-day (0..23) -> band label; first matching band wins."""
    h = _col(hour)
    # The four hour bands of the reference's profile, in order.
    return (F.when(h.between(6, 9), F.lit("Morning Peak"))
            .when(h.between(18, 22), F.lit("Evening Peak"))
            .when((h >= 23) | (h <= 5), F.lit("Night (Low)"))
            .otherwise(F.lit("Daytime (Medium)")))


def as_ntz(c: str | Column) -> Column:
    """Zone-aware timestamp -> TIMESTAMP_NTZ (wall clock in the session zone)."""
    return _col(c).cast("timestamp_ntz")
