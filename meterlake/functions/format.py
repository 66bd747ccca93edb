"""Report formatting and ratio helpers (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def human_bytes(c: str | Column) -> Column:
    """Byte count -> ``"123 kB"`` style text, switching unit at 10x1024."""
    b = _col(c).cast("double")
    # Size units in ascending order, 1024 apart.
    units = ["kB", "MB", "GB", "TB"]
    expr = F.when(b < F.lit(10 * 1024.0), F.format_string("%d bytes", b.cast("long")))
    for i, unit in enumerate(units, start=1):
        text = F.format_string(f"%d {unit}", F.round(b / F.lit(1024.0 ** i)).cast("long"))
        expr = expr.when(b < F.lit(10 * 1024.0 ** (i + 1)), text)
    return expr.otherwise(F.format_string(
        "%d PB", F.round(b / F.lit(1024.0 ** 5)).cast("long")))


def savings_pct(before: str | Column, after: str | Column,
                on_zero: float | None = 0.0, digits: int = 1) -> Column:
    """``100 * (1 - after/before)`` rounded; ``on_zero`` when before is 0/NULL.

    ``on_zero=0.0`` is the CASE form of the per-partition report,
    ``on_zero=None`` the NULLIF form of the per-table report.
    """
    b, a = _col(before).cast("double"), _col(after).cast("double")
    pct = F.round(F.lit(100.0) * (F.lit(1.0) - F.try_divide(a, b)), digits)
    fallback = F.lit(on_zero).cast("double")
    return F.when(b > 0, pct).otherwise(fallback)


def grouped_number(c: str | Column) -> Column:
    """Whole number with thousands separators (``4,033,000``)."""
    return F.format_number(_col(c), 0)


def pct_change(before: str | Column, after: str | Column) -> Column:
    """``(after / before - 1) * 100``; NULL when before is 0."""
    return (F.try_divide(_col(after).cast("double"), _col(before).cast("double"))
            - F.lit(1.0)) * F.lit(100.0)


def speedup(slow: str | Column, fast: str | Column) -> Column:
    """``slow / fast``; NULL when fast is 0."""
    return F.try_divide(_col(slow).cast("double"), _col(fast).cast("double"))


def sorted_report(df: DataFrame, *cols) -> DataFrame:
    """ORDER BY for a result bounded by a small key space (time buckets,
    hours of day, regions x days), never by the input size.

    The aggregate before it stays parallel; its few output rows are moved
    into one partition and sorted there.  A global sort would instead plan a
    range shuffle whose boundaries cost an extra sampling job per query.
    No row is ever cut, whatever NULL keys or widths the data bring.
    """
    return df.repartition(1).sortWithinPartitions(*cols)
