"""Time-partitioned layouts of the readings table.

A layout is a Parquet dataset (a folder, or a managed catalog table)
partitioned by ``chunk``: the start of an epoch-aligned time range of a
chosen width, formatted ``yyyy-MM-dd-HH``.  Reads through ``scan_range`` add
a predicate on ``chunk`` next to the one on ``timestamp`` so Spark prunes
whole partitions before any file is opened.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.time import (
    chunk_label, day_label, floor_to, label_of, sql_name, sql_timestamp, to_utc, width_micros,
)
from meterlake.session import write_conf
from meterlake.sources.schema import (
    READING_COLUMNS, derive_measures, is_table, readings, split_valid, stored_readings,
)

DEFAULT_SORT = ("meter_id", "-timestamp")


def _sort_cols(order: tuple[str, ...]) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


def cluster_by_chunk(df: DataFrame, order: tuple[str, ...] = DEFAULT_SORT,
                     num_files: int | None = None) -> DataFrame:
    """Range-partition on (chunk, *order) and sort each task's rows.

    Range boundaries come from a sample, so a chunk (or a single meter) that
    holds a third of all rows is split over many tasks instead of landing in
    one; without ``num_files`` AQE sizes the partitions.  Each task then
    writes contiguous (chunk, meter, time) runs, which gives tight Parquet
    row-group statistics for meter lookups.
    """
    keys = [F.col("chunk")] + [F.col(c.lstrip("-")) for c in order]
    if "timestamp" not in [c.lstrip("-") for c in order]:
        keys.append(F.col("timestamp"))
    parts = df.repartitionByRange(num_files, *keys) if num_files \
        else df.repartitionByRange(*keys)
    return parts.sortWithinPartitions(F.col("chunk"), *_sort_cols(order))


# Order of rows along a curve through time and meters, in place of column names.
Z_ORDER = ("z",)
Z_BITS = 5


def _spread(x: Column, bits: int) -> Column:
    """A number with a zero between any two of its ``bits`` bits."""
    out = F.lit(0)
    for i in range(bits):
        out = out + F.shiftleft(F.shiftright(x, i).bitwiseAND(F.lit(1)), 2 * i)
    return out


def z_value(df: DataFrame, width: str, bits: int = Z_BITS) -> Column:
    """Interleaved bits of a row's place in its partition's time range and of
    its meter's rank: neighbours in both are neighbours in number.

    Ranks come from ``2**bits - 1`` quantiles of the ids (numbers, or the
    first bytes of other ids), which is all that reaches the driver.
    """
    w = width_micros(width)
    image = F.coalesce(F.col("meter_id").try_cast("bigint"),
                       F.conv(F.hex(F.substring(F.rpad("meter_id", 7, " "), 1, 7)), 16, 10).try_cast("bigint"), F.lit(0))
    cuts = [i / 2 ** bits for i in range(1, 2 ** bits)]
    bounds = sorted(set(df.agg(F.percentile_approx(image, cuts, 100 * 2 ** bits)).first()[0] or []))
    rank = sum(((image > F.lit(b)).cast("int") for b in bounds), F.lit(0))
    at = F.coalesce(F.pmod(F.unix_micros("timestamp"), F.lit(w)), F.lit(0))
    place = F.floor(at * 2 ** bits / F.lit(w)).cast("int")
    return _spread(rank, bits) * 2 + _spread(place, bits)


def cluster_by_z(df: DataFrame, width: str, bits: int = Z_BITS) -> DataFrame:
    """Like ``cluster_by_chunk``, along the curve: a file, and each row group
    of it, covers a small range of meters and of times."""
    rows = df.withColumn("z", z_value(df, width, bits))
    return (rows.repartitionByRange("chunk", "z", "meter_id", "timestamp")
            .sortWithinPartitions("chunk", "z", "meter_id", F.col("timestamp").desc()).drop("z"))


def with_chunk(df: DataFrame, width: str) -> DataFrame:
    return df.select(*READING_COLUMNS).withColumn("chunk", chunk_label(width, "timestamp"))


def write_partitioned(df: DataFrame, handle: str, width: str = "1 day",
                      sort: tuple[str, ...] = DEFAULT_SORT, mode: str = "errorifexists",
                      codec: str | None = None, num_files: int | None = None,
                      location: str | None = None, meter_bloom: bool = False) -> None:
    """Write readings partitioned by ``chunk`` of the given width.

    ``mode="ignore"`` is the idempotent create; ``handle`` is a folder or a
    table name (managed, or external when ``location`` is given).
    ``meter_bloom`` adds a Parquet bloom filter on ``meter_id`` so point
    lookups skip row groups whose min/max range covers the id but not it.
    """
    out = cluster_by_chunk(with_chunk(df, width), sort, num_files)
    writer = out.write.mode(mode).partitionBy("chunk")
    if codec:
        writer = writer.option("compression", codec)
    if meter_bloom:
        writer = writer.option("parquet.bloom.filter.enabled#meter_id", "true")
    with write_conf(df.sparkSession):
        if is_table(handle):
            if location:
                writer = writer.option("path", location)
            writer.format("parquet").saveAsTable(handle)
        else:
            writer.parquet(handle)


# Bytes of stored readings per bucket: what one task reads of a bucketed table.
BUCKET_BYTES = 2 << 30


def write_bucketed(df: DataFrame, table: str, buckets: int, location: str | None = None,
                   sort: tuple[str, ...] = ("meter_id", "timestamp"), mode: str = "errorifexists") -> None:
    """Readings in ``buckets`` files by a hash of the meter, each sorted.

    Questions grouped by meter (monthly totals, per-meter rollups) need no
    shuffle on such a table: each task has all rows of its meters.  For tables
    whose meters are about equally busy; a bucket is one task, so a single
    meter with a large share of all rows belongs in the time-partitioned
    layout, whose partial aggregates split it.  Choose ``buckets`` by stored
    size (``BUCKET_BYTES`` each).
    """
    rows = df.select(*READING_COLUMNS).repartition(buckets, "meter_id")
    writer = rows.write.mode(mode).format("parquet").bucketBy(buckets, "meter_id").sortBy(*sort)
    if location:
        writer = writer.option("path", location)
    with write_conf(df.sparkSession):
        writer.saveAsTable(table)


def append_readings(df: DataFrame, handle: str, width: str = "1 day",
                    minutes: float = 5.0) -> DataFrame:
    """Append valid rows (derived measures filled); return the rejected rows.

    The rejected side is lazy: the caller decides whether to store it.
    """
    good, rejected = split_valid(df)
    write_partitioned(derive_measures(good, minutes), handle, width, mode="append")
    return rejected


def relayout(spark: SparkSession, src: str, dst: str, width: str,
             sort: tuple[str, ...] = DEFAULT_SORT, mode: str = "errorifexists") -> None:
    """Copy a readings dataset into a layout of another partition width."""
    write_partitioned(readings(spark, src), dst, width, sort=sort, mode=mode)


def _chunk_sql(start=None, end=None, width: str = "1 day") -> list[str]:
    terms = []
    if start is not None:
        terms.append(f"chunk >= '{label_of(floor_to(start, width))}'")
    if end is not None:
        last = floor_to(to_utc(end) - timedelta(microseconds=1), width)
        terms.append(f"chunk <= '{label_of(last)}'")
    return terms


def _time_sql(start=None, end=None, time_col: str = "timestamp") -> list[str]:
    terms = []
    if start is not None:
        terms.append(f"{sql_name(time_col)} >= {sql_timestamp(start)}")
    if end is not None:
        terms.append(f"{sql_name(time_col)} < {sql_timestamp(end)}")
    return terms


def _all(terms: list[str]) -> Column | None:
    return F.expr(" AND ".join(terms)) if terms else None


def chunk_bounds(start=None, end=None, width: str = "1 day") -> Column | None:
    """Predicate on ``chunk`` implied by ``start <= timestamp < end``."""
    return _all(_chunk_sql(start, end, width))


def time_bounds(start=None, end=None, time_col: str = "timestamp") -> Column | None:
    """Half-open ``[start, end)`` on the time column; either side optional."""
    return _all(_time_sql(start, end, time_col))


def scan_range(spark: SparkSession, handle: str, start=None, end=None,
               width: str = "1 day") -> DataFrame:
    """Readings in ``[start, end)`` read only from the partitions that hold them.

    On a catalog table the ``chunk`` predicate prunes partitions in the
    catalog before any folder is listed; on a plain folder every partition
    folder is listed first and pruned after, so keep large layouts as tables.
    """
    df = stored_readings(spark, handle)
    cond = _all(_chunk_sql(start, end, width) + _time_sql(start, end))
    if cond is not None:
        df = df.filter(cond)
    return df.select(*READING_COLUMNS)


def chunks_for_ranges(ranges: list[tuple[datetime, datetime]], width: str = "1 day") -> list[str]:
    """Labels of every ``width`` partition overlapping half-open time ranges."""
    w = timedelta(microseconds=width_micros(width))
    labels = set()
    for start, end in ranges:
        c = floor_to(start, width)
        while c < end:
            labels.add(label_of(c))
            c += w
    return sorted(labels)


def chunks_for_days(days: list[str], width: str = "1 day") -> list[str]:
    """Labels of every ``width`` partition overlapping the given UTC days."""
    return chunks_for_ranges([(to_utc(d), to_utc(d) + timedelta(days=1)) for d in days], width)


def scan_days(spark: SparkSession, handle: str, days: list[str],
              width: str = "1 day") -> DataFrame:
    """Readings of the given UTC days, read only from the partitions that
    overlap them (an ``IN`` list on ``chunk``, however scattered the days)."""
    df = stored_readings(spark, handle)
    in_days = F.col("chunk").isin(chunks_for_days(days, width)) & \
        day_label("timestamp").isin(list(days))
    return df.filter(in_days).select(*READING_COLUMNS)


def in_ranges(ranges: list[tuple[datetime, datetime]], time_col: str = "timestamp") -> Column:
    """Whether a time lies in one of some half-open ranges."""
    return F.expr(" OR ".join(f"({' AND '.join(_time_sql(a, b, time_col))})" for a, b in ranges) or "false")


def scan_ranges(spark: SparkSession, handle: str, ranges: list[tuple[datetime, datetime]],
                width: str = "1 day") -> DataFrame:
    """Readings of some time ranges: an ``IN`` list prunes the partitions, and
    the ranges themselves are pushed down to the files' row groups."""
    df = stored_readings(spark, handle)
    wanted = F.col("chunk").isin(chunks_for_ranges(ranges, width)) & in_ranges(ranges)
    return df.filter(wanted).select(*READING_COLUMNS)


def scan_last(df: DataFrame, span: str = "1 day", as_of=None,
              time_col: str = "timestamp") -> DataFrame:
    """Rows of the last ``span`` before ``as_of`` (``NOW()`` when None)."""
    anchor = F.lit(to_utc(as_of)) if as_of is not None else F.current_timestamp()
    return df.filter(F.col(time_col) >= anchor - F.expr(f"INTERVAL {span}"))
