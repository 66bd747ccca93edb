"""Rollups: per-meter bucketed aggregates kept as mergeable state.

A rollup table holds, per (meter, bucket), ``sum_power``, ``power_count``,
``max_power``, ``min_power``, ``total_energy`` and ``reading_count``; the
mean is exposed as ``sum_power / power_count`` on read, so re-aggregating to
coarser keys can be exact (``weighted=True``) as well as the reference's
mean of means.  Tables are partitioned by ``day`` (UTC) so a refresh
rewrites whole days with dynamic partition overwrite.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.functions.time import (
    day_label, floor_to, sql_string, sql_timestamp, time_bucket, to_utc, width_micros,
)
from meterlake.functions.format import sorted_report
from meterlake.operators.queries import region_of, tables_equal
from meterlake.session import TIME_CONF, session_conf, staging_path, write_conf
from meterlake.sources import files
from meterlake.sources.layout import in_ranges, scan_ranges

ROLLUP_COLUMNS = ["meter_id", "bucket", "sum_power", "power_count", "max_power",
                  "min_power", "total_energy", "reading_count", "day"]
Ranges = list[tuple[datetime, datetime]]


@dataclass(frozen=True)
class RefreshPolicy:
    """Refresh window ``[as_of - start_offset, as_of - end_offset)``.

    ``end_offset`` is the publish horizon (buckets younger than it are left
    for a later run); ``start_offset`` the correction horizon (late rows
    older than it no longer change the rollup).  ``schedule`` is advisory:
    the caller's trigger runs the refresh.
    """
    start_offset: str
    end_offset: str
    schedule: str | None = None


# The reference's three rollup tiers and their refresh policies.
TIERS = {
    "15min": ("15 minutes", RefreshPolicy("3 days", "1 hour", "15 minutes")),
    "hourly": ("1 hour", RefreshPolicy("7 days", "1 hour", "1 hour")),
    "daily": ("1 day", RefreshPolicy("30 days", "1 day", "1 day")),
}


def rollup_state(df: DataFrame, width: str, key_col: str = "meter_id",
                 time_col: str = "timestamp", value_col: str = "power",
                 energy_col: str = "energy") -> DataFrame:
    """Raw readings -> mergeable per-(meter, bucket) state with its ``day``."""
    return (df.groupBy(F.col(key_col).alias("meter_id"),
                       time_bucket(width, time_col).alias("bucket"))
            .agg(F.sum(value_col).alias("sum_power"),
                 F.count(value_col).alias("power_count"),
                 F.max(value_col).alias("max_power"),
                 F.min(value_col).alias("min_power"),
                 F.sum(energy_col).alias("total_energy"),
                 F.count(F.lit(1)).alias("reading_count"))
            .withColumn("day", day_label("bucket")))


def merge_state(state: DataFrame, width: str) -> DataFrame:
    """Re-bucket rollup state to a coarser width by merging it.

    Sums, counts, minima and maxima merge exactly, so a coarser tier built
    from a finer one equals one built from raw rows (up to float summation
    order).  ``width`` must be a whole multiple of the finer width.
    """
    return (state.groupBy("meter_id", time_bucket(width, "bucket").alias("bucket"))
            .agg(F.sum("sum_power").alias("sum_power"),
                 F.sum("power_count").alias("power_count"),
                 F.max("max_power").alias("max_power"),
                 F.min("min_power").alias("min_power"),
                 F.sum("total_energy").alias("total_energy"),
                 F.sum("reading_count").alias("reading_count"))
            .withColumn("day", day_label("bucket")))


def with_avg(state: DataFrame) -> DataFrame:
    """Expose ``avg_power`` (NULL when a bucket has no power values)."""
    return state.withColumn("avg_power", F.try_divide(F.col("sum_power"),
                                                      F.col("power_count")))


def _clustered(state: DataFrame) -> DataFrame:
    """Range-partition by (day, meter, bucket): a hot day or meter is split
    over many writer tasks, and each file covers a contiguous key range."""
    return (state.repartitionByRange("day", "meter_id", "bucket")
            .sortWithinPartitions("day", "meter_id", "bucket"))


def build_rollup(raw: DataFrame, table: str, width: str, mode: str = "errorifexists",
                 location: str | None = None) -> None:
    """Full build of one rollup tier into a table partitioned by day
    (managed, or external at ``location``)."""
    writer = (_clustered(rollup_state(raw, width)).select(*ROLLUP_COLUMNS)
              .write.mode(mode).format("parquet").partitionBy("day"))
    if location:
        writer = writer.option("path", location)
    with write_conf(raw.sparkSession):
        writer.saveAsTable(table)


def build_rollups(raw: DataFrame, tiers: dict[str, str], mode: str = "errorifexists",
                  locations: dict[str, str] | None = None) -> None:
    """Build several tiers with one scan of the raw rows.

    ``tiers`` maps table -> width.  The finest tier is aggregated from raw
    rows; each coarser tier is merged from the previous tier's stored table
    (3-12x smaller than raw for 5-minute readings), which also cuts lineage.
    """
    ordered = sorted(tiers.items(), key=lambda kv: width_micros(kv[1]))
    for (_, fine), (_, coarse) in zip(ordered, ordered[1:]):
        if width_micros(coarse) % width_micros(fine):
            raise ValueError(f"{coarse} is not a multiple of {fine}")
    spark = raw.sparkSession
    previous = None
    for table, width in ordered:
        state = rollup_state(raw, width) if previous is None \
            else merge_state(spark.table(previous), width)
        writer = (_clustered(state).select(*ROLLUP_COLUMNS)
                  .write.mode(mode).format("parquet").partitionBy("day"))
        if locations and table in locations:
            writer = writer.option("path", locations[table])
        with write_conf(spark):
            writer.saveAsTable(table)
        previous = table


def read_rollup(spark: SparkSession, table: str) -> DataFrame:
    return with_avg(spark.table(table))


def rollup_range(rollup: DataFrame, start=None, end=None) -> DataFrame:
    """Rows with ``start <= bucket < end``; the ``day`` bound prunes partitions."""
    cond = _range_condition(start, end)
    return rollup if cond is None else rollup.filter(cond)


def _range_terms(start=None, end=None) -> list[str]:
    terms = []
    if start is not None:
        s = to_utc(start)
        terms += [f"day >= '{s.strftime('%Y-%m-%d')}'", f"bucket >= {sql_timestamp(s)}"]
    if end is not None:
        e = to_utc(end)
        last = (e - timedelta(microseconds=1)).strftime("%Y-%m-%d")
        terms += [f"day <= '{last}'", f"bucket < {sql_timestamp(e)}"]
    return terms


def _range_condition(start=None, end=None) -> Column | None:
    terms = _range_terms(start, end)
    return F.expr(" AND ".join(terms)) if terms else None


def rollup_point_read(rollup: DataFrame, meter_id: str, start, end) -> DataFrame:
    """The A5 question answered from a rollup: no aggregation at read time."""
    terms = [f"meter_id = {sql_string(meter_id)}"] + _range_terms(start, end)
    out = rollup.filter(" AND ".join(terms)).select(
        "meter_id", "bucket", F.try_divide(F.col("sum_power"), F.col("power_count"))
        .alias("avg_power"))
    return sorted_report(out, "bucket")


# --- re-aggregation to coarser keys --------------------------------------------

def _mean(weighted: bool) -> Column:
    if weighted:
        return F.try_divide(F.sum("sum_power"), F.sum("power_count"))
    return F.avg("avg_power")


def region_daily(rollup_daily: DataFrame, weighted: bool = False,
                 limit: int | None = None) -> DataFrame:
    """Region x day: sum of energy and mean power (mean of means by default)."""
    out = (rollup_daily.groupBy(region_of("meter_id").alias("region"),
                                F.col("bucket").alias("day"))
           .agg(F.sum("total_energy").alias("region_energy"),
                _mean(weighted).alias("region_avg_power")))
    out = out.orderBy("day", "region")
    return out.limit(limit) if limit is not None else out


def peak_hours(rollup_hourly: DataFrame, weighted: bool = False) -> DataFrame:
    """Hour of day: mean power (mean of means by default) and peak power."""
    out = (rollup_hourly.groupBy(F.hour("bucket").alias("hour_of_day"))
           .agg(_mean(weighted).alias("average_power"),
                F.max("max_power").alias("peak_power")))
    return sorted_report(out, "hour_of_day")


# --- distinct meters, mergeable -----------------------------------------------------

def meter_sets(df: DataFrame, day: str = "day", key_col: str = "meter_id") -> DataFrame:
    """Exact sets of meters per day, as bitmaps that merge by OR.

    Columns ``day, id_length, bucket, other_id, meters``: ids of digits only
    are bits at their number, a bitmap per 32,768 neighbouring numbers of one
    length (so that ``01`` and ``1`` stay two meters); any other id is a row
    of its own.  From readings or, cheaper, from a rollup tier.
    """
    digits = F.col(key_col).rlike("^[0-9]{1,18}$")
    number = F.when(digits, F.col(key_col).try_cast("bigint"))
    rows = df.filter(F.col(key_col).isNotNull()).select(
        F.col(day).alias("day"), F.when(digits, F.length(key_col)).alias("id_length"),
        F.bitmap_bucket_number(number + 1).alias("bucket"), F.bitmap_bit_position(number + 1).alias("bit"),
        F.when(~digits, F.col(key_col)).alias("other_id"))
    return (rows.groupBy("day", "id_length", "bucket", "other_id")
            .agg(F.bitmap_construct_agg(F.coalesce("bit", F.lit(0).cast("bigint"))).alias("meters")))


def distinct_meters(sets: DataFrame, *by: Column) -> DataFrame:
    """Distinct meters of the sets' days, in groups ``by`` (all days: none)."""
    names = [f"g{i}" for i in range(len(by))]
    merged = (sets.select(*(c.alias(n) for c, n in zip(by, names)), "id_length", "bucket", "other_id", "meters")
              .groupBy(*names, "id_length", "bucket", "other_id").agg(F.bitmap_or_agg("meters").alias("meters")))
    return merged.groupBy(*names).agg(F.coalesce(F.sum(F.bitmap_count("meters")), F.lit(0)).cast("bigint").alias("n_meters"))


def headline_from_rollup(daily: DataFrame, sets: DataFrame) -> DataFrame:
    """Readings, meters and days spanned, without reading raw rows."""
    return daily.agg(F.coalesce(F.sum("reading_count"), F.lit(0)).alias("readings"),
                     distinct_meters(sets).scalar().alias("meters"),
                     F.datediff(F.max(F.to_date("day")), F.min(F.to_date("day"))).alias("days"))


def rollup_vs_raw(raw_answer: DataFrame, rollup_answer: DataFrame) -> DataFrame:
    """Rows only in the raw answer and only in the rollup answer (both 0: same), and the rows of each."""
    return tables_equal(raw_answer, rollup_answer.select(*raw_answer.columns))


# --- incremental refresh ------------------------------------------------------------

def refresh_window(policy: RefreshPolicy, as_of, width: str) -> tuple[datetime, datetime]:
    """Window bounds snapped inward to whole buckets."""
    t = to_utc(as_of)
    lo = t - timedelta(microseconds=width_micros(policy.start_offset))
    hi = t - timedelta(microseconds=width_micros(policy.end_offset))
    return _ceil_to(lo, width), floor_to(hi, width)


def _days_of(ranges: Ranges) -> list[str]:
    """UTC days overlapping half-open ranges."""
    out = set()
    for lo, hi in ranges:
        d = floor_to(lo, "1 day")
        while d < hi:
            out.add(d.strftime("%Y-%m-%d"))
            d += timedelta(days=1)
    return sorted(out)


def _ceil_to(t: datetime, width: str) -> datetime:
    low = floor_to(t, width)
    return low if low == t else low + timedelta(microseconds=width_micros(width))


def whole_buckets(ranges: Ranges, width: str) -> Ranges:
    """Ranges widened to whole buckets, those that meet joined, in time order."""
    out: Ranges = []
    for lo, hi in sorted((floor_to(a, width), _ceil_to(b, width)) for a, b in ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def refresh_ranges(policy: RefreshPolicy | None, as_of, width: str, touched: Ranges | None) -> Ranges:
    """What a refresh recomputes: the buckets of the touched ranges (None: all)
    that lie in the policy's window."""
    if policy is None:
        return whole_buckets(touched or [], width)
    if as_of is None:
        raise ValueError("a refresh policy needs as_of")
    lo, hi = refresh_window(policy, as_of, width)
    ranges = [(lo, hi)] if touched is None else whole_buckets(touched, width)
    return [(max(a, lo), min(b, hi)) for a, b in ranges if max(a, lo) < min(b, hi)]


def _split(ranges: Ranges, inner: tuple[datetime, datetime] | None, width: str) -> tuple[Ranges, Ranges]:
    """Whole buckets of ``ranges`` inside ``inner`` (None: everywhere), and the rest."""
    if inner is None:
        return ranges, []
    lo, hi = _ceil_to(inner[0], width), floor_to(inner[1], width)
    inside = [(max(a, lo), min(b, hi)) for a, b in ranges if max(a, lo) < min(b, hi)]
    rest = [r for a, b in ranges for r in ((a, min(b, lo)), (max(a, hi, lo), b)) if r[0] < r[1]]
    return inside, rest


@dataclass(frozen=True)
class Finer:
    """A finer tier that a refresh may merge from, refreshed just before.

    ``window``: where its buckets are those of the raw rows (None: everywhere).
    """
    table: str
    width: str
    window: tuple[datetime, datetime] | None


def refreshed_state(spark: SparkSession, raw_handle: str, width: str, ranges: Ranges, raw_width: str = "1 day",
                    finer: Finer | None = None) -> DataFrame:
    """State of the buckets in bucket-aligned ranges: merged from the finer
    tier where that has them, else from raw rows, of which only these ranges
    are read."""
    merged, plain = [], ranges
    if finer is not None and width_micros(width) % width_micros(finer.width) == 0:
        merged, plain = _split(ranges, finer.window, width)
    parts = []
    if plain or not merged:
        parts.append(rollup_state(scan_ranges(spark, raw_handle, plain, raw_width), width))
    if merged:
        rows = spark.table(finer.table).filter(F.col("day").isin(_days_of(merged)) & in_ranges(merged, "bucket"))
        parts.append(merge_state(rows, width))
    return reduce(DataFrame.unionByName, parts).select(*ROLLUP_COLUMNS)


def refresh_rollup(spark: SparkSession, raw_handle: str, table: str, width: str,
                   raw_width: str = "1 day", policy: RefreshPolicy | None = None,
                   as_of=None, touched_days: list[str] | None = None,
                   touched: Ranges | None = None, finer: Finer | None = None) -> list[str]:
    """Recompute the rollup's buckets that changed; return the days rewritten.

    * ``touched`` are time ranges with new rows (``touched_days``: whole
      days); only their buckets inside the policy's window are recomputed,
      the other buckets of those days are carried over from the rollup.
    * Raw rows are read from the partitions overlapping those ranges, with
      the ranges pushed down; a coarse tier is merged from ``finer`` instead
      wherever that has its buckets.
    * New rows are staged under the shared checkpoint folder, then swapped
      in with dynamic partition overwrite, so a failed or repeated run leaves
      the same result; days that come back empty are dropped.
    """
    if touched_days is not None:
        touched = (touched or []) + [(to_utc(d), to_utc(d) + timedelta(days=1)) for d in touched_days]
    ranges = refresh_ranges(policy, as_of, width, touched)
    if not ranges:
        return []
    days = _days_of(ranges)
    fresh = refreshed_state(spark, raw_handle, width, ranges, raw_width, finer)
    kept = spark.table(table).filter(F.col("day").isin(days) & ~in_ranges(ranges, "bucket"))
    fresh = fresh.unionByName(kept.select(*ROLLUP_COLUMNS))
    staging = staging_path(spark, "refresh", table)
    with write_conf(spark):
        (_clustered(fresh.select(*ROLLUP_COLUMNS)).write
         .partitionBy("day").parquet(staging))
    staged = spark.read.schema(spark.table(table).schema).parquet(staging)
    written = {r[0] for r in staged.select("day").distinct().collect()}
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic", **TIME_CONF}):
        staged.select(*ROLLUP_COLUMNS).write.insertInto(table, overwrite=True)
    empty = [d for d in days if d not in written]
    if empty:
        specs = ", ".join(f"PARTITION (day='{d}')" for d in empty)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    files.delete(spark, staging)
    return days


def rollup_status(raw: DataFrame, rollups: dict[str, tuple[DataFrame, str]],
                  time_col: str = "timestamp") -> DataFrame:
    """Per rollup: width, end of the last bucket, newest raw row, lag in seconds.

    The newest raw time is attached with a window over the handful of status
    rows (one per rollup plus one for the raw table).
    """
    rows = [r.agg(F.max("bucket").alias("last_bucket")).select(
                F.lit(name).alias("rollup"), F.lit(width).alias("width"),
                F.timestamp_micros(F.unix_micros("last_bucket") + F.lit(width_micros(width)))
                .alias("materialized_until"),
                F.lit(None).cast("timestamp").alias("raw_latest"))
            for name, (r, width) in rollups.items()]
    raw_row = raw.agg(F.max(time_col).alias("raw_latest")).select(
        F.lit(None).cast("string").alias("rollup"), F.lit(None).cast("string").alias("width"),
        F.lit(None).cast("timestamp").alias("materialized_until"), "raw_latest")
    everything = reduce(DataFrame.unionByName, rows + [raw_row])
    latest = F.max("raw_latest").over(Window.partitionBy())
    out = (everything.withColumn("raw_latest", latest).filter(F.col("rollup").isNotNull())
           .withColumn("lag_seconds", (F.unix_micros("raw_latest")
                                       - F.unix_micros("materialized_until")) / F.lit(1e6)))
    return sorted_report(out, "rollup")
