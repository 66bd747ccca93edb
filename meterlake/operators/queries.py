"""Time-bucketed questions on the readings table.

Every function takes and returns a DataFrame and is built from built-in
column expressions, so Catalyst plans each one as scan (filters and column
pruning pushed to Parquet) -> partial aggregate -> one exchange -> final
aggregate, with top-k answers fused into ``TakeOrderedAndProject`` and
reports bounded by a small key space ordered by ``sorted_report``.  Column
names are parameters so the same code runs on other time-stamped tables.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.format import sorted_report
from meterlake.functions.time import period_type, sql_name, sql_string, time_bucket, to_utc
from meterlake.sources.layout import scan_last, time_bounds

TS, KEY, POWER, ENERGY = "timestamp", "meter_id", "power", "energy"


def _in_range(df: DataFrame, start=None, end=None, time_col: str = TS) -> DataFrame:
    cond = time_bounds(start, end, time_col)
    return df if cond is None else df.filter(cond)


def region_of(key: str | Column = KEY) -> Column:
    """Region = first character of the meter id."""
    return F.substring(F.col(key) if isinstance(key, str) else key, 1, 1)


def round_numeric(c: Column, digits: int = 2) -> Column:
    """``ROUND(x::numeric, n)``: decimal half-up rounding, returned as double."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


# --- A1 / A2 / A3 / A4: the four benchmark questions -------------------------

def hourly_avg(df: DataFrame, start=None, end=None, width: str = "1 hour",
               time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Q1: mean of ``value_col`` per bucket from ``start`` on, by bucket."""
    out = (_in_range(df, start, end, time_col)
           .groupBy(time_bucket(width, time_col).alias("hour"))
           .agg(F.avg(value_col).alias("avg_power")))
    return sorted_report(out, "hour")


def peak_periods(df: DataFrame, start=None, k: int = 10, end=None,
                 width: str = "15 minutes", time_col: str = TS,
                 value_col: str = POWER) -> DataFrame:
    """Q2: the ``k`` buckets with the highest mean (ties broken by period)."""
    return (_in_range(df, start, end, time_col)
            .groupBy(time_bucket(width, time_col).alias("period"))
            .agg(F.avg(value_col).alias("avg_power"))
            .orderBy(F.col("avg_power").desc_nulls_first(), F.col("period"))
            .limit(k))


def monthly_per_key(df: DataFrame, k: int | None = 20, key_col: str = KEY,
                    time_col: str = TS, value_col: str = ENERGY,
                    alias: str = "total_energy") -> DataFrame:
    """Q3: total per key and calendar month; top ``k`` by month, total desc."""
    out = (df.groupBy(F.col(key_col), F.date_trunc("month", F.col(time_col)).alias("month"))
             .agg(F.sum(value_col).alias(alias))
             .orderBy(F.col("month"), F.col(alias).desc_nulls_first(), F.col(key_col)))
    return out.limit(k) if k is not None else out


def table_stats(df: DataFrame, value_col: str = POWER) -> DataFrame:
    """Q4: row count and mean / max / min over the whole table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.avg(value_col).alias("avg_power"),
                  F.max(value_col).alias("max_power"),
                  F.min(value_col).alias("min_power"))


# --- A5: one meter, one range ------------------------------------------------

def meter_profile(df: DataFrame, meter_id: str, start, end,
                  width: str = "15 minutes", key_col: str = KEY,
                  time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Per-bucket mean for one meter in ``[start, end)`` (filters reach Parquet)."""
    cond = F.expr(f"{sql_name(key_col)} = {sql_string(meter_id)}")
    bounds = time_bounds(start, end, time_col)
    out = (df.filter(cond if bounds is None else cond & bounds)
           .groupBy(F.col(key_col), time_bucket(width, time_col).alias("bucket"))
           .agg(F.avg(value_col).alias("avg_power")))
    return sorted_report(out, "bucket")


# --- A9 / A10 / A13-A15: data-quality and load checks ------------------------
def quality_summary(df: DataFrame, name: str = "energy_readings", key_col: str = KEY,
                    time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Row count, distinct meters, time range and 2-place mean/min/max."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(key_col).alias("unique_meters"),
        F.min(time_col).alias("earliest_reading"),
        F.max(time_col).alias("latest_reading"),
        round_numeric(F.avg(value_col)).alias("avg_power"),
        round_numeric(F.min(value_col)).alias("min_power"),
        round_numeric(F.max(value_col)).alias("max_power"),
    ).select(F.lit(name).alias("table_name"), "*")


def hourly_profile(df: DataFrame, time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Mean per hour of day with its band label (label applied after grouping)."""
    out = (df.groupBy(F.hour(time_col).alias("hour"))
           .agg(round_numeric(F.avg(value_col)).alias("avg_power"))
           .withColumn("period_type", period_type("hour")))
    return sorted_report(out, "hour")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of one labelled row count per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(name).alias("table_name"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def date_range(df: DataFrame, time_col: str = TS) -> DataFrame:
    return df.agg(F.min(time_col).alias("earliest"), F.max(time_col).alias("latest"))


def recent_profile(df: DataFrame, as_of, k: int | None = None, span: str = "1 day",
                   time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Hourly means of the last ``span`` before ``as_of`` (first ``k`` hours)."""
    out = sorted_report(scan_last(df, span, as_of, time_col)
                        .groupBy(F.hour(time_col).alias("hour"))
                        .agg(round_numeric(F.avg(value_col)).alias("avg_power")), "hour")
    return out.limit(k) if k is not None else out


# --- A16-A21: dashboard datasets ---------------------------------------------

def region_month_totals(df: DataFrame, key_col: str = KEY, time_col: str = TS,
                        value_col: str = POWER, energy_col: str = ENERGY) -> DataFrame:
    """Energy, mean power and readings per region and month (unordered).

    The unordered form is what other operators build on, so no sort is
    planned under their own shuffles.
    """
    return (df.groupBy(region_of(key_col).alias("region"),
                       F.date_trunc("month", F.col(time_col)).alias("month"))
            .agg(F.sum(energy_col).alias("total_energy"),
                 F.avg(value_col).alias("avg_power"),
                 F.count(F.lit(1)).alias("readings")))


def region_monthly(df: DataFrame, **kw) -> DataFrame:
    """Energy, mean power and readings per region and month, by month."""
    return sorted_report(region_month_totals(df, **kw), "month", "region")


def daily_energy(df: DataFrame, time_col: str = TS, energy_col: str = ENERGY) -> DataFrame:
    out = (df.groupBy(time_bucket("1 day", time_col).alias("day"))
           .agg(F.sum(energy_col).alias("total_energy")))
    return sorted_report(out, "day")


def daily_power(df: DataFrame, time_col: str = TS, value_col: str = POWER) -> DataFrame:
    out = (df.groupBy(time_bucket("1 day", time_col).alias("day"))
           .agg(F.min(value_col).alias("min_power"),
                F.avg(value_col).alias("avg_power"),
                F.max(value_col).alias("max_power")))
    return sorted_report(out, "day")


def headline(df: DataFrame, key_col: str = KEY, time_col: str = TS) -> DataFrame:
    """Readings, meters and the number of calendar days spanned."""
    return df.agg(F.count(F.lit(1)).alias("readings"),
                  F.countDistinct(key_col).alias("meters"),
                  F.datediff(F.to_date(F.max(time_col)),
                             F.to_date(F.min(time_col))).alias("days"))


# Expected power range (W) per band from the reference's report.
EXPECTED_BANDS = {
    "Night (Low)": (200.0, 500.0),
    "Morning Peak": (1500.0, 3000.0),
    "Daytime (Medium)": (800.0, 1500.0),
    "Evening Peak": (1500.0, 3000.0),
}


def band_check(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None,
               time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Mean/min/max per hour band and whether the mean is in its range.

    The ranges are a handful of literals, attached with a ``when`` chain to
    the four grouped rows; no join is needed.
    """
    ranges = ranges or EXPECTED_BANDS
    band = F.col("period_type")
    low = high = None
    for name, (lo, hi) in ranges.items():
        low = (F.when(band == name, F.lit(float(lo))) if low is None
               else low.when(band == name, F.lit(float(lo))))
        high = (F.when(band == name, F.lit(float(hi))) if high is None
                else high.when(band == name, F.lit(float(hi))))
    out = (df.groupBy(period_type(F.hour(time_col)).alias("period_type"))
           .agg(F.avg(value_col).alias("avg_power"),
                F.min(value_col).alias("min_power"),
                F.max(value_col).alias("max_power"))
           .withColumn("expected_low", low)
           .withColumn("expected_high", high)
           .withColumn("in_range", F.col("avg_power").between(
               F.col("expected_low"), F.col("expected_high"))))
    return sorted_report(out, "period_type")


def completeness(df: DataFrame, per_day: int = 288, key_col: str = KEY,
                 time_col: str = TS) -> DataFrame:
    """Readings per meter and day against the expected count."""
    return (df.groupBy(F.col(key_col), time_bucket("1 day", time_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("readings"))
            .withColumn("missing", F.lit(per_day) - F.col("readings")))


def completeness_calendar(df: DataFrame, per_day: int = 288, start=None, end=None, key_col: str = KEY,
                          time_col: str = TS) -> DataFrame:
    """Readings per meter and day of its calendar, days without any included.

    A meter's calendar runs from its first to its last day with readings, or
    over the days of ``[start, end)`` where given; a meter without any reading
    does not appear.  Only the meter-day counts are grouped and joined again:
    readings are shuffled once, as partial counts.
    """
    one_day = F.expr("INTERVAL 1 DAY")
    bounds = time_bounds(start, end, time_col)
    counts = (df if bounds is None else df.filter(bounds)).filter(F.col(time_col).isNotNull())
    counts = counts.groupBy(F.col(key_col), time_bucket("1 day", time_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    first = F.min("day") if start is None else time_bucket("1 day", F.lit(to_utc(start)))
    last = F.max("day") if end is None else time_bucket("1 day", F.lit(to_utc(end) - timedelta(microseconds=1)))
    calendar = (counts.groupBy(key_col).agg(first.alias("first"), last.alias("last"))
                .select(key_col, F.explode(F.sequence("first", "last", one_day)).alias("day")))
    return (calendar.join(counts, [key_col, "day"], "left")
            .select(key_col, "day", F.coalesce("n", F.lit(0)).cast("bigint").alias("readings"))
            .withColumn("missing", F.lit(per_day) - F.col("readings")))


# --- W1 / W2: windows over small grouped results -----------------------------

def ranked_peaks(df: DataFrame, start=None, k: int = 10, **kw) -> DataFrame:
    """Top ``k`` periods with their rank 1..k.

    The rank window runs after the top-k, on at most ``k`` rows, so its
    single window partition never holds more than ``k`` rows.
    """
    top = peak_periods(df, start, k, **kw)
    w = Window.orderBy(F.col("avg_power").desc_nulls_first(), F.col("period"))
    return top.select(F.row_number().over(w).alias("rank"), "period", "avg_power")


def region_share(df: DataFrame, by: str | None = "month", **kw) -> DataFrame:
    """Percent of energy per region within each ``by`` group (None: overall).

    The window runs on the region x month result, which has at most
    (regions x months) rows, never on readings.
    """
    grouped = region_month_totals(df, **kw)
    part = Window.partitionBy(by) if by else Window.partitionBy()
    return grouped.select(
        "region", "month", "total_energy",
        (F.lit(100.0) * F.col("total_energy") / F.sum("total_energy").over(part))
        .alias("share_pct"))


# --- J6 / J7: comparisons and labels -------------------------------------------

def day_over_day(df: DataFrame, day, time_col: str = TS, value_col: str = POWER) -> DataFrame:
    """Hourly mean of ``day`` beside the day before, aligned on hour.

    Conditional aggregation over a two-day range: one scan, one group-by,
    no self-join.
    """
    d = to_utc(day).date()
    start, end = to_utc(d) - timedelta(days=1), to_utc(d) + timedelta(days=1)
    today = F.to_date(F.col(time_col)) == F.lit(d)
    out = (_in_range(df, start, end, time_col)
           .groupBy(F.hour(time_col).alias("hour"))
           .agg(F.avg(F.when(today, F.col(value_col))).alias("today_avg"),
                F.avg(F.when(~today, F.col(value_col))).alias("yesterday_avg")))
    return sorted_report(out, "hour")


def with_region_label(df: DataFrame, labels: DataFrame, region_col: str = "region") -> DataFrame:
    """Left join of a region label table.

    No broadcast hint: the planner broadcasts the label table only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
    re-checks at run time), and shuffles both sides otherwise.
    """
    return df.join(labels, on=region_col, how="left")


# --- U2: equality of two copies -------------------------------------------------

EQUAL_BUCKETS = 1024


def _row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row, in which NULL is a value of its own.

    ``xxhash64`` skips NULLs, so each column goes in with its null flag, and a
    nested one with its JSON text, which shows the NULLs inside.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [F.isnull(c), c]
        if isinstance(f.dataType, (T.StructType, T.ArrayType)):
            parts.append(F.to_json(c, {"ignoreNullFields": "false"}))
    return F.xxhash64(*parts)


def _bucket_digests(df: DataFrame, side: str) -> DataFrame:
    """Row count and sum of row hashes of every hash bucket."""
    h = _row_hash(df)
    return (df.select(F.pmod(h, F.lit(EQUAL_BUCKETS)).alias("bucket"), h.cast("decimal(38,0)").alias("h"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias(f"n_{side}"), F.sum("h").alias(f"h_{side}")))


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in ``a`` and only in ``b``, counted as multisets, and the rows of each.

    Both sides are first summed into ``EQUAL_BUCKETS`` hash buckets, which
    shuffles no row.  Only rows of buckets that differ are then grouped over
    all columns, with duplicates collapsed before that shuffle.  NULLs count
    as values in the hash, so buckets that agree differ by 64-bit chance only.
    """
    spark, cols = a.sparkSession, a.columns
    b = b.select(*cols)
    digests = (_bucket_digests(a, "a").join(_bucket_digests(b, "b"), "bucket", "full")
               .na.fill(0, ["n_a", "n_b"]).collect())  # at most EQUAL_BUCKETS rows
    n_a, n_b = sum(r.n_a for r in digests), sum(r.n_b for r in digests)
    differ = [r.bucket for r in digests if (r.n_a, r.h_a) != (r.n_b, r.h_b)]
    only_left = only_right = 0
    if differ:
        here = lambda df: F.pmod(_row_hash(df), F.lit(EQUAL_BUCKETS)).isin(differ)
        tagged = (a.filter(here(a)).select(*cols, F.lit(1).alias("_in_a"), F.lit(0).alias("_in_b"))
                  .unionByName(b.filter(here(b)).select(*cols, F.lit(0).alias("_in_a"), F.lit(1).alias("_in_b"))))
        per_row = tagged.groupBy(*cols).agg(F.sum("_in_a").alias("na"), F.sum("_in_b").alias("nb"))
        only = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0))
        only_left, only_right = per_row.agg(only("na", "nb"), only("nb", "na")).first()
    return spark.createDataFrame([(only_left, only_right, n_a, n_b)],
                                 "only_left bigint, only_right bigint, rows_left bigint, rows_right bigint")
