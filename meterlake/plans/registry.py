"""Named queries over the test tables, each with an equivalent DuckDB query.

Each registered callable takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole input tables.  The readings view over ``events`` is defined
once per engine (``events_readings`` in Spark, ``READINGS_CTE`` in DuckDB).
Means and sums are compared at 9 decimal places, the 2-place columns are
rounded as decimals (see ``round_numeric``), and bucket columns are returned
as TIMESTAMP_NTZ to match DuckDB's naive TIMESTAMP.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.format import sorted_report
from meterlake.functions.time import as_ntz
from meterlake.operators import queries as Q
from meterlake.session import configure
from meterlake.sources.layout import scan_last
from meterlake.sources.schema import events_readings

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir.rstrip("/"))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run
    return deco


def r9(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


def shape(df: DataFrame, ts: tuple[str, ...] = (), rounded: tuple[str, ...] = ()) -> DataFrame:
    """Cast bucket columns to NTZ and round floating measures, keeping order."""
    cols = [as_ntz(c).alias(c) if c in ts else r9(c).alias(c) if c in rounded else F.col(c)
            for c in df.columns]
    return df.select(*cols)


def readings_cte(extra: str = "") -> str:
    """DuckDB form of the readings view over ``events`` (FIXTURES §2)."""
    return f"""
with r as (
  select ts as "timestamp",
         (user_id % 10)::varchar || lpad(user_id::varchar, 9, '0') as meter_id,
         value as power,
         (225 + event_id % 11)::double as voltage,
         value / (225 + event_id % 11)::double as current,
         50 + (event_id % 5 - 2) * 0.1::double as frequency,
         value * 5 / 60 / 1000 as energy{extra}
  from events)
"""


READINGS_CTE = readings_cte()

# Fixed parameters of the registered queries (events cover 2024-01-01..30).
Q1_START = "2024-01-30"
Q2_START = "2024-01-23"
PROFILE_METER, PROFILE_START, PROFILE_END = "7000000007", "2024-01-15", "2024-01-16"
RECENT_AS_OF = "2024-01-31"
DOD_DAY = "2024-01-30"
EVENT_BANDS = {
    "Night (Low)": (0.0, 60.0),
    "Morning Peak": (0.0, 60.0),
    "Daytime (Medium)": (0.0, 60.0),
    "Evening Peak": (60.0, 120.0),
}


def readings_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_readings(spark, sf_dir)


# --- A1-A4 ---------------------------------------------------------------------

SQL_HOURLY_AVG = READINGS_CTE + f"""
select time_bucket(interval '1 hour', "timestamp") as hour, round(avg(power), 9) as avg_power
from r where "timestamp" >= date '{Q1_START}' group by 1 order by 1"""


@register("hourly_avg", SQL_HOURLY_AVG)
def hourly_avg(spark, sf_dir):
    """Q1: hourly mean power from the last day on."""
    return shape(Q.hourly_avg(readings_of(spark, sf_dir), Q1_START), ("hour",), ("avg_power",))


SQL_PEAK_PERIODS = READINGS_CTE + f"""
select time_bucket(interval '15 minutes', "timestamp") as period, round(avg(power), 9) as avg_power
from r where "timestamp" >= date '{Q2_START}' group by 1
order by avg(power) desc nulls first, period limit 10"""


@register("peak_periods", SQL_PEAK_PERIODS)
def peak_periods(spark, sf_dir):
    """Q2: top-10 15-minute periods by mean power over the last 7 days."""
    return shape(Q.peak_periods(readings_of(spark, sf_dir), Q2_START, 10),
                 ("period",), ("avg_power",))


SQL_MONTHLY = READINGS_CTE + """
select meter_id, date_trunc('month', "timestamp") as month, round(sum(energy), 9) as total_energy
from r group by 1, 2 order by month, sum(energy) desc nulls first, meter_id limit 20"""


@register("monthly_per_key", SQL_MONTHLY)
def monthly_per_key(spark, sf_dir):
    """Q3: monthly energy per meter, top 20."""
    return shape(Q.monthly_per_key(readings_of(spark, sf_dir), 20), ("month",), ("total_energy",))


SQL_MONTHLY_ORDERS = """
select o_custkey, date_trunc('month', o_orderdate) as month, round(sum(o_totalprice), 2) as total_price
from orders group by 1, 2 order by month, sum(o_totalprice) desc nulls first, o_custkey limit 20"""


@register("monthly_per_key_orders", SQL_MONTHLY_ORDERS)
def monthly_per_key_orders(spark, sf_dir):
    """Q3 on ``orders``: monthly total price per customer, top 20."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_totalprice")
    out = Q.monthly_per_key(orders, 20, key_col="o_custkey", time_col="o_orderdate",
                            value_col="o_totalprice", alias="total_price")
    return out.select("o_custkey", as_ntz("month").alias("month"),
                      F.round("total_price", 2).alias("total_price"))


SQL_TABLE_STATS = READINGS_CTE + """
select count(*) as n_rows, round(avg(power), 9) as avg_power, max(power) as max_power,
       min(power) as min_power from r"""


@register("table_stats", SQL_TABLE_STATS)
def table_stats(spark, sf_dir):
    """Q4: full-table count / mean / max / min."""
    return shape(Q.table_stats(readings_of(spark, sf_dir)), rounded=("avg_power",))


# --- A5 ----------------------------------------------------------------------------

SQL_METER_PROFILE = READINGS_CTE + f"""
select meter_id, time_bucket(interval '15 minutes', "timestamp") as bucket,
       round(avg(power), 9) as avg_power
from r where "timestamp" >= date '{PROFILE_START}' and "timestamp" < date '{PROFILE_END}'
  and meter_id = '{PROFILE_METER}'
group by 1, 2 order by bucket"""


@register("meter_profile", SQL_METER_PROFILE)
def meter_profile(spark, sf_dir):
    """A5: one meter, one day, 15-minute means (the raw side of raw-vs-rollup)."""
    out = Q.meter_profile(readings_of(spark, sf_dir), PROFILE_METER, PROFILE_START, PROFILE_END)
    return shape(out, ("bucket",), ("avg_power",))


# --- A9 / A10 / A15 ----------------------------------------------------------------

SQL_QUALITY = READINGS_CTE + """
select 'energy_readings' as table_name, count(*) as total_rows,
       count(distinct meter_id) as unique_meters,
       min("timestamp") as earliest_reading, max("timestamp") as latest_reading,
       round(avg(power)::decimal(38,10), 2)::double as avg_power,
       round(min(power)::decimal(38,10), 2)::double as min_power,
       round(max(power)::decimal(38,10), 2)::double as max_power
from r"""


@register("quality_summary", SQL_QUALITY)
def quality_summary(spark, sf_dir):
    """Data-quality summary."""
    return shape(Q.quality_summary(readings_of(spark, sf_dir)),
                 ("earliest_reading", "latest_reading"))


SQL_HOURLY_PROFILE = READINGS_CTE + """
select extract(hour from "timestamp")::int as hour,
       round(avg(power)::decimal(38,10), 2)::double as avg_power,
       case when extract(hour from "timestamp") between 6 and 9 then 'Morning Peak'
            when extract(hour from "timestamp") between 18 and 22 then 'Evening Peak'
            when extract(hour from "timestamp") >= 23 or extract(hour from "timestamp") <= 5
                 then 'Night (Low)'
            else 'Daytime (Medium)' end as period_type
from r group by extract(hour from "timestamp") order by hour"""


@register("hourly_profile", SQL_HOURLY_PROFILE)
def hourly_profile(spark, sf_dir):
    """A10: hour-of-day profile with band label."""
    return Q.hourly_profile(readings_of(spark, sf_dir))


SQL_RECENT = READINGS_CTE + f"""
select extract(hour from "timestamp")::int as hour,
       round(avg(power)::decimal(38,10), 2)::double as avg_power
from r where "timestamp" >= timestamp '{RECENT_AS_OF}' - interval 1 day
group by 1 order by 1"""


@register("recent_profile", SQL_RECENT)
def recent_profile(spark, sf_dir):
    """Hourly means of the day before a fixed ``as_of``."""
    return Q.recent_profile(readings_of(spark, sf_dir), RECENT_AS_OF)


SQL_DATE_RANGE = READINGS_CTE + """
select min("timestamp") as earliest, max("timestamp") as latest from r"""


@register("date_range", SQL_DATE_RANGE)
def date_range(spark, sf_dir):
    """First and last reading (post-load check)."""
    return shape(Q.date_range(readings_of(spark, sf_dir)), ("earliest", "latest"))


# --- A16-A21 -----------------------------------------------------------------------

SQL_REGION_MONTHLY = READINGS_CTE + """
select substring(meter_id, 1, 1) as region, date_trunc('month', "timestamp") as month,
       round(sum(energy), 9) as total_energy, round(avg(power), 9) as avg_power,
       count(*) as readings
from r group by 1, 2 order by month, region"""


@register("region_monthly", SQL_REGION_MONTHLY)
def region_monthly(spark, sf_dir):
    """Energy, mean power and readings per region and month."""
    return shape(Q.region_monthly(readings_of(spark, sf_dir)), ("month",),
                 ("total_energy", "avg_power"))


SQL_REGION_LABELLED = READINGS_CTE + """
, m as (select substring(meter_id, 1, 1) as region, date_trunc('month', "timestamp") as month,
               round(sum(energy), 9) as total_energy, round(avg(power), 9) as avg_power,
               count(*) as readings
        from r group by 1, 2)
select m.*, l.r_name as region_name
from m left join region l on m.region = l.r_regionkey::varchar"""


@register("region_monthly_labelled", SQL_REGION_LABELLED)
def region_monthly_labelled(spark, sf_dir):
    """Region rows with a label from the ``region`` dimension (left join)."""
    labels = spark.read.parquet(f"{sf_dir}/region.parquet").select(
        F.col("r_regionkey").cast("string").alias("region"), F.col("r_name").alias("region_name"))
    monthly = shape(Q.region_month_totals(readings_of(spark, sf_dir)), ("month",),
                    ("total_energy", "avg_power"))
    return sorted_report(Q.with_region_label(monthly, labels), "month", "region")


SQL_DAILY_ENERGY = READINGS_CTE + """
select time_bucket(interval '1 day', "timestamp") as day, round(sum(energy), 9) as total_energy
from r group by 1 order by 1"""


@register("daily_energy", SQL_DAILY_ENERGY)
def daily_energy(spark, sf_dir):
    """Daily energy total."""
    return shape(Q.daily_energy(readings_of(spark, sf_dir)), ("day",), ("total_energy",))


SQL_DAILY_POWER = READINGS_CTE + """
select time_bucket(interval '1 day', "timestamp") as day, min(power) as min_power,
       round(avg(power), 9) as avg_power, max(power) as max_power
from r group by 1 order by 1"""


@register("daily_power", SQL_DAILY_POWER)
def daily_power(spark, sf_dir):
    """Daily min / mean / max power."""
    return shape(Q.daily_power(readings_of(spark, sf_dir)), ("day",), ("avg_power",))


SQL_HEADLINE = READINGS_CTE + """
select count(*) as readings, count(distinct meter_id) as meters,
       date_diff('day', min("timestamp")::date, max("timestamp")::date)::int as days
from r"""


@register("headline", SQL_HEADLINE)
def headline(spark, sf_dir):
    """Readings, meters, days spanned."""
    return Q.headline(readings_of(spark, sf_dir))


def _band_sql() -> str:
    low = " ".join(f"when '{k}' then {lo}" for k, (lo, _) in EVENT_BANDS.items())
    high = " ".join(f"when '{k}' then {hi}" for k, (_, hi) in EVENT_BANDS.items())
    return READINGS_CTE + f"""
, b as (
  select case when extract(hour from "timestamp") between 6 and 9 then 'Morning Peak'
              when extract(hour from "timestamp") between 18 and 22 then 'Evening Peak'
              when extract(hour from "timestamp") >= 23 or extract(hour from "timestamp") <= 5
                   then 'Night (Low)'
              else 'Daytime (Medium)' end as period_type, power
  from r)
, g as (select period_type, avg(power) as a, min(power) as min_power, max(power) as max_power
        from b group by 1)
select period_type, round(a, 9) as avg_power, min_power, max_power,
       (case period_type {low} end)::double as expected_low,
       (case period_type {high} end)::double as expected_high,
       a between (case period_type {low} end) and (case period_type {high} end) as in_range
from g order by period_type"""


@register("band_check", _band_sql())
def band_check(spark, sf_dir):
    """Mean power per hour band against expected ranges."""
    return shape(Q.band_check(readings_of(spark, sf_dir), EVENT_BANDS), rounded=("avg_power",))


SQL_COMPLETENESS = READINGS_CTE + """
select meter_id, time_bucket(interval '1 day', "timestamp") as day, count(*) as readings,
       288 - count(*) as missing
from r group by 1, 2"""


@register("completeness", SQL_COMPLETENESS)
def completeness(spark, sf_dir):
    """Readings per meter-day against the expected 288."""
    return shape(Q.completeness(readings_of(spark, sf_dir), 288), ("day",))


SQL_CALENDAR = READINGS_CTE + """
, kept as (select meter_id, time_bucket(interval '1 day', "timestamp") as day from r
           where (extract(day from "timestamp") + substr(meter_id, 8)::int) % 4 <> 0),
spans as (select meter_id, min(day) as a, max(day) as b from kept group by 1),
calendar as (select meter_id, unnest(generate_series(a, b, interval '1 day')) as day from spans)
select c.meter_id, c.day, count(k.day) as readings, 288 - count(k.day) as missing
from calendar c left join kept k on c.meter_id = k.meter_id and c.day = k.day group by 1, 2"""


@register("completeness_calendar", SQL_CALENDAR)
def completeness_calendar(spark, sf_dir):
    """Readings per meter and calendar day, with planted empty days (each
    meter loses every fourth day): those have 0 readings and 288 missing."""
    kept = readings_of(spark, sf_dir).filter(
        (F.dayofmonth("timestamp") + F.substring("meter_id", 8, 3).cast("int")) % 4 != 0)
    return shape(Q.completeness_calendar(kept, 288), ("day",))


SQL_LAST_DAY = READINGS_CTE + """
select substring(meter_id, 1, 1) as region, count(*) as readings, round(avg(power), 9) as avg_power
from r where "timestamp" >= (select max(ts) from events) - interval '1 day' group by 1"""


@register("last_day_now", SQL_LAST_DAY)
def last_day_now(spark, sf_dir):
    """The last day before the real clock, on readings shifted so
    that the newest one is from now."""
    df = readings_of(spark, sf_dir)
    newest = df.agg(F.max(F.unix_micros("timestamp"))).scalar()
    shift = F.unix_micros(F.current_timestamp()) - newest
    shifted = df.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + shift))
    out = scan_last(shifted, "1 day").groupBy(Q.region_of("meter_id").alias("region")).agg(
        F.count(F.lit(1)).alias("readings"), F.avg("power").alias("avg_power"))
    return shape(out, rounded=("avg_power",))


# --- W1 / W2 / J6 ------------------------------------------------------------------

SQL_REGION_SHARE = READINGS_CTE + """
, m as (select substring(meter_id, 1, 1) as region, date_trunc('month', "timestamp") as month,
               sum(energy) as te from r group by 1, 2)
select region, month, round(te, 9) as total_energy,
       round(100.0 * te / sum(te) over (partition by month), 9) as share_pct
from m"""


@register("region_share", SQL_REGION_SHARE)
def region_share(spark, sf_dir):
    """Percent of energy per region within each month."""
    return shape(Q.region_share(readings_of(spark, sf_dir)), ("month",),
                 ("total_energy", "share_pct"))


SQL_RANKED_PEAKS = READINGS_CTE + """
, p as (select time_bucket(interval '15 minutes', "timestamp") as period, avg(power) as a
        from r group by 1 order by a desc nulls first, period limit 10)
select (row_number() over (order by a desc nulls first, period))::int as rank, period,
       round(a, 9) as avg_power
from p"""


@register("ranked_peaks", SQL_RANKED_PEAKS)
def ranked_peaks(spark, sf_dir):
    """The whole-range top-10 periods with rank."""
    return shape(Q.ranked_peaks(readings_of(spark, sf_dir), None, 10), ("period",),
                 ("avg_power",))


SQL_DAY_OVER_DAY = READINGS_CTE + f"""
select extract(hour from "timestamp")::int as hour,
       round(avg(power) filter (where "timestamp"::date = date '{DOD_DAY}'), 9) as today_avg,
       round(avg(power) filter (where "timestamp"::date <> date '{DOD_DAY}'), 9) as yesterday_avg
from r where "timestamp" >= date '{DOD_DAY}' - interval 1 day
  and "timestamp" < date '{DOD_DAY}' + interval 1 day
group by 1 order by 1"""


@register("day_over_day", SQL_DAY_OVER_DAY)
def day_over_day(spark, sf_dir):
    """Hourly means of a day beside the day before."""
    return shape(Q.day_over_day(readings_of(spark, sf_dir), DOD_DAY), (),
                 ("today_avg", "yesterday_avg"))
