"""Registered queries that write: layouts, catalogues, compaction, retention,
rollups and their refresh.

Each call writes into a fresh folder under the cluster's shared checkpoint
folder (``spark.checkpoint.dir``) and reads the result back, so the answer
comes from the stored data.  Tables are external tables at those folders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.format import grouped_number, human_bytes, pct_change, savings_pct, speedup
from meterlake.functions.time import day_label
from meterlake.operators import lifecycle as L
from meterlake.operators import queries as Q
from meterlake.operators import rollups as R
from meterlake.plans.registry import (
    PROFILE_END, PROFILE_METER, PROFILE_START, Q1_START, Q2_START, READINGS_CTE,
    SQL_HEADLINE, SQL_HOURLY_AVG, SQL_METER_PROFILE, SQL_MONTHLY, SQL_PEAK_PERIODS, SQL_TABLE_STATS,
    readings_cte, readings_of, register, shape,
)
from meterlake.session import scratch_path, unique_table
from meterlake.sources import catalog as C
from meterlake.sources.layout import (
    Z_ORDER, append_readings, relayout, scan_range, write_bucketed, write_partitioned,
)
from meterlake.sources.schema import derive_measures, readings, readings_from_events

# The reference's three layouts (table name, partition width).
LAYOUTS = {
    "3h": ("energy_readings_3h", "3 hours"),
    "1d": ("energy_readings", "1 day"),
    "1w": ("energy_readings_week", "1 week"),
}


def write_layout(spark: SparkSession, sf_dir: str, which: str, as_table: bool = False) -> str:
    """Write the readings of ``sf_dir`` in one layout; return its handle."""
    name, width = LAYOUTS[which]
    path = scratch_path(spark, f"layout-{which}")
    if as_table:
        table = unique_table(name)
        write_partitioned(readings_of(spark, sf_dir), table, width, location=path)
        return table
    write_partitioned(readings_of(spark, sf_dir), path, width)
    return path


# --- L1 / S5 / S6: the benchmark questions on each layout ----------------------

@register("layout_3h_hourly_avg", SQL_HOURLY_AVG)
def layout_3h_hourly_avg(spark, sf_dir):
    """Q1 through ``scan_range`` on a freshly written 3-hour layout."""
    path = write_layout(spark, sf_dir, "3h")
    df = scan_range(spark, path, Q1_START, width="3 hours")
    return shape(Q.hourly_avg(df), ("hour",), ("avg_power",))


@register("layout_1d_peak_periods", SQL_PEAK_PERIODS)
def layout_1d_peak_periods(spark, sf_dir):
    """Q2 through ``scan_range`` on a freshly written 1-day layout."""
    path = write_layout(spark, sf_dir, "1d")
    df = scan_range(spark, path, Q2_START, width="1 day")
    return shape(Q.peak_periods(df, None, 10), ("period",), ("avg_power",))


@register("layout_1w_monthly", SQL_MONTHLY)
def layout_1w_monthly(spark, sf_dir):
    """Q3 on a 1-week layout copied (``relayout``) from the 1-day one."""
    src = write_layout(spark, sf_dir, "1d")
    dst = scratch_path(spark, "layout-1w")
    relayout(spark, src, dst, "1 week")
    return shape(Q.monthly_per_key(readings(spark, dst), 20), ("month",), ("total_energy",))


SQL_ROW_COUNTS = READINGS_CTE + """
select 'energy_readings (1-day)' as table_name, count(*) as rows from r
union all select 'energy_readings_3h (3-hour)', count(*) from r
union all select 'energy_readings_week (1-week)', count(*) from r"""


@register("row_counts", SQL_ROW_COUNTS)
def row_counts(spark, sf_dir):
    """Row counts of the three layouts, labelled."""
    labels = {"1d": "energy_readings (1-day)", "3h": "energy_readings_3h (3-hour)",
              "1w": "energy_readings_week (1-week)"}
    return Q.row_counts({labels[k]: readings(spark, write_layout(spark, sf_dir, k))
                         for k in ("1d", "3h", "1w")})


@register("relayout_compare", READINGS_CTE + """
select 0::bigint as only_left, 0::bigint as only_right, count(*) as rows_left, count(*) as rows_right from r""")
def relayout_compare(spark, sf_dir):
    """The 3-hour copy of the data equals the source readings, row for row."""
    src = readings_of(spark, sf_dir)
    copy = readings(spark, write_layout(spark, sf_dir, "3h"))
    return Q.tables_equal(src, copy)


def _partition_sql(name: str, width: str) -> str:
    b = f"time_bucket(interval '{width}', \"timestamp\", timestamp '1970-01-01')"
    return (f"select '{name}' as \"table\", count(distinct {b}) as num_chunks, "
            f"min({b})::date as earliest_chunk, "
            f"max({b} + interval '{width}')::date as latest_chunk from r")


SQL_PARTITION_SUMMARY = READINGS_CTE + "\nunion all\n".join(
    _partition_sql(n, w) for n, w in LAYOUTS.values())


@register("partition_summary", SQL_PARTITION_SUMMARY)
def partition_summary(spark, sf_dir):
    """Partition count and date range of each layout, from the listing."""
    tables = {LAYOUTS[k][0]: (write_layout(spark, sf_dir, k), LAYOUTS[k][1])
              for k in LAYOUTS}
    return C.partition_summary(C.union_catalogs(spark, tables))


def _chunks_sql(name: str, width: str) -> str:
    return f"""select '{name}' as "table", time_bucket(interval '{width}', "timestamp",
         timestamp '1970-01-01') as range_start,
         time_bucket(interval '{width}', "timestamp", timestamp '1970-01-01') + interval '{width}' as range_end,
         count(*) as n_rows from r group by 1, 2, 3"""


CHUNKS_CTE = READINGS_CTE + ", c as (" + "\nunion all\n".join(_chunks_sql(n, w) for n, w in LAYOUTS.values()) + ")\n"


def _layout_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.union_catalogs(spark, {LAYOUTS[k][0]: (write_layout(spark, sf_dir, k), LAYOUTS[k][1])
                                    for k in LAYOUTS})


@register("table_sizes", CHUNKS_CTE + """
select "table", count(*) as n_partitions, true as has_bytes, true as partitions_sum_to_table from c group by 1""")
def table_sizes(spark, sf_dir):
    """Totals per layout; that files and bytes are there and the
    partitions' sizes add up to the table's, as sizes themselves are not in the data."""
    catalog = _layout_catalog(spark, sf_dir)
    parts = C.partition_sizes(catalog).groupBy("table").agg(F.sum("bytes").alias("part_bytes"))
    return (C.table_catalog(catalog).join(parts, "table")
            .select("table", "n_partitions", ((F.col("bytes") > 0) & (F.col("n_files") >= F.col("n_partitions"))
                                              & F.col("total_size").isNotNull()).alias("has_bytes"),
                    (F.col("bytes") == F.col("part_bytes")).alias("partitions_sum_to_table")))


# --- L7 / L8 / L9 / L11: compaction and retention -------------------------------

COMPACT_AS_OF, RETENTION_AS_OF = "2024-01-31", "2024-02-15"


@register("compacted_table_stats", SQL_TABLE_STATS)
def compacted_table_stats(spark, sf_dir):
    """Q4 after compacting every partition older than 24 hours (same answer)."""
    table = write_layout(spark, sf_dir, "1d", as_table=True)
    L.compact_partitions(spark, table, "1 day", older_than="24 hours", as_of=COMPACT_AS_OF)
    return shape(Q.table_stats(readings(spark, table)), rounded=("avg_power",))


@register("compacted_z_profile", SQL_METER_PROFILE)
def compacted_z_profile(spark, sf_dir):
    """A5 after compacting along time and meters at once (same answer)."""
    table = write_layout(spark, sf_dir, "1w", as_table=True)
    L.compact_partitions(spark, table, "1 week", order_by=Z_ORDER)
    rows = scan_range(spark, table, PROFILE_START, PROFILE_END, "1 week")
    return shape(Q.meter_profile(rows, PROFILE_METER, PROFILE_START, PROFILE_END), ("bucket",), ("avg_power",))


def _compacted_layouts(spark: SparkSession, sf_dir: str) -> dict[str, tuple[str, str]]:
    """The three layouts with everything older than 24 hours at ``COMPACT_AS_OF`` compacted."""
    tables = {LAYOUTS[k][0]: (write_layout(spark, sf_dir, k, as_table=True), LAYOUTS[k][1]) for k in LAYOUTS}
    for handle, width in tables.values():
        L.compact_partitions(spark, handle, width, older_than="24 hours", as_of=COMPACT_AS_OF)
    return tables


def _stored_stats(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    return L.compaction_stats(spark, {name: handle for name, (handle, _) in tables.items()})


SQL_STATUS = CHUNKS_CTE + """, s as (
select *, case when range_end <= timestamp '2024-01-30' then 'Compressed' else 'Uncompressed' end as compression_status
from c)
"""


@register("compression_report", SQL_STATUS + """
select "table", compression_status, count(*) as chunk_count, true as has_sizes,
       compression_status = 'Compressed' as shrunk from s group by 1, 2""")
def compression_report(spark, sf_dir):
    """The report over the three layouts, from the stored
    statistics: counts, and flags in place of sizes that are not in the data."""
    tables = _compacted_layouts(spark, sf_dir)
    report = L.compression_report(C.union_catalogs(spark, tables), _stored_stats(spark, tables))
    sizes = (F.col("before_bytes") > 0) & (F.col("after_bytes") > 0) & F.col("before_size").isNotNull()
    return report.select("table", "compression_status", "chunk_count", sizes.alias("has_sizes"),
                         (F.col("savings_pct") != 0).alias("shrunk"))


@register("compression_status_counts", SQL_STATUS + """
select "table", compression_status, count(*) as chunk_count, 0::bigint as rewritten_again from s group by 1, 2""")
def compression_status_counts(spark, sf_dir):
    """A12 / J1-J2 without sizes: partitions per table and status, and how
    many a second compaction rewrites (none: the stored state names them)."""
    tables = _compacted_layouts(spark, sf_dir)
    again = [L.compact_partitions(spark, handle, width, older_than="24 hours", as_of=COMPACT_AS_OF, name=name)
             for name, (handle, width) in tables.items()]
    again = reduce(DataFrame.unionByName, again).groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    report = L.compression_report(C.union_catalogs(spark, tables), _stored_stats(spark, tables))
    return report.join(again, "table", "left").select(
        "table", "compression_status", "chunk_count", F.coalesce("n", F.lit(0).cast("bigint")).alias("rewritten_again"))


@register("compression_detail", SQL_STATUS + """
select "table", strftime(range_start, '%Y-%m-%d-%H') as chunk, compression_status as status, true as has_sizes
from s where compression_status = 'Compressed'""")
def compression_detail(spark, sf_dir):
    """Every compacted partition of the three layouts."""
    tables = _compacted_layouts(spark, sf_dir)
    detail = L.compression_detail(C.union_catalogs(spark, tables), _stored_stats(spark, tables))
    sizes = F.col("before_size").isNotNull() & F.col("after_size").isNotNull() & F.col("savings_pct").isNotNull()
    return detail.select("table", "chunk", "status", sizes.alias("has_sizes"))


@register("partition_sizes", CHUNKS_CTE + """
select "table", strftime(range_start, '%Y-%m-%d-%H') as chunk, range_start::date as start_date,
       range_end::date as end_date, true as has_bytes from c""")
def partition_sizes(spark, sf_dir):
    """Every partition of the three layouts with its dates."""
    has = (F.col("bytes") > 0) & (F.col("n_files") > 0) & F.col("chunk_size").isNotNull()
    return C.partition_sizes(_layout_catalog(spark, sf_dir)).select(
        "table", "chunk", "start_date", "end_date", has.alias("has_bytes"))


SQL_SIZE_RATIOS = """
with p as (select substring((user_id % 10)::varchar, 1, 1) as region,
                  sum(octet_length(props::blob)) as all_bytes,
                  coalesce(sum(octet_length(props::blob)) filter (event_type <> 'view'), 0) as kept_bytes,
                  count(*) as n
           from events group by 1),
f as (select region, all_bytes, kept_bytes, n, 0 as no_bytes from p)
select region,
       case when all_bytes < 10240 then all_bytes || ' bytes'
            when all_bytes < 10485760 then round(all_bytes / 1024.0)::bigint || ' kB'
            when all_bytes < 10737418240 then round(all_bytes / 1048576.0)::bigint || ' MB'
            else round(all_bytes / 1073741824.0)::bigint || ' GB' end as all_size,
       format('{:,}', n) as n_text,
       round(100.0 * (1 - kept_bytes::double / all_bytes), 1) as savings_pct,
       0.0::double as savings_zero_rule, null::double as savings_null_rule,
       round((kept_bytes::double / all_bytes - 1) * 100, 9) as change_pct, null::double as change_of_nothing,
       round(all_bytes::double / kept_bytes, 9) as ratio, null::double as ratio_to_nothing
from f
"""


@register("size_ratios", SQL_SIZE_RATIOS)
def size_ratios(spark, sf_dir):
    """Sizes, savings and ratios on sizes that the data
    have (bytes of ``events.props`` per region, with and without views), and
    each rule for a zero denominator."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    size = F.octet_length("props")
    p = events.groupBy((F.col("user_id") % 10).cast("string").alias("region")).agg(
        F.sum(size).alias("a"), F.coalesce(F.sum(F.when(F.col("event_type") != "view", size)), F.lit(0)).alias("k"),
        F.count(F.lit(1)).alias("n")).withColumn("zero", F.lit(0))
    return p.select("region", human_bytes("a").alias("all_size"), grouped_number("n").alias("n_text"),
                    savings_pct("a", "k").alias("savings_pct"),
                    savings_pct("zero", "k", on_zero=0.0).alias("savings_zero_rule"),
                    savings_pct("zero", "k", on_zero=None).alias("savings_null_rule"),
                    F.round(pct_change("a", "k"), 9).alias("change_pct"), pct_change("zero", "k").alias("change_of_nothing"),
                    F.round(speedup("a", "k"), 9).alias("ratio"), speedup("a", "zero").alias("ratio_to_nothing"))


SQL_RETENTION = READINGS_CTE + """
select count(*) as n_rows, round(avg(power), 9) as avg_power, max(power) as max_power,
       min(power) as min_power from r where "timestamp" >= timestamp '2024-01-16'"""


@register("retention_table_stats", SQL_RETENTION)
def retention_table_stats(spark, sf_dir):
    """Q4 after dropping partitions older than 30 days at 2024-02-15."""
    table = write_layout(spark, sf_dir, "1d", as_table=True)
    L.drop_older_than(spark, table, "30 days", RETENTION_AS_OF)
    return shape(Q.table_stats(readings(spark, table)), rounded=("avg_power",))


@register("retention_partitions", READINGS_CTE + """
select strftime(time_bucket(interval '1 day', "timestamp"), '%Y-%m-%d-%H') as chunk, 0::bigint as dropped_again
from r where "timestamp" >= timestamp '2024-01-16' group by 1""")
def retention_partitions(spark, sf_dir):
    """Partitions still on disk after retention (the listing, not the
    metastore), and how many a second run drops."""
    table = write_layout(spark, sf_dir, "1d", as_table=True)
    L.drop_older_than(spark, table, "30 days", RETENTION_AS_OF)
    again = L.drop_older_than(spark, table, "30 days", RETENTION_AS_OF)
    return C.partition_catalog(spark, table).select(
        "chunk", F.lit(len(again)).cast("bigint").alias("dropped_again"))


# --- A9 / A19: distinct meters from a rollup ------------------------------------------

@register("distinct_meters_rollup", READINGS_CTE + """
, d as (select time_bucket(interval '1 day', "timestamp") as day, meter_id from r)
select 'day' as span, strftime(day, '%Y-%m-%d') as first_day, count(distinct meter_id) as n_meters from d group by day
union all
select 'week', strftime(date_trunc('week', day), '%Y-%m-%d'), count(distinct meter_id) from d group by date_trunc('week', day)
union all
select 'all', strftime(min(day), '%Y-%m-%d'), count(distinct meter_id) from d""")
def distinct_meters_rollup(spark, sf_dir):
    """Distinct meters of days, weeks and the whole span, merged
    from the daily tier's sets of meters (raw rows are not counted again)."""
    tables = {w: unique_table("energy_readings_rollup") for w in ("1 hour", "1 day")}
    R.build_rollups(readings_of(spark, sf_dir), {t: w for w, t in tables.items()},
                    locations={t: scratch_path(spark, "distinct-rollup") for t in tables.values()})
    sets = R.meter_sets(spark.table(tables["1 day"]))
    week = F.date_format(F.date_trunc("week", F.to_timestamp("day")), "yyyy-MM-dd")
    parts = [R.distinct_meters(sets, F.lit("day"), F.col("day")), R.distinct_meters(sets, F.lit("week"), week)]
    whole = R.distinct_meters(sets).select(F.lit("all").alias("g0"), sets.agg(F.min("day")).scalar().alias("g1"), "n_meters")
    return reduce(DataFrame.unionByName, [*parts, whole]).select(
        F.col("g0").alias("span"), F.col("g1").alias("first_day"), "n_meters")


@register("headline_rollup", SQL_HEADLINE)
def headline_rollup(spark, sf_dir):
    """A19 from the daily tier and its sets of meters."""
    table = unique_table("energy_readings_daily")
    R.build_rollup(readings_of(spark, sf_dir), table, "1 day", location=scratch_path(spark, "headline-rollup"))
    return R.headline_from_rollup(spark.table(table), R.meter_sets(spark.table(table)))


# --- S2 / S3 / S8 / P4 / P5: ingest ---------------------------------------------------

SQL_INGEST = READINGS_CTE + """
select strftime("timestamp", '%Y-%m-%d') as day, count(*) as accepted,
       count(*) filter (voltage <> 225) as with_current, count(energy) as with_energy,
       round(coalesce(sum(power / voltage) filter (voltage <> 225), 0), 9) as sum_current,
       round(sum(energy), 9) as sum_energy,
       (select 3 * count(*) from r where voltage = 230) as rejected
from r group by 1"""


@register("ingest_readings", SQL_INGEST)
def ingest_readings(spark, sf_dir):
    """Append to a table made once, from input without
    current and energy.

    Bad rows are injected: for every reading at 230 V one without a time, one
    without a meter and one whose meter id is too long.  Voltages of 225 are
    set to zero, which leaves the current empty.  Accepted rows are read back
    from the table, rejected ones are counted; creating it again changes nothing.
    """
    raw = readings_of(spark, sf_dir).drop("current", "energy")
    raw = raw.withColumn("voltage", F.when(F.col("voltage") == 225, 0.0).otherwise(F.col("voltage")))
    model = raw.filter("voltage = 230")
    bad = (model.withColumn("timestamp", F.lit(None).cast("timestamp"))
           .unionByName(model.withColumn("meter_id", F.lit(None).cast("string")))
           .unionByName(model.withColumn("meter_id", F.concat("meter_id", F.lit("0")))))
    table, place = unique_table("energy_readings"), scratch_path(spark, "ingest")
    nothing = derive_measures(raw.filter(F.lit(False)))
    write_partitioned(nothing, table, "1 day", mode="ignore", location=place)
    rejected = append_readings(raw.unionByName(bad), table, "1 day").count()
    write_partitioned(derive_measures(raw), table, "1 day", mode="ignore", location=place)
    return (readings(spark, table).groupBy(day_label("timestamp").alias("day"))
            .agg(F.count(F.lit(1)).alias("accepted"), F.count("current").alias("with_current"),
                 F.count("energy").alias("with_energy"),
                 F.round(F.coalesce(F.sum("current"), F.lit(0.0)), 9).alias("sum_current"),
                 F.round(F.sum("energy"), 9).alias("sum_energy"))
            .withColumn("rejected", F.lit(rejected).cast("bigint")))


# --- A6-A8 / L3-L6 / S9 / J5: rollups ------------------------------------------------

def build_tier(spark: SparkSession, raw: DataFrame, tier: str) -> DataFrame:
    width, _ = R.TIERS[tier]
    table = unique_table(f"energy_readings_{tier}")
    R.build_rollup(raw, table, width, location=scratch_path(spark, f"rollup-{tier}"))
    return R.read_rollup(spark, table)


def rollup_output(rollup: DataFrame) -> DataFrame:
    """The reference's rollup columns (means and sums at 9 places)."""
    out = rollup.select("meter_id", "bucket", "avg_power", "max_power", "min_power",
                        "total_energy", "reading_count")
    return shape(out, ("bucket",), ("avg_power", "total_energy"))


def _rollup_sql(width: str, where: str = "", cte: str = READINGS_CTE) -> str:
    return cte + f"""
select meter_id, time_bucket(interval '{width}', "timestamp") as bucket,
       round(avg(power), 9) as avg_power, max(power) as max_power, min(power) as min_power,
       round(sum(energy), 9) as total_energy, count(*) as reading_count
from r {where} group by 1, 2"""


def _register_tier(tier: str) -> None:
    width, _ = R.TIERS[tier]

    def run(spark, sf_dir):
        return rollup_output(build_tier(spark, readings_of(spark, sf_dir), tier))
    run.__doc__ = f"A6 / L3: full build of the {width} rollup, read back."
    register(f"rollup_{tier}", _rollup_sql(width))(run)


for _tier in R.TIERS:
    _register_tier(_tier)


def bucketed_table(spark: SparkSession, sf_dir: str, buckets: int = 8) -> str:
    table = unique_table("energy_readings_by_meter")
    write_bucketed(readings_of(spark, sf_dir), table, buckets, location=scratch_path(spark, "bucketed"))
    return table


@register("bucketed_monthly", SQL_MONTHLY)
def bucketed_monthly(spark, sf_dir):
    """A3 on a table bucketed by meter: grouped without a shuffle."""
    return shape(Q.monthly_per_key(readings(spark, bucketed_table(spark, sf_dir)), 20), ("month",), ("total_energy",))


@register("bucketed_rollup_hourly", _rollup_sql("1 hour"))
def bucketed_rollup_hourly(spark, sf_dir):
    """A6 on a table bucketed by meter: grouped without a shuffle."""
    state = R.rollup_state(readings(spark, bucketed_table(spark, sf_dir)), "1 hour")
    return rollup_output(R.with_avg(state))


@register("rollup_cascade_daily", _rollup_sql("1 day"))
def rollup_cascade_daily(spark, sf_dir):
    """Three tiers built with one raw scan (hourly merged from
    15-minute state, daily from hourly); the daily tier equals one built
    from raw rows."""
    tables = {unique_table(f"energy_readings_{t}"): R.TIERS[t][0] for t in R.TIERS}
    R.build_rollups(readings_of(spark, sf_dir), tables,
                    locations={t: scratch_path(spark, "rollup-cascade") for t in tables})
    daily = [t for t, w in tables.items() if w == "1 day"][0]
    return rollup_output(R.read_rollup(spark, daily))


@register("rollup_point_read", SQL_METER_PROFILE)
def rollup_point_read(spark, sf_dir):
    """The one-meter, one-day question answered from the 15-minute rollup."""
    rollup = build_tier(spark, readings_of(spark, sf_dir), "15min")
    out = R.rollup_point_read(rollup, PROFILE_METER, PROFILE_START, PROFILE_END)
    return shape(out, ("bucket",), ("avg_power",))


@register("rollup_vs_raw", f"""
with answer as ({SQL_METER_PROFILE})
select 0::bigint as only_left, 0::bigint as only_right, count(*) as rows_left, count(*) as rows_right from answer""")
def rollup_vs_raw(spark, sf_dir):
    """Raw and rollup answers of the A5 question compared row by row."""
    raw = readings_of(spark, sf_dir)
    rollup = build_tier(spark, raw, "15min")
    raw_answer = shape(Q.meter_profile(raw, PROFILE_METER, PROFILE_START, PROFILE_END),
                       rounded=("avg_power",))
    rollup_answer = shape(R.rollup_point_read(rollup, PROFILE_METER, PROFILE_START,
                                              PROFILE_END), rounded=("avg_power",))
    return R.rollup_vs_raw(raw_answer, rollup_answer)


SQL_REGION_DAILY = READINGS_CTE + """
, d as (select meter_id, time_bucket(interval '1 day', "timestamp") as bucket,
               avg(power) as avg_power, sum(energy) as total_energy from r group by 1, 2)
select substring(meter_id, 1, 1) as region, bucket as day,
       round(sum(total_energy), 9) as region_energy,
       round(avg(avg_power), 9) as region_avg_power
from d group by 1, 2 order by day, region"""


@register("region_daily", SQL_REGION_DAILY)
def region_daily(spark, sf_dir):
    """Region x day from the daily rollup (mean of meter means)."""
    out = R.region_daily(build_tier(spark, readings_of(spark, sf_dir), "daily"))
    return shape(out, ("day",), ("region_energy", "region_avg_power"))


SQL_REGION_DAILY_W = READINGS_CTE + """
select substring(meter_id, 1, 1) as region, time_bucket(interval '1 day', "timestamp") as day,
       round(sum(energy), 9) as region_energy, round(avg(power), 9) as region_avg_power
from r group by 1, 2 order by day, region"""


@register("region_daily_weighted", SQL_REGION_DAILY_W)
def region_daily_weighted(spark, sf_dir):
    """A7, exact form: mean weighted by readings (sum of sums / sum of counts)."""
    out = R.region_daily(build_tier(spark, readings_of(spark, sf_dir), "daily"), weighted=True)
    return shape(out, ("day",), ("region_energy", "region_avg_power"))


SQL_PEAK_HOURS = READINGS_CTE + """
, h as (select meter_id, time_bucket(interval '1 hour', "timestamp") as bucket,
               avg(power) as avg_power, max(power) as max_power from r group by 1, 2)
select extract(hour from bucket)::int as hour_of_day, round(avg(avg_power), 9) as average_power,
       max(max_power) as peak_power
from h group by 1 order by 1"""


@register("peak_hours", SQL_PEAK_HOURS)
def peak_hours(spark, sf_dir):
    """Hour-of-day profile from the hourly rollup."""
    out = R.peak_hours(build_tier(spark, readings_of(spark, sf_dir), "hourly"))
    return shape(out, rounded=("average_power",))


# --- L4 / L5: incremental refresh ----------------------------------------------------

# Rows of type 'view' from Jan 20 on arrive late, after the first build.
LATE_FROM = "2024-01-20"


def _late_rows(events: DataFrame) -> F.Column:
    return ((events["event_type"] == "view")
            & (events["ts"] >= F.lit(LATE_FROM).cast("timestamp_ntz")))


def _refresh_case(spark: SparkSession, sf_dir: str, tier: str, as_of: str) -> DataFrame:
    """Build a rollup from the on-time rows, append the late batch to the
    raw table, refresh the touched days under the tier's policy."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = readings_from_events(events.filter(_late_rows(events)))
    table = unique_table("energy_readings")
    write_partitioned(readings_from_events(events.filter(~_late_rows(events))), table,
                      "1 day", location=scratch_path(spark, "raw"))
    width, policy = R.TIERS[tier]
    rollup = unique_table(f"energy_readings_{tier}")
    R.build_rollup(readings(spark, table), rollup, width,
                   location=scratch_path(spark, f"rollup-{tier}"))
    write_partitioned(late, table, "1 day", mode="append")
    touched = sorted(r[0] for r in late.select(day_label("timestamp")).distinct().collect())
    R.refresh_rollup(spark, table, rollup, width, "1 day", policy, as_of, touched)
    return rollup_output(R.read_rollup(spark, rollup))


@register("refresh_equals_rebuild", _rollup_sql("1 day"))
def refresh_equals_rebuild(spark, sf_dir):
    """L4: daily rollup built before a late batch, refreshed after it (30-day
    window covers every touched day) equals a full rebuild."""
    return _refresh_case(spark, sf_dir, "daily", "2024-02-01")


SQL_REFRESH_WINDOW = _rollup_sql("15 minutes", """
where not (event_type = 'view' and "timestamp" >= timestamp '2024-01-20')
   or (time_bucket(interval '15 minutes', "timestamp") >= timestamp '2024-01-28'
       and time_bucket(interval '15 minutes', "timestamp") < timestamp '2024-01-30 23:00:00')""",
    cte=readings_cte(", event_type"))


@register("refresh_window_15min", SQL_REFRESH_WINDOW)
def refresh_window_15min(spark, sf_dir):
    """With the 15-minute policy (3 days back, 1 hour gap) at Jan 31 00:00,
    late rows count only in buckets from Jan 28 00:00 to Jan 30 23:00."""
    return _refresh_case(spark, sf_dir, "15min", "2024-01-31")


SQL_ROLLUP_STATUS = READINGS_CTE + "\nunion all\n".join(
    f"""select '{tier}' as rollup, '{w}' as width,
       max(time_bucket(interval '{w}', "timestamp")) + interval '{w}' as materialized_until,
       max("timestamp") as raw_latest,
       (epoch_us(max("timestamp")) - epoch_us(max(time_bucket(interval '{w}', "timestamp"))
         + interval '{w}')) / 1e6 as lag_seconds
from r""" for tier, (w, _) in R.TIERS.items())


@register("rollup_status", SQL_ROLLUP_STATUS)
def rollup_status(spark, sf_dir):
    """How far each rollup reaches against the newest raw row."""
    raw = readings_of(spark, sf_dir)
    tiers = {tier: (build_tier(spark, raw, tier), R.TIERS[tier][0]) for tier in R.TIERS}
    out = R.rollup_status(raw, tiers)
    return shape(out, ("materialized_until", "raw_latest"))
