"""Registered streaming jobs (T1-T4), run to completion with ``availableNow``.

The stream source is a folder of Parquet files under the shared checkpoint
folder into which the readings of ``events`` arrive in two drops: on-time
rows first, the late batch after the first run.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.time import to_utc
from meterlake.operators import lifecycle as L
from meterlake.operators import queries as Q
from meterlake.operators import rollups as R
from meterlake.plans.registry import READINGS_CTE, SQL_TABLE_STATS, readings_of, register, shape
from meterlake.plans.storage import _late_rows, _rollup_sql, rollup_output
from meterlake.session import scratch_path, unique_table
from meterlake.sources.schema import READINGS, readings, readings_from_events
from meterlake.streaming.refresh import (
    create_raw_table, create_rollup_table, stream_refresh, stream_rollup,
)

STREAM_AS_OF = "2024-02-01"


def _run_refresh_stream(spark: SparkSession, source: str, raw: str, rollup: str,
                        checkpoint: str) -> None:
    width, policy = R.TIERS["daily"]
    q = stream_refresh(spark, source, raw, {rollup: (width, policy)}, checkpoint,
                       trigger={"availableNow": True}, as_of=STREAM_AS_OF)
    q.awaitTermination()


def _two_drop_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Feed the on-time rows, then the late batch, through the refresh stream;
    return the raw and daily rollup tables."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = scratch_path(spark, "stream-src")
    raw, rollup = unique_table("energy_readings"), unique_table("energy_readings_daily")
    create_raw_table(spark, raw, scratch_path(spark, "stream-raw"))
    create_rollup_table(spark, rollup, scratch_path(spark, "stream-rollup"))
    checkpoint = scratch_path(spark, "stream-ckpt")
    readings_from_events(events.filter(~_late_rows(events))).write.parquet(source)
    _run_refresh_stream(spark, source, raw, rollup, checkpoint)
    readings_from_events(events.filter(_late_rows(events))).write.mode("append").parquet(source)
    _run_refresh_stream(spark, source, raw, rollup, checkpoint)
    return raw, rollup


@register("stream_refresh_daily", _rollup_sql("1 day", """
where "timestamp" >= timestamp '2024-01-02' and "timestamp" < timestamp '2024-01-31'"""))
def stream_refresh_daily(spark, sf_dir):
    """File stream + foreachBatch refresh of the daily rollup.

    Two runs on one checkpoint: on-time rows, then the late batch (views
    from Jan 20 on).  With the daily policy at 2024-02-01 the window is
    [Jan 2, Jan 31), so Jan 1 and Jan 31 stay outside the rollup.
    """
    _, rollup = _two_drop_stream(spark, sf_dir)
    return rollup_output(R.read_rollup(spark, rollup))


@register("stream_raw_compacted_stats", SQL_TABLE_STATS)
def stream_raw_compacted_stats(spark, sf_dir):
    """L7 on a stream-fed table: both drops' batch partitions of every chunk
    merged into one, then Q4 over the raw table (same answer as the source)."""
    raw, _ = _two_drop_stream(spark, sf_dir)
    L.compact_partitions(spark, raw, "1 day")
    return shape(Q.table_stats(readings(spark, raw)), rounded=("avg_power",))


# The live stream gets the month in drops of this many hours, as they pass:
# less than the shortest correction window (3 days) minus its publish gap.
LIVE_START, LIVE_DROP_HOURS, LIVE_DROPS = "2024-01-01", 60, 12


def _live_sql() -> str:
    tiers = []
    for tier, (width, policy) in R.TIERS.items():
        bucket = f"time_bucket(interval '{width}', \"timestamp\")"
        tiers.append(f"""
select '{tier}' as tier, meter_id, {bucket} as bucket, round(avg(power), 9) as avg_power,
       max(power) as max_power, min(power) as min_power, round(sum(energy), 9) as total_energy,
       count(*) as reading_count
from r where {bucket} + interval '{width}' <= timestamp '2024-01-31' - interval '{policy.end_offset}'
group by all""")
    return READINGS_CTE + "\nunion all\n".join(tiers)


@register("stream_live_tiers", _live_sql())
def stream_live_tiers(spark, sf_dir):
    """T1 / L4 live: all three tiers fed by one stream, in drops of 60 hours
    that arrive as they end.

    Buckets inside a tier's publish gap are held back, stay pending, and come
    out with a later batch: at the end every bucket that ends by the last
    window's end is there.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source, checkpoint = scratch_path(spark, "live-src"), scratch_path(spark, "live-ckpt")
    raw = unique_table("energy_readings")
    create_raw_table(spark, raw, scratch_path(spark, "live-raw"))
    tables = {tier: unique_table(f"energy_readings_{tier}") for tier in R.TIERS}
    for tier, table in tables.items():
        create_rollup_table(spark, table, scratch_path(spark, f"live-{tier}"))
    rollups = {tables[tier]: R.TIERS[tier] for tier in R.TIERS}
    start = to_utc(LIVE_START)
    for _ in range(LIVE_DROPS):
        end = start + timedelta(hours=LIVE_DROP_HOURS)
        now = F.col("timestamp")
        drop = readings_from_events(events).filter((now >= F.lit(start)) & (now < F.lit(end)))
        drop.write.mode("append").parquet(source)
        stream_refresh(spark, source, raw, rollups, checkpoint, trigger={"availableNow": True},
                       as_of=end).awaitTermination()
        start = end
    parts = [rollup_output(R.read_rollup(spark, table)).select(F.lit(tier).alias("tier"), "*")
             for tier, table in tables.items()]
    return reduce(DataFrame.unionByName, parts)


STREAM_WATERMARK = "1 day"


@register("stream_rollup_watermark", _rollup_sql("1 hour", """
where time_bucket(interval '1 hour', "timestamp") + interval '1 hour'
      <= (select max(ts) from events) - interval '1 day'"""))
def stream_rollup_watermark(spark, sf_dir):
    """Watermarked hourly windows in append mode; a window is final
    once the watermark (newest time minus one day) passes its end."""
    source = scratch_path(spark, "wm-src")
    readings_of(spark, sf_dir).write.parquet(source)
    stream = spark.readStream.schema(READINGS).parquet(source)
    out, checkpoint = scratch_path(spark, "wm-out"), scratch_path(spark, "wm-ckpt")
    q = (stream_rollup(stream, "1 hour", STREAM_WATERMARK).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return rollup_output(R.with_avg(spark.read.parquet(out)))
