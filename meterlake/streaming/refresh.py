"""Structured Streaming jobs for the rollups.

``stream_refresh`` (main path) is the scheduled refresh: each micro-batch
appends its rows to the raw table and refreshes the ranges that are pending
(touched by this or an earlier batch) inside each rollup's window, finest tier
first.  Raw rows land in partition ``(chunk, ingest_batch)`` with dynamic overwrite, so replaying a batch id rewrites that batch's
partition instead of duplicating it, and the refresh itself is idempotent.
Two late-data horizons (publish gap and correction window) stay exact,
which a single watermark cannot express.

``stream_rollup`` is the low-latency variant with engine-managed state: a
watermark plus tumbling windows; rows later than the watermark are dropped.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.functions.time import BUCKET_ORIGIN, day_label, to_utc, width_micros
from meterlake.operators.rollups import ROLLUP_COLUMNS, Finer, refresh_rollup, refresh_window
from meterlake.session import write_conf
from meterlake.sources.catalog import location
from meterlake.sources.layout import cluster_by_chunk, with_chunk
from meterlake.sources.schema import READINGS, derive_measures, split_valid
from meterlake.streaming import pending as P
from meterlake.streaming.pending import Rollups

RAW_DDL = ("`timestamp` TIMESTAMP, meter_id STRING, power DOUBLE, voltage DOUBLE, "
           "current DOUBLE, frequency DOUBLE, energy DOUBLE, chunk STRING, ingest_batch BIGINT")
ROLLUP_DDL = ("meter_id STRING, bucket TIMESTAMP, sum_power DOUBLE, power_count BIGINT, "
              "max_power DOUBLE, min_power DOUBLE, total_energy DOUBLE, "
              "reading_count BIGINT, day STRING")


def create_raw_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Raw table fed by a stream: partitioned by (chunk, ingest_batch)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({RAW_DDL}) USING parquet "
              f"PARTITIONED BY (chunk, ingest_batch){loc}")


def create_rollup_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ROLLUP_DDL}) USING parquet "
              f"PARTITIONED BY (day){loc}")


def pending_path(spark: SparkSession, raw_table: str) -> str:
    """Folder of the pending days of a raw table's rollups, beside the table."""
    return location(spark, raw_table).rstrip("/") + "__pending"


def rejects_path(spark: SparkSession, raw_table: str) -> str:
    """Folder of the rows refused at ingest, beside the table."""
    return location(spark, raw_table).rstrip("/") + "__rejected"


def ingest_batch(spark: SparkSession, batch: DataFrame, batch_id: int, raw_table: str,
                 rollups: Rollups, raw_width: str = "1 day", as_of=None, minutes: float = 5.0,
                 pending: str | None = None, rejects: str | None = None) -> list[str]:
    """One micro-batch: idempotent raw append, then refresh of pending days.

    Returns the days that were refreshed in some rollup.  ``rollups`` maps a
    rollup table to ``(width, policy)`` and may be empty; ``as_of`` defaults
    to the current time.  Rows that break a constraint are written to
    ``rejects`` (by batch id), ranges that the refresh window does not reach
    yet stay in ``pending``; both default to folders beside the table.
    """
    now = to_utc(as_of) if as_of is not None else datetime.now(timezone.utc)
    good, bad = split_valid(batch)
    rejects = rejects or rejects_path(spark, raw_table)
    if not bad.isEmpty():  # a stream without bad rows leaves no files
        bad.write.mode("overwrite").parquet(f"{rejects}/ingest_batch={batch_id}")
    rows = (with_chunk(derive_measures(good, minutes), raw_width)
            .withColumn("ingest_batch", F.lit(batch_id).cast("bigint")))
    cols = [f.name for f in READINGS.fields] + ["chunk", "ingest_batch"]
    with write_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        cluster_by_chunk(rows).select(*cols).write.insertInto(raw_table, overwrite=True)
    if not rollups:
        return []
    pending = pending or pending_path(spark, raw_table)
    state = P.add_touched(P.read_pending(spark, pending, before=batch_id), P.touched_ranges(good), rollups).persist()
    try:
        return _refresh_pending(spark, raw_table, rollups, raw_width, now, pending, state, batch_id)
    finally:
        state.unpersist()


def refresh_pending(spark: SparkSession, raw_table: str, rollups: Rollups, as_of=None,
                    raw_width: str = "1 day", pending: str | None = None) -> list[str]:
    """Refresh without a batch: publish what the windows have reached since.

    For times without new rows; run it while the stream is idle.  A rollup
    given with policy None gets all its pending days, also those that its
    window missed, and has none pending afterwards.
    """
    now = to_utc(as_of) if as_of is not None else datetime.now(timezone.utc)
    pending = pending or pending_path(spark, raw_table)
    done = _refresh_pending(spark, raw_table, rollups, raw_width, now, pending, P.read_pending(spark, pending), None)
    whole = [name for name, (_, policy) in rollups.items() if policy is None]
    if whole:
        P.drop_published(spark, pending, whole)
    return done


def _refresh_pending(spark: SparkSession, raw_table: str, rollups: Rollups, raw_width: str, now: datetime,
                     pending: str, state: DataFrame, batch_id: int | None) -> list[str]:
    """Refresh the pending ranges in each window, finest tier first.

    A coarser tier is merged from the one refreshed before it where that
    tier's window has its buckets, so raw rows are read once, in the touched
    ranges only.  This holds as long as each rollup has the state of all raw
    rows inside its window: build a tier in full before adding it to a stream.
    """
    days: set[str] = set()
    finer = None
    for name, (width, policy) in sorted(rollups.items(), key=lambda r: width_micros(r[1][0])):
        touched = P.ranges_in_window(state, name, width, policy, now)
        days.update(refresh_rollup(spark, raw_table, name, width, raw_width, policy, now, touched=touched, finer=finer))
        finer = Finer(name, width, refresh_window(policy, now, width) if policy else None)
    if batch_id is not None:  # without a batch the next one finds the same ranges, and refreshes them again
        P.write_pending(spark, pending, batch_id, P.still_pending(state, rollups, now))
    return sorted(days)


def stream_refresh(spark: SparkSession, source: str, raw_table: str,
                   rollups: Rollups, checkpoint: str,
                   trigger: dict | None = None, raw_width: str = "1 day", as_of=None,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the refresh stream over Parquet files arriving in ``source``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "15 minutes"}``; ``{"availableNow": True}`` in tests).
    The checkpoint must live in the shared checkpoint folder.
    """
    reader = spark.readStream.schema(READINGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch belongs to the stream's own (cloned) session: write
        # settings must be made on that session to reach its writes.
        batch.persist()
        try:
            ingest_batch(batch.sparkSession, batch, batch_id, raw_table, rollups,
                         raw_width, as_of)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "15 minutes"}))
    return writer.start()


def stream_rollup(stream: DataFrame, width: str, watermark: str,
                  time_col: str = "timestamp", key_col: str = "meter_id") -> DataFrame:
    """Watermarked tumbling-window rollup of a readings stream (append mode).

    A window is emitted once the watermark passes its end; rows older than
    the watermark are dropped by the engine.  Week windows start on Monday
    like ``time_bucket``.
    """
    w = width_micros(width)
    offset = (int((BUCKET_ORIGIN - datetime(1970, 1, 1, tzinfo=timezone.utc))
                  .total_seconds() * 1_000_000)) % w
    window = F.window(F.col(time_col), f"{w} microseconds",
                      startTime=f"{offset} microseconds" if offset else None)
    return (stream.withWatermark(time_col, watermark)
            .groupBy(F.col(key_col).alias("meter_id"), window.alias("w"))
            .agg(F.sum("power").alias("sum_power"),
                 F.count("power").alias("power_count"),
                 F.max("power").alias("max_power"),
                 F.min("power").alias("min_power"),
                 F.sum("energy").alias("total_energy"),
                 F.count(F.lit(1)).alias("reading_count"))
            .select("meter_id", F.col("w.start").alias("bucket"), *ROLLUP_COLUMNS[2:8],
                    day_label(F.col("w.start")).alias("day")))
