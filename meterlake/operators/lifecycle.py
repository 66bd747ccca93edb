"""Data lifecycle: age-based compaction, retention and storage reports.

Compaction rewrites whole partitions sorted (time descending by default)
with a stronger codec; it is the Parquet counterpart of turning row chunks
into compressed columnar ones.  The only lists that reach the driver are
partition names and sizes from the file catalogue, never rows.

A run writes each row once, into a folder of its own inside the table's, and
publishes it partition by partition through the catalogue: ``ALTER TABLE ...
PARTITION ... SET LOCATION``.  No file is moved; a reader finds a partition's
old files or its new ones.  Replaced files stay until the next run, so a query
that was planned before the switch still finds them.  One compaction of a
table runs at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.functions.format import human_bytes, savings_pct, sorted_report
from meterlake.functions.time import parse_label, to_utc, width_micros
from meterlake.operators.rollups import TIERS, RefreshPolicy
from meterlake.session import TIME_CONF, session_conf
from meterlake.sources import files
from meterlake.sources.catalog import (
    MERGED_BATCH, REWRITTEN, list_folders, list_partitions, location, partition_spec,
)
from meterlake.sources.layout import Z_ORDER, cluster_by_chunk, cluster_by_z
from meterlake.sources.schema import READING_COLUMNS, is_table, stored_readings

COMPACT_ORDER = ("-timestamp",)
STATE_SCHEMA = ("chunk string, run string, codec string, file_order string, before_bytes bigint, after_bytes bigint, "
                "after_files bigint, finished timestamp")
STATS_SCHEMA = "table string, chunk string, status string, before_bytes bigint, after_bytes bigint"


def _ended(chunk: str, width: str, age: str | None, as_of) -> bool:
    """Whether the partition's whole range ended at least ``age`` before ``as_of``."""
    try:
        start = parse_label(chunk)
    except ValueError:  # rows without a time have no age
        return False
    if age is None:
        return True
    cutoff = to_utc(as_of) - timedelta(microseconds=width_micros(age))
    return start + timedelta(microseconds=width_micros(width)) <= cutoff


def _partition_columns(spark: SparkSession, handle: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(handle) if c.isPartition]


def _state_path(spark: SparkSession, handle: str) -> str:
    """Folder of the statistics of a table's compactions (hidden from its readers)."""
    return location(spark, handle).rstrip("/") + "/_compaction_state"


def _by_chunk(rows: Iterable) -> dict[str, list]:
    out: dict[str, list] = {}
    for r in rows:
        out.setdefault(r["chunk"], []).append(r)
    return out


def _totals(rows: list) -> tuple[int, int]:
    return sum(r["n_files"] for r in rows), sum(r["bytes"] for r in rows)


def _run_of(folder: str) -> str | None:
    """Name of the run that wrote a partition's folder."""
    return folder.split(f"/{REWRITTEN}/", 1)[1].split("/", 1)[0] if f"/{REWRITTEN}/" in folder else None


def compact_partitions(spark: SparkSession, table: str, width: str = "1 day",
                       order_by: tuple[str, ...] = COMPACT_ORDER, codec: str = "zstd",
                       older_than: str | None = None, as_of=None,
                       name: str | None = None, committed_below: int | None = None,
                       row_group_bytes: int | None = None) -> DataFrame:
    """Rewrite eligible partitions sorted by ``order_by`` with ``codec``.

    ``order_by=Z_ORDER`` sorts along a curve through time and meters, for
    tables that are asked by both; ``row_group_bytes`` sets how fine readers
    can skip.

    Returns the statistics of the partitions rewritten now (table, chunk,
    status, before_bytes, after_bytes); ``compaction_stats`` has those of all
    runs.  Partitions that an earlier run left in this order and codec, and
    that have not changed since, are not touched.  A plain folder has no
    catalogue to publish through and is refused.

    A stream-fed table partitioned by (chunk, ingest_batch) has its batch
    partitions of each eligible chunk merged into one (``ingest_batch = -1``),
    whose folder's name says below which batch.  Only batches below
    ``committed_below`` take part; by default the newest batch of the table is
    left out, as it may be replayed.  Batches that arrive meanwhile are other
    partitions and stay.  A partition of another table that changed while it
    was rewritten is left for the next run.

    A run that breaks off leaves each partition old or new; the next one
    rewrites what is still old.  Only where it broke between the two catalogue
    calls of a merged chunk are rows there twice, until ``drop_merged``, with
    which every run begins, has dropped the merged batches.
    """
    if not is_table(table):
        raise ValueError("compaction switches partitions in the catalogue: it needs a table")
    parts = _partition_columns(spark, table)
    if parts not in (["chunk"], ["chunk", "ingest_batch"]):
        raise ValueError(f"cannot compact {table}: partitioned by {parts}")
    batched, file_order = len(parts) == 2, ",".join(order_by)
    drop_merged(spark, table)
    free_replaced(spark, table)
    listing = list_partitions(spark, table)
    if batched and committed_below is None:
        committed_below = max((r["ingest_batch"] for r in listing), default=0)
    found = _by_chunk(r for r in listing if _ended(r["chunk"], width, older_than, as_of)
                      and (not batched or r["ingest_batch"] < committed_below))
    done = {r["chunk"]: r for r in _state(spark, table).filter(
        (F.col("codec") == codec) & (F.col("file_order") == file_order)).collect()}
    chunks = [c for c, rows in sorted(found.items()) if not (c in done and _as_left(rows, done[c]))]
    if not chunks:
        return spark.createDataFrame([], STATS_SCHEMA)
    source = stored_readings(spark, table).filter(F.col("chunk").isin(chunks))
    if batched:
        source = source.filter(F.col("ingest_batch") < committed_below)
    run = f"run-{uuid.uuid4().hex[:12]}"
    root = f"{location(spark, table).rstrip('/')}/{REWRITTEN}/{run}" + (f"/below={committed_below}" if batched else "")
    # Default AQE sizing (not the small-write spread): compaction is about
    # fewer, larger files per partition.
    rows = source.select(*READING_COLUMNS, "chunk")
    rows = cluster_by_z(rows, width) if tuple(order_by) == Z_ORDER else cluster_by_chunk(rows, order_by)
    writer = rows.write.option("compression", codec)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    with session_conf(spark, TIME_CONF):
        writer.partitionBy("chunk").parquet(root)
    n_src, n_written = source.count(), spark.read.schema(source.schema).parquet(root).count()
    if n_src != n_written:  # both counts come from file footers
        raise RuntimeError(f"compaction wrote {n_written} rows for {n_src}; nothing replaced")
    written = {r["chunk"]: r for r in _rewritten(spark, table, run)}
    now = _by_chunk(list_partitions(spark, table))
    kept = [c for c in chunks if batched or _totals(now.get(c, [])) == _totals(found[c])]
    stamp = datetime.now(timezone.utc)
    state = [(c, run, codec, file_order, _totals(found[c])[1], written[c]["bytes"], written[c]["n_files"], stamp) for c in kept]
    if state:  # before the switch: a row counts only while its run's folder is the partition's
        (spark.createDataFrame(state, STATE_SCHEMA).coalesce(1).write
         .parquet(f"{_state_path(spark, table)}/{run}"))
    for c in kept:
        batches = [r["ingest_batch"] for r in found[c]] if batched else [None]
        _switch(spark, table, c, batches, written[c]["folder"])
    return spark.createDataFrame([(name or table, r[0], "Compressed", r[4], r[5]) for r in state], STATS_SCHEMA)


def _rewritten(spark: SparkSession, table: str, run: str) -> list:
    """Files, bytes and folder of what a run wrote, by chunk."""
    return [r for r in list_folders(spark, table) if _run_of(r["folder"]) == run]


def _switch(spark: SparkSession, table: str, chunk: str, batches: list[int | None], folder: str) -> None:
    """Let a partition's rows be those in ``folder``."""
    place = f"'{folder}'"
    if batches == [None]:
        spark.sql(f"ALTER TABLE {table} {partition_spec(chunk)} SET LOCATION {place}")
        return
    merged = partition_spec(chunk, MERGED_BATCH)
    if MERGED_BATCH in batches:
        spark.sql(f"ALTER TABLE {table} {merged} SET LOCATION {place}")
    else:
        spark.sql(f"ALTER TABLE {table} ADD {merged} LOCATION {place}")
    _drop_batches(spark, table, chunk, batches)


def _drop_batches(spark: SparkSession, table: str, chunk: str, batches: Iterable[int]) -> None:
    gone = [partition_spec(chunk, b) for b in batches if b != MERGED_BATCH]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")


def drop_merged(spark: SparkSession, table: str) -> None:
    """Drop batch partitions whose rows the chunk's merged partition holds: a run broke off before it did."""
    for chunk, rows in _by_chunk(list_partitions(spark, table)).items():
        below = [int(r["folder"].split("/below=", 1)[1].split("/", 1)[0]) for r in rows
                 if r["ingest_batch"] == MERGED_BATCH and "/below=" in r["folder"]]
        if below:
            _drop_batches(spark, table, chunk, [r["ingest_batch"] for r in rows if r["ingest_batch"] < below[0]])


def free_replaced(spark: SparkSession, table: str) -> list[str]:
    """Delete folders of rewritten chunks that the catalogue does not name:
    replaced and merged partitions, runs that broke off.  Returns them.

    Every compaction begins with it.  A query planned before the last switch
    may still read them, so run it alone only when none is under way.
    """
    used = {r["folder"] for r in list_partitions(spark, table)}
    folders = list_folders(spark, table)
    rewritten = {r["chunk"] for r in folders if _run_of(r["folder"])}
    gone = [r["folder"] for r in folders if r["chunk"] in rewritten and r["folder"] not in used]
    for folder in gone:
        files.delete(spark, folder)
    return gone


def _state(spark: SparkSession, table: str) -> DataFrame:
    """The newest statistics row of every chunk (one small file per run)."""
    home = _state_path(spark, table)
    runs = [f"{home}/{r}" for r in files.children(spark, home)]
    if not runs:
        return spark.createDataFrame([], STATE_SCHEMA)
    newest = Window.partitionBy("chunk").orderBy(F.col("finished").desc())
    return (spark.read.schema(STATE_SCHEMA).parquet(*runs).withColumn("n", F.row_number().over(newest))
            .filter("n = 1").drop("n"))


def _as_left(rows: list, state) -> bool:
    """Whether a partition is what its last run left: that run's folder, no file more."""
    return len(rows) == 1 and _run_of(rows[0]["folder"]) == state["run"] and \
        _totals(rows) == (state["after_files"], state["after_bytes"])


def compaction_stats(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Stored statistics of ``{name: table}``: table, chunk, status, bytes before and after.

    A partition counts as compressed while its files are those that its last
    run left; one that has received rows since has no row here.
    """
    rows = []
    for name, table in tables.items():
        now = _by_chunk(list_partitions(spark, table))
        rows += [(name, r["chunk"], "Compressed", r["before_bytes"], r["after_bytes"])
                 for r in _state(spark, table).collect() if _as_left(now.get(r["chunk"], []), r)]
    return spark.createDataFrame(rows, STATS_SCHEMA)


def compression_report(catalog: DataFrame, stats: DataFrame) -> DataFrame:
    """Per table and status: partitions, bytes before/after, savings %.

    ``catalog`` may hold several tables (``union_catalogs``); statistics join
    on (table, chunk), and every partition of the catalogue appears: one
    without statistics (never compacted) counts as Uncompressed at its
    current size.  Savings use the NULLIF rule: NULL when before is 0.
    """
    joined = catalog.join(stats, ["table", "chunk"], "left").select(
        "table", F.coalesce("status", F.lit("Uncompressed")).alias("compression_status"),
        F.coalesce("before_bytes", "bytes").alias("before_bytes"),
        F.coalesce("after_bytes", "bytes").alias("after_bytes"))
    out = (joined.groupBy("table", "compression_status")
           .agg(F.count(F.lit(1)).alias("chunk_count"),
                F.sum("before_bytes").alias("before_bytes"),
                F.sum("after_bytes").alias("after_bytes"))
           .withColumn("before_size", human_bytes("before_bytes"))
           .withColumn("after_size", human_bytes("after_bytes"))
           .withColumn("savings_pct", savings_pct("before_bytes", "after_bytes", on_zero=None)))
    return sorted_report(out, "table", "compression_status")


def compression_detail(catalog: DataFrame, stats: DataFrame) -> DataFrame:
    """Per compacted partition: sizes and savings % (0 when before is 0)."""
    out = (catalog.select("table", "chunk", "range_start")
           .join(stats, ["table", "chunk"])
           .select("table", "chunk", "status",
                   human_bytes("before_bytes").alias("before_size"),
                   human_bytes("after_bytes").alias("after_size"),
                   savings_pct("before_bytes", "after_bytes", on_zero=0.0).alias("savings_pct"),
                   "range_start"))
    return out.orderBy("table", "range_start").drop("range_start")


def drop_older_than(spark: SparkSession, table: str, retention: str, as_of, width: str = "1 day",
                    policies: Iterable[RefreshPolicy] | None = None) -> list[str]:
    """Drop raw partitions whose range ended ``retention`` before ``as_of``, and their files.

    Refuses a retention shorter than the longest correction horizon of the
    refresh ``policies`` in use (the standard tiers' by default): refreshing a
    window whose raw rows are gone would erase rollup rows.  On an external
    table the catalogue forgets a partition without its files, so they are
    deleted here; metastore, listing and disk agree afterwards.
    """
    used = [p for _, p in TIERS.values()] if policies is None else list(policies)
    floor = max((p.start_offset for p in used), key=width_micros, default=None)
    if floor is not None and width_micros(retention) < width_micros(floor):
        raise ValueError(f"retention {retention} is shorter than the refresh horizon {floor}")
    if not is_table(table):
        raise ValueError("retention drops partitions of a table")
    expired = _by_chunk(r for r in list_partitions(spark, table) if _ended(r["chunk"], width, retention, as_of))
    if not expired:
        return []
    specs = ", ".join(partition_spec(c, r["ingest_batch"]) for c, rows in expired.items() for r in rows)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    for r in list_folders(spark, table):  # what the catalogue leaves: an external table's files, replaced ones
        if r["chunk"] in expired:
            files.delete(spark, r["folder"])
    spark.catalog.refreshTable(table)
    return sorted(expired)
