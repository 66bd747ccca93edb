"""Compaction, size reports and retention."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterlake.operators import lifecycle as L
from meterlake.operators import queries as Q
from meterlake.session import scratch_path, unique_table
from meterlake.sources import catalog as C
from meterlake.sources.layout import write_partitioned
from meterlake.sources.schema import events_readings, readings
from conftest import SF_MID, SF_SMALL


def _layout(spark, width="1 day"):
    table = unique_table("t_life")
    write_partitioned(events_readings(spark, SF_MID), table, width,
                      location=scratch_path(spark, "t-life"))
    return table


def _answers(spark, table):
    df = readings(spark, table)
    r9 = lambda rows: [tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                       for r in rows]
    return (r9(Q.hourly_avg(df, "2024-01-30").collect()),
            r9(Q.peak_periods(df, "2024-01-23").collect()),
            r9(Q.monthly_per_key(df).collect()), r9(Q.table_stats(df).collect()))


def test_compaction_keeps_answers_and_reports(spark):
    table = _layout(spark)
    before = _answers(spark, table)
    stats = L.compact_partitions(spark, table, "1 day", older_than="24 hours",
                                 as_of="2024-01-31", name="energy_readings")
    # the cutoff is Jan 30 00:00: Jan 29 (ending then) is the last eligible day
    assert stats.count() == 29
    assert _answers(spark, table) == before
    report = L.compression_report(C.partition_catalog(spark, table, "1 day",
                                                      "energy_readings"), stats).collect()
    assert [(r.compression_status, r.chunk_count) for r in report] == \
        [("Compressed", 29), ("Uncompressed", 1)]
    # each file is now sorted by time, newest first
    day = readings(spark, table, with_chunk=True).filter(F.col("chunk") == "2024-01-15-00")
    rows = day.select(F.input_file_name().alias("f"), "timestamp").collect()
    for f in {r.f for r in rows}:
        times = [r.timestamp for r in rows if r.f == f]
        assert times == sorted(times, reverse=True)


def test_age_limit_leaves_recent_partitions(spark):
    table = _layout(spark)
    stats = L.compact_partitions(spark, table, "1 day", older_than="48 hours",
                                 as_of="2024-01-31")
    assert stats.count() == 28
    report = {r.compression_status: r.chunk_count for r in L.compression_report(
        C.partition_catalog(spark, table, "1 day"), stats).collect()}
    assert report == {"Compressed": 28, "Uncompressed": 2}


def test_zero_byte_rules(spark):
    catalog = spark.createDataFrame([("t", "a", 0), ("t", "b", 0)],
                                    "table string, chunk string, bytes long")
    stats = spark.createDataFrame([("t", "a", "Compressed", 0, 0)],
                                  "table string, chunk string, status string, "
                                  "before_bytes long, after_bytes long")
    totals = {r.compression_status: r.savings_pct
              for r in L.compression_report(catalog, stats).collect()}
    assert totals == {"Compressed": None, "Uncompressed": None}
    cat = catalog.withColumn("range_start", F.current_timestamp())
    assert L.compression_detail(cat, stats).first().savings_pct == 0.0


def test_retention_drops_old_partitions(spark):
    table = _layout(spark)
    with pytest.raises(ValueError):
        L.drop_older_than(spark, table, "7 days", "2024-02-15")
    dropped = L.drop_older_than(spark, table, "30 days", "2024-02-15")
    assert dropped[0] == "2024-01-01-00" and dropped[-1] == "2024-01-15-00"
    left = readings(spark, table).agg(F.min("timestamp")).first()[0]
    assert left.isoformat() >= "2024-01-16"


def test_table_sizes_listing_only(spark):
    tables = {"a": (_layout(spark), "1 day"), "b": (_layout(spark, "1 week"), "1 week")}
    sizes = {r.table: r.n_partitions for r in C.table_sizes(spark, tables).collect()}
    assert sizes == {"a": 30, "b": 5}
    listing = C.list_files(spark, tables["a"][0])
    assert "ReadSchema: struct<path:string,length:bigint>" in \
        listing._jdf.queryExecution().executedPlan().toString()


def test_report_over_several_tables_joins_on_table_and_chunk(spark):
    """Chunk labels repeat across layouts (1 day and 1 week share Jan 4):
    statistics must attach to their own table only."""
    tables = {"day": (_layout(spark, "1 day"), "1 day"), "week": (_layout(spark, "1 week"), "1 week")}
    stats = L.compact_partitions(spark, tables["day"][0], "1 day", name="day")
    report = {(r.table, r.compression_status): r.chunk_count for r in L.compression_report(
        C.union_catalogs(spark, tables), stats).collect()}
    assert report == {("day", "Compressed"): 30, ("week", "Uncompressed"): 5}


# --- compaction under failures ------------------------------------------------------

def _rows(spark, handle):
    return sorted(map(str, readings(spark, handle).collect()))


def _in_time_order(spark, handle):
    rows = readings(spark, handle, with_chunk=True).select(F.input_file_name().alias("f"), "timestamp").collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append(r.timestamp)
    return all(t == sorted(t, reverse=True) for t in by_file.values())


def _stream_table(spark, batches=3):
    """A stream-fed table: every day has rows in each of the batches but the last."""
    from meterlake.streaming.refresh import create_raw_table, ingest_batch
    table = unique_table("t_batches")
    create_raw_table(spark, table, scratch_path(spark, "t-batches"))
    rows = events_readings(spark, SF_SMALL)
    for b in range(batches):
        ingest_batch(spark, rows.filter(F.pmod(F.xxhash64("timestamp"), F.lit(batches)) == b), b, table, {}, as_of="2024-02-01")
    return table


@pytest.mark.parametrize("fail_at", [1, 2, 5])
@pytest.mark.parametrize("batched", [False, True])
def test_broken_run_leaves_every_partition_old_or_new(spark, monkeypatch, fail_at, batched):
    table = _stream_table(spark) if batched else _layout(spark, "1 week")
    before = _rows(spark, table)
    total = len({r["chunk"] for r in C.list_partitions(spark, table)})
    switch, calls = L._switch, []

    def broken(*args):
        calls.append(args)
        if len(calls) == fail_at:
            raise OSError("metastore is gone")
        switch(*args)
    monkeypatch.setattr(L, "_switch", broken)
    with pytest.raises(OSError):
        L.compact_partitions(spark, table)
    monkeypatch.setattr(L, "_switch", switch)
    assert _rows(spark, table) == before
    assert L.compaction_stats(spark, {"t": table}).count() == (0 if batched else fail_at - 1)
    left = L.compact_partitions(spark, table).count()
    assert left == total - (fail_at - 1)  # what was switched stays as it was left
    assert _rows(spark, table) == before and L.compact_partitions(spark, table).count() == 0


def test_broken_between_the_two_calls_of_a_merged_chunk(spark, monkeypatch):
    table = _stream_table(spark)
    before = _rows(spark, table)
    drop = L._drop_batches
    monkeypatch.setattr(L, "_drop_batches", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        L.compact_partitions(spark, table)
    monkeypatch.setattr(L, "_drop_batches", drop)
    assert len(_rows(spark, table)) > len(before)  # one chunk's merged batches are there twice
    L.drop_merged(spark, table)
    assert _rows(spark, table) == before
    L.compact_partitions(spark, table)
    assert _rows(spark, table) == before


def test_readers_planned_before_the_switch_still_read(spark):
    table = _layout(spark, "1 week")
    n = readings(spark, table).count()
    old = readings(spark, table).select("timestamp", "meter_id")
    old._jdf.queryExecution().executedPlan()  # planned: its partitions are looked up
    L.compact_partitions(spark, table, "1 week")
    assert old.count() == n
    folders = {r["folder"] for r in C.list_folders(spark, table)}
    used = {r["folder"] for r in C.list_partitions(spark, table)}
    assert len(folders) == 10 and len(used) == 5 and all("/_compacted/" in f for f in used)
    assert set(L.free_replaced(spark, table)) == folders - used
    assert readings(spark, table).count() == n and L.free_replaced(spark, table) == []


def test_no_file_is_moved_and_only_the_catalogue_changes(spark):
    from meterlake.sources import files
    assert not hasattr(files, "move")
    table = _layout(spark, "1 week")
    old = {(r.path, r.length) for r in C.list_files(spark, table).collect()}
    L.compact_partitions(spark, table, "1 week")
    now = {(r.path, r.length) for r in C.list_files(spark, table).collect()}
    assert old < now and len({C.partition_folder(spark, table, C.partition_spec(r["chunk"]))
                              for r in C.list_partitions(spark, table)}) == 5


def test_folder_of_a_broken_run_is_dropped(spark):
    table = _layout(spark, "1 week")
    before = _rows(spark, table)
    stray = f"{C.location(spark, table)}/{C.REWRITTEN}/run-unfinished/chunk=2024-01-04-00"
    readings(spark, table).limit(5).write.parquet(stray)
    assert _rows(spark, table) == before and len(C.list_partitions(spark, table)) == 5
    assert len(L.free_replaced(spark, table)) == 1 and _rows(spark, table) == before


def test_folders_are_refused(spark):
    with pytest.raises(ValueError):
        L.compact_partitions(spark, scratch_path(spark, "no-table"))


def test_managed_table_is_compacted_and_dropped_whole(spark):
    from meterlake.sources import files
    table = unique_table("t_managed")
    write_partitioned(events_readings(spark, SF_SMALL), table, "1 week")
    root, before = C.location(spark, table), _rows(spark, table)
    assert L.compact_partitions(spark, table, "1 week").count() == 5 and _rows(spark, table) == before
    extra = events_readings(spark, SF_SMALL).filter("timestamp < '2024-01-02'")
    write_partitioned(extra, table, "1 week", mode="append")  # lands in the partition's new folder
    assert readings(spark, table).count() == len(before) + extra.count()
    assert L.compact_partitions(spark, table, "1 week").count() == 1
    spark.sql(f"DROP TABLE {table}")
    assert not files.exists(spark, root)


def test_partition_that_changed_meanwhile_is_left(spark, monkeypatch):
    table = _layout(spark, "1 week")
    extra = events_readings(spark, SF_SMALL).filter("timestamp >= '2024-01-12' and timestamp < '2024-01-14'")
    rewritten = L._rewritten

    def late(*args):
        write_partitioned(extra, table, "1 week", mode="append")
        return rewritten(*args)
    monkeypatch.setattr(L, "_rewritten", late)
    n = readings(spark, table).count()
    assert L.compact_partitions(spark, table, "1 week").count() == 4
    monkeypatch.setattr(L, "_rewritten", rewritten)
    assert readings(spark, table).count() == n + extra.count()
    assert L.compact_partitions(spark, table, "1 week").count() == 1
    assert readings(spark, table).count() == n + extra.count()


def test_state_is_kept_and_nothing_is_rewritten_twice(spark):
    tables = {"day": _layout(spark, "1 day"), "week": _layout(spark, "1 week")}
    widths = {"day": "1 day", "week": "1 week"}
    for name, t in tables.items():
        L.compact_partitions(spark, t, widths[name], older_than="24 hours", as_of="2024-01-31")
        assert L.compact_partitions(spark, t, widths[name], older_than="24 hours", as_of="2024-01-31").count() == 0
    stats = L.compaction_stats(spark.newSession(), tables)
    assert {(r.table, r.n) for r in stats.groupBy("table").agg(F.count("*").alias("n")).collect()} == {("day", 29), ("week", 4)}
    again = L.compact_partitions(spark, tables["week"], "1 week", codec="snappy")
    assert again.count() == 5
    write_partitioned(events_readings(spark, SF_SMALL).filter("timestamp < '2024-01-02'"), tables["day"], "1 day", mode="append")
    assert L.compaction_stats(spark, {"day": tables["day"]}).count() == 28


def test_several_files_per_partition_stay_in_order(spark):
    table = unique_table("t_files")
    write_partitioned(events_readings(spark, SF_MID), table, "1 week", num_files=12, location=scratch_path(spark, "t-files"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        L.compact_partitions(spark, table, "1 week")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["n_files"] for r in C.list_partitions(spark, table)) > 5
    assert _in_time_order(spark, table)


def test_retention_frees_the_space(spark):
    external = _layout(spark)
    managed = unique_table("t_managed")
    write_partitioned(events_readings(spark, SF_SMALL), managed, "1 day")
    for table in (external, managed):
        assert len(L.drop_older_than(spark, table, "30 days", "2024-02-15")) == 15
        assert len(C.list_partitions(spark, table)) == 15 == len(spark.sql(f"SHOW PARTITIONS {table}").collect())
        assert L.drop_older_than(spark, table, "30 days", "2024-02-15") == []
    from meterlake.operators.rollups import RefreshPolicy
    with pytest.raises(ValueError):
        L.drop_older_than(spark, external, "30 days", "2024-02-20", policies=[RefreshPolicy("60 days", "1 day")])
    assert L.drop_older_than(spark, external, "7 days", "2024-01-25", policies=[RefreshPolicy("3 days", "1 hour")])


def test_listing_takes_few_tasks(spark):
    table = _layout(spark, "3 hours")
    with_conf = C.session_conf(spark, {**C.LISTING_CONF})
    with with_conf:
        assert C.list_files(spark, table).rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert len(C.list_partitions(spark, table)) == 240


def test_tables_equal_counts_what_differs(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "k int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "z")], "k int, s string")
    assert tuple(Q.tables_equal(a, b).first()) == (2, 2, 4, 4)
    assert tuple(Q.tables_equal(a, a.repartition(3)).first()) == (0, 0, 4, 4)
    assert tuple(Q.tables_equal(a.limit(0), a.limit(0)).first()) == (0, 0, 0, 0)
    assert tuple(Q.tables_equal(a, a.limit(0)).first()) == (4, 0, 4, 0)


@pytest.mark.parametrize("left, right, columns", [
    (("m", None, 230.0), ("m", 230.0, None), "meter_id string, power double, voltage double"),
    ((1, (None, 2)), (1, (2, None)), "k int, s struct<a:int,b:int>"),
    ((1, [None, 2]), (1, [2, None]), "k int, s array<int>"),
])
def test_tables_equal_sees_which_column_is_null(spark, left, right, columns):
    a, b = (spark.createDataFrame([row, row], columns) for row in (left, right))
    assert tuple(Q.tables_equal(a, b).first()) == (2, 2, 2, 2)
    assert tuple(Q.tables_equal(a, a.repartition(3)).first()) == (0, 0, 2, 2)


def test_shared_folder_is_needed_off_local(monkeypatch):
    from meterlake import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def _row_groups(spark, table, column, low, high):
    """Row groups whose range of a column meets [low, high], and all of them."""
    import pyarrow.parquet as pq
    from urllib.parse import unquote, urlparse
    hit = total = 0
    for f in spark.table(table).inputFiles():
        meta = pq.ParquetFile(unquote(urlparse(f).path)).metadata
        k = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(k).statistics
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit, total


def test_z_order_serves_time_and_meter(spark):
    """One week-wide table, compacted three ways: row groups that a reader of
    one meter, and of six hours, cannot skip."""
    from datetime import datetime
    from meterlake.sources.layout import Z_ORDER
    rows = spark.range(120_000).select(
        F.timestamp_micros(F.lit(1704326400000000) + F.pmod(F.xxhash64("id"), F.lit(7 * 86400)) * 1000000).alias("timestamp"),
        F.lpad((F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500))).cast("string"), 10, "0").alias("meter_id"),
        *(F.rand(3).alias(c) for c in ("power", "voltage", "current", "frequency", "energy")))
    hits, answers = {}, set()
    for name, order in (("time", L.COMPACT_ORDER), ("meter", ("meter_id", "-timestamp")), ("z", Z_ORDER)):
        table = unique_table("t_z")
        write_partitioned(rows, table, "1 week", location=scratch_path(spark, "t-z"))
        assert L.compact_partitions(spark, table, "1 week", order_by=order, row_group_bytes=40_000).count() == 1
        one, total = _row_groups(spark, table, "meter_id", "0000000250", "0000000250")
        hours, _ = _row_groups(spark, table, "timestamp", datetime(2024, 1, 6).astimezone(), datetime(2024, 1, 6, 6).astimezone())
        hits[name] = one / total, hours / total
        assert total > 40
        df = readings(spark, table)
        answers.add((df.filter("meter_id = '0000000250'").count(), df.filter("timestamp < '2024-01-06'").count(), df.count()))
        assert L.compact_partitions(spark, table, "1 week", order_by=order).count() == 0
    assert len(answers) == 1
    assert hits["time"][0] > 0.9 and hits["meter"][1] > 0.9  # each order serves one question only
    assert hits["z"][0] < 0.3 and hits["z"][1] < 0.3


def test_z_order_of_odd_ids(spark, make_readings):
    from meterlake.sources.layout import Z_ORDER
    table = unique_table("t_odd_z")
    rows = make_readings([("2024-01-01 00:00:00", m, 1.0) for m in ("A", "9999999999", "é", "", "-4", "0000000001")])
    write_partitioned(rows, table, "1 day", location=scratch_path(spark, "t-odd-z"))
    before = _rows(spark, table)
    assert L.compact_partitions(spark, table, order_by=Z_ORDER).count() == 1 and _rows(spark, table) == before
