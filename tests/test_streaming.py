"""Streaming: refresh stream reruns, replayed batches, watermark drops."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from meterlake.operators import rollups as R
from meterlake.session import scratch_path, unique_table
from meterlake.sources.schema import READINGS
from meterlake.streaming.refresh import (
    create_raw_table, create_rollup_table, ingest_batch, stream_refresh, stream_rollup,
)
from conftest import ts


def _grid(start, n, power, step_min=60, meter="1000000001"):
    t0 = ts(start)
    return [((t0 + timedelta(minutes=step_min * i)).isoformat(sep=" "), meter, power)
            for i in range(n)]


def _tables(spark):
    raw, rollup = unique_table("s_raw"), unique_table("s_rollup")
    create_raw_table(spark, raw, scratch_path(spark, "s-raw"))
    create_rollup_table(spark, rollup, scratch_path(spark, "s-rollup"))
    return raw, rollup


def test_replayed_batch_does_not_duplicate(spark, make_readings):
    raw, rollup = _tables(spark)
    tiers = {rollup: ("1 hour", R.TIERS["hourly"][1])}
    as_of = "2024-01-05 00:00:00"
    b0 = make_readings(_grid("2024-01-01 00:00:00", 96, 10.0))
    b1 = make_readings(_grid("2024-01-03 00:30:00", 10, 30.0))
    ingest_batch(spark, b0, 0, raw, tiers, as_of=as_of)
    ingest_batch(spark, b1, 1, raw, tiers, as_of=as_of)
    first = sorted(spark.table(rollup).collect())
    ingest_batch(spark, b1, 1, raw, tiers, as_of=as_of)   # replay after a crash
    assert spark.table(raw).count() == 106
    assert sorted(spark.table(rollup).collect()) == first
    hour = spark.table(rollup).filter(F.col("bucket") == ts("2024-01-03 00:00:00")).first()
    assert hour.reading_count == 2 and hour.max_power == 30.0


def test_stream_two_runs_same_checkpoint(spark, make_readings):
    raw, rollup = _tables(spark)
    source, ckpt = scratch_path(spark, "s-src"), scratch_path(spark, "s-ckpt")
    tiers = {rollup: ("1 day", None)}
    make_readings(_grid("2024-01-01 00:00:00", 48, 10.0)).write.parquet(source)
    for _ in range(2):   # second run finds nothing new
        stream_refresh(spark, source, raw, tiers, ckpt, {"availableNow": True}).awaitTermination()
    make_readings(_grid("2024-01-02 12:30:00", 4, 20.0)).write.mode("append").parquet(source)
    stream_refresh(spark, source, raw, tiers, ckpt, {"availableNow": True}).awaitTermination()
    assert spark.table(raw).count() == 52
    got = {r.day: (r.reading_count, r.sum_power) for r in spark.table(rollup).collect()}
    assert got == {"2024-01-01": (24, 240.0), "2024-01-02": (28, 320.0)}


def test_watermark_drops_rows_later_than_it(spark, make_readings):
    source = scratch_path(spark, "w-src")
    out, ckpt = scratch_path(spark, "w-out"), scratch_path(spark, "w-ckpt")
    make_readings(_grid("2024-01-01 00:00:00", 48, 10.0)).write.parquet(source)

    def run():
        stream = spark.readStream.schema(READINGS).parquet(source)
        (stream_rollup(stream, "1 hour", "2 hours").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True).start().awaitTermination())

    run()
    emitted = spark.read.parquet(out).count()
    assert emitted == 45          # newest 23:00, watermark 21:00: windows ending <= 21:00
    # a row for Jan 1 01:10 is far behind the watermark: dropped; a row at
    # Jan 3 06:00 moves the watermark to 04:00 and flushes Jan 2 21:00-23:00
    make_readings([("2024-01-01 01:10:00", "1000000001", 99.0),
                   ("2024-01-03 06:00:00", "1000000001", 1.0)]).write.mode("append").parquet(source)
    run()
    rows = spark.read.parquet(out)
    assert rows.filter(F.col("max_power") == 99.0).count() == 0
    assert rows.count() == 48


def test_compaction_merges_stream_batches(spark, make_readings):
    from meterlake.operators.lifecycle import compact_partitions
    from meterlake.sources import catalog as C
    raw, rollup = _tables(spark)
    tiers = {rollup: ("1 day", None)}
    for i in range(3):
        batch = make_readings(_grid(f"2024-01-0{i + 1} 06:00:00", 30, float(i + 1)))
        ingest_batch(spark, batch, i, raw, tiers)
    before = sorted(spark.table(raw).collect())
    stats = compact_partitions(spark, raw, "1 day", older_than="1 day", as_of="2024-01-04")
    assert stats.count() == 2            # Jan 1 and Jan 2 end before Jan 3 00:00
    assert sorted(spark.table(raw).drop("ingest_batch").collect()) == \
        sorted(r for r in [tuple(x)[:-1] for x in before])
    batches = {(r.chunk, r.ingest_batch) for r in
               spark.sql(f"select distinct chunk, ingest_batch from {raw}").collect()}
    assert {b for c, b in batches if c < "2024-01-03"} == {-1}
    assert len(C.partition_catalog(spark, raw).collect()) == 4   # 30-hour grids reach Jan 4
    # a replay of a recent batch still overwrites only its own partition
    ingest_batch(spark, make_readings(_grid("2024-01-03 06:00:00", 30, 3.0)), 2, raw, tiers)
    assert spark.table(raw).count() == len(before)


def test_retention_on_stream_fed_table(spark, make_readings):
    from meterlake.operators.lifecycle import drop_older_than
    raw, rollup = _tables(spark)
    tiers = {rollup: ("1 day", None)}
    ingest_batch(spark, make_readings(_grid("2024-01-01 00:00:00", 24, 1.0)), 0, raw, tiers)
    ingest_batch(spark, make_readings(_grid("2024-01-01 12:30:00", 40, 2.0)), 1, raw, tiers)
    dropped = drop_older_than(spark, raw, "30 days", "2024-02-01")
    assert dropped == ["2024-01-01-00"]              # Jan 2 ends Jan 3, after the cutoff
    days = {r.chunk for r in spark.sql(f"select distinct chunk from {raw}").collect()}
    assert days == {"2024-01-02-00", "2024-01-03-00"}  # batch 1 runs to Jan 3 03:30
    assert spark.table(raw).count() == 28            # batch 1 rows from Jan 2 00:30 on


def test_one_raw_scan_refreshes_all_tiers(spark, make_readings):
    raw, _ = _tables(spark)
    tiers = {}
    for width in ("15 minutes", "1 hour", "1 day"):
        table = unique_table("s_tier")
        create_rollup_table(spark, table, scratch_path(spark, "s-tier"))
        tiers[table] = (width, None)
    ingest_batch(spark, make_readings(_grid("2024-01-01 00:00:00", 100, 2.0, 20)), 0, raw, tiers)
    ingest_batch(spark, make_readings(_grid("2024-01-01 10:05:00", 50, 5.0, 20)), 1, raw, tiers)
    cols = ["meter_id", "bucket", "reading_count", "power_count", "max_power", "min_power"]
    for table, (width, _) in tiers.items():
        want = R.rollup_state(spark.table(raw), width).select(*cols)
        assert sorted(spark.table(table).select(*cols).collect()) == sorted(want.collect())


def test_many_micro_batches_in_one_run(spark, make_readings):
    raw, rollup = _tables(spark)
    source, ckpt = scratch_path(spark, "s-src"), scratch_path(spark, "s-ckpt")
    for i in range(3):   # three files -> three micro-batches with one file each
        make_readings(_grid(f"2024-01-0{i + 1} 03:00:00", 30, float(i + 1))) \
            .coalesce(1).write.mode("append").parquet(source)
    q = stream_refresh(spark, source, raw, {rollup: ("1 hour", None)}, ckpt,
                       {"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    batches = {r[0] for r in spark.sql(f"select distinct ingest_batch from {raw}").collect()}
    assert batches == {0, 1, 2}
    cols = ["meter_id", "bucket", "reading_count", "sum_power"]
    want = R.rollup_state(spark.table(raw), "1 hour").select(*cols)
    assert sorted(spark.table(rollup).select(*cols).collect()) == sorted(want.collect())


def _hours(start: str, n: int):
    return _grid(start, n, 1.0)


def test_on_time_data_is_published_in_every_tier(spark, make_readings):
    """Five days of hourly rows in 12-hour batches, each as it ends."""
    from datetime import timedelta
    from meterlake.functions.time import to_utc
    from meterlake.streaming.refresh import refresh_pending
    raw, _ = _tables(spark)
    tiers = {}
    for name, (width, policy) in R.TIERS.items():
        table = unique_table(f"s_live_{name}")
        create_rollup_table(spark, table, scratch_path(spark, "s-live"))
        tiers[table] = (width, policy)
    for i in range(10):
        start = to_utc("2024-01-01") + timedelta(hours=12 * i)
        ingest_batch(spark, make_readings(_hours(start.strftime("%Y-%m-%d %H:%M:%S"), 12)), i, raw, tiers,
                     as_of=start + timedelta(hours=12))
    counts = [spark.table(t).count() for t in tiers]
    assert counts == [119, 119, 4]        # the last hour and the last day are held back
    refresh_pending(spark, raw, tiers, as_of="2024-01-07")
    assert [spark.table(t).count() for t in tiers] == [120, 120, 5]
    # the last batch again
    ingest_batch(spark, make_readings(_hours("2024-01-05 12:00:00", 12)), 9, raw, tiers, as_of="2024-01-07")
    assert spark.table(raw).count() == 120
    assert [spark.table(t).agg(F.sum("reading_count")).first()[0] for t in tiers] == [120, 120, 120]


def test_pending_state_does_not_pile_up(spark, make_readings):
    from meterlake.sources import files
    from meterlake.streaming import pending as P
    from meterlake.streaming.refresh import pending_path
    raw, rollup = _tables(spark)
    tiers = {rollup: R.TIERS["daily"]}
    for i in range(5):
        ingest_batch(spark, make_readings(_hours(f"2024-01-0{i + 1} 00:00:00", 24)), i, raw, tiers, as_of=f"2024-01-0{i + 2}")
    path = pending_path(spark, raw)
    assert len(files.children(spark, path)) == 3
    assert [r.day for r in P.read_pending(spark, path).collect()] == ["2024-01-05"]
    far = make_readings([("2999-01-01 00:00:00", "1000000001", 1.0)])
    assert ingest_batch(spark, far, 5, raw, tiers, as_of="2024-01-08") == ["2024-01-05"]
    assert [r.day for r in P.read_pending(spark, path).collect()] == ["2999-01-01"]


def test_missed_days_wait_for_a_refresh_without_policy(spark, make_readings):
    """No batch for longer than the window: held-back buckets and old days of the catch-up stay pending."""
    from meterlake.streaming import pending as P
    from meterlake.streaming.refresh import pending_path, refresh_pending
    raw, rollup = _tables(spark)
    width, policy = R.TIERS["15min"]
    tiers = {rollup: (width, policy)}
    total = lambda: spark.table(rollup).agg(F.sum("reading_count")).first()[0]
    ingest_batch(spark, make_readings(_hours("2024-01-01 00:00:00", 24)), 0, raw, tiers, as_of="2024-01-02")
    assert total() == 23                  # the last hour is held back
    late = make_readings(_hours("2024-01-02 00:00:00", 24) + _hours("2024-01-09 00:00:00", 12))
    ingest_batch(spark, late, 1, raw, tiers, as_of="2024-01-10 02:00:00")
    path = pending_path(spark, raw)
    assert sorted(r.day for r in P.read_pending(spark, path).collect()) == ["2024-01-01", "2024-01-02"]
    assert total() == 23 + 12
    assert refresh_pending(spark, raw, {rollup: (width, None)}, as_of="2024-01-10") == ["2024-01-01", "2024-01-02"]
    assert total() == 60
    assert P.read_pending(spark, path).count() == 0
    ingest_batch(spark, make_readings(_hours("2024-01-10 00:00:00", 1)), 2, raw, tiers, as_of="2024-01-11 02:00:00")
    assert P.read_pending(spark, path).count() == 0 and total() == 61


def test_rejected_rows_are_kept_and_rollups_are_optional(spark, make_readings):
    from meterlake.streaming.refresh import rejects_path
    raw, _ = _tables(spark)
    bad = make_readings([("2024-01-01 00:00:00", "1000000001", 1.0), (None, "1000000001", 2.0),
                         ("2024-01-01 00:00:00", "10000000001", 3.0)])
    for _ in range(2):
        assert ingest_batch(spark, bad, 0, raw, {}) == []
    assert spark.table(raw).count() == 1
    assert sorted(r.power for r in spark.read.parquet(rejects_path(spark, raw)).collect()) == [2.0, 3.0]


def test_compaction_leaves_uncommitted_and_later_batches(spark, make_readings, monkeypatch):
    from meterlake.operators import lifecycle as L
    raw, rollup = _tables(spark)
    tiers = {rollup: ("1 day", None)}
    for i in range(3):
        ingest_batch(spark, make_readings(_grid("2024-01-01 00:00:00", 8, float(i))), i, raw, tiers)
    rewritten = L._rewritten

    def late(*args):
        ingest_batch(spark, make_readings(_grid("2024-01-01 08:00:00", 4, 9.0)), 3, raw, tiers)
        return rewritten(*args)
    monkeypatch.setattr(L, "_rewritten", late)
    assert L.compact_partitions(spark, raw, "1 day").count() == 1
    monkeypatch.setattr(L, "_rewritten", rewritten)
    batches = lambda: {r[0] for r in spark.sql(f"select distinct ingest_batch from {raw}").collect()}
    assert batches() == {-1, 2, 3} and spark.table(raw).count() == 28
    # the newest batch is replayed after compaction: nothing is counted twice
    ingest_batch(spark, make_readings(_grid("2024-01-01 08:00:00", 4, 9.0)), 3, raw, tiers)
    assert spark.table(raw).count() == 28
    assert spark.table(rollup).agg(F.sum("reading_count")).first()[0] == 28
    assert L.compact_partitions(spark, raw, "1 day", committed_below=4).count() == 1
    assert batches() == {-1} and spark.table(raw).count() == 28


def _three_tiers(spark):
    tiers = {}
    for name, (width, policy) in R.TIERS.items():
        table = unique_table(f"s_tier_{name}")
        create_rollup_table(spark, table, scratch_path(spark, "s-tier"))
        tiers[table] = (width, policy)
    return tiers


def _files_by_day(spark, table):
    out = {}
    for f in spark.table(table).inputFiles():
        out.setdefault(f.split("/day=")[1].split("/")[0], set()).add(f)
    return out


def test_a_late_row_costs_its_range_and_one_day_per_tier(spark, make_readings, monkeypatch):
    """Five days of rows, then one late row: raw rows are read once, in its
    15 minutes; the other tiers are merged, and one day of each is rewritten."""
    from meterlake.streaming import refresh as S
    raw, _ = _tables(spark)
    tiers = _three_tiers(spark)
    ingest_batch(spark, make_readings(_grid("2024-01-01 00:00:00", 120 * 4, 2.0, 15)), 0, raw, tiers, as_of="2024-01-06")
    before = {t: _files_by_day(spark, t) for t in tiers}
    scans, scan = [], R.scan_ranges

    def seen(spark, handle, ranges, width):
        df = scan(spark, handle, ranges, width)
        scans.append((ranges, df))
        return df
    monkeypatch.setattr(R, "scan_ranges", seen)
    late = make_readings([("2024-01-04 10:20:00", "1000000001", 9.0)])
    assert S.ingest_batch(spark, late, 1, raw, tiers, as_of="2024-01-06") == ["2024-01-04"]
    (ranges, df), = scans
    assert [(a.isoformat(), b.isoformat()) for a, b in ranges] == [("2024-01-04T10:15:00+00:00", "2024-01-04T10:30:00+00:00")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "chunk" in plan and "PushedFilters: [" in plan and "GreaterThanOrEqual(timestamp,2024-01-04 10:15:00" in plan
    assert {f.split("/chunk=")[1][:13] for f in df.inputFiles()} <= {"2024-01-04-00"} and df.count() == 2
    for t in tiers:
        after = _files_by_day(spark, t)
        assert [d for d in after if after[d] != before[t].get(d)] == ["2024-01-04"]
        width, policy = tiers[t]
        lo, hi = R.refresh_window(policy, "2024-01-06", width)
        want = R.rollup_state(spark.table(raw), width).filter((F.col("bucket") >= F.lit(lo)) & (F.col("bucket") < F.lit(hi)))
        cols = ["meter_id", "bucket", "reading_count", "power_count", "max_power", "min_power", "sum_power"]
        assert sorted(spark.table(t).select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_random_batches_leave_what_a_rebuild_gives(spark, make_readings):
    """Late and early rows in any order: within its window each tier equals its rebuild."""
    import random
    from datetime import timedelta
    from meterlake.functions.time import to_utc
    rng = random.Random(2)
    raw, _ = _tables(spark)
    tiers, now = _three_tiers(spark), to_utc("2024-01-10")
    for i in range(5):
        now += timedelta(hours=rng.choice([1, 5, 26]))
        rows = [((now - timedelta(minutes=rng.choice([-30, 5, 50, 300, 4000, 9000, 40000, 50000]) + rng.randint(0, 400)))
                 .strftime("%Y-%m-%d %H:%M:%S"), f"100000000{rng.randint(0, 3)}", float(rng.randint(1, 9))) for _ in range(40)]
        ingest_batch(spark, make_readings(rows), i, raw, tiers, as_of=now)
        cols = ["meter_id", "bucket", "reading_count", "max_power", "min_power", "sum_power"]
        for t, (width, policy) in tiers.items():
            lo, hi = R.refresh_window(policy, now, width)
            inside = (F.col("bucket") >= F.lit(lo)) & (F.col("bucket") < F.lit(hi))
            want = R.rollup_state(spark.table(raw), width).filter(inside).select(*cols)
            assert sorted(spark.table(t).filter(inside).select(*cols).collect()) == sorted(want.collect())


def test_ranges_are_split_at_the_finer_window():
    from meterlake.functions.time import to_utc
    t = lambda h: to_utc(f"2024-01-01 {h:02d}:00:00")
    assert R._split([(t(0), t(10))], (t(3), t(7)), "1 hour") == ([(t(3), t(7))], [(t(0), t(3)), (t(7), t(10))])
    assert R._split([(t(0), t(2)), (t(4), t(5))], (t(3), t(7)), "1 hour") == ([(t(4), t(5))], [(t(0), t(2))])
    assert R._split([(t(0), t(2))], None, "1 hour") == ([(t(0), t(2))], [])
    assert R.whole_buckets([(t(1), t(2)), (t(4), t(5)), (t(2), t(3))], "2 hours") == [(t(0), t(6))]
