"""Rollups: build, re-aggregation semantics, refresh windows, vanished days."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterlake.operators import queries as Q
from meterlake.operators import rollups as R
from meterlake.session import scratch_path, unique_table
from meterlake.sources.layout import write_partitioned
from meterlake.sources.schema import readings
from conftest import ts


def grid(meter: str, start: str, n: int, power: float, step_min: int = 5):
    t0 = ts(start)
    return [((t0 + timedelta(minutes=step_min * i)).isoformat(sep=" "), meter, power)
            for i in range(n)]


def _raw_table(spark, df, width="1 day"):
    table = unique_table("t_raw")
    write_partitioned(df, table, width, location=scratch_path(spark, "t-raw"))
    return table


def _rollup(spark, raw_df, width):
    table = unique_table("t_rollup")
    R.build_rollup(raw_df, table, width, location=scratch_path(spark, "t-rollup"))
    return table


def test_uneven_buckets_weighted_vs_unweighted(spark, make_readings):
    rows = grid("1000000001", "2024-01-04 00:00:00", 3, 100.0) + \
        grid("1000000002", "2024-01-04 00:00:00", 288, 400.0)
    raw = make_readings(rows)
    daily = R.read_rollup(spark, _rollup(spark, raw, "1 day"))
    plain = R.region_daily(daily).first()
    exact = R.region_daily(daily, weighted=True).first()
    assert plain.region_avg_power == pytest.approx(250.0)
    assert exact.region_avg_power == pytest.approx((300 + 288 * 400) / 291)
    assert exact.region_avg_power == pytest.approx(Q.table_stats(raw).first().avg_power)


def test_rollup_counts_and_grid(spark, make_readings):
    """2 meters x 288 ticks -> 96 / 24 / 1 rollup rows per meter and day."""
    rows = grid("1000000001", "2024-01-04 00:00:00", 288, 10.0) + \
        grid("2000000002", "2024-01-04 00:00:00", 287, 20.0)
    raw = make_readings(rows)
    sizes = {w: spark.table(_rollup(spark, raw, w)).count()
             for w in ("15 minutes", "1 hour", "1 day")}
    assert sizes == {"15 minutes": 192, "1 hour": 48, "1 day": 2}
    missing = {r.meter_id: r.missing for r in Q.completeness(raw).collect()}
    assert missing == {"1000000001": 0, "2000000002": 1}


def test_null_power_mean_matches_avg(spark, make_readings):
    raw = make_readings([("2024-01-04 00:00:00", "1000000001", 10.0),
                         ("2024-01-04 00:01:00", "1000000001", None)])
    row = R.read_rollup(spark, _rollup(spark, raw, "15 minutes")).first()
    assert row.reading_count == 2 and row.power_count == 1 and row.avg_power == 10.0


def test_top_k_tie_break_by_period(spark, make_readings):
    raw = make_readings([("2024-01-04 00:20:00", "1000000001", 5.0),
                         ("2024-01-04 00:05:00", "1000000001", 5.0),
                         ("2024-01-04 00:35:00", "1000000001", 1.0)])
    got = [r.period for r in Q.peak_periods(raw, None, 2).collect()]
    assert got == [ts("2024-01-04 00:00:00"), ts("2024-01-04 00:15:00")]
    ranks = [r["rank"] for r in Q.ranked_peaks(raw, None, 3).collect()]
    assert ranks == [1, 2, 3]


def test_rollup_answers_raw_question(spark, make_readings):
    raw = make_readings(grid("1000000001", "2024-01-04 00:00:00", 300, 7.5)
                        + grid("1000000002", "2024-01-04 00:00:00", 300, 9.0))
    rollup = R.read_rollup(spark, _rollup(spark, raw, "15 minutes"))
    raw_answer = Q.meter_profile(raw, "1000000001", "2024-01-04", "2024-01-05")
    roll_answer = R.rollup_point_read(rollup, "1000000001", "2024-01-04", "2024-01-05")
    assert R.rollup_vs_raw(raw_answer, roll_answer).first() == (0, 0, 96, 96)
    assert roll_answer.count() == 96


def test_refresh_window_bounds():
    lo, hi = R.refresh_window(R.TIERS["15min"][1], "2024-01-10 12:07:00", "15 minutes")
    assert lo == ts("2024-01-07 12:15:00+00:00") and hi == ts("2024-01-10 11:00:00+00:00")
    lo, hi = R.refresh_window(R.TIERS["daily"][1], "2024-02-01", "1 day")
    assert lo == ts("2024-01-02 00:00:00+00:00") and hi == ts("2024-01-31 00:00:00+00:00")


def test_late_data_inside_and_outside_window(spark, make_readings):
    base = make_readings(grid("1000000001", "2024-01-01 00:00:00", 10 * 24, 10.0, 60))
    table = _raw_table(spark, base)
    rollup = _rollup(spark, readings(spark, table), "15 minutes")
    as_of = "2024-01-11 00:00:00"       # window [Jan 8 00:00, Jan 10 23:00)
    late = make_readings([
        ("2024-01-10 21:05:00", "1000000001", 50.0),   # 2 hours late: inside
        ("2024-01-09 00:05:00", "1000000001", 50.0),   # 2 days late: inside
        ("2024-01-06 00:05:00", "1000000001", 50.0),   # 5 days late: outside
        ("2024-01-10 23:05:00", "1000000001", 50.0),   # inside the 1-hour gap
    ])
    write_partitioned(late, table, "1 day", mode="append")
    touched = ["2024-01-06", "2024-01-09", "2024-01-10"]
    policy = R.TIERS["15min"][1]
    done = R.refresh_rollup(spark, table, rollup, "15 minutes", "1 day", policy, as_of, touched)
    assert done == ["2024-01-09", "2024-01-10"]
    again = R.refresh_rollup(spark, table, rollup, "15 minutes", "1 day", policy, as_of, touched)
    assert again == done
    got = {r.bucket: r.reading_count for r in spark.table(rollup).collect()}
    assert got[ts("2024-01-10 21:00:00")] == 2
    assert got[ts("2024-01-09 00:00:00")] == 2
    assert got[ts("2024-01-06 00:00:00")] == 1        # correction horizon passed
    assert got[ts("2024-01-10 23:00:00")] == 1        # not yet published
    assert spark.table(rollup).count() == 10 * 24


def test_vanished_day_is_dropped(spark, make_readings):
    raw_df = make_readings(grid("1000000001", "2024-01-01 00:00:00", 3 * 24, 10.0, 60))
    table = _raw_table(spark, raw_df)
    rollup = _rollup(spark, readings(spark, table), "1 day")
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (chunk='2024-01-02-00')")
    R.refresh_rollup(spark, table, rollup, "1 day", touched_days=["2024-01-02"])
    days = sorted(r.day for r in spark.table(rollup).select("day").distinct().collect())
    assert days == ["2024-01-01", "2024-01-03"]


def test_rollup_status_lag(spark, make_readings):
    raw = make_readings(grid("1000000001", "2024-01-01 00:00:00", 30, 10.0, 5))
    tiers = {"15min": (R.read_rollup(spark, _rollup(spark, raw, "15 minutes")), "15 minutes"),
             "daily": (R.read_rollup(spark, _rollup(spark, raw, "1 day")), "1 day")}
    got = {r.rollup: r.lag_seconds for r in R.rollup_status(raw, tiers).collect()}
    # newest row 02:25; 15-minute rollup reaches 02:30, daily reaches Jan 2
    assert got == {"15min": -300.0, "daily": -(21 * 3600 + 35 * 60)}


def test_cascade_equals_direct_build(spark, make_readings):
    rows = grid("1000000001", "2024-01-04 00:00:00", 600, 10.0) + \
        grid("2000000002", "2024-01-04 07:02:00", 100, 33.0, 7)
    raw = make_readings(rows)
    tables = {unique_table("c15"): "15 minutes", unique_table("c1h"): "1 hour",
              unique_table("c1d"): "1 day"}
    R.build_rollups(raw, tables, locations={t: scratch_path(spark, "t-casc") for t in tables})
    for table, width in tables.items():
        direct = R.read_rollup(spark, _rollup(spark, raw, width))
        cols = ["meter_id", "bucket", "reading_count", "power_count", "max_power", "min_power"]
        assert sorted(spark.table(table).select(*cols).collect()) == \
            sorted(direct.select(*cols).collect())
    with pytest.raises(ValueError):
        R.build_rollups(raw, {unique_table("x"): "15 minutes", unique_table("y"): "20 minutes"})


def test_empty_input(spark, make_readings):
    empty = make_readings([])
    assert Q.table_stats(empty).first().n_rows == 0
    assert Q.peak_periods(empty).count() == 0
    assert Q.hourly_profile(empty).count() == 0
    table = _rollup(spark, empty, "1 hour")
    assert spark.table(table).count() == 0
    raw = _raw_table(spark, empty)
    assert R.refresh_rollup(spark, raw, table, "1 hour", touched_days=[]) == []
    assert R.refresh_rollup(spark, raw, table, "1 hour", touched_days=["2024-01-01"]) == \
        ["2024-01-01"]
    assert spark.table(table).count() == 0


def test_bounded_range_report_keeps_every_bucket(spark, make_readings):
    raw = make_readings(grid("1000000001", "2024-01-04 00:00:00", 288, 5.0))
    got = Q.hourly_avg(raw, "2024-01-04", "2024-01-05").collect()
    assert [r.hour for r in got] == [ts("2024-01-04 00:00:00") + timedelta(hours=h)
                                     for h in range(24)]


def test_meter_sets_are_exact_and_merge(spark):
    """Leading zeros, other ids, neighbours over a bitmap's edge, NULLs."""
    ids = ["1", "01", "001", "0", "00", "32767", "32768", "32769", "99999", "A1", "a1", "é", "", None, "-5", "9999999999"]
    rows = [(f"2024-01-{1 + i % 3:02d}", m) for i, m in enumerate(ids)] + [("2024-01-01", "1"), ("2024-01-02", "1"), ("2024-01-05", None)]
    df = spark.createDataFrame(rows, "day string, meter_id string")
    sets = R.meter_sets(df)
    assert R.distinct_meters(sets).first().n_meters == len({m for _, m in rows if m is not None})
    got = {r.g0: r.n_meters for r in R.distinct_meters(sets, F.col("day")).collect()}
    assert got == {d: len({m for e, m in rows if e == d and m is not None}) for d in got}
    two = sets.filter("day <= '2024-01-02'")
    assert R.distinct_meters(two).first().n_meters == len({m for d, m in rows if d <= "2024-01-02" and m is not None})
    assert R.distinct_meters(sets.limit(0)).first().n_meters == 0


def test_calendar_fills_days_without_readings(make_readings):
    from datetime import datetime
    rows = [("2024-01-02 10:00:00", "1000000001", 1.0), ("2024-01-02 11:00:00", "1000000001", 1.0),
            ("2024-01-05 00:00:00", "1000000001", 1.0), ("2024-01-04 23:59:59", "2000000002", 1.0), (None, "3000000003", 1.0)]
    df = make_readings(rows)
    got = lambda out: sorted((r.meter_id[0], r.day.day, r.readings, r.missing) for r in out.collect())
    assert got(Q.completeness_calendar(df, 3)) == [
        ("1", 2, 2, 1), ("1", 3, 0, 3), ("1", 4, 0, 3), ("1", 5, 1, 2), ("2", 4, 1, 2)]
    ranged = got(Q.completeness_calendar(df, 3, "2024-01-01", "2024-01-05"))
    assert [x for x in ranged if x[0] == "1"] == [("1", 1, 0, 3), ("1", 2, 2, 1), ("1", 3, 0, 3), ("1", 4, 0, 3)]
    assert [x[1:3] for x in ranged if x[0] == "2"] == [(1, 0), (2, 0), (3, 0), (4, 1)]
    assert isinstance(Q.completeness_calendar(df, 3).first().day, datetime)
