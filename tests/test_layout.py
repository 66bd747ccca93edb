"""Layouts, range scans and their plans; ingest checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.operators import queries as Q
from meterlake.session import scratch_path, unique_table
from meterlake.sources import catalog as C
from meterlake.sources.layout import append_readings, relayout, scan_range, write_partitioned
from meterlake.sources.schema import derive_measures, events_readings, readings, split_valid
from conftest import SF_MID


def _rounded(rows):
    """Rows with floats at 9 places: sums differ in the last bit by file order."""
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_counts_per_width(spark):
    """Events at sf0.01 span 30 days: 240 / 30 / 5 epoch-aligned partitions."""
    raw = events_readings(spark, SF_MID)
    counts = {}
    for width in ("3 hours", "1 day", "1 week"):
        path = scratch_path(spark, "t-layout")
        write_partitioned(raw, path, width)
        counts[width] = C.partition_catalog(spark, path, width).count()
    assert counts == {"3 hours": 240, "1 day": 30, "1 week": 5}


def test_scan_range_prunes_partitions_and_pushes_filters(spark):
    table = unique_table("t_scan")
    write_partitioned(events_readings(spark, SF_MID), table, "1 day",
                      location=scratch_path(spark, "t-scan"))
    df = Q.hourly_avg(scan_range(spark, table, "2024-01-30", width="1 day"))
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(chunk" in plan
    assert "chunk#" in plan and ">= 2024-01-30-00" in plan
    assert "GreaterThanOrEqual(timestamp" in plan
    # only the two columns the question uses are read
    assert "ReadSchema: struct<timestamp:timestamp,power:double>" in plan
    # one day of 30 partitions is listed
    files = df.sparkSession.table(table).filter(F.col("chunk") >= "2024-01-30-00").inputFiles()
    assert files and all("chunk=2024-01-30-00" in f for f in files)


def test_scan_range_half_open_bounds_unaligned(spark, make_readings):
    df = make_readings([
        ("2024-01-04 10:29:59", "1000000001", 1.0),
        ("2024-01-04 10:30:00", "1000000001", 2.0),
        ("2024-01-04 12:00:00", "1000000001", 3.0),
        ("2024-01-04 13:00:00", "1000000001", 4.0),
    ])
    path = scratch_path(spark, "t-bounds")
    write_partitioned(df, path, "1 hour")
    got = sorted(r.power for r in scan_range(spark, path, "2024-01-04 10:30:00",
                                             "2024-01-04 13:00:00", "1 hour").collect())
    assert got == [2.0, 3.0]


def test_three_layouts_same_answers(spark):
    raw = events_readings(spark, SF_MID)
    src = scratch_path(spark, "t-src")
    write_partitioned(raw, src, "1 day")
    answers = []
    for width in ("3 hours", "1 day", "1 week"):
        dst = scratch_path(spark, "t-dst")
        relayout(spark, src, dst, width)
        df = readings(spark, dst)
        answers.append((
            _rounded(Q.hourly_avg(scan_range(spark, dst, "2024-01-30", width=width)).collect()),
            _rounded(Q.peak_periods(scan_range(spark, dst, "2024-01-23", width=width)).collect()),
            _rounded(Q.monthly_per_key(df).collect()),
            _rounded(Q.table_stats(df).collect()),
        ))
        assert Q.tables_equal(raw, df).first()[:2] == (0, 0)
    assert answers[0] == answers[1] == answers[2]


def test_split_valid_edges(spark, make_readings):
    df = make_readings([
        ("2024-01-04 10:00:00", "1000000001", 1.0),
        (None, "1000000001", 1.0),
        ("2024-01-04 10:00:00", None, 1.0),
        ("2024-01-04 10:00:00", "10000000012", 1.0),   # 11 characters
    ])
    good, bad = split_valid(df)
    assert good.count() == 1 and bad.count() == 3


def test_derive_measures_zero_voltage(spark, make_readings):
    df = make_readings([("2024-01-04 10:00:00", "1000000001", 460.0, 0.0),
                        ("2024-01-04 10:00:00", "1000000001", 460.0, 230.0)])
    df = df.withColumn("current", F.lit(None).cast("double")) \
           .withColumn("energy", F.lit(None).cast("double"))
    got = derive_measures(df).orderBy("voltage").collect()
    assert got[0].current is None and got[1].current == 2.0
    assert abs(got[1].energy - 460.0 * 5 / 60 / 1000) < 1e-15


def test_append_readings_rejects_and_appends(spark, make_readings):
    table = unique_table("t_append")
    loc = scratch_path(spark, "t-append")
    first = make_readings([("2024-01-04 10:00:00", "1000000001", 1.0)])
    write_partitioned(first, table, "1 day", location=loc)
    batch = make_readings([("2024-01-05 10:00:00", "1000000001", 2.0),
                           (None, "1000000002", 3.0)])
    rejected = append_readings(batch, table, "1 day")
    assert rejected.count() == 1
    assert readings(spark, table).count() == 2
    assert {r.chunk for r in C.partition_catalog(spark, table).collect()} == \
        {"2024-01-04-00", "2024-01-05-00"}


def test_idempotent_create(spark, make_readings):
    table = unique_table("t_ignore")
    loc = scratch_path(spark, "t-ignore")
    df = make_readings([("2024-01-04 10:00:00", "1000000001", 1.0)])
    write_partitioned(df, table, "1 day", location=loc)
    write_partitioned(df, table, "1 day", mode="ignore")
    assert readings(spark, table).count() == 1


def test_meter_bloom_filter_layout(spark):
    path = scratch_path(spark, "t-bloom")
    raw = events_readings(spark, SF_MID)
    write_partitioned(raw, path, "1 day", meter_bloom=True)
    got = Q.meter_profile(readings(spark, path), "7000000007", "2024-01-15", "2024-01-16")
    want = Q.meter_profile(raw, "7000000007", "2024-01-15", "2024-01-16")
    assert sorted(got.collect()) == sorted(want.collect())


def test_hot_chunk_and_meter_split_over_writers(spark, make_readings):
    """One meter holding every row of one chunk is still written by several
    tasks: range boundaries include the time column."""
    import glob
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 4)
    rows = [((t0 + timedelta(seconds=7 * i)).isoformat(sep=" "), "1000000001", float(i % 97))
            for i in range(6000)]
    rows += [("2024-01-05 01:00:00", "2000000002", 1.0)]
    path = scratch_path(spark, "t-hot")
    write_partitioned(make_readings(rows), path, "1 day", num_files=4)
    hot = glob.glob(path + "/chunk=2024-01-04-00/*.parquet")
    assert len(hot) >= 3
    assert readings(spark, path).count() == 6001


def test_scan_days_prunes_scattered_days(spark):
    from meterlake.sources.layout import chunks_for_days, scan_days
    assert chunks_for_days(["2024-01-04"], "1 week") == ["2024-01-04-00"]
    assert chunks_for_days(["2024-01-05"], "1 week") == ["2024-01-04-00"]
    assert len(chunks_for_days(["2024-01-04", "2024-01-20"], "3 hours")) == 16
    table = unique_table("t_days")
    raw = events_readings(spark, SF_MID)
    write_partitioned(raw, table, "3 hours", location=scratch_path(spark, "t-days"))
    df = scan_days(spark, table, ["2024-01-02", "2024-01-29"], "3 hours")
    files = df.inputFiles()
    assert files and all(("chunk=2024-01-02-" in f) or ("chunk=2024-01-29-" in f) for f in files)
    want = raw.filter(F.to_date("timestamp").isin("2024-01-02", "2024-01-29")).count()
    assert df.count() == want


def test_bucketed_table_is_grouped_by_meter_without_a_shuffle(spark):
    from meterlake.operators import queries as Q
    from meterlake.operators import rollups as R
    from meterlake.sources.layout import write_bucketed
    table, plain = unique_table("t_bucketed"), unique_table("t_plain")
    rows = events_readings(spark, SF_MID)
    write_bucketed(rows, table, 8, location=scratch_path(spark, "t-bucketed"))
    write_partitioned(rows, plain, "1 week", location=scratch_path(spark, "t-plain"))

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    questions = (lambda t: Q.monthly_per_key(readings(spark, t), 20), lambda t: R.rollup_state(readings(spark, t), "1 hour"))
    for question in questions:
        assert shuffles(question(table)) == 0 and shuffles(question(plain)) > 0
        rows = lambda t: sorted((tuple(r) for r in question(t).collect()), key=lambda r: (r[0], str(r[1])))  # noqa: E731,B023
        for one, other in zip(rows(table), rows(plain), strict=True):
            for x, y in zip(one, other):  # sums differ in the last bit by file order
                assert abs(x - y) < 1e-6 if isinstance(x, float) else x == y
