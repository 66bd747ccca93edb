"""Scalar functions: buckets, partition labels, bands, formats."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from meterlake.functions import (
    chunk_label, day_label, floor_to, human_bytes, label_of, period_type, savings_pct,
    time_bucket, width_micros,
)
from conftest import ts


def _one(spark, expr, value, kind="timestamp"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def test_width_parsing():
    assert width_micros("15 minutes") == 900_000_000
    assert width_micros("1 hour") == 3_600_000_000
    assert width_micros("3 hours") == 3 * 3_600_000_000
    assert width_micros("1 week") == 7 * 86_400_000_000
    with pytest.raises(ValueError):
        width_micros("1 month")


@pytest.mark.parametrize("width,value,expected", [
    ("15 minutes", "2024-01-04 10:14:59", "2024-01-04 10:00:00"),
    ("15 minutes", "2024-01-04 10:15:00", "2024-01-04 10:15:00"),
    ("1 hour", "2024-01-04 10:59:59.999999", "2024-01-04 10:00:00"),
    ("1 day", "2024-01-04 23:59:59", "2024-01-04 00:00:00"),
    # weeks start on Monday (Jan 1 2024), not on the epoch's Thursday
    ("1 week", "2024-01-04 12:00:00", "2024-01-01 00:00:00"),
    # times before 1970 floor downwards
    ("1 hour", "1969-12-31 23:30:00", "1969-12-31 23:00:00"),
])
def test_time_bucket(spark, width, value, expected):
    got = _one(spark, lambda c: time_bucket(width, c), ts(value))
    assert got == ts(expected)


def test_time_bucket_null(spark):
    assert _one(spark, lambda c: time_bucket("1 hour", c), None) is None


def test_chunk_label_epoch_aligned_and_zone_independent(spark):
    value = ts("2024-01-04 12:00:00")
    assert _one(spark, lambda c: chunk_label("1 week", c), value, ) == "2024-01-04-00"
    assert _one(spark, lambda c: chunk_label("3 hours", c), value) == "2024-01-04-12"
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("select timestamp '2024-01-04 20:00:00 UTC' as v")
        assert df.select(chunk_label("1 day", "v")).first()[0] == "2024-01-04-00"
        assert df.select(day_label("v")).first()[0] == "2024-01-04"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_driver_side_floor_matches_labels():
    t = datetime(2024, 1, 4, 13, 30, tzinfo=timezone.utc)
    assert label_of(floor_to(t, "3 hours")) == "2024-01-04-12"
    assert label_of(floor_to(t, "1 week")) == "2024-01-04-00"


def test_period_type_all_hours(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = dict(df.select("h", period_type("h")).collect())
    assert got[5] == "Night (Low)" and got[23] == "Night (Low)" and got[0] == "Night (Low)"
    assert got[6] == "Morning Peak" and got[9] == "Morning Peak"
    assert got[10] == "Daytime (Medium)" and got[17] == "Daytime (Medium)"
    assert got[18] == "Evening Peak" and got[22] == "Evening Peak"


def test_human_bytes(spark):
    df = spark.createDataFrame([(0,), (10239,), (10240,), (390 * 1024 * 1024,)], "b long")
    got = [r[0] for r in df.select(human_bytes("b")).collect()]
    assert got == ["0 bytes", "10239 bytes", "10 kB", "390 MB"]


def test_savings_rules(spark):
    df = spark.createDataFrame([(390, 183), (0, 0)], "b long, a long")
    case_rule = [r[0] for r in df.select(savings_pct("b", "a", on_zero=0.0)).collect()]
    nullif_rule = [r[0] for r in df.select(savings_pct("b", "a", on_zero=None)).collect()]
    assert case_rule == [53.1, 0.0]
    assert nullif_rule == [53.1, None]


def test_chunk_label_before_1970(spark):
    value = ts("1969-12-31 22:30:00")
    assert _one(spark, lambda c: chunk_label("3 hours", c), value) == "1969-12-31-21"
    assert _one(spark, lambda c: chunk_label("1 day", c), value) == "1969-12-31-00"


def test_scan_last_relative_window(spark, make_readings):
    from meterlake.sources.layout import scan_last
    df = make_readings([("2024-01-30 23:00:00", "1000000001", 1.0),
                        ("2024-01-29 23:59:59", "1000000001", 2.0)])
    got = [r.power for r in scan_last(df, "1 day", as_of="2024-01-31 00:00:00").collect()]
    assert got == [1.0]
    assert scan_last(df, "1 day").count() == 0        # NOW() is long after the data


def test_reports_keep_rows_with_null_times(spark, make_readings):
    from meterlake.operators import queries as Q
    rows = [(f"2024-01-05 {h:02d}:10:00", "1000000001", float(h)) for h in range(24)]
    df = make_readings(rows + [(None, "1000000001", 5.0)])
    assert Q.hourly_profile(df).count() == 25
    assert Q.recent_profile(df, "2024-01-06", k=0).count() == 0
    assert Q.monthly_per_key(df, k=0).count() == 0
    assert [r.hour for r in Q.hourly_profile(df).collect()] == [None, *range(24)]


def test_grouped_number_and_ratios(spark):
    from meterlake.functions.format import grouped_number, pct_change, speedup
    r = spark.range(1).select(grouped_number(F.lit(4033000)).alias("n"), pct_change(F.lit(50), F.lit(75)).alias("p"),
                              pct_change(F.lit(0), F.lit(1)).alias("z"), speedup(F.lit(9.0), F.lit(3)).alias("s")).first()
    assert tuple(r) == ("4,033,000", 50.0, None, 3.0)


def test_bucket_expressions_match_python_floor(spark):
    """Property check: Spark's bucket/label expressions equal a plain Python
    floor on random instants (1900-2100, microsecond precision)."""
    from datetime import timezone

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from meterlake.functions.time import BUCKET_ORIGIN, EPOCH

    widths = ["15 minutes", "1 hour", "3 hours", "1 day", "1 week"]
    instants = st.datetimes(min_value=ts("1900-01-01"), max_value=ts("2100-01-01"))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(instants, min_size=20, max_size=60))
    def check(values):
        df = spark.createDataFrame([(v.replace(tzinfo=timezone.utc),) for v in values],
                                   "t timestamp")
        cols = [time_bucket(w, "t").alias(f"b{i}") for i, w in enumerate(widths)]
        cols += [chunk_label(w, "t").alias(f"c{i}") for i, w in enumerate(widths[1:], 1)]
        rows = df.select("t", *cols).collect()
        for r in rows:
            t = r.t.replace(tzinfo=timezone.utc)
            for i, w in enumerate(widths):
                want = floor_to(t, w, BUCKET_ORIGIN).replace(tzinfo=None)
                assert r[f"b{i}"] == want, (t, w)
            for i, w in enumerate(widths[1:], 1):
                assert r[f"c{i}"] == label_of(floor_to(t, w, EPOCH)), (t, w)

    check()


def test_session_settings_profiles(spark):
    from meterlake.session import CLUSTER_CONF, checkpoint_root, session_settings
    local = session_settings()
    assert local["spark.sql.session.timeZone"] == "UTC"
    assert local["spark.sql.adaptive.enabled"] == "true"
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" not in local
    cluster = session_settings("cluster", shuffle_partitions=4096)
    assert cluster["spark.sql.shuffle.partitions"] == "4096"        # explicit wins
    assert cluster["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert set(CLUSTER_CONF) <= set(cluster)
    with pytest.raises(ValueError):
        session_settings("laptop")
    # the shared folder comes from the session, never invented when configured
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir",
                                                    checkpoint_root(spark)).rstrip("/")
