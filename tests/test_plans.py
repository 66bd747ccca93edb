"""Plan shapes that the scale design relies on (checked on executed plans)."""

from __future__ import annotations

import re

import pytest

from meterlake.operators import queries as Q
from meterlake.operators import rollups as R
from meterlake.session import scratch_path, unique_table
from meterlake.sources.layout import scan_range, write_partitioned
from meterlake.sources.schema import events_readings, readings
from conftest import SF_MID


@pytest.fixture(scope="module")
def layout(spark):
    table = unique_table("t_plans")
    write_partitioned(events_readings(spark, SF_MID), table, "1 day",
                      location=scratch_path(spark, "t-plans"))
    rollup = unique_table("t_plans_15m")
    R.build_rollup(readings(spark, table), rollup, "15 minutes",
                   location=scratch_path(spark, "t-plans-15m"))
    return table, rollup


def executed(df) -> str:
    """Executed (AQE final) plan in formatted mode, where filter lists are
    printed in full."""
    df.collect()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_top_k_is_one_shuffle_with_partial_aggregate(spark, layout):
    plan = executed(Q.peak_periods(scan_range(spark, layout[0], "2024-01-23")))
    assert "TakeOrderedAndProject" in plan
    final_tree = plan.split("+- == Initial Plan ==")[0]
    assert len(re.findall(r"ShuffleQueryStage \(\d+\)", final_tree)) == 1
    assert "partial_avg(power" in plan
    assert "rangepartitioning" not in plan


def test_window_on_grouped_rows_has_no_global_sort(spark, layout):
    plan = executed(Q.region_share(readings(spark, layout[0])))
    assert "rangepartitioning" not in plan
    assert "Window" in plan and "sum(total_energy" in plan


def test_count_distinct_pre_aggregates_per_meter(spark, layout):
    plan = executed(Q.quality_summary(readings(spark, layout[0])))
    # per-meter partial aggregate below the exchange on meter_id: a hot meter
    # contributes one row per task to that shuffle
    assert re.search(r"Keys \[1\]: \[meter_id#\d+\]\nFunctions \[\d+\]: \[partial_count", plan)


def test_point_reads_push_filters_and_prune(spark, layout):
    raw = executed(Q.meter_profile(scan_range(spark, layout[0], "2024-01-15", "2024-01-16"),
                                   "7000000007", "2024-01-15", "2024-01-16"))
    assert "EqualTo(meter_id,7000000007)" in raw
    assert "PartitionFilters: [isnotnull(chunk" in raw
    roll = executed(R.rollup_point_read(spark.table(layout[1]), "7000000007",
                                        "2024-01-15", "2024-01-16"))
    assert "EqualTo(meter_id,7000000007)" in roll
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-15", roll)
    assert "HashAggregate" not in roll          # the rollup answers without aggregating


def test_scans_read_only_needed_columns(spark, layout):
    plan = executed(Q.table_stats(readings(spark, layout[0])))
    assert "ReadSchema: struct<power:double>" in plan
    assert "[codegen id :" in plan          # whole-stage codegen
