"""Write the formatted physical plans of the headline operators to PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
Plans are taken after one run, so the adaptive (final) plan is shown.
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from meterlake.operators import queries as Q  # noqa: E402
from meterlake.operators import rollups as R  # noqa: E402
from meterlake.session import get_session, scratch_path, unique_table  # noqa: E402
from meterlake.sources.layout import scan_range, write_partitioned  # noqa: E402
from meterlake.sources.schema import events_readings, readings  # noqa: E402


def formatted(df) -> str:
    df.collect()
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    raw = events_readings(spark, sf)
    table = unique_table("plans_1d")
    write_partitioned(raw, table, "1 day", location=scratch_path(spark, "plans-1d"))
    rollup = unique_table("plans_15min")
    R.build_rollup(readings(spark, table), rollup, "15 minutes",
                   location=scratch_path(spark, "plans-rollup"))
    cases = {
        "Q1 hourly_avg via scan_range (1-day layout)":
            Q.hourly_avg(scan_range(spark, table, "2024-01-30")),
        "Q2 peak_periods via scan_range": Q.peak_periods(scan_range(spark, table, "2024-01-23")),
        "Q3 monthly_per_key": Q.monthly_per_key(readings(spark, table)),
        "Q4 table_stats": Q.table_stats(readings(spark, table)),
        "A9 quality_summary (count distinct)": Q.quality_summary(readings(spark, table)),
        "W2 region_share": Q.region_share(readings(spark, table)),
        "A5 point query on raw rows":
            Q.meter_profile(scan_range(spark, table, "2024-01-15", "2024-01-16"),
                            "7000000007", "2024-01-15", "2024-01-16"),
        "S9 same question on the 15-minute rollup":
            R.rollup_point_read(spark.table(rollup), "7000000007",
                                "2024-01-15", "2024-01-16", "15 minutes"),
        "U2 tables_equal": Q.tables_equal(raw, readings(spark, table)),
    }
    out = ["# PLANS", "",
           f"Formatted physical plans (after execution, AQE final plans) on `{sf}`,",
           "generated by `tools/explain_plans.py`. Layouts are catalog tables.", ""]
    for title, df in cases.items():
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
