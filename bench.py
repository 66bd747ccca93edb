"""Benchmark: the reference's Q1-Q4 on three layouts, after compaction, and
the point query on raw rows vs the 15-minute rollup.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line.  The readings are repeated with other meters and
shifted times until they are as many as the reference's (``$BENCH_ROWS``).
Setup (writing the three layouts, compaction, rollup build) is timed
separately and reported as ``setup``; each query's first run is reported as
``cold``, then it runs ``$BENCH_REPEAT`` times (default 5) and the median is
reported in seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from meterlake.operators import lifecycle as L  # noqa: E402
from meterlake.operators import queries as Q  # noqa: E402
from meterlake.operators import rollups as R  # noqa: E402
from meterlake.plans.registry import (  # noqa: E402
    PROFILE_END, PROFILE_METER, PROFILE_START, Q1_START, Q2_START,
)
from meterlake.session import get_session, scratch_path, unique_table  # noqa: E402
from meterlake.sources.layout import Z_ORDER, scan_range, write_partitioned  # noqa: E402
from meterlake.sources.schema import readings, readings_from_events  # noqa: E402

WIDTHS = {"3h": "3 hours", "1d": "1 day", "1w": "1 week"}

# same questions, on 4,033,000 rows, cold cache, hardware not published.
REFERENCE_ROWS = 4_033_000
REFERENCE_MS = {
    "q1_3h": 295.53, "q1_1d": 181.37, "q1_1w": 86.24,
    "q2_3h": 414.62, "q2_1d": 1238.10, "q2_1w": 972.51,
    "q3_3h": 1757.17, "q3_1d": 1629.75, "q3_1w": 1444.98,
    "q4_3h": 340.42, "q4_1d": 188.86, "q4_1w": 239.31,
    "q1_1d_compressed": 734.24, "q2_1d_compressed": 3175.28,
    "q3_1d_compressed": 1586.10, "q4_1d_compressed": 428.19,
    "point_raw": 59.42, "point_rollup": 3.21,
    "hourly_raw": 94.71, "hourly_rollup": 14.00,
}


def expanded(spark, sf_dir: str, rows: int):
    """Readings of ``events``, repeated under other user ids and shifted by
    some seconds, ``rows`` or a little more of them (never fewer than once)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    copies = max(1, -(-rows // events.count()))
    more = events.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    users = events.agg(F.max("user_id")).first()[0] + 1
    return readings_from_events(more.withColumns({
        "user_id": F.col("user_id") + F.col("k") * F.lit(users),
        "ts": F.col("ts") + F.make_dt_interval(secs=F.col("k") * F.lit(7.0))}).drop("k"))


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    # local mode: every executor thread shares the driver JVM's heap
    spark = get_session(f"local[{cpus}]", "meterlake-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    raw = expanded(spark, sf_dir, int(os.environ.get("BENCH_ROWS", REFERENCE_ROWS)))
    n_rows = raw.count()
    setup: dict[str, float] = {}
    paths: dict[str, str] = {}
    # Layouts are catalog tables (like the reference's tables), so a time
    # filter prunes partitions in the catalog before any folder is listed.
    for key, width in WIDTHS.items():
        paths[key] = unique_table(f"bench_{key}")
        setup[f"load_{key}"] = timed(lambda: write_partitioned(
            raw, paths[key], width, location=scratch_path(spark, f"bench-{key}")))

    def questions(path: str, width: str) -> dict:
        return {
            "q1": lambda: Q.hourly_avg(scan_range(spark, path, Q1_START, width=width)).collect(),
            "q2": lambda: Q.peak_periods(scan_range(spark, path, Q2_START, width=width),
                                         None, 10).collect(),
            "q3": lambda: Q.monthly_per_key(readings(spark, path), 20).collect(),
            "q4": lambda: Q.table_stats(readings(spark, path)).collect(),
        }

    runs: dict[str, callable] = {}
    for key, width in WIDTHS.items():
        for q, fn in questions(paths[key], width).items():
            runs[f"{q}_{key}"] = fn

    # Compaction of a copy of the 1-day layout (sorted by time desc, zstd).
    compacted = unique_table("bench_1d_zstd")
    write_partitioned(raw, compacted, "1 day", location=scratch_path(spark, "bench-1d-zstd"))
    setup["compact_1d"] = timed(lambda: L.compact_partitions(spark, compacted, "1 day"))
    for q, fn in questions(compacted, "1 day").items():
        runs[f"{q}_1d_compressed"] = fn

    # The same along a curve through time and meters (Q3 and the point query).
    curve = unique_table("bench_1d_z")
    write_partitioned(raw, curve, "1 day", location=scratch_path(spark, "bench-1d-z"))
    setup["compact_1d_z"] = timed(lambda: L.compact_partitions(spark, curve, "1 day", order_by=Z_ORDER))
    runs["q3_1d_z"] = questions(curve, "1 day")["q3"]
    for name, table in (("compressed", compacted), ("z", curve)):
        runs[f"point_raw_{name}"] = lambda t=table: Q.meter_profile(
            scan_range(spark, t, PROFILE_START, PROFILE_END, "1 day"), PROFILE_METER, PROFILE_START, PROFILE_END).collect()

    # Raw vs rollup: one meter, one day, 15-minute and hourly buckets.  The
    # three tiers are built with one raw scan (coarser tiers merged from finer).
    tiers = {unique_table("bench_rollup_15min"): "15 minutes",
             unique_table("bench_rollup_hourly"): "1 hour",
             unique_table("bench_rollup_daily"): "1 day"}
    rollup, hourly = list(tiers)[:2]
    setup["rollups_3_tiers_build"] = timed(lambda: R.build_rollups(
        readings(spark, paths["1d"]), tiers,
        locations={t: scratch_path(spark, "bench-rollup") for t in tiers}))
    for label, width, table in (("point", "15 minutes", rollup), ("hourly", "1 hour", hourly)):
        runs[f"{label}_raw"] = lambda w=width: Q.meter_profile(
            scan_range(spark, paths["1d"], PROFILE_START, PROFILE_END, "1 day"),
            PROFILE_METER, PROFILE_START, PROFILE_END, width=w).collect()
        runs[f"{label}_rollup"] = lambda t=table: R.rollup_point_read(
            spark.table(t), PROFILE_METER, PROFILE_START, PROFILE_END).collect()
    results: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, fn in runs.items():
        cold[name] = round(timed(fn), 4)  # also warms up: JIT, codegen, file listing caches
        results[name] = round(statistics.median(timed(fn) for _ in range(repeat)), 4)

    headline = ["q1_1d", "q2_1d", "q3_1d", "q4_1d"]
    out = {
        "metric": "q1_q4_1day_layout_total",
        "value": round(sum(results[k] for k in headline), 4),
        "unit": "sec",
        "queries": results,
        "cold": cold,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "rows": n_rows,
        "setup_sec": {k: round(v, 3) for k, v in setup.items()},
        "load_rows_per_sec_1d": round(n_rows / setup["load_1d"], 1),
        "cpus": cpus,
        "reference_ms": REFERENCE_MS,
        "reference_rows": REFERENCE_ROWS,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
