"""Time ranges whose rollup rows are still to be published.

New rows touch a range of each of their days.  What of it lies in a rollup's
refresh window is recomputed at once; what lies above it (held back by the
publish gap) stays pending and comes out when the window has reached it; what
lies below it is missed, and waits for a refresh without a policy
(``refresh_pending``).  The state is one small table (rollup, day, lo, hi) per
version, times in microseconds; a version is written for every batch, from the
newest one before it, so a replayed batch leaves the same state.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.time import day_label, to_utc
from meterlake.operators.rollups import Ranges, RefreshPolicy, refresh_window
from meterlake.sources import files

SCHEMA = "rollup string, day string, lo bigint, hi bigint"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
Rollups = dict[str, tuple[str, RefreshPolicy | None]]


def _version(batch_id: int) -> str:
    return f"batch-{batch_id:015d}"


def read_pending(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(rollup, day) of the newest version (before a batch id)."""
    found = [v for v in files.children(spark, path) if v.startswith("batch-")
             and (before is None or v < _version(before)) and files.exists(spark, f"{path}/{v}/_SUCCESS")]
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{path}/{found[-1]}")


def touched_ranges(rows: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """``day, lo, hi``: the half-open range of each day in which rows lie."""
    at = F.unix_micros(time_col)
    return rows.groupBy(day_label(time_col).alias("day")).agg(F.min(at).alias("lo"), (F.max(at) + 1).alias("hi"))


def add_touched(pending: DataFrame, touched: DataFrame, rollups: Rollups) -> DataFrame:
    """Pending ranges with those of new rows, for every rollup."""
    names = F.explode(F.array(*(F.lit(r) for r in rollups)))
    return pending.unionByName(touched.select(names.alias("rollup"), "day", "lo", "hi"))


def _micros(t: datetime) -> int:
    return (t - _EPOCH) // timedelta(microseconds=1)


def ranges_in_window(pending: DataFrame, rollup: str, width: str, policy: RefreshPolicy | None, as_of) -> Ranges:
    """Pending ranges of a rollup that meet its refresh window, a few per day of it."""
    rows = pending.filter(F.col("rollup") == rollup)
    if policy is not None:
        lo, hi = refresh_window(policy, as_of, width)
        rows = rows.filter((F.col("hi") > _micros(lo)) & (F.col("lo") < _micros(hi)))
    at = lambda m: _EPOCH + timedelta(microseconds=m)
    return [(at(r.lo), at(r.hi)) for r in rows.groupBy("day").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()]


def still_pending(pending: DataFrame, rollups: Rollups, as_of) -> DataFrame:
    """What a refresh of all rollups at ``as_of`` leaves of the ranges: at most
    one held back and one missed per rollup and day."""
    named = F.col("rollup")
    rest = [pending.filter(~named.isin(list(rollups))).withColumn("held", F.lit(True))]
    for name, (width, policy) in rollups.items():
        if policy is not None:
            lo, hi = map(_micros, refresh_window(policy, to_utc(as_of), width))
            mine, top = pending.filter(named == name), F.lit(max(lo, hi))
            held = mine.filter(F.col("hi") > top).withColumn("lo", F.greatest("lo", top))
            missed = mine.filter(F.col("lo") < lo).withColumn("hi", F.least("hi", F.lit(lo)))
            rest += [held.withColumn("held", F.lit(True)), missed.withColumn("held", F.lit(False))]
    return (reduce(DataFrame.unionByName, rest).groupBy("rollup", "day", "held")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("rollup", "day", "lo", "hi"))


def write_pending(spark: SparkSession, path: str, batch_id: int, pending: DataFrame, keep: int = 3) -> None:
    """Store the version of a batch and delete all but the newest ``keep``."""
    pending.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_version(batch_id)}")
    for old in [v for v in files.children(spark, path) if v <= _version(batch_id)][:-keep]:
        files.delete(spark, f"{path}/{old}")


def drop_published(spark: SparkSession, path: str, rollups: list[str]) -> None:
    """Leave out the days of rollups that a refresh without a policy has published.

    Stored beside the newest batch's version, which stays as it is: it sorts
    after that version and before the next batch's.
    """
    found = [v for v in files.children(spark, path) if v.startswith("batch-")
             and files.exists(spark, f"{path}/{v}/_SUCCESS")]
    if found:
        rest = read_pending(spark, path).filter(~F.col("rollup").isin(rollups)).collect()
        target = f"{path}/{found[-1].removesuffix('-published')}-published"
        spark.createDataFrame(rest, SCHEMA).coalesce(1).write.mode("overwrite").parquet(target)
