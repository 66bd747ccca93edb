"""The readings table: declared schema, ingest checks, derived measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("meter_id", T.StringType(), False),
    T.StructField("power", T.DoubleType(), True),
    T.StructField("voltage", T.DoubleType(), True),
    T.StructField("current", T.DoubleType(), True),
    T.StructField("frequency", T.DoubleType(), True),
    T.StructField("energy", T.DoubleType(), True),
])
READING_COLUMNS = [f.name for f in READINGS.fields]

METER_ID_LENGTH = 10


def is_table(handle: str) -> bool:
    """A handle without a path separator or scheme names a catalog table."""
    return "/" not in handle and ":" not in handle


def read_dataset(spark: SparkSession, handle: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """Catalog table or Parquet folder, never with an inferred schema."""
    if is_table(handle):
        return spark.table(handle)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(handle)


READINGS_WITH_CHUNK = T.StructType(READINGS.fields + [T.StructField("chunk", T.StringType())])


def stored_readings(spark: SparkSession, handle: str) -> DataFrame:
    """A stored layout as written: reading columns plus ``chunk`` (plus any
    further partition column of a table), no projection applied."""
    return read_dataset(spark, handle, None if is_table(handle) else READINGS_WITH_CHUNK)


def readings(spark: SparkSession, handle: str, with_chunk: bool = False) -> DataFrame:
    """Readings with the declared schema; ``chunk`` kept only when asked.

    One projection over the stored dataset and no schema round trip: each
    extra DataFrame step costs a driver-side re-analysis per query.
    """
    cols = READING_COLUMNS + (["chunk"] if with_chunk else [])
    return stored_readings(spark, handle).select(*cols)


def meter_id_from_user(user_id: Column) -> Column:
    """Ten-digit meter id whose first digit (the region) is ``user_id % 10``."""
    return F.concat((user_id % 10).cast("string"),
                    F.lpad(user_id.cast("string"), METER_ID_LENGTH - 1, "0"))


def readings_from_events(events: DataFrame) -> DataFrame:
    """Readings view over an ``events`` table (test input, see FIXTURES §2)."""
    volts = (F.lit(225) + F.col("event_id") % 11).cast("double")
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        meter_id_from_user(F.col("user_id")).alias("meter_id"),
        F.col("value").alias("power"),
        volts.alias("voltage"),
        (F.col("value") / volts).alias("current"),
        (F.lit(50) + (F.col("event_id") % 5 - 2) * F.lit(0.1)).alias("frequency"),
        (F.col("value") * 5 / 60 / 1000).alias("energy"),
    )


def events_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows meeting NOT NULL time/id and id length <= 10, all other rows).

    Both sides come from one predicate, so each row lands in exactly one.
    """
    ok = (F.col("timestamp").isNotNull() & F.col("meter_id").isNotNull()
          & (F.length("meter_id") <= METER_ID_LENGTH))
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))


def derive_measures(df: DataFrame, minutes: float = 5.0) -> DataFrame:
    """Fill ``current = power / voltage`` and ``energy = power*minutes/60/1000``.

    Existing values are kept; a zero voltage yields NULL instead of an error.
    """
    def existing(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    current = F.try_divide(F.col("power"), F.col("voltage"))
    energy = F.col("power") * F.lit(minutes) / 60 / 1000
    return (df.withColumn("current", F.coalesce(existing("current"), current))
              .withColumn("energy", F.coalesce(existing("energy"), energy)))
