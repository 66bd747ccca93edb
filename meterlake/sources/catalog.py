"""Partition and table catalogues built from the file listing.

The ``binaryFile`` source is used only for its listing: selecting ``path``
and ``length`` keeps file contents unread (``ReadSchema`` is just those two
columns), and the listing itself is done in parallel by Spark's file index.  Files are
summed by partition in a few tasks, and only partition rows reach the driver.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote as url_decoded

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.format import human_bytes, sorted_report
from meterlake.functions.time import sql_string, width_micros
from meterlake.session import session_conf
from meterlake.sources import files
from meterlake.sources.schema import is_table


def location(spark: SparkSession, handle: str) -> str:
    """Folder of a dataset handle (a catalog table's storage location)."""
    if not is_table(handle):
        return handle
    rows = (spark.sql(f"DESCRIBE TABLE EXTENDED {handle}")
            .filter(F.col("col_name") == "Location").select("data_type").take(1))
    if not rows:
        raise ValueError(f"table {handle} has no storage location")
    return rows[0][0]


def _label_start(label):
    """``yyyy-MM-dd[-HH]`` partition text -> UTC TIMESTAMP of its start."""
    hour = F.when(F.length(label) > 10, F.substring(label, 12, 2).cast("int")).otherwise(0)
    return F.make_timestamp(
        F.substring(label, 1, 4).cast("int"), F.substring(label, 6, 2).cast("int"),
        F.substring(label, 9, 2).cast("int"), hour, F.lit(0), F.lit(0).cast("decimal(8,6)"),
        F.lit("UTC"))


# Folder, inside a table's own, of partitions that compaction has rewritten;
# its name hides it from readers of the table's folder.
REWRITTEN = "_compacted"
# Batch number of what compaction has merged.
MERGED_BATCH = -1


def list_files(spark: SparkSession, handle: str) -> DataFrame:
    """(path, length) of every data file under the dataset, whether in use or not."""
    root = location(spark, handle).rstrip("/")
    paths = [root, f"{root}/{REWRITTEN}"] if files.exists(spark, f"{root}/{REWRITTEN}") else [root]
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(paths).select("path", "length"))


PARTITION_SCHEMA = "chunk string, ingest_batch bigint, n_files bigint, bytes bigint, folder string"
# A listing reads no file, so file sizes must not spread it over one task per file.
LISTING_CONF = {"spark.sql.files.maxPartitionBytes": "1024t", "spark.sql.files.openCostInBytes": "0"}


def list_folders(spark: SparkSession, handle: str, partition_col: str = "chunk") -> list:
    """Files and bytes of every partition folder, also of those no longer in use."""
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    batch = F.nullif(part("ingest_batch"), F.lit("")).cast("bigint")
    merged = F.col("path").contains(f"/{REWRITTEN}/") & F.col("path").contains("/below=")
    with session_conf(spark, LISTING_CONF):
        return (list_files(spark, handle)
                .groupBy(F.url_decode(part(partition_col)).alias("chunk"),
                         F.when(merged, MERGED_BATCH).otherwise(batch).alias("ingest_batch"),
                         F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"))
                .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
                .select("chunk", "ingest_batch", "n_files", "bytes", "folder")
                .orderBy("chunk", "ingest_batch", "folder").collect())


def partition_spec(chunk: str, ingest_batch: int | None = None) -> str:
    batch = "" if ingest_batch is None else f", ingest_batch={ingest_batch}"
    return f"PARTITION (chunk={sql_string(chunk)}{batch})"


def partition_folder(spark: SparkSession, table: str, spec: str) -> str:
    """Where the catalogue says a partition's files are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").filter(F.col("col_name") == "Location")
    return rows.select("data_type").first()[0]


def _tail(folder: str) -> str:
    """What tells a rewritten folder from any other, whatever the scheme of the path."""
    return folder.split(f"/{REWRITTEN}/", 1)[1].rstrip("/") if f"/{REWRITTEN}/" in folder else ""


def list_partitions(spark: SparkSession, handle: str, partition_col: str = "chunk") -> list:
    """Files and bytes of every partition in use, one row each, with its folder.

    ``ingest_batch`` is NULL where the dataset is not partitioned by it.  The
    catalogue is asked about chunks that have been rewritten: which of their
    partitions there still are, and, where there are several folders, which
    of them a partition's files are in.
    """
    rows = list_folders(spark, handle, partition_col)
    rewritten = {r["chunk"] for r in rows if _tail(r["folder"])}
    if not rewritten:
        return rows
    known = {url_decoded(r[0]) for r in spark.sql(f"SHOW PARTITIONS {handle}").collect()}
    found: dict[tuple, list] = {}
    for r in rows:
        found.setdefault((r["chunk"], r["ingest_batch"]), []).append(r)
    out = []
    for (chunk, batch), folders in found.items():
        if chunk in rewritten:
            name = f"{partition_col}={chunk}" + ("" if batch is None else f"/ingest_batch={batch}")
            if name not in known:
                continue
            if len(folders) > 1:
                here = _tail(partition_folder(spark, handle, partition_spec(chunk, batch)))
                folders = [r for r in folders if _tail(r["folder"]) == here]
        out += folders
    return out


def partition_catalog(spark: SparkSession, handle: str, width: str = "1 day",
                      table: str | None = None, partition_col: str = "chunk") -> DataFrame:
    """One row per partition: table, chunk, range_start, range_end, n_files, bytes."""
    w = width_micros(width)
    found = spark.createDataFrame(list_partitions(spark, handle, partition_col), PARTITION_SCHEMA)
    parts = found.groupBy("chunk").agg(F.sum("n_files").alias("n_files"), F.sum("bytes").alias("bytes"))
    start = _label_start(F.col("chunk"))
    return parts.select(
        F.lit(table or handle).alias("table"), "chunk",
        start.alias("range_start"),
        F.timestamp_micros(F.unix_micros(start) + F.lit(w)).alias("range_end"),
        "n_files", "bytes")


def union_catalogs(spark: SparkSession, tables: dict[str, tuple[str, str]],
                   partition_col: str = "chunk") -> DataFrame:
    """Partition catalogues of ``{name: (handle, width)}`` in one DataFrame."""
    parts = [partition_catalog(spark, h, w, name, partition_col)
             for name, (h, w) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def partition_summary(catalog: DataFrame) -> DataFrame:
    """Partition count and date range per table."""
    out = catalog.groupBy("table").agg(
        F.count(F.lit(1)).alias("num_chunks"),
        F.min(F.to_date("range_start")).alias("earliest_chunk"),
        F.max(F.to_date("range_end")).alias("latest_chunk"))
    return sorted_report(out, "table")


def partition_sizes(catalog: DataFrame) -> DataFrame:
    """Per-partition size with readable text, in time order."""
    out = catalog.select("table", "chunk", F.to_date("range_start").alias("start_date"),
                         F.to_date("range_end").alias("end_date"), "n_files", "bytes",
                         human_bytes("bytes").alias("chunk_size"))
    return out.orderBy("table", "chunk")


def table_catalog(catalog: DataFrame) -> DataFrame:
    """Totals per table from a partition catalogue, largest first."""
    out = (catalog.groupBy("table")
           .agg(F.count(F.lit(1)).alias("n_partitions"),
                F.sum("n_files").alias("n_files"),
                F.sum("bytes").alias("bytes"))
           .withColumn("total_size", human_bytes("bytes")))
    return sorted_report(out, F.col("bytes").desc(), "table")


def table_sizes(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    return table_catalog(union_catalogs(spark, tables))
