"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import os
from collections.abc import Callable, Iterator
from functools import cache

import meterlake
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_path

# Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage and computes shared input once; a lost executor then only
    rereads files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where it lies.

    On a cluster the package is installed or sent with the job; this helps
    where driver and workers share the folder but not the working directory.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(meterlake.__file__)))
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


# Bytes of a batch that a Python worker turns into objects at a time.
PART_BYTES = 4 << 20
_KEPT: dict[tuple, object] = {}


def kept(owner: str, key: str, make: Callable) -> object:
    """An operator's tables in a worker, made once; those of other operators go."""
    forget(owner)
    if (owner, key) not in _KEPT:
        give_back()
        _KEPT[owner, key] = make(key)
    return _KEPT[owner, key]


def give_back() -> None:
    """Hand memory that earlier operators' tables and batches took in this worker back to the system."""
    gc.collect()
    trim()


def trim() -> None:
    """The same without a search for garbage in cycles: quick enough for the end of every task."""
    pa.default_memory_pool().release_unused()
    if (malloc_trim := _malloc_trim()) is not None:
        malloc_trim(0)


@cache
def _malloc_trim() -> Callable | None:
    libc = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None


def by_batch(df: DataFrame, run: Callable, schema, owner: str | None = None) -> DataFrame:
    """``mapInArrow`` in small parts, with this package on the workers' path.

    ``owner``: whose tables (``kept``) the worker may go on holding.
    """
    ship(df.sparkSession)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * PART_BYTES // max(batch.nbytes, PART_BYTES))
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(owner)
        yield from run(parts(batches))
        trim()
    return df.mapInArrow(small, schema)


def forget(owner: str | None) -> None:
    """Drop what this worker keeps for operators other than ``owner``, and free its memory."""
    others = [k for k in _KEPT if k[0] != owner]
    for other in others:
        del _KEPT[other]
    if others:
        give_back()


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs.

    They go when the driver collects the objects that own them; on a large
    job this keeps the disk from holding every earlier shuffle.  The scheduler
    holds the last job's plan until another one ends, so an empty one is run.
    """
    gc.collect()
    spark.range(1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# Words of 64 bits in an id filter: the table has at most so many rows.
FILTER_WORDS = 1 << 20


def id_filter(ids: DataFrame, column: str) -> DataFrame:
    """Bit table of a set of ids, for ``maybe_in``; at most ``FILTER_WORDS`` rows of 16 bytes."""
    word, bit = _filter_place(F.col(column))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return ids.select(word.alias("word"), one.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def _filter_place(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return F.pmod(h, F.lit(FILTER_WORDS)), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int")


def maybe_in(df: DataFrame, column: str, bits: DataFrame, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have an id of the set, and those that have none.

    ``key``: the column as the set has it, where the types differ.

    Wrongly taken rows are few while the set is smaller than the table's 64
    million bits, and more beyond; none is missed.  It spares large rows a
    shuffle before an exact join; the table's fixed size allows its broadcast.
    """
    w, b, hit = fresh(df, "word", "bits", "hit")
    word, bit = _filter_place(F.col(f"`{column}`") if key is None else key)
    d = df.withColumn(w, word).join(F.broadcast(bits.select(F.col("word").alias(w), F.col("bits").alias(b))), w, "left")
    d = d.withColumn(hit, F.coalesce(F.getbit(b, bit), F.lit(0)) == 1)
    names = [f"`{c}`" for c in df.columns]
    return d.filter(hit).select(*names), d.filter(~F.col(hit)).select(*names)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """Words of a text; an empty array for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names."""
    return df.select(*(F.col(f"`{c}`").alias(k) for k, c in columns.items()))
