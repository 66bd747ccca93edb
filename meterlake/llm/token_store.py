"""Token ids of documents in ORC files (operator 10).

Rows are stored in ascending document order, ids as a list of integers (run
length encoded by ORC), with row indexes and a Bloom filter on the document
id, so that readers take single stripes and skip those without a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.encode import END_ID, encoder, end_mark, tokenizer_path
from meterlake.llm.shared import by_batch, pick, saved, table
from meterlake.session import scratch_path

# Format settings of the files.  Integers are run length encoded already, so
# a quick codec is enough on top.
ORC_OPTIONS = {
    "compression": "lz4",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _encode_rows(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), end_mark(end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # bounds the ids held at once
                part = batch.slice(at, 500)
                ids = [x + end for x in enc.encode(part.column("text").to_pylist())]
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.record_batch([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                                      names=["doc_id", "ids"])
    return run


def token_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              tokenizer: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """``doc_id, ids`` of every row, in the order of the rows.

    A NULL text counts as empty and gives the end id alone.
    """
    path = tokenizer or tokenizer_path()
    kind = docs.schema[doc_id].dataType.simpleString()
    return pick(docs, doc_id=doc_id, text=text).transform(
        by_batch, _encode_rows(path, end_id), f"doc_id {kind}, ids array<int>", owner="encode")


def write_token_store(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                      tokenizer: str | None = None, end_id: int | None = END_ID) -> None:
    """Write the token ids of all documents to ORC files under ``path``.

    Rows are dealt by ranges of (document id, text hash), so one id with very
    many rows still spreads over files; text is shuffled, not ids, as it is
    smaller.  NULL ids come first, rows of one id by text.  ``row_id`` numbers
    the rows in that order (not gapless).  Ids keep their type.  Long texts
    are stored whole; repeated rows and NULL ids stay; other columns are left
    out, whatever their names.  No rows: files without rows.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    (token_ids(rows, tokenizer=tokenizer, end_id=end_id)
     .withColumn("row_id", F.monotonically_increasing_id())
     .write.options(**ORC_OPTIONS).orc(path))


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids, row_id`` of a token store, the id in the type it was written in."""
    got = spark.read.orc(path)
    kinds = dict(got.dtypes)
    if kinds.get("ids") != "array<int>" or kinds.get("row_id") != "bigint" or "doc_id" not in kinds:
        raise ValueError(f"no token store: {got.schema.simpleString()}")
    return got.select("doc_id", "ids", "row_id")


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        at = ids.offsets.to_numpy()
        # The ids of all the rows that came together, of which this may be a part: seen as bytes, not copied.
        flat = memoryview(ids.values.to_numpy(zero_copy_only=False).view(np.uint8))
        crc = [zlib.crc32(flat[4 * s:4 * e]) for s, e in zip(at[:-1], at[1:])]
        yield pa.record_batch([batch.column("doc_id"), batch.column("row_id"),
                               pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                              names=["doc_id", "row_id", "n_tokens", "ids_crc32"])


def store_digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document.

    ``start`` counts the ids of all rows before this one.  It is summed within
    each writing task's rows, and over the tasks' totals (one row each).
    """
    store = read_token_store(spark, path)
    light = saved(store.transform(
        by_batch, _digest_rows, f"doc_id {dict(store.dtypes)['doc_id']}, row_id bigint, n_tokens bigint, ids_crc32 bigint", owner="encode"), "token-digest")
    light = light.withColumn("task", F.shiftright("row_id", 33))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = (light.groupBy("task").agg(F.sum("n_tokens").alias("total"))
              .select("task", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("task").orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1)
    return (light.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(totals, "task")
            .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as an ORC token store and read back."""
    path = scratch_path(spark, "token-store")
    write_token_store(table(spark, sf_dir, "documents"), path)
    return store_digest(spark, path)
