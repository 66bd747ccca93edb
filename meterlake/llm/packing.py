"""Best-fit packing of tokenized documents into fixed-length sequences (operator 4).

Best-two-fit needs only the number of pieces of each length.  The driver
packs that histogram (at most ``capacity`` numbers, whatever the input) and
gets bin patterns with multiplicities; every piece then finds its place from
its rank among the pieces of its length, which Spark counts in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.encode import END_ID, encoder, end_mark, tokenizer_path
from meterlake.llm.shared import by_batch, pick, saved, ship, table

CAPACITY = 1024
PIECE_SCHEMA = "piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"


def _cut_rows(path: str, end_id: int | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), end_mark(end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, ids = [], []
                for i, full in enumerate(enc.encode(part.column("text").to_pylist())):
                    full += end
                    ids.append(full)
                    n = len(full) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n else [0, 0]
                    for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                        rows.append((i, k, s, e - s, zlib.crc32(memoryview(full)[4 * s:4 * e])))
                i, k, s, n, crc = (np.array(x) for x in zip(*rows))
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.record_batch(
                    [part.column("doc_id").take(pa.array(i)), pa.array(k.astype(np.int32)),
                     pa.array(s.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(crc.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), flat)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                 end_id: int | None = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Token ids of every row in pieces of at most ``capacity`` ids.

    Columns ``doc_id, piece, start, length, ids_crc32, ids``.  Only longer
    documents are cut; the first piece takes the remainder, the others are
    full.  A NULL text counts as empty.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return pick(docs, doc_id=doc_id, text=text).transform(
        by_batch, _cut_rows(tokenizer or tokenizer_path(), end_id, capacity), f"doc_id {kind}, {PIECE_SCHEMA}", owner="encode")


@dataclass
class Pattern:
    """``copies`` bins that hold pieces of these lengths, in this order."""
    lengths: list[int]
    copies: int


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Pack ``counts[length]`` pieces of each length 1..capacity.

    Each bin is filled greedily with the largest piece that fits; then its
    smallest piece gives way to the two unpacked pieces that fill the widened
    gap best, if they fill more.  Equal bins are made at once, as often as
    the counts allow, so the work depends on the lengths, not on the pieces.
    """
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"piece length {length} outside 1..{capacity}")
        left[length] = n
    out = []
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        bin_, used, gap, at = [], {}, capacity, top
        while at:  # greedy fill
            n = min(left[at], gap // at) if at <= gap else 0
            if n:
                bin_ += [at] * n
                used[at] = n
                gap -= n * at
            at = min(at - 1, gap)
        if gap and len(bin_) > 1:
            small = bin_[-1]
            free = lambda x: left[x] - used.get(x, 0)
            wide = gap + small
            best, pair = small, None
            lower = [0] * (wide + 1)  # largest unpacked length up to this one
            for x in range(1, wide + 1):
                lower[x] = x if free(x) > 0 else lower[x - 1]
            for a in range(wide - 1, 0, -1):
                if 2 * a <= best or best == wide:
                    break
                if free(a) > 0:
                    b = lower[min(wide - a, a)]
                    if b == a and free(a) < 2:
                        b = lower[a - 1]
                    if b and a + b > best:
                        best, pair = a + b, (a, b)
            if pair:
                bin_[-1:] = pair
        need: dict[int, int] = {}
        for x in bin_:
            need[x] = need.get(x, 0) + 1
        copies = min(left[x] // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= n * copies
        out.append(Pattern(bin_, copies))


def _slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """One row per place in a pattern: which ranks of which length go there."""
    length, rank, sequence, offset = [], [], [], []
    taken: dict[int, int] = {}
    base = 0
    for p in patterns:
        at = 0
        for x in p.lengths:
            length.append(x)
            rank.append(taken.get(x, 0))
            sequence.append(base)
            offset.append(at)
            taken[x] = taken.get(x, 0) + p.copies
            at += x
        base += p.copies
    cols = {"length": length, "rank": rank, "sequence": sequence, "offset": offset}
    cols = {k: np.array(v, np.int64) for k, v in cols.items()}
    order = np.lexsort((cols["rank"], cols["length"]))
    return {k: v[order] for k, v in cols.items()} | {"key": (cols["length"] << 48 | cols["rank"])[order]}


PER_GROUP = 20_000


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to pieces (``doc_id, piece, length, ids_crc32`` ...).

    ``pieces`` is read three times and should be a stored table.  Pieces of
    one length are numbered in groups of about ``PER_GROUP`` by a hash of
    their key, so a frequent length does not meet in one task.  Pieces of
    length 0 (empty text without end id) take no place: both columns NULL.
    Columns ``g, r, p, n, base, sequence_id, offset`` of the pieces are
    overwritten.
    """
    spark = pieces.sparkSession
    groups = max(1, pieces.count() // PER_GROUP)
    pieces = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = pieces.groupBy("length", "g").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {r[0]: r[1] for r in pieces.filter("length > 0").groupBy("length").count().collect()}  # <= capacity rows
    ship(spark)
    slots = spark.sparkContext.broadcast(_slots(best_two_fit(counts, capacity)))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s, n, r = slots.value, length.to_numpy(), rank.to_numpy()
        i = np.searchsorted(s["key"], n << 48 | r, "right") - 1
        return pd.DataFrame({"sequence_id": s["sequence"][i] + r - s["rank"][i], "offset": s["offset"][i]})

    order = Window.partitionBy("length", "g").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.filter("length > 0").withColumn("r", F.row_number().over(order) - 1)
              .join(sizes.select("length", "g", "base"), ["length", "g"])
              .withColumn("p", place("length", F.col("r") + F.col("base")))
              .withColumns({"sequence_id": F.col("p.sequence_id"), "offset": F.col("p.offset")}))
    names = [c for c in pieces.columns if c != "g"]
    none = F.lit(None).cast("bigint")
    empty = pieces.filter("length = 0").select(*names, none.alias("sequence_id"), none.alias("offset"))
    return ranked.select(*names, "sequence_id", "offset").unionByName(empty)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, offsets`` from placed pieces with their ``ids``.

    A sequence has at most ``capacity`` ids, so its group is small.
    """
    one = F.struct("offset", "doc_id", "ids")
    got = F.sort_array(F.collect_list(one))
    return (placed.filter("sequence_id is not null").groupBy("sequence_id").agg(got.alias("p"))
            .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                   end_id: int | None = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack all rows; one row per piece with its place.

    Repeated rows are packed once each.  NULL text: empty.  A long text is cut
    into as many pieces as it needs.  NULL or repeated ids are kept; other
    columns are left out, whatever their names.  ``with_ids`` keeps the token ids (for ``packed_sequences``).
    An empty table gives no pieces.
    """
    pieces = token_pieces(docs, doc_id, text, tokenizer, end_id, capacity)
    return place_pieces(saved(pieces if with_ids else pieces.drop("ids"), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
