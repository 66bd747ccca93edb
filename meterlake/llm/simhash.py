"""SimHash near-duplicates by segment popcounts (operator 9).

Fingerprints are embedded as the bit counts of their 32 two-bit segments.
The Manhattan distance of two such vectors never exceeds the bit distance, so
fingerprints within 3 bits have, in one of their two halves, vectors at
distance 0 or 1.  A grid over each half's vectors finds those: a fingerprint
stands in its own cell and probes the cells one step above.  What meets in a
cell is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from meterlake.llm.components import components
from meterlake.llm.shared import by_batch, fresh, id_filter, maybe_in, pick, saved, table

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_SEGMENTS = 16  # in a half


def simhash(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half the shingles' XXH64.

    A-Z in lower case; shingles of ``width`` words joined by blanks, repeats
    included; fewer words: the whole sequence; none (or NULL): 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    shingles = map(b" ".join, zip(*(words[j:] for j in range(width))))
    n = len(words) - width + 1
    h = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    count = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = h[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row (``fp`` as a signed 64-bit number)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t, width) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(fp.view(np.int64))],
                                  names=["doc_id", "text_hash", "fp"])
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("text_hash", F.xxhash64("text"))
    return rows.transform(by_batch, run, f"doc_id {kind}, text_hash bigint, fp bigint")


def segment_counts(half: Column) -> Column:
    """Bit counts of the two-bit segments of a 32-bit number, two bits each."""
    ones = F.lit(0x55555555)
    return half.bitwiseAND(ones) + F.shiftrightunsigned(half, 1).bitwiseAND(ones)


def grid_rows(fps: DataFrame) -> DataFrame:
    """``cell, probe, fp``: per half the own cell (``probe`` false) and the cells one step above."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    halves = F.explode(F.array(*(F.struct(F.lit(k).alias("half"), segment_counts(x).alias("own"))
                                 for k, x in enumerate((low, high)))))
    c = fps.select("fp", halves.alias("x")).select("fp", "x.half", "x.own")
    steps = [F.when(F.shiftrightunsigned("own", 2 * j).bitwiseAND(F.lit(3)) < 2, F.col("own") + F.lit(1 << 2 * j))
             for j in range(_SEGMENTS)]
    cells = F.posexplode(F.array(F.col("own"), *steps))
    c = c.select("fp", "half", cells.alias("at", "v")).filter("v is not null")
    return c.select((F.col("v") * 2 + F.col("half")).alias("cell"), (F.col("at") > 0).alias("probe"), "fp")


def _links(own: np.ndarray, probes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever is linked in a cell: own x own and probes x own.

    A row at a time against all own fingerprints; a link is kept only if it
    joins two parts, so a cell gives fewer links than it has fingerprints.
    """
    every = np.concatenate([own, probes])
    part, out = np.arange(len(every)), []
    for i in range(1, len(every)):
        near = np.flatnonzero(np.bitwise_count(own[:min(i, len(own))] ^ every[i]) <= max_bits)
        if len(near):
            parts, first = np.unique(part[near], return_index=True)
            for p, k in zip(parts.tolist(), near[first].tolist()):
                if part[i] != p:
                    out.append((int(every[i]), int(own[k])))
                    part[part == p] = part[i]
    return out


def _cell_links(max_bits: int):
    """Links of every cell in rows sorted by cell, own fingerprints first."""
    def cells(cell: np.ndarray, probe: np.ndarray, fp: np.ndarray) -> list[tuple[int, int]]:
        edge = np.flatnonzero(np.diff(cell)) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(cell)]])
        busy = (ends - starts > 1) & ~probe[starts]
        out = []
        for s, e in zip(starts[busy].tolist(), ends[busy].tolist()):
            k = s + int(np.searchsorted(probe[s:e], True))
            if e - s == 2:
                if (int(fp[s]) ^ int(fp[s + 1])).bit_count() <= max_bits:
                    out.append((int(fp[s]), int(fp[s + 1])))
            else:
                out += _links(fp[s:k], fp[k:e], max_bits)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(links):
            ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.record_batch([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            got = (batch.column("cell").to_numpy(), batch.column("probe").to_numpy(zero_copy_only=False),
                   batch.column("fp").to_numpy().view(np.uint64))
            last = int(np.searchsorted(got[0], got[0][-1]))  # where the batch's last, open cell starts
            if last or (held and held[0][0][0] != got[0][0]):
                held.append(tuple(x[:last] for x in got))
                yield batch_of(cells(*map(np.concatenate, zip(*held))))
                held = [tuple(x[last:] for x in got)]
            else:
                held.append(got)
        if held:
            yield batch_of(cells(*map(np.concatenate, zip(*held))))
    return run


def link_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``node, root`` of the distinct fingerprints ``fp`` that have a link."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid finds links of at most 3 bits")
    rows = grid_rows(fps)
    links = rows.repartition("cell").sortWithinPartitions("cell", "probe").transform(by_batch, _cell_links(max_bits), "a bigint, b bigint")
    return components(links)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, first_hash`` of every row.

    Rows are linked if their fingerprints differ in ``max_bits`` bits or
    fewer; ``component_id`` is the least id reachable (NULL only where all
    are NULL), ``first_hash`` the least text hash among that id's rows.  Equal
    fingerprints meet before the grid, so copies cost one row each.  Texts
    without words share fingerprint 0.  Repeated rows and NULL ids stay; an
    empty table gives no rows.
    """
    rows = saved(fingerprints(docs, doc_id, text, width), "simhash")
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    fps = saved(rows.groupBy("fp").agg(F.min(one).alias("first")), "distinct-fingerprints")
    roots = link_components(fps.select("fp"), max_bits)
    fps = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = fps.groupBy("root").agg(F.min("first").alias("least"))
    fps = fps.join(least, "root").select(F.col("fp").alias("f"), F.col("least.doc_id").alias("component_id"),
                                         F.col("least.text_hash").alias("first_hash"))
    return rows.join(fps, rows.fp == fps.f).select("doc_id", "text_hash", "fp", "component_id", "first_hash")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every component of ``docs``: that with the least id (then text hash).

    Only rows whose id may be dropped, or that may be there twice, are
    shuffled; the others go through as they are read.
    """
    groups = saved(near_duplicates(docs, doc_id, text, **options), "near-duplicates")
    mine = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    rows = groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.max(mine).alias("first"))
    rows = saved(rows, "near-duplicate-rows")
    doubtful = id_filter(rows.filter(~F.col("first") | (F.col("n") > 1)), "doc_id")
    some, none = maybe_in(docs, doc_id, doubtful)
    h, a, b = fresh(docs, "text_hash", "first_id", "first_hash")
    first = rows.filter("first").select(F.col("doc_id").alias(a), F.col("text_hash").alias(b))
    some = some.withColumn(h, F.xxhash64(F.col(f"`{text}`")))
    some = some.join(first, F.col(f"`{doc_id}`").eqNullSafe(F.col(a)) & (F.col(h) == F.col(b)), "left_semi")
    return some.dropDuplicates([doc_id, h]).drop(h).unionByName(none)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
