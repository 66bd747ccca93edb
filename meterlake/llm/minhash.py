"""Document fingerprints by MinHash (operator 7).

A fingerprint is the least value of each of ``N_HASHES`` universal hash
functions over a text's 5-word shingles.  The share of equal values estimates
the Jaccard similarity of two texts' shingle sets; equal texts have equal
fingerprints.  Texts that share a band of their fingerprints are compared
exactly, and form classes of near-duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from meterlake.llm import jaccard as tiles
from meterlake.llm.components import components
from meterlake.llm.shared import by_batch, id_filter, maybe_in, pick, release, saved, table
from meterlake.llm.shingles import constants, window_hashes, word_hashes

SHINGLE_WORDS = 5
N_HASHES = 128
BANDS = 25  # of 5 values: a pair at 0.8 shares none once in 20 000
_FACTORS = constants(SHINGLE_WORDS, 71)
_A, _B = constants(N_HASHES, 72), constants(N_HASHES, 73)
_BLOCK = 1 << 14


def shingle_hashes(text: str) -> np.ndarray:
    """One number per shingle, repeats included; fewer than five words: the
    whole sequence as one shingle; no words: none."""
    h = word_hashes(text.encode().split())
    width = min(SHINGLE_WORDS, len(h))
    return window_hashes(h, width, _FACTORS[:width]) if width else h


def signatures(texts: list[str]) -> np.ndarray:
    """Fingerprints, ``len(texts)`` x ``N_HASHES`` numbers of 16 bits.

    Hash k is the top 16 bits of a_k * x + b_k mod 2**64; the least is taken
    before the cut.  A text without words has 65535 everywhere.  Shingles are
    worked on in blocks, so memory does not grow with a text's hashes.
    """
    least = np.full((N_HASHES, len(texts)), np.iinfo(np.uint64).max, np.uint64)
    parts, owner, held = [], [], 0

    def flush() -> None:
        nonlocal parts, owner, held
        if parts:
            x = np.concatenate(parts)
            starts = np.cumsum([0, *map(len, parts[:-1])])
            own, v = np.array(owner), np.empty_like(x)
            for k in range(N_HASHES):
                np.multiply(x, _A[k], out=v)
                np.add(v, _B[k], out=v)
                np.minimum.at(least[k], own, np.minimum.reduceat(v, starts))
        parts, owner, held = [], [], 0

    for i, text in enumerate(texts):
        x = shingle_hashes(text)
        for at in range(0, len(x), _BLOCK):
            piece = x[at:at + _BLOCK]
            if held + len(piece) > _BLOCK:
                flush()
            parts.append(piece)
            owner.append(i)
            held += len(piece)
    flush()
    return (least >> np.uint64(48)).astype(">u2").T


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values, row by row: the estimated Jaccard similarity."""
    return (a == b).mean(axis=1)


def text_node(text: str) -> int | None:
    """Signed 64-bit hash of a text; None for one without words."""
    return int(np.uint64(xxh64_intdigest(text.encode())).view(np.int64)) if text.strip(" \t\n\r\x0b\x0c") else None


def edited_text(text: str, following: str) -> str:
    """The last half of the code points gives way to the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_SCHEMA = ("n_chars bigint, node bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double, part int, first_text string, last_text string")
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _compared(ids: list, texts: list[str], following: list[str], next_signature: np.ndarray | None, kind: pa.DataType):
    """Rows for ``texts``; ``next_signature``: of the last one's follower, or
    None to compute all followers' fingerprints."""
    own = signatures(texts)
    nxt = signatures(following) if next_signature is None else np.vstack([own[1:], next_signature])
    edited = [edited_text(t, f) for t, f in zip(texts, following)]
    other = signatures(edited)
    none = pa.nulls(len(texts))
    return pa.record_batch([
        pa.array(ids, kind), pa.array([len(t) for t in texts], pa.int64()), pa.array([text_node(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array([r.tobytes() for r in own], pa.binary()), pa.array([r.tobytes() for r in other], pa.binary()),
        pa.array(likeness(own, other)), pa.array(likeness(own, nxt)),
        none.cast(pa.int32()), none.cast(pa.string()), none.cast(pa.string())], names=["doc_id", *_NAMES])


def _chain(kind: pa.DataType):
    """Compare each row of a sorted partition with the next one.

    The last row's follower is in another partition: it comes out as an edge
    row, with the partition's number and its first and last text.
    """
    schema = pa.schema([("doc_id", kind), ("n_chars", pa.int64()), ("node", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()),
                        ("first_text", pa.string()), ("last_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, ids, texts = None, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids += part.column("doc_id").to_pylist()
                texts += [t or "" for t in part.column("text").to_pylist()]
                first = texts[0] if first is None else first
                if len(texts) > 1:
                    last = signatures(texts[-1:])
                    yield _compared(ids[:-1], texts[:-1], texts[1:], last, kind)
                    ids, texts = ids[-1:], texts[-1:]
        if texts:
            edge = {"doc_id": ids[0], "part": TaskContext.get().partitionId(),
                    "first_text": first, "last_text": texts[0]}
            yield pa.RecordBatch.from_pylist([edge], schema)
    return run


def _edges(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _compared(batch.column("doc_id").to_pylist(), batch.column("last_text").to_pylist(),
                                batch.column("next_text").to_pylist(), None, kind)
    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (binary) of every row, without a shuffle."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = signatures([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("doc_id"), pa.array([r.tobytes() for r in got], pa.binary())],
                                  names=["doc_id", "fingerprint"])
    return pick(docs, doc_id=doc_id, text=text).transform(by_batch, run, f"doc_id {kind}, fingerprint binary")


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every row's text and of its edited text, and the text's ``node``.

    The next document is the next row by ``doc_id`` (NULL first), rows of one
    id by text hash and text; after the last comes the first, a single row is
    its own next.  NULL text: empty; texts without words are alike.  Long texts are read whole;
    other columns are left out, whatever their names; an empty table gives no
    rows.

    Rows are dealt by id ranges and sorted, so a row's follower is at hand in
    the same task; only one row per task meets its follower afterwards, by way
    of a table with two texts per task.
    """
    kind = docs.schema[doc_id].dataType
    arrow = to_arrow_type(kind)
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    schema = f"doc_id {kind.simpleString()}, {_SCHEMA}"
    got = saved(rows.select("doc_id", "text").transform(by_batch, _chain(arrow), schema), "fingerprints")
    del rows
    release(docs.sparkSession)  # the shuffled texts
    edges = got.filter("part is not null")
    after = Window.orderBy("part")  # one row per task
    following = F.coalesce(F.lead("first_text").over(after),
                           F.first("first_text").over(after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = edges.select("doc_id", "last_text", following.alias("next_text"))
    return got.filter("part is null").unionByName(edges.transform(by_batch, _edges(arrow), schema)).drop(
        "part", "first_text", "last_text")


def band_buckets(nodes: DataFrame) -> DataFrame:
    """``key, node, pivot, is_upper`` from ``node, fingerprint``: the nodes of
    each bucket of each band (``BANDS`` of ``N_HASHES // BANDS`` values) that
    has several, with the bucket's first.  A bucket may have any number."""
    width = 2 * (N_HASHES // BANDS)
    band = lambda k: F.xxhash64(F.lit(k), F.substring("fingerprint", width * k + 1, width))
    keys = nodes.select("node", F.explode(F.array(*map(band, range(BANDS)))).alias("key"))
    keys = keys.select("key", F.lit(False).alias("is_upper"), "node").repartition("key").sortWithinPartitions("key", "node")
    return keys.transform(by_batch, tiles.shared_tiles, "key bigint, node bigint, pivot bigint, is_upper boolean")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t for t in batch.column("text").to_pylist() if t and text_node(t) is not None]
        got = [np.unique(shingle_hashes(t)) for t in texts]
        yield pa.record_batch([pa.array([text_node(t) for t in texts], pa.int64()), pa.array([len(x) for x in got], pa.int64()),
                               pa.array([tiles.bitmap(x) for x in got], pa.binary()), pa.array([x.tobytes() for x in got], pa.binary())],
                              names=["node", "n", "bits", "shingles"])


def near_duplicate_links(docs: DataFrame, nodes: DataFrame, percent: int = 80) -> DataFrame:
    """``a, b``: links that connect all ``nodes`` (``node, doc_id, fingerprint``)
    that share a bucket and are similar, each compared exactly.

    A bucket's nodes are compared with its first, then as few as could connect
    those still apart, then all that are apart even so: a family of k near
    copies gives some k candidates a band, not k * k.  The shingle sets are
    made anew from one document per node that shares a bucket.
    """
    buckets = saved(band_buckets(nodes), "buckets")
    wanted = saved(nodes.select("node", "doc_id").join(buckets.select("node").distinct(), "node"), "bucket-nodes")
    texts, _ = maybe_in(docs, "doc_id", id_filter(wanted, "doc_id"))
    sets = texts.select("text").transform(by_batch, _shingle_rows, "node bigint, n bigint, bits binary, shingles binary")
    sets, _ = maybe_in(sets, "node", id_filter(wanted, "node"))
    sets = saved(sets.dropDuplicates(["node"]), "shingle-sets")
    star = buckets.filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    links = saved(tiles.verified(star.distinct(), sets, percent), "links")
    for forest in (True, False):
        pairs = saved(tiles.apart_pairs(buckets, links, sets, forest, percent), "apart-pairs")
        links = saved(links.unionByName(tiles.verified(pairs, sets, percent, bounded=True)), "links")
    return links


def with_classes(rows: DataFrame, docs: DataFrame, percent: int = 80) -> DataFrame:
    """``rows`` (of ``compare_with_next``) with ``class_id``.

    Classes are joined by verified links of at least ``percent`` hundredths
    in Jaccard similarity of 5-word shingles; ``class_id`` is the least id
    among their rows (NULL only where all are NULL).  Equal texts are of one
    class; one without words has its own id.  The bands miss a pair at the
    threshold once in 20,000.
    """
    some = rows.filter("node is not null")
    nodes = some.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("fingerprint").alias("fingerprint"))
    nodes = saved(nodes, "text-nodes")
    links = near_duplicate_links(pick(docs, doc_id="doc_id", text="text"), nodes, percent)
    roots = components(links).select(F.col("node").alias("linked"), "root")
    nodes = saved(nodes.select("node", "doc_id").join(roots, F.col("node") == F.col("linked"), "left").select(
        F.col("node").alias("of"), "doc_id", F.coalesce("root", "node").alias("root")), "class-roots")
    least = nodes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    nodes = nodes.join(least, "root").select("of", "class_id")
    none = rows.filter("node is null").select("*", F.col("doc_id").alias("class_id"))
    return some.join(nodes, F.col("node") == F.col("of")).drop("of").unionByName(none).drop("node")


def fingerprints_and_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """``compare_with_next`` with the classes of near-duplicates (``with_classes``)."""
    docs = pick(docs, doc_id=doc_id, text=text)
    return with_classes(compare_with_next(docs), docs, percent)


def op7_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and classes of near-duplicates."""
    got = fingerprints_and_classes(table(spark, sf_dir, "documents"))
    show = lambda c: F.lower(F.hex(c)).alias(c)
    return got.select("doc_id", "n_chars", "edited_sha256", show("fingerprint"), show("edited_fingerprint"),
                      "near_edited", "near_next", "class_id")
