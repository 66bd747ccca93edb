"""Exact repeated passages by fixed-block anchors (operator 8).

A passage is a window of ``WINDOW`` words; any such window holds a whole
block of ``BLOCK`` words that stands at a multiple of ``BLOCK`` in its own
document.  Those non-overlapping blocks are the index; every rolling
``BLOCK``-word window of every document probes it.  A hit in two documents is
extended: all ``WINDOW``-word windows around it are compared by a 96-bit
hash, and the neighbours that repeat are joined to maximal repeats.

Rolling windows are many, so they travel packed: per destination one row with
the hashes, places and documents of a run of documents.  The index and the
probes of a destination are read in turn, sorted by kind, so a task holds the
distinct hashes of its share and never all rows of a frequent passage.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from meterlake.llm.shared import by_batch, fresh, id_filter, maybe_in, pick, release, saved, table
from meterlake.llm.shingles import constants, window_hashes, word_hashes

WINDOW, BLOCK = 50, 25
# Text bytes for each share of the hash space, and least number of shares.
SHARE_BYTES, LEAST_SHARES = 64 << 20, 24
_BLOCK_F, _WINDOW_F, _CHECK_F = constants(BLOCK, 81), constants(WINDOW, 82), constants(WINDOW, 83)
_PACKED = "part int, kind int, h binary, pos binary, docs binary, hashes binary, n binary"
_NAMES = [c.split()[0] for c in _PACKED.split(", ")]
INDEX, PROBE, INDEX_AGAIN = 0, 1, 2  # the kinds, in reading order


def _planes(x: np.ndarray) -> bytes:
    """Numbers with their bytes sorted by weight: the high ones compress well."""
    return np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _packed_rows(parts: int, kind: int, h: np.ndarray, key: np.ndarray, pos: np.ndarray,
                 doc: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    """Rows per share: ``h`` (some bytes each), places, documents and rows per
    document.  ``key``: 64-bit hashes that choose the share; ``doc``:
    index into ``ids``, ascending."""
    part = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    part = part.astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    h, pos, doc = np.ascontiguousarray(h[order]), pos[order], doc[order]
    out = []
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        s, e = int(cuts[p]), int(cuts[p + 1])
        new = np.flatnonzero(np.diff(doc[s:e], prepend=-1))
        own = doc[s:e][new]
        out.append((p, kind, h[s:e].tobytes(), _planes(pos[s:e]),
                    np.diff(ids[own], prepend=np.int64(0)).tobytes(), hashes[own].tobytes(),
                    _planes(np.diff(np.append(new, e - s)))))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)


def _read(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``part, kind, h, pos, ids, hashes, n`` of each packed row; ``ids`` one per document."""
    c = [batch.column(n) for n in _NAMES]
    for i in range(batch.num_rows):
        n = _unplanes(c[6][i].as_py())
        yield (c[0][i].as_py(), c[1][i].as_py(), c[2][i].as_py(), _unplanes(c[3][i].as_py()),
               np.cumsum(np.frombuffer(c[4][i].as_py(), np.int64)), np.frombuffer(c[5][i].as_py(), np.int64), n)


def _block_hashes(words: list[bytes]) -> np.ndarray:
    return window_hashes(word_hashes(words), BLOCK, _BLOCK_F)


def _anchor_rows(parts: int) -> Callable:
    """Index and probe rows of whole documents, some hundred thousand words at a time."""
    room = min(max(2000 * parts, 300_000), 4_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes = [], []

        def flush() -> pa.RecordBatch:
            n = np.array([len(x) for x in hashes])
            h, doc = np.concatenate(hashes), np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            key, none = np.array(ids, np.int64), np.zeros(len(n), np.int64)
            low = h.view(np.uint8).reshape(-1, 8)[:, :5]  # the share tells most of the others
            rows = _packed_rows(parts, PROBE, low, h, pos, doc, key, none)
            at = np.flatnonzero(pos % BLOCK == 0)
            for kind in (INDEX, INDEX_AGAIN):
                rows += _packed_rows(parts, kind, low[at], h[at], pos[at], doc[at], key, none)
            return _batch(rows)
        held = 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = text.encode().split()
                if len(words) >= WINDOW:
                    ids.append(i)
                    hashes.append(_block_hashes(words))
                    held += len(hashes[-1])
                if held >= room:
                    yield flush()
                    ids, hashes, held = [], [], 0
        if held:
            yield flush()
    return run


class _Least:
    """Least document of each key ``(h, check)``, gathered from many arrays."""

    def __init__(self) -> None:
        self.parts, self.size, self.limit = [], 0, 1 << 20

    def add(self, h: np.ndarray, check: np.ndarray, doc: np.ndarray) -> None:
        self.parts.append((h, check, doc))
        self.size += len(h)
        if self.size > self.limit:
            self.settle()

    def settle(self) -> None:
        h, check, doc = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (
            np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        order = np.lexsort((doc, check, h))
        h, check, doc = h[order], check[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        self.h, self.check, self.doc = h[new], check[new], doc[new]
        self.most = np.full(len(self.h), np.iinfo(np.int64).min)  # greatest document that probed
        self.parts, self.size = [(self.h, self.check, self.doc)], len(self.h)
        self.limit = 2 * self.size + (1 << 20)

    def find(self, h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``h`` that have a key, and the place of the key."""
        if not len(self.h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.h, h)
        row = np.arange(len(h))
        rows, places = [], []
        while len(row):
            inside = at < len(self.h)
            row, at = row[inside], at[inside]
            same = self.h[at] == h[row]
            row, at = row[same], at[same]
            hit = self.check[at] == check[row]
            rows.append(row[hit])
            places.append(at[hit])
            row, at = row[~hit], at[~hit] + 1
        return np.concatenate(rows), np.concatenate(places)


def _hashes5(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = np.zeros((len(b) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    h = wide.view("<u8").ravel()
    return h, np.zeros(len(h), np.uint32)


def _hashes12(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b, np.uint8).reshape(-1, 12)
    return (np.ascontiguousarray(both[:, :8]).view("<u8").ravel(), np.ascontiguousarray(both[:, 8:]).view("<u4").ravel())


def _match(decode: Callable) -> Callable:
    """Join a share's probes to its index.

    A probe matters if a smaller document has its hash in the index; an index
    entry matters if a larger document probed it.  Out: per document the
    places that matter, ``side`` 1 for probes and 0 for index entries.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, least, open_ = None, _Least(), True
        for batch in batches:
            out: list[tuple] = []
            for part, kind, h, pos, ids, hashes, n in _read(batch):
                if part != share:
                    share, least, open_ = part, _Least(), True
                h, check = decode(h)
                doc = np.repeat(ids, n)
                if kind == INDEX:
                    least.add(h, check, doc)
                    continue
                if open_:
                    least.settle()
                    open_ = False
                row, place = least.find(h, check)
                if kind == PROBE:
                    np.maximum.at(least.most, place, doc[row])
                    row = row[least.doc[place] < doc[row]]
                else:
                    row = row[least.most[place] > doc[row]]
                row = np.sort(row)
                own = np.repeat(np.arange(len(n)), n)[row]
                for k in np.unique(own).tolist():
                    s, e = np.searchsorted(own, [k, k + 1])
                    out.append((int(ids[k]), int(hashes[k]), int(kind == PROBE), _planes(pos[row[s:e]])))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    names=["doc_id", "text_hash", "side", "pos"])
    return run


_HITS = "doc_id bigint, text_hash bigint, side int, pos binary"


def _marked(places: list[bytes] | None, before: int, n: int) -> np.ndarray:
    """Window starts 0..n-1 that lie at, or up to ``before`` ahead of, a place."""
    step = np.zeros(n + 1, np.int64)
    if places:
        p = np.concatenate([_unplanes(x) for x in places])
        np.add.at(step, np.clip(p - before, 0, n), 1)
        np.add.at(step, np.clip(p + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(step[:n]) > 0)


def _window_rows(parts: int) -> Callable:
    """Windows around hits: those around index blocks are looked up by those around probes."""
    room = min(max(1000 * parts, 200_000), 2_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.array([x[0] for x in held], np.int64)
            hashes = np.array([x[1] for x in held], np.int64)
            rows = []
            for kind, k in ((INDEX, 2), (PROBE, 3)):
                starts = [x[k] for x in held]
                n = np.array([len(x) for x in starts])
                if not n.sum():
                    continue
                h = np.concatenate([x[4][s] for x, s in zip(held, starts)])
                check = np.concatenate([x[5][s] for x, s in zip(held, starts)]).astype("<u4")
                both = np.hstack([h.view(np.uint8).reshape(-1, 8), check.view(np.uint8).reshape(-1, 4)])
                rows += _packed_rows(parts, kind, both, h, np.concatenate(starts),
                                     np.repeat(np.arange(len(n)), n), ids, hashes)
            return _batch(rows)
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in ("doc_id", "text_hash", "text", "refs", "probes")}
            for i, th, text, refs, probes in zip(*c.values()):
                words = text.encode().split()
                n = len(words) - WINDOW + 1
                if n <= 0:
                    continue
                refs, probes = _marked(refs, WINDOW - BLOCK, n), _marked(probes, WINDOW - BLOCK, n)
                if not len(refs) + len(probes):
                    continue
                h = window_hashes(word_hashes(words), WINDOW, _WINDOW_F)
                second = np.fromiter((xxh64_intdigest(w, 1) for w in words), np.uint64, len(words))
                held.append((i, th, refs, probes, h, window_hashes(second, WINDOW, _CHECK_F) & np.uint64(0xFFFFFFFF)))
                size += len(h)
                if size >= room:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return run


def _merge(places: list[bytes]) -> list[tuple[int, int]]:
    """Maximal word spans covered by the windows that start at these places."""
    p = np.unique(np.concatenate([_unplanes(x) for x in places]))
    new = np.flatnonzero(np.diff(p, prepend=-WINDOW - 1) > WINDOW)
    last = np.append(new[1:] - 1, len(p) - 1)
    return list(zip(p[new].tolist(), (p[last] + WINDOW).tolist()))


def _share(rows: DataFrame) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part", "kind")


def repeat_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, spans`` of the rows with words to remove.

    ``spans``: ``array<struct<start, end>>``, word numbers (end exclusive) of
    maximal runs covered by windows that also start in a row with a smaller
    id.  Rows of one id are no references for each other; rows with NULL id
    neither give nor lose words; NULL, empty and short texts have none.  Ids
    are numbers; text that is none raises.  Long texts are read whole; other
    columns may have any name.  An empty table gives no rows.  ``docs`` is read twice.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=doc_id, text=text).filter("doc_id is not null and text is not null")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_SHARES, size // SHARE_BYTES)
    anchors = rows.transform(by_batch, _anchor_rows(parts), _PACKED)
    hits = saved(_share(anchors).transform(by_batch, _match(_hashes5), _HITS), "anchor-hits")
    del anchors
    release(spark)
    side = lambda k: F.collect_list(F.when(F.col("side") == k, F.col("pos")))
    hits = hits.groupBy("doc_id").agg(side(0).alias("refs"), side(1).alias("probes"))
    hits = saved(hits, "documents-hit")  # places of a document together, and its id for the filter
    near, _ = maybe_in(rows, "doc_id", id_filter(hits, "doc_id"))
    around = near.join(hits, "doc_id").withColumn("text_hash", F.xxhash64("text"))
    windows = around.select("doc_id", "text_hash", "text", "refs", "probes").transform(by_batch, _window_rows(parts), _PACKED)
    found = saved(_share(windows).transform(by_batch, _match(_hashes12), _HITS), "window-hits")
    del around, windows, near
    release(spark)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            got = [[{"start": s, "end": e} for s, e in _merge(p)] for p in batch.column("pos").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(got, kind)],
                                  names=["doc_id", "text_hash", "spans"])
    return found.groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("pos")).transform(by_batch, spans, "doc_id bigint, text_hash bigint, spans array<struct<start:bigint,end:bigint>>")


def split_by_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, str]:
    """Rows of ``docs`` that may have words to remove, with a column of spans
    (NULL: none after all), the other rows, and the column's name.

    Only the first are joined with the spans.
    """
    h, name, a, b = fresh(docs, "text_hash", "spans", "span_id", "span_hash")
    spans = saved(repeat_spans(docs, doc_id, text), "spans").toDF(a, b, name)
    release(docs.sparkSession)
    some, none = maybe_in(docs, doc_id, id_filter(spans, a), F.col(f"`{doc_id}`").cast("bigint"))
    some = some.withColumn(h, F.xxhash64(F.col(f"`{text}`")))
    some = some.join(spans, (F.col(f"`{doc_id}`") == F.col(a)) & (F.col(h) == F.col(b)), "left")
    return some.select(*(f"`{c}`" for c in docs.columns), name), none, name


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without these word spans; each goes with the white space after it."""
    data = text.encode()
    starts = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    kept, at = [], 0
    for s, e in spans:
        kept.append(data[at:starts[s]])
        at = starts[e]
    return b"".join([*kept, data[at:]]).decode()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; other texts stay as they are.

    ``n_chars``, where there is such a column, follows the text.
    """
    some, none, name = split_by_spans(docs, doc_id, text)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if s is None else cut_words(t, [(x["start"], x["end"]) for x in s])
                     for t, s in zip(batch.column(text).to_pylist(), batch.column(name).to_pylist())]
            columns = {c: batch.column(c) for c in names}
            columns[text] = pa.array(texts, pa.string())
            if n_chars in columns:
                sizes = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                columns[n_chars] = sizes.cast(columns[n_chars].type)
            yield pa.record_batch(list(columns.values()), names=list(columns))
    return by_batch(some, cut, docs.schema).unionByName(none)


def removal_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()
    some, none, name = split_by_spans(pick(docs, doc_id=doc_id, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, digest = [], [], []
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (t or "").encode().split()
                n.append(len(words))
                for s in reversed(spans or ()):
                    del words[s["start"]:s["end"]]
                removed.append(n[-1] - len(words))
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                   pa.array(digest, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    spans = F.col(name).alias("spans")
    none = none.select("doc_id", "text", F.lit(None).cast(some.schema[name].dataType).alias("spans"))
    return by_batch(some.select("doc_id", "text", spans).unionByName(none), run,
                    f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that repeat a passage of an earlier one, removed."""
    return removal_digest(table(spark, sf_dir, "documents"))
