"""Documents with similar n-gram sets, by size-banded tiles (operator 12).

Sets of which one is at least ``PERCENT`` hundredths of the other in Jaccard
similarity lie in one size band or in two neighbouring ones.  A band bounds
the number of shingles in which a pair may differ; the shingle space is cut
into more segments than that, so a similar pair has equal content in some
segment.  A tile holds the sets of a band, and of the next one up, with the
same content in a segment.  Within a tile hashed bitmaps bound the overlap
from above by bit counts; what they let through is intersected exactly.

A tile's sets are compared with one of them first, so that a family of near
copies becomes one component by a star of links; only sets of a tile that are
still apart are compared further.  Tiles with many sets are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.components import components
from meterlake.llm.shared import by_batch, id_filter, maybe_in, pick, saved, table
from meterlake.llm.shingles import constants, mix, window_hashes, word_hashes

SHINGLE_WORDS = 4
PERCENT = 85
# Sets of a tile that are compared with each other in one go.
BLOCK = 2048
# A segment with fewer shingles is weak: it is shared by chance too often.
WEAK = 2
_FACTORS = constants(SHINGLE_WORDS, 121)
_SET, _KEY = constants(2, 122)
_MAX_SIZE = 1 << 40


def size_bands(percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Least size of each band, and the number of differences a pair may have
    whose smaller set is in the band.  The larger set is in it or in the next."""
    low, most = [1], []
    while low[-1] < _MAX_SIZE:
        high = low[-1] * 100 // percent
        most.append((100 - percent) * (high + high * 100 // percent) // (100 + percent))
        low.append(high + 1)
    return np.array(low[:-1], np.int64), np.array(most, np.int64)


def spare(differences: int) -> int:
    """Segments beyond the differences: so many agree in any similar pair, and one more."""
    return 1 + differences // 10


def text_shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingles as 64-bit numbers: A-Z in lower case; fewer
    than four words are one shingle, none are none."""
    h = word_hashes((text or "").encode().lower().split())
    width = min(SHINGLE_WORDS, len(h))
    return np.unique(window_hashes(h, width, _FACTORS[:width])) if width else h


def set_hash(x: np.ndarray) -> int:
    """Signed 64-bit hash of a set: equal sets are one node."""
    return int(mix(np.array([mix(x * _SET).sum(dtype=np.uint64) + np.uint64(len(x))], np.uint64)).view(np.int64)[0])


def segment_keys(x: np.ndarray, band: int, differences: int) -> np.ndarray:
    """Keys of a set's segments in a band, as the band cuts the shingle space.

    A similar pair agrees in more than ``spare`` segments.  A set with at most
    that many weak ones leaves them out: one that both keep is left.
    """
    if not differences:  # sets so small are similar only if equal
        return np.zeros(0, np.int64)
    extra = spare(differences)
    m = differences + 1 + extra
    at = (x % np.uint64(m)).astype(np.int64)
    content = np.zeros(m, np.uint64)
    np.add.at(content, at, x)
    keys = mix((content + np.arange(1, m + 1, dtype=np.uint64) * _KEY) ^ np.uint64(band + 1))
    weak = np.bincount(at, minlength=m) < WEAK
    return (keys[~weak] if weak.sum() <= extra else keys).view(np.int64)


def bitmap(x: np.ndarray) -> bytes:
    """Parity of the shingles at each of 4 to 8 places a shingle: bits that
    differ between two sets are at most their differences."""
    width = max(64, 1 << (4 * len(x) - 1).bit_length())
    parity = np.bincount((x >> np.uint64(20)) % np.uint64(width), minlength=width) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def narrowed(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit numbers, the wider ones folded to the narrowest."""
    words = min(map(len, maps)) // 8
    return np.array([np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, words), axis=0) for b in maps])


def may_link(maps: np.ndarray, sizes: np.ndarray, i: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Which rows row ``i`` may be similar to by their bit counts, and the counts."""
    bits = np.bitwise_count(maps ^ maps[i]).sum(axis=1, dtype=np.int64)
    return (100 + percent) * bits <= (100 - percent) * (sizes + sizes[i]), bits


def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact test of two sorted arrays."""
    if len(x) < len(y):
        x, y = y, x
    if percent * len(x) > 100 * len(y) or not len(y):
        return False
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    common = int((x[at] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _set_rows(percent: int):
    low, most = size_bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, own, upper = [], [], [], []
            for text in batch.column("text").to_pylist():
                x = text_shingles(text)
                n.append(len(x))
                node.append(set_hash(x) if len(x) else None)
                band = int(np.searchsorted(low, len(x), "right")) - 1
                own.append(segment_keys(x, band, int(most[band])) if len(x) else None)
                upper.append(segment_keys(x, band - 1, int(most[band - 1])) if band > 0 else None)
            kind = pa.list_(pa.int64())
            yield pa.record_batch([batch.column("doc_id"), pa.array(node, pa.int64()), pa.array(n, pa.int64()),
                                   pa.array(own, kind), pa.array(upper, kind)], names=["doc_id", "node", "n", "own", "upper"])
    return run


def document_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, node, n, own, upper`` of every row: hash and size of its set,
    its segments' keys in its own band and in the band below."""
    kind = docs.schema[doc_id].dataType.simpleString()
    return pick(docs, doc_id=doc_id, text=text).transform(
        by_batch, _set_rows(percent), f"doc_id {kind}, node bigint, n bigint, own array<bigint>, upper array<bigint>")


def shared_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the tiles with several sets, with the tile's first set.

    Rows come by key, those of the own band first.  Of a tile only the first
    row is remembered, so its size does not matter; tiles without a set of
    the own band are left out.
    """
    last, pivot, own, waits = None, 0, False, False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        upper = batch.column("is_upper").to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        new[0] = last is None or key[0] != last
        # A row before the batch stands for what is remembered.
        starts = np.flatnonzero(new)
        run = np.cumsum(new)
        pivots, owns = np.append(pivot, node[starts]), np.append(own, ~upper[starts])
        count = np.bincount(run, minlength=len(starts) + 1)
        out = owns[run] & (~new | (count[run] > 1))
        rows = [key[out], node[out], pivots[run][out], upper[out]]
        if waits and own and not new[0]:
            rows = [np.append(x, r) for x, r in zip((last, pivot, pivot, False), rows)]
        waits = bool(new[-1])  # the open tile has one row so far, which is not out yet
        last, pivot, own = key[-1], pivots[-1], owns[-1]
        yield pa.record_batch([pa.array(r) for r in rows], names=["key", "node", "pivot", "is_upper"])


def tiles(sets: DataFrame) -> DataFrame:
    """``key, node, pivot, is_upper`` of the tiles in which different sets meet."""
    nodes = sets.filter("size(own) > 0 or size(upper) > 0").groupBy("node").agg(
        F.first("own").alias("own"), F.coalesce(F.first("upper"), F.array().cast("array<bigint>")).alias("upper"))
    rows = nodes.select("node", F.size("own").alias("n_own"), F.posexplode(F.concat("own", "upper")).alias("at", "key"))
    rows = rows.select("key", (F.col("at") >= F.col("n_own")).alias("is_upper"), "node")
    rows = rows.repartition("key").sortWithinPartitions("key", "is_upper", "node")
    return rows.transform(by_batch, shared_tiles, "key bigint, node bigint, pivot bigint, is_upper boolean")


def _array_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [x for x in map(text_shingles, batch.column("text").to_pylist()) if len(x)]
        yield pa.record_batch([pa.array([set_hash(x) for x in got], pa.int64()), pa.array([len(x) for x in got], pa.int64()),
                               pa.array([bitmap(x) for x in got], pa.binary()), pa.array([x.tobytes() for x in got], pa.binary())],
                              names=["node", "n", "bits", "shingles"])


def set_arrays(docs: DataFrame, sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n, bits, shingles`` of the given nodes, one row each.

    Made anew from the text of one document each: arrays of all documents
    would be larger than the documents.
    """
    ids = sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = saved(ids.join(nodes, "node", "left_semi"), "tile-documents")
    texts, _ = maybe_in(docs, "doc_id", id_filter(ids, "doc_id"))
    rows = texts.select("text").transform(by_batch, _array_rows, "node bigint, n bigint, bits binary, shingles binary")
    rows, _ = maybe_in(rows, "node", id_filter(ids, "node"))
    return rows.dropDuplicates(["node"])


def _bound_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            bits = np.array([int(np.bitwise_count(np.bitwise_xor(*narrowed([a, b]))).sum()) for a, b in maps], np.int64)
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = pa.array((100 + percent) * bits <= (100 - percent) * sizes)
            yield pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return run


def _exact_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            as_set = lambda c: map(lambda s: np.frombuffer(s.as_buffer(), np.uint64), batch.column(c))
            keep = pa.array([similar(x, y, percent) for x, y in zip(as_set("set_a"), as_set("set_b"))], pa.bool_())
            yield pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return run


def _both(pairs: DataFrame, arrays: DataFrame, **columns: str) -> DataFrame:
    """Pairs ``a, b`` with columns of both sides; one row a node on the other
    side of each join, so Spark can split a node with many pairs."""
    for side in "ab":
        one = arrays.select(F.col("node").alias(side), *(F.col(c).alias(f"{k}_{side}") for k, c in columns.items()))
        pairs = pairs.join(one, side)
    return pairs


def verified(pairs: DataFrame, arrays: DataFrame, percent: int = PERCENT, bounded: bool = False) -> DataFrame:
    """The similar ones of pairs ``a, b``; ``bounded``: their bit counts are tested already."""
    if not bounded:
        pairs = _both(pairs, arrays, n="n", bits="bits").transform(by_batch, _bound_rows(percent), "a bigint, b bigint")
    return _both(pairs, arrays, set="shingles").transform(by_batch, _exact_rows(percent), "a bigint, b bigint")


def _apart(cell: dict[str, np.ndarray], maps: np.ndarray, forest: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows of a cell that are apart and may be similar.

    Rows of two blocks meet crosswise.  ``forest``: a pair joins its two
    components for the rest of the cell, so there are fewer pairs than
    components; of two components the row's nearest pair is taken.
    """
    root, block = cell["root"].copy(), cell["block"]
    upper, pivot = cell["is_upper"] > 0, cell["is_pivot"] > 0
    crosswise = cell["i"][0] != cell["j"][0]
    for k in range(1, len(root)):
        ok, bits = may_link(maps[:k + 1], cell["n"][:k + 1], k, percent)
        ok = ok[:k] & (root[:k] != root[k]) & ~(upper[:k] & upper[k]) & ~(pivot[:k] | pivot[k])
        if crosswise:
            ok &= block[:k] != block[k]
        hits = np.flatnonzero(ok)
        if forest and len(hits):
            hits = hits[np.lexsort((bits[hits], root[hits]))]
            hits = hits[np.append(True, np.diff(root[hits]) != 0)]
            root[np.isin(root, root[hits])] = root[k]
        yield from ((int(h), k) for h in hits)


def _cell_pairs(forest: bool, percent: int):
    numbers = ("key", "i", "j", "block", "node", "is_upper", "is_pivot", "root", "n")

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        """Pairs of whole cells."""
        col = {c: rows.column(c).to_numpy() for c in numbers}
        bits = rows.column("bits").to_pylist()
        new = np.flatnonzero(np.any([np.diff(col[c]) != 0 for c in ("key", "i", "j")], axis=0)) + 1
        out = []
        for s, e in zip([0, *new.tolist()], [*new.tolist(), len(bits)]):
            cell = {c: x[s:e] for c, x in col.items()}
            if e - s > 1 and (cell["root"] != cell["root"][0]).any():
                out += [(col["node"][s + a], col["node"][s + b])
                        for a, b in _apart(cell, narrowed(bits[s:e]), forest, percent)]
        ends = np.sort(np.array(out, np.int64).reshape(-1, 2), axis=1)
        return pa.record_batch([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the open cell
        for batch in batches:
            if not batch.num_rows:
                continue
            col = [batch.column(c).to_numpy() for c in ("key", "i", "j")]
            last = len(col[0]) - int(np.argmin(np.append(np.all([x[::-1] == x[-1] for x in col], axis=0), False)))
            ends = not held or any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("key", "i", "j"))
            if last or (held and ends):
                yield pairs(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield pairs(pa.Table.from_batches(held))
    return run


def apart_pairs(tiles: DataFrame, links: DataFrame, arrays: DataFrame, forest: bool, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a, b`` of tiles that ``links`` do not connect and that may be similar.

    Pairs with a tile's first set have been tested, so tiles of two are done.
    A tile is cut into blocks of about ``BLOCK`` sets by a hash; every two
    blocks meet in a cell of their own.
    """
    roots = saved(components(links), "roots").select(F.col("node").alias("linked"), "root")
    rows = tiles.join(roots, F.col("node") == F.col("linked"), "left").select(
        "key", "node", "is_upper", (F.col("node") == F.col("pivot")).alias("is_pivot"), F.coalesce("root", "node").alias("root"))
    rows = saved(rows, "tile-roots")
    open_ = rows.filter("not is_pivot").groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("r"), F.max("root").alias("s"))
    open_ = open_.filter("r <> s").select(F.col("key").alias("k"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(open_, F.col("key") == F.col("k")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node",
                       F.col("is_upper").cast("int").alias("is_upper"), F.col("is_pivot").cast("int").alias("is_pivot"), "root")
    rows = rows.join(arrays.select(F.col("node").alias("node_"), "n", "bits"), F.col("node") == F.col("node_")).drop("node_")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.transform(by_batch, _cell_pairs(forest, percent), "a bigint, b bigint").distinct()


def similar_links(docs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` between sets that connect all sets linked by similarity.

    First each tile's sets with one of them; then, among a tile's sets that
    are still apart, as few pairs as could connect them; then all that are
    apart even so.  Each pair is tested exactly, and a similar pair is either
    tested or connected already.
    """
    shared = saved(tiles(sets), "tiles")
    arrays = saved(set_arrays(docs, sets, shared.select("node").distinct()), "set-arrays")
    star = shared.filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = saved(verified(star, arrays, percent), "links")
    for forest in (True, False):
        pairs = saved(apart_pairs(shared, links, arrays, forest, percent), "apart-pairs")
        links = saved(links.unionByName(verified(pairs, arrays, percent, bounded=True)), "links")
    return links


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``n_shingles``: size of the set of 4-word shingles; ``component_id``: the
    least id reachable over links of at least ``percent`` hundredths in
    Jaccard similarity (NULL only where all are NULL).  Shingles and equal
    sets are told apart by 64-bit hashes; equal sets meet once.

    NULL and empty texts, and those without words, have the empty set and are
    linked with nothing; texts of one to three words are one shingle.  Long
    texts are read whole.  Repeated rows and NULL ids stay.  Extra columns are
    left out, whatever their names.  An empty table gives no rows.
    """
    docs = pick(docs, doc_id=doc_id, text=text)
    sets = saved(document_sets(docs, percent=percent), "document-sets")
    roots = components(similar_links(docs, sets, percent)).select(F.col("node").alias("linked"), "root")
    sets = sets.select("doc_id", "node", "n")
    nodes = sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = saved(nodes.join(roots, F.col("node") == F.col("linked"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")), "set-roots")
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(least, "root").select(F.col("node").alias("of"), "component_id")
    full = sets.filter("node is not null")
    full = full.join(nodes, F.col("node") == F.col("of")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = sets.filter("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(none)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity component of every document by its 4-word shingles."""
    return similar_documents(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s
  FROM w),
f AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM s JOIN reach ON s.doc_id = reach.a GROUP BY ALL
"""
