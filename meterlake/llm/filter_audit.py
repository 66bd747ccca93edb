"""Filter interaction audit by decision diagrams (operator 13).

Spark counts, per part of the table, the rows of each failure mask (which of
the filters a row fails).  A part's counts become a decision diagram with one
level per filter and counts at its leaves; swaps of neighbouring levels turn
it from one filter order into the next, through all orders.  In each order
the path on which every filter passes reads off what each step keeps and
removes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.shared import by_batch, pick, saved, ship, table

FILTERS = "ABCDE"
# The limits of the registered query: fixed values.
MIN_WORDS, MIN_DISTINCT_PCT, MAX_UPPER_PCT = 200, 50, 3
_MARKS = re.compile(rb"[#$%&*|]")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DUPLICATE = 1 << FILTERS.index("E")


def text_mask(text: str | None) -> int:
    """Bits of the filters A to D that a text fails (bit 0: A)."""
    data = (text or "").encode()
    words = data.split()
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_PCT * len(words)) << 1
            | (100 * (len(data) - len(data.translate(None, _UPPER))) > MAX_UPPER_PCT * len(text or "")) << 2
            | bool(_MARKS.search(data)) << 3)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("part"),
             pa.array([hashlib.sha256((t or "").encode()).digest() for t in texts], pa.binary()),
             pa.array([text_mask(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])


def mask_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                part: str = "lang", label_id: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: rows by failure mask, at most 32 rows a part.

    Texts are equal if their SHA-256 is.  ``good`` and ``toxic`` count rows
    with a label of quality 1, or toxic 1, under their id.  Rows of one id are
    no copies of each other; a row with NULL id is no copy, no original, and
    has no labels.  Only ids, digests and masks are shuffled; the least id of
    a text is combined before its shuffle, and joined back as one row per text.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = pick(docs, doc_id=doc_id, text=text, part=part).withColumn("part", F.coalesce(F.col("part").cast("string"), F.lit("")))
    rows = saved(rows.transform(by_batch, _masks, f"doc_id {kind}, part string, digest binary, mask int"), "failure-masks")
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    least = least.filter("copies > 1").select(F.col("digest").alias("d"), "least")
    # Rows whose text stands alone meet no partner, so the left side's hot digests are Spark's to split.
    rows = rows.join(least, F.col("digest") == F.col("d"), "left")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    mask = F.col("mask") + F.when(copy, _DUPLICATE).otherwise(0)
    marks = pick(labels, label_id=label_id, quality="quality", toxic="toxic").filter("label_id is not null")
    marks = marks.groupBy("label_id").agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
                                            for c in ("quality", "toxic")))
    marks = marks.filter("quality = 1 or toxic = 1")
    got = rows.select("doc_id", "part", mask.alias("mask")).join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return got.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


class Node:
    """A test: what is left where its filter fails, and where it passes."""
    __slots__ = ("fails", "passes", "total")

    def __init__(self, fails, passes):
        self.fails, self.passes = fails, passes
        self.total = tuple(a + b for a, b in zip(fails.total, passes.total))


class Leaf:
    __slots__ = ("total",)

    def __init__(self, total: tuple):
        self.total = total


class Diagram:
    """Count-weighted decision diagram of failure masks.

    ``order``: the filters (bit numbers) by level.  Equal subdiagrams of a
    level are one node; one without rows is the empty leaf at any level.
    """

    def __init__(self, counts: dict[int, tuple], n_filters: int):
        width = len(next(iter(counts.values()), (0,)))
        self.order = list(range(n_filters))
        self.empty = Leaf((0,) * width)
        leaves = {self.empty.total: self.empty}
        level = [leaves.setdefault(tuple(counts.get(m, self.empty.total)), Leaf(tuple(counts.get(m, self.empty.total))))
                 for m in range(1 << n_filters)]  # bit 0, the top level, is the highest of the places
        self.levels: list[dict] = [{} for _ in range(n_filters)]
        for k in reversed(range(n_filters)):  # the half with bit k lies 2**k places on
            level = [self._node(k, level[i + (1 << k)], level[i]) for i in range(1 << k)]
        self.root = level[0]

    def _node(self, k: int, fails, passes):
        if fails is self.empty and passes is self.empty:
            return self.empty
        key = (id(fails), id(passes))
        node = self.levels[k].get(key)
        if node is None:
            node = self.levels[k][key] = Node(fails, passes)
        return node

    def swap(self, k: int) -> None:
        """Let levels ``k`` and ``k + 1`` trade their filters.

        Nodes of level ``k`` stay what they are for the levels above; their
        branches are taken from the four quarters below them in new order.
        """
        upper = list(self.levels[k].values())
        self.levels[k + 1] = {}
        both = lambda x: (x, x) if x is self.empty else (x.fails, x.passes)
        for node in upper:
            (ff, fp), (pf, pp) = both(node.fails), both(node.passes)
            node.fails, node.passes = self._node(k + 1, ff, pf), self._node(k + 1, fp, pp)
        self.levels[k] = {(id(n.fails), id(n.passes)): n for n in upper}
        self.order[k], self.order[k + 1] = self.order[k + 1], self.order[k]

    def all_pass(self) -> Iterator[tuple[tuple, tuple]]:
        """Totals that fail, and pass, at each level of the path on which all before passed."""
        node = self.root
        for _ in self.order:
            if node is self.empty:
                yield node.total, node.total
            else:
                yield node.fails.total, node.passes.total
                node = node.passes


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels to swap (with the next one) that lead through all n! orders once."""
    if n < 2:
        return
    down, inner = True, neighbour_swaps(n - 1)
    for block in range(factorial(n - 1)):  # the last item runs to one end and back between the others' swaps
        if block:
            yield next(inner) + (1 if down else 0)
            down = not down
        yield from (range(n - 2, -1, -1) if down else range(n - 1))


def audit(counts: dict[int, tuple], filters: str = FILTERS) -> list[dict]:
    """Steps of every order of the filters, from ``{mask: (n, good, toxic)}``."""
    n = len(filters)
    failing = [sum(c[0] for m, c in counts.items() if m >> f & 1) for f in range(n)]
    alone = [counts.get(1 << f, (0,))[0] for f in range(n)]
    diagram, rows, shapley = Diagram(counts, n), [], [0] * n

    def read() -> None:
        name = "".join(filters[f] for f in diagram.order)
        for step, (f, (out, left)) in enumerate(zip(diagram.order, diagram.all_pass()), 1):
            shapley[f] += out[0]
            rows.append({"filter_order": name, "step": step, "filter": filters[f], "kept": left[0], "removed": out[0],
                         "redundant": failing[f] - out[0], "unique_fails": alone[f], "good_lost": out[1], "toxic_lost": out[2]})
    read()
    for k in neighbour_swaps(n):
        diagram.swap(k)
        read()
    for r in rows:
        r["shapley"] = shapley[filters.index(r["filter"])]
    return rows


_AUDIT = ("part string, filter_order string, step int, filter string, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def audit_orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order of the filters on every part of ``part, mask, n, good, toxic``.

    Columns ``part, filter_order, step, filter, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``; ``n!`` orders of ``n``
    steps a part, zeros included.  A part is one group of at most ``2**n``
    rows, so parts spread over tasks.  No parts: no rows.
    """
    ship(counts.sparkSession)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        part = rows["part"].iloc[0]
        got = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in rows.itertuples()}
        out = pd.DataFrame(audit(got, filters))
        out.insert(0, "part", part)
        return out
    return counts.select("part", F.col("mask").alias("mask"), "n", "good", "toxic").groupBy("part").applyInPandas(one, _AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 part: str = "lang", label_id: str = "doc_id") -> DataFrame:
    """What each filter removes in each order of the five, per part of ``docs``.

    A NULL text counts as empty, a NULL part as the empty string; empty texts
    fail A only (and E if an earlier one is empty too); very long texts are
    read whole, once.  Repeated rows count each; rows of one id do not make
    each other duplicates; rows with NULL id are never duplicates and have no
    labels.  Several labels of an id count as one, good or toxic if any is.
    Extra columns are left out, whatever their names.  An empty table gives
    no rows.
    """
    return audit_orders(mask_counts(docs, labels, doc_id, text, part, label_id))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of five filters on all documents, by language."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * len(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 3 * len(d.t) AS c,
         regexp_matches(d.t, '[#$%&*|]') AS d, coalesce(d.doc_id > first.least, false) AS e
  FROM d JOIN first ON d.t = first.t LEFT JOIN l ON d.doc_id = l.doc_id),
masks AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letter AS (SELECT unnest(range(5))::INT AS i),
orders AS (
  SELECT p.i AS p, q.i AS q, r.i AS r, s.i AS s, t.i AS t
  FROM letter p, letter q, letter r, letter s, letter t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
steps AS (
  SELECT substr('ABCDE', p + 1, 1) || substr('ABCDE', q + 1, 1) || substr('ABCDE', r + 1, 1)
         || substr('ABCDE', s + 1, 1) || substr('ABCDE', t + 1, 1) AS filter_order, k AS step,
         1 << [p, q, r, s, t][k] AS bit,
         list_sum(list_transform([p, q, r, s, t][1:k - 1], lambda x: 1 << x)) AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS k)),
seen AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
         coalesce(sum(n) FILTER (mask & (coalesce(before, 0)::INT | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & coalesce(before, 0)::INT = 0 AND mask & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & coalesce(before, 0)::INT <> 0 AND mask & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & coalesce(before, 0)::INT = 0 AND mask & bit <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & coalesce(before, 0)::INT = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM seen
"""
