"""Filter interaction audit against a plain replay of every order."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import types as T

from meterlake.llm import filter_audit
from odd_documents import EXTRA, document_schema, documents, empty, odd  # noqa: F401


def plain_masks(rows, labels):
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    out = []
    for r in rows:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = (("A" if len(w) < 200 else "") + ("B" if 100 * len(set(w)) < 50 * len(w) else "")
                 + ("C" if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else "") + ("D" if re.search(r"[#$%&*|]", t) else "")
                 + ("E" if r.doc_id is not None and any(
                     o.doc_id is not None and o.doc_id < r.doc_id and (o.text or "") == t for o in rows) else ""))
        out.append((r.lang or "", fails, r.doc_id in good, r.doc_id in toxic))
    return out


def plain_audit(rows, labels):
    masks, out = plain_masks(rows, labels), {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    f, len(left), len(gone), sum(f in m[1] for m in mine) - len(gone), sum(m[1] == f for m in mine),
                    sum(m[2] for m in gone), sum(m[3] for m in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[v[0]])
    return out


def check(docs, labels):
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.filter_audit(docs, labels).collect()}
    assert got == plain_audit(docs.collect(), labels.collect())
    return got


@pytest.fixture(scope="module")
def labels(spark):
    from conftest import SF_SMALL
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")


def test_all_orders(spark, documents, odd, empty, labels):
    assert len(check(documents, labels)) == 600 * 4
    made = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (6, 1, 1), (None, 1, 1), (11, None, None), (5, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    assert len(check(odd, made)) == 600
    assert check(empty, made) == {}


def test_parts_copies_and_nulls(spark):
    """Parts with and without a name, copies over parts, rows of one id, ids that are text."""
    rng = random.Random(3)
    texts = ["", None, "a " * 250, "Abc " * 30, "x#y", " ".join(map(str, range(300)))]
    rows = [(rng.choice(["p", "q", None, "10", ""]), rng.choice([None, *"abcdefgh"]), rng.choice(texts), "x") for _ in range(150)]
    docs = spark.createDataFrame(rows, "lang string, doc_id string, text string, mask string")
    labels = spark.createDataFrame([("a", 1, 0, "x"), ("b", 0, 1, "x"), ("a", 1, 1, "x")], "doc_id string, quality int, toxic int, part string")
    check(docs, labels)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_swaps_visit_every_order_once(n):
    diagram = filter_audit.Diagram({0: (1,)}, n)
    seen = [tuple(diagram.order)]
    for k in filter_audit.neighbour_swaps(n):
        diagram.swap(k)
        seen.append(tuple(diagram.order))
    assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_swaps_keep_the_counts_and_share_nodes():
    rng = random.Random(1)
    counts = {m: (rng.choice([0, 0, 1, 5]),) for m in range(32)}
    diagram = filter_audit.Diagram(counts, 5)
    for k in filter_audit.neighbour_swaps(5):
        diagram.swap(k)
        for mask in range(32):
            node = diagram.root
            for f in diagram.order:
                if node is not diagram.empty:
                    node = node.fails if mask >> f & 1 else node.passes
            assert node.total == counts[mask]
    same = filter_audit.Diagram({m: (7,) for m in range(32)}, 5)
    assert [len(level) for level in same.levels] == [1] * 5
