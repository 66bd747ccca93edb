"""N-gram Jaccard join against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import jaccard
from odd_documents import documents, empty, odd  # noqa: F401


def plain_set(text):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def plain_components(rows):
    sets = [plain_set(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    order = sorted((i for i in range(len(rows)) if sets[i]), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1:]:
            if 85 * len(sets[j]) > 100 * len(sets[i]):
                break
            if find(i) != find(j):
                common = len(sets[i] & sets[j])
                if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    parent[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(find(i), []).append(r.doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r.doc_id, len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def check(docs):
    got = sorted(map(tuple, jaccard.similar_documents(docs).collect()), key=repr)
    assert got == plain_components(docs.collect())
    return got


def test_components(documents, odd, empty):
    got = check(documents)
    assert any(i != c for i, _, c in got)
    check(odd)
    assert check(empty) == []


def families(rng, sizes):
    """Families of near copies at all likenesses around the limit, over a shared passage."""
    words = [f"w{i}" for i in range(3000)]
    shared = rng.choices(words, k=60)
    rows = []
    for size in sizes:
        base = rng.choices(words, k=size)
        if rng.random() < 0.4:
            base = shared + base
        for _ in range(rng.choice([1, 2, 25])):
            copy = list(base)
            for _ in range(rng.randint(0, 2 + len(copy) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(["edit", "Edit", rng.choice(words)])
            copy = copy[rng.choice([0, 0, 1, 3]):]
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_families(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(jaccard, "BLOCK", rng.choice([4, 30, 2048]))
    sizes = [rng.choice([5, 8, 12, 17, 40, 90, 300, 900]) for _ in range(25)]
    check(spark.createDataFrame(families(rng, sizes), "doc_id long, text string"))


def test_similar_pairs_share_a_kept_segment():
    """Any pair at the limit agrees in a key, in the band of the smaller set."""
    rng = np.random.Generator(np.random.PCG64(4))
    low, most = jaccard.size_bands()
    for _ in range(3000):
        a = int(rng.integers(1, 400))
        x = rng.integers(0, 1 << 64, a, dtype=np.uint64)
        gone = int(rng.integers(0, a // 6 + 1))
        new = int(rng.integers(0, a // 6 + 1))
        y = np.unique(np.append(x[gone:], rng.integers(0, 1 << 64, new, dtype=np.uint64)))
        x = np.unique(x)
        if not jaccard.similar(x, y):
            continue
        s, t = sorted((x, y), key=len)
        band = int(np.searchsorted(low, len(s), "right")) - 1
        assert int(np.searchsorted(low, len(t), "right")) - 1 in (band, band + 1)
        d = int(most[band])
        if len(np.setxor1d(x, y)):
            assert set(jaccard.segment_keys(s, band, d).tolist()) & set(jaccard.segment_keys(t, band, d).tolist())
        maps = jaccard.narrowed([jaccard.bitmap(x), jaccard.bitmap(y)])
        ok, bits = jaccard.may_link(maps, np.array([len(x), len(y)]), 0)
        assert ok[1] and bits[1] <= len(np.setxor1d(x, y))


def test_exact_test_at_the_limit():
    x = np.arange(1, 186, dtype=np.uint64)
    assert jaccard.similar(x[:100], x[:85]) and not jaccard.similar(x[:100], x[:84])
    assert jaccard.similar(x[:85], x[:100]) and not jaccard.similar(x[:0], x[:0])


@pytest.mark.parametrize("step", [1, 2, 3, 5, 100])
def test_tiles_over_batches(step):
    """Tiles cut by batches anywhere give what whole ones give."""
    rows = [(1, False, 5), (2, False, 1), (2, False, 4), (2, True, 9), (3, True, 1), (3, True, 2), (4, False, 7), (4, True, 8),
            (5, False, 1), (6, False, 2), (6, False, 3), (6, False, 6), (6, False, 8), (6, True, 9), (7, False, 1)]
    schema = pa.schema([("key", pa.int64()), ("is_upper", pa.bool_()), ("node", pa.int64())])
    cut = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i:i + step]], schema) for i in range(0, len(rows), step)]
    got = [tuple(r.values()) for b in jaccard.shared_tiles(iter(cut)) for r in b.to_pylist()]
    want = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        if len(mine) > 1 and not mine[0][1]:
            want += [(key, r[2], mine[0][2], r[1]) for r in mine]
    assert sorted(got) == sorted(want)
