"""Spelling variants against brute force over deletion and wildcard patterns."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from meterlake.llm import spelling
from odd_documents import documents, empty, odd  # noqa: F401


def plain_counts(rows, drop=199):
    out = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return out


def plain_near(words):
    """Every pair at edit distance 1: equal but for one place, or by one letter left out."""
    near, masks = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i], w[i + 1:]].add(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(rows, drop=199):
    counts = {w: n for w, n in plain_counts(rows, drop).items() if len(w) >= 6 and n >= 5}
    near, form = plain_near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), counts[f] if f else None))
    return sorted(out)


def check(docs, **options):
    got = sorted(map(tuple, spelling.spelling_variants(docs, **options).collect()))
    assert got == plain_variants(docs.collect(), options.get("drop_every", 199))
    return got


def test_variants(documents, odd, empty):
    got = check(documents)
    assert any(w[1] for w in got) and any(w[4] for w in got)
    check(odd)
    assert check(empty) == []


def made(rng):
    """Words a letter or two apart in families, with accents, repeats and long ones."""
    base = ["".join(rng.choices("abcéœÿ", k=rng.randint(5, 9))) for _ in range(15)] + ["a" * 400, "ab" * 150, "straße", "naïveté"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rng.randint(0, 30)):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at, c = rng.randrange(len(w)), rng.choice("abcéZ")
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]])
            words += [w] * rng.choice([1, 1, 5, 30])
        rows.append((rng.choice([i, None]), rng.choice([" ", "-", "\n"]).join(words), "x", "x"))
    return rows


def test_dense_families(spark):
    for seed in range(2):
        docs = spark.createDataFrame(made(random.Random(seed)), "doc_id long, text string, word string, n string")
        got = check(docs)
        assert max(w[4] for w in got) > 5
        check(docs, drop_every=None)


def test_signatures_lose_no_pair():
    rng = random.Random(5)
    for _ in range(300):
        w = "".join(rng.choices("abcdeé", k=rng.randint(6, 14)))
        at, c = rng.randrange(len(w)), rng.choice("abxé")
        replaced, longer = w[:at] + c + w[at + 1:], w[:at] + c + w[at:]
        p = spelling.part_hashes([w, replaced, longer])
        assert (p[0] != p[1]).sum() <= 2 and (p[0] != p[2]).sum() == 1


def test_counts_are_handed_on_in_parts(documents, monkeypatch):
    whole = plain_counts(documents.collect())
    monkeypatch.setattr(spelling, "ROOM_CHARS", 100)
    got = {r.word: r.n for r in spelling.word_counts(documents).collect()}
    assert got == {w: n for w, n in whole.items() if len(w) >= 6 and n >= 5}
