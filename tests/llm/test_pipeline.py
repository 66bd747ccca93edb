"""Mixing, and the pipeline's stages against the operators' brute-force versions."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from meterlake.llm import mixing, quality
from meterlake.llm.shared import words
from odd_documents import documents, empty, odd  # noqa: F401
from test_dedup import plain_removal, plain_simhash, union
from test_filters import plain_stats


def plain_targets(sizes, weights, cap=3):
    """Pour small drops of the total by weight; full sources take no more."""
    total = left = sum(sizes.values())
    target = dict.fromkeys(sizes, 0.0)
    for _ in range(len(sizes) + 1):
        open_ = [s for s in sizes if target[s] < cap * sizes[s]]
        weight = sum(weights[s] for s in open_)
        if not open_ or left <= 1e-9 * total:
            break
        poured = {s: min(left * weights[s] / weight, cap * sizes[s] - target[s]) for s in open_}
        for s, x in poured.items():
            target[s] += x
        left -= sum(poured.values())
    return target


@pytest.mark.parametrize("seed", range(5))
def test_water_fill(seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 5, 100, 1000, 10000]) for s in "abcdefg"}
    weights = mixing.cyclic_weights(list(sizes))
    got, want = mixing.water_fill(sizes, weights, sum(sizes.values())), plain_targets(sizes, weights)
    assert got == pytest.approx(want, rel=1e-6)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_cyclic_weights():
    assert mixing.cyclic_weights(["é", None, "b", "Z", "🙂"]) == {"Z": 1, "b": 2, "é": 3, "🙂": 1, None: 2}
    assert mixing.water_fill({}, {}, 0) == {}


def check_mix(docs):
    size = F.size(words(F.col("text")))
    got = mixing.mix_sources(docs, mixing.cyclic_weights, size)
    rows = got.collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_sources(docs.repartition(5), mixing.cyclic_weights, size).collect()))
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    target = plain_targets(sizes, mixing.cyclic_weights(list(sizes)))
    taken, largest = Counter(), Counter()
    for r in rows:
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(target[r.source]))
        assert 0 <= r.times <= 3
        taken[r.source] += r.times * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        # half a document off at most; a repeated row meets the cut as a whole
        assert abs(taken[s] - target[s]) <= largest[s] * (0.5 if docs.distinct().count() == docs.count() else 1) + 1e-6
    return rows


def test_mix(documents, odd, empty):
    check_mix(documents)
    check_mix(odd)
    assert check_mix(empty) == []


def test_mix_rows(odd):
    size = F.size(words(F.col("text")))
    times = {repr(r[:5]): r.times for r in mixing.mix_sources(odd, mixing.cyclic_weights, size).collect()}
    mixed = mixing.mixed(odd, mixing.cyclic_weights, size)
    assert mixed.columns == odd.columns
    copies = Counter(repr(r) for r in mixed.collect())
    rows = Counter(repr(r) for r in odd.collect())
    by_row = {repr(r): times[repr(r[:5])] for r in odd.collect()}
    assert copies == Counter({k: n * by_row[k] for k, n in rows.items() if by_row[k]})


def test_plan_takes_one_row_per_source(spark, monkeypatch):
    """The cuts are found in Spark: what reaches the driver does not grow with the documents."""
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 3) as source",
                                        "repeat('w ', cast(1 + id % 7 as int)) as text")
    want = Counter()
    for r in docs.collect():
        want[r.source] += len(r.text.split())
    target = plain_targets(want, mixing.cyclic_weights(list(want)))
    sent, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: (lambda got: sent.append(len(got)) or got)(collect(df)))
    mix = mixing.mix_sources(docs, mixing.cyclic_weights, F.size(words(F.col("text"))))
    assert sent and max(sent) <= 3
    for r in mix.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("taken")).toLocalIterator():
        assert abs(r.taken - target[r.source]) <= 3.5 + 1e-6


def test_stage_list():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "simhash near-dedup", "substring dedup", "source mixing", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_stages(spark, documents):
    docs = documents
    columns = sorted(documents.dtypes)
    key = lambda rows: sorted((r.doc_id, r.text) for r in rows)

    kept = corpus_pipeline.quality_rules(spark, docs, SF_SMALL).cache()
    assert sorted(kept.dtypes) == columns
    verdict = {r.doc_id: r.rule for r in quality.judge(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    want = [r for r in docs.collect() if not (lambda s: s[0] < 10 or 100 * s[4] > 20 * s[0])(plain_stats(r.text))
            and verdict[r.doc_id] is None]
    assert key(kept.collect()) == key(want)

    rows, first = kept.collect(), corpus_pipeline.simhash_dedup(spark, kept, SF_SMALL).cache()
    assert sorted(first.dtypes) == columns
    fp = [plain_simhash(r.text) for r in rows]
    root = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3])
    least = {}
    for r, k in zip(rows, root):
        least[k] = min(r.doc_id, least.get(k, r.doc_id))
    assert key(first.collect()) == key(r for r in rows if r.doc_id in least.values())

    rows, cut = first.collect(), corpus_pipeline.substring_dedup(spark, first, SF_SMALL).cache()
    assert sorted(cut.dtypes) == columns
    want = {i: b" ".join(x for x, g in zip(w, gone) if not g) for i, w, gone in plain_removal(rows)}
    assert {r.doc_id: b" ".join(r.text.encode().split()) for r in cut.collect()} == {i: t for i, t in want.items() if t}

    mix = corpus_pipeline.mix_sources(spark, cut, SF_SMALL).cache()
    assert sorted(mix.dtypes) == columns
    planned = {r.doc_id: r.times for r in check_mix(cut)}
    assert Counter(r.doc_id for r in mix.collect()) == Counter({i: n for i, n in planned.items() if n})

    pieces = corpus_pipeline.pack(spark, mix, SF_SMALL)
    one = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.countDistinct("piece").alias("k"), F.count("*").alias("m"))
    for r in one.collect():
        assert r.m == r.k * planned[r.doc_id]
    full = corpus_pipeline.run(spark, SF_SMALL)
    assert full.drop("sequence_id", "offset").exceptAll(pieces.drop("sequence_id", "offset")).count() == 0
    assert full.count() == pieces.count()


def test_pipeline_on_odd_documents(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_SMALL)
        docs.count()
