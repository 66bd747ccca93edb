"""Spelling variants of a corpus's words by PartEnum signatures (operator 11).

A word's letters form a set of (letter, how many of it came before), a binary
vector.  One inserted or deleted letter changes one place of that vector, one
replaced letter two.  The places are dealt into ``PARTS`` parts: vectors that
differ in d places agree on all but d parts, so words that share a signature
(all parts but some d, and the lengths) hold every pair that is near.  Words
meet by an equi-join on the signatures and are verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.shared import by_batch, pick, saved, table
from meterlake.llm.shingles import mix

MIN_CHARS, MIN_COUNT, FORM_RATIO = 6, 5, 5
# Parts of a word's vector: 21 signatures leave out two, 7 leave out one.
PARTS = 7
# Every so-many-th run by checksum loses a letter, in the registered query.
DROP_EVERY = 199
# Characters of distinct words that a worker gathers before it hands counts on.
ROOM_CHARS = 8 << 20
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_CHARS)


def text_words(doc_id, text: str | None, drop_every: int | None = DROP_EVERY) -> Iterator[tuple[str, int]]:
    """Words of one text with their occurrences; a word may come twice.

    Runs of letters with only A-Z in lower case.  Where ``drop_every`` divides
    the checksum h of ``<doc_id>:<run>``, the run loses its code point h %
    length.  A run that is too short cannot become a word and is not made.
    """
    runs = Counter(_RUN.findall((text or "").encode().lower().decode()))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start) if drop_every else 1
        if drop_every and h % drop_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= MIN_CHARS:
            yield run, n


def _count_rows(drop_every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        size = 0

        def hand_on() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                   names=["word", "n"])
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in text_words(doc, text, drop_every):
                    if word in held:
                        held[word] += n
                    else:
                        held[word] = n
                        size += len(word)
                if size > ROOM_CHARS:
                    yield hand_on()
                    held, size = {}, 0
        if held:
            yield hand_on()
    return run


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT,
                drop_every: int | None = DROP_EVERY) -> DataFrame:
    """``word, n`` of the words with at least ``min_count`` occurrences.

    Counted within a task first, so a frequent word is a few rows.
    """
    rows = pick(docs, doc_id=doc_id, text=text).transform(by_batch, _count_rows(drop_every), "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def part_hashes(words: list[str]) -> np.ndarray:
    """``len(words)`` x ``PARTS`` numbers: each part's share of a word's vector."""
    out = np.zeros(len(words) * PARTS, np.uint64)
    code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    before = np.arange(len(code)) - np.repeat(starts, np.diff(np.append(starts, len(code))))
    # Neighbouring letters, and the repeats of a letter, go to different parts.
    np.bitwise_xor.at(out, owner * PARTS + (code + 3 * before) % PARTS,
                      mix(((code << 32) + before + 1).astype(np.uint64)))
    return out.reshape(-1, PARTS)


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word")
        got = part_hashes(words.to_pylist()).view(np.int64).ravel()
        offsets = np.arange(0, len(got) + 1, PARTS, dtype=np.int32)
        yield pa.record_batch([words, batch.column("n"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(got))],
                              names=["word", "n", "parts"])


def _signatures(leave_out: int, length: Column) -> list[Column]:
    """Signatures without each choice of ``leave_out`` parts, for words that meet at ``length``."""
    out = []
    for gone in combinations(range(PARTS), leave_out):
        rest = F.lit(0).cast("bigint")
        for j in range(PARTS):
            if j not in gone:
                rest = rest.bitwiseXOR(F.col("parts")[j])
        out.append(F.xxhash64(F.lit(leave_out), F.lit(",".join(map(str, gone))), length, rest))
    return out


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of words (``word, n``) at edit distance 1, once.

    Words of one length meet on the signatures without two parts; a word meets
    those one letter longer on the signatures without one part.  The edit
    distance is tested where they meet, so what else shares a signature goes
    no further; a frequent signature is a skewed join key, which Spark splits.
    """
    words = saved(vocabulary.transform(by_batch, _part_rows, "word string, n bigint, parts array<bigint>"), "word-parts")
    size = F.length("word")
    left = F.explode(F.array(*_signatures(2, size), *_signatures(1, size + 1)))
    right = F.explode(F.array(*_signatures(2, size), *_signatures(1, size)))
    a = words.select(left.alias("key"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = words.select(right.alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    meet = (a["key"] == b["key"]) & once & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, meet).select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: the end of their chain.

    Each round every word takes over where its target points to, so chains
    halve; counts grow along a chain by a factor, so it is short.
    """
    links = saved(forms.filter("form is not null").select("word", F.col("form").alias("root")), "word-links")
    while True:
        onward = links.select(F.col("word").alias("w"), F.col("root").alias("further"))
        links = saved(links.join(onward, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("w").isNotNull().alias("moved")), "word-links")
        if not links.filter("moved").take(1):
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT,
                      form_ratio: int = FORM_RATIO, drop_every: int | None = DROP_EVERY) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with ``min_count`` occurrences.

    ``form``: the near word of largest count (ties: smallest in code-point
    order) if that is at least ``form_ratio`` times the word's, else NULL;
    ``root``: where following the forms ends.  ``drop_every``: see
    ``text_words``; None leaves the words as they stand.

    NULL and empty texts have no words; a NULL id counts as an empty one.
    Long texts and long words are read whole.  Repeated rows count each.
    Extra columns are left out, whatever their names.  An empty table gives
    no rows.
    """
    words = saved(word_counts(docs, doc_id, text, min_count, drop_every), "words")
    pairs = near_pairs(words)
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")).alias("near")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("n"), F.col("a").alias("word")).alias("near"))))
    best = (pairs.select(sides.alias("s")).groupBy(F.col("s.word").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_near"), F.min("s.near").alias("best")))
    fits = -F.col("best.n") >= form_ratio * F.col("n")
    forms = saved(words.join(best, F.col("word") == F.col("w"), "left").select(
        "word", F.when(fits, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, -F.col("best.n")).alias("form_n")), "word-forms")
    roots = _roots(forms).select(F.col("word").alias("w"), F.col("root").alias("r"))
    return forms.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("r", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words' counts, forms and roots."""
    return spelling_variants(table(spark, sf_dir, "documents"))
