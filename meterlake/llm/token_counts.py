"""Token counts under a unigram model, without making the tokens (operator 5).

The tokenizer is ``tokenizers.models.Unigram`` over the pieces and scores of a
public vocabulary file, behind the ``Metaspace`` pre-tokenizer: a word is what
stands from one blank to the next.  Aho-Corasick finds the pieces that end at
each place of a word; a Viterbi pass carries only the best score and its
number of pieces.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from meterlake.llm.shared import by_batch, kept, pick, table

BLANK_MARK = "▁"
# The tokenizer's penalty, below the worst piece, for a character no piece covers.
UNKNOWN_PENALTY = 10.0
# A longer word is not remembered; bytes that an entry takes besides its word.
LONG, _ENTRY = 100, 184


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """``(piece, score)`` by id: unknown at 0, control pieces left out."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    unknown = sp.unk_id()
    return [(sp.id_to_piece(unknown), 0.0)] + [
        (sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
        if i != unknown and not sp.is_control(i)]


class Counter:
    """Counts of words, remembered in a store of bounded size (``room`` bytes).

    Words of more than ``LONG`` characters are counted each time, a text's own
    repeats aside.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], room: int = 96 << 20):
        import ahocorasick
        self.find = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}
        self.room, self.held = room, 0

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path through one word.

        Of equal paths the tokenizer keeps the one it met first: to each end,
        the piece that starts earliest.  A character that no path piece covers
        counts as its UTF-8 bytes (byte fallback).
        """
        n = len(word)
        if self.single.issuperset(word):  # no unknown character: every place is reached by a piece
            score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
            for end, (length, s) in self.find.iter(word):  # per end, the longest first
                end += 1
                s += score[end - length]
                if s > score[end]:
                    score[end], count[end] = s, count[end - length] + 1
            return count[n], score[n]
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, piece in self.find.iter(word):
            ends[end].append(piece)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        for i in range(n):
            best, pieces, single = None, 0, False
            for length, s in ends[i]:
                s += score[i + 1 - length]
                if best is None or s > best:
                    best, pieces = s, count[i + 1 - length] + 1
                single = single or length == 1
            if not single:
                s = score[i] + self.unknown
                if best is None or s > best:
                    best, pieces = s, count[i] + len(word[i].encode())
            score[i + 1], count[i + 1] = best, pieces
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, float]:
        """Pieces and score of a text; 0 for NULL or empty."""
        if not text:
            return 0, 0.0
        words = text.replace(BLANK_MARK, " ").split(" ")
        if words[0] == "":
            del words[0]  # the text starts with a blank: no mark is put before it
        known = self.known
        new = set(words).difference(known)
        for w in new:
            known[w] = self.word(BLANK_MARK + w)
        got = list(map(known.__getitem__, words))
        for w in new:
            if len(w) > LONG:
                del known[w]
            else:
                self.held += sys.getsizeof(w) + _ENTRY
        if self.held > self.room:
            known.clear()
            self.held = 0
        return sum(c for c, _ in got), sum(s for _, s in got)


def counter(path: str) -> Counter:
    """This worker's counter for a vocabulary file."""
    return kept("token_counts", path, lambda p: Counter(read_vocabulary(p)))


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_chars, n_tokens, score`` of every row, no shuffle.

    ``score``: sum of the best path's piece scores.  NULL and empty texts have
    0 tokens; long texts and long words are counted whole; repeated rows and
    NULL ids stay; other columns are left out, whatever their names; an empty
    table gives no rows.
    """
    path = vocabulary or vocabulary_path()
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = [c.text(t) for t in texts]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(t or "") for t in texts], pa.int64()),
                 pa.array([n for n, _ in got], pa.int64()), pa.array(np.array([s for _, s in got], float))],
                names=["doc_id", "n_chars", "n_tokens", "score"])
    return pick(docs, doc_id=doc_id, text=text).transform(
        by_batch, run, f"doc_id {kind}, n_chars bigint, n_tokens bigint, score double", owner="token_counts")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return token_counts(table(spark, sf_dir, "documents"))
