"""Token ids of whole texts with a public byte-level BPE tokenizer.

The pre-tokenizer of these tokenizers never joins a word to what stands
before the single blank in front of it, nor a letter to a sign after it, so
texts are cut into chunks at such places; of some texts at a time each distinct
chunk is looked up once.  Each worker remembers the ids of the chunks it has
met, in a store of bounded size in bytes.  Texts with unusual white space or with a special token's
string are encoded as one piece.  Either way the ids are those the
``tokenizers`` library gives for the whole text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from meterlake.llm.shared import kept

END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# Kinds of bytes: ASCII white space, such white space but the blank, and ASCII characters
# that are neither white space nor letters, digits or "_".
_SPACE, _LINE, _SIGN, _LETTER = (np.zeros(256, bool) for _ in range(4))
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LINE[[9, 10, 11, 12, 13]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN[:128] = ~(_SPACE | _LETTER)[:128]
_SIGN[[*range(48, 58), 95]] = False
# All other white space, spelled out as that is searched faster than a class.
_ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Words that are one pre-token.
_PLAIN = re.compile(r" ?[A-Za-z]+").fullmatch
# Characters of texts, and new chunks in one string, that are handled at once.
_PART, _JOIN = 1 << 20, 2000
# A longer chunk is not remembered; bytes that an entry of the store takes besides its chunk and ids.
_LONG, _ENTRY = 100, 137


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``room``: bytes of chunks, ids and their entries kept in each of two
    generations; a chunk that was not used for a whole generation is
    forgotten.  What is forgotten is encoded again, so ids never depend on it.
    """

    def __init__(self, path: str, room: int = 66 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        set_up = json.loads(self.tokenizer.to_str())
        split = set_up["pre_tokenizer"] or {}
        # A blank and ASCII letters are one pre-token, in which only the blank is written otherwise.
        self.plain_words = (set_up["normalizer"] is None and split.get("type") == "ByteLevel"
                            and split["use_regex"] and not split["add_prefix_space"])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # byte-level: a character stands for a byte
            self.n_bytes[i] = len(token)
        self.room, self.held, self.young, self.old = room, 0, {}, {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in got]

    def _learn(self, new: list[str]) -> list[str]:
        """Hold the ids of these chunks, not yet in ``young``; returns the long ones, not to be kept."""
        young, old = self.young, self.old
        back = {c: old[c] for c in new if c in old}
        young.update(back)
        self._hold(back.keys(), back.values())
        fresh = [c for c in new if c not in back]
        if self.plain_words:
            known = [c for c in fresh if _PLAIN(c)]
            model = self.tokenizer.model
            ids = [array("I", [t.id for t in model.tokenize(c.replace(" ", "Ġ"))]).tobytes() for c in known]
            young.update(zip(known, ids))
            self._hold(known, ids)
            fresh = [c for c in fresh if not _PLAIN(c)]
        # A chunk begins with a blank, or is white space, or has none.
        odd = [c for c in fresh if c[0] != " " or c.isspace()]
        ids = [x.tobytes() for x in self._ids(odd)]
        young.update(zip(odd, ids))
        self._hold(odd, ids)
        # Chunks that start with a blank are encoded as one string and told apart by their bytes.
        joined = [c for c in fresh if c[0] == " " and not c.isspace()]
        for at in range(0, len(joined), _JOIN):
            group = joined[at:at + _JOIN]
            ids, = self._ids(["".join(group)])
            ends = np.cumsum(np.fromiter((len(c.encode()) for c in group), np.int64, len(group)))
            cuts = (4 * (np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1)).tolist()
            data = ids.tobytes()
            parts = [data[s:e] for s, e in zip([0, *cuts], cuts)]
            young.update(zip(group, parts))
            self._hold(group, parts)
        return [c for c in new if len(c) > _LONG]

    def _hold(self, chunks: Iterable[str], ids: Iterable[bytes]) -> None:
        self.held += sum(map(sys.getsizeof, chunks)) + sum(map(len, ids)) + _ENTRY * len(chunks)

    def _forget(self, chunks: list[str]) -> None:
        """Drop these chunks; begin a new generation when this one is full."""
        for c in chunks:
            self.held -= sys.getsizeof(c) + len(self.young.pop(c)) + _ENTRY
        if self.held > self.room:
            self.young, self.old, self.held = {}, self.young, 0

    def _whole(self, text: str) -> bool:
        return bool(_ODD_SPACE.search(text)) or any(s in text for s in self.special)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text in turn; NULL counts as empty."""
        part, size = [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size > _PART:
                yield from self._part(part)
                part, size = [], 0
        yield from self._part(part)

    def _part(self, texts: list[str]) -> Iterator[bytes]:
        whole = [self._whole(t) for t in texts]
        raw = [b"" if w else t.encode() for t, w in zip(texts, whole)]
        data = np.frombuffer(b"".join(raw), np.uint8)
        bounds = np.cumsum([0, *map(len, raw)])
        starts = _chunk_starts(data, bounds)
        # Each distinct chunk is looked up once, however often it occurs.
        chunks = pa.Array.from_buffers(pa.large_string(), len(starts) - 1,
                                       [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        names, young = chunks.dictionary.to_numpy(zero_copy_only=False).tolist(), self.young
        ids = list(map(young.get, names))
        holes = [i for i, x in enumerate(ids) if x is None]
        which = chunks.indices
        del raw, data, chunks  # before new chunks are encoded
        long = self._learn([names[i] for i in holes])
        for i in holes:
            ids[i] = young[names[i]]
        got = pa.array(ids, pa.large_binary()).take(which)
        del names, ids, which
        self._forget(long)
        pa.default_memory_pool().release_unused()
        _, ends, values = got.buffers()
        cuts = np.frombuffer(ends, np.int64)[np.searchsorted(starts, bounds)].tolist() if len(got) else [0] * len(bounds)
        values = memoryview(values or b"")
        for text, w, s, e in zip(texts, whole, cuts, cuts[1:]):
            yield self._ids([text])[0].tobytes() if w else values[s:e].tobytes()


def _chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the chunks of texts start, and the end of the last one.

    ``data``: UTF-8 bytes of texts on end, which begin and end at ``bounds``.
    """
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[bounds] = True
    if n:
        space = _SPACE[data]
        goes_on = ~start[1:]  # another byte of the text, not white space, follows
        goes_on[:-1] &= ~space[1:]
        start[1:n] |= space[1:] & (~space[:-1] | goes_on[1:])
        start[1:n] |= ~space[1:] & _LINE[data[:-1]]
        letter = _LETTER[data]
        # Latin letters of two bytes.
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        letter[1:] |= wide
        letter[:-1] |= wide
        # A sign after letters that follow white space; other signs go with what is before them.
        other = np.flatnonzero(~letter)
        before, sign = other[:-1], other[1:]
        start[sign[_SIGN[data[sign]] & space[before] & (sign - before > 1)]] = True
    return np.flatnonzero(start)


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    return kept("encode", path, Encoder)


def end_mark(end_id: int | None) -> bytes:
    return b"" if end_id is None else np.array([end_id], "<u4").tobytes()
