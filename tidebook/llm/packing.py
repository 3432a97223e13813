"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

A document's tokens are cut where that saves padding: full sequences first, then the largest power
of two that fits, until the rest wastes little in its own class. Class j holds pieces of more than
capacity / (j + 1) and at most capacity / j tokens, and a bin of class j is filled by exactly j of
them. Every task fills its own bins, so nothing is shuffled and no task waits for another; the bins
that a task leaves open are packed together, largest piece first, when its input ends.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidebook.llm.arrow import Batches, batch, longs, map_batches
from tidebook.llm.words import slices

CAPACITY = 4096
END = 2
# A rest of this part of its class, or of a class of so many pieces, is not cut.
FULL_ENOUGH = 0.97
SMALL_CLASS = 16
# Bins of one task are numbered within this range.
BINS_PER_TASK = 1 << 33
CACHED_WORDS = 500_000
LONGEST_CACHED = 48


# Kinds of bytes. Punctuation that ends a word after a letter is a token of its own, so it may be split off.
_BLANK, _LETTER, _STOP = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t\n\r\x0b\f")] = _BLANK
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[list(b".,;:!?")] = _STOP
# Lower-case letters that neither normalisation nor case folding changes: one run of letters.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and the number of words before each text and after the last."""
    joined = np.frombuffer(b"".join(part for t in texts for part in (t, b"\n")), np.uint8)
    kind = _KIND[joined]
    blank = kind == _BLANK
    starts = ~blank
    starts[1:] &= blank[:-1]
    starts[1:-1] |= (kind[1:-1] == _STOP) & (kind[:-2] == _LETTER) & blank[2:]
    begin = np.flatnonzero(starts)
    # A word ends before a blank, or where the next one starts.
    end = np.flatnonzero(~blank[:-1] & (blank[1:] | starts[1:])) + 1
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined[~blank])]
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), buffers)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return words, np.searchsorted(begin, at)


class WordEncoder:
    """Token ids of texts, as little-endian 32-bit numbers, for tokenizers that never join what is
    on both sides of a blank: each word is encoded once and remembered.

    Words of plain letters are encoded many at a time, as one text, and its ids are cut after the
    tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Once the first is full it becomes the second, from which words that occur again come back.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # Folded case makes words equal that the tokenizer does not tell apart; control strings,
        # which it takes literally, are left alone.
        words, first = split_words([t if b"<|" in t else t.lower() for t in texts])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHED_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        missing = [w for w in distinct if w not in known]
        known.update([(w, older[w]) for w in missing if w in older])
        missing = [w for w in missing if w not in known]
        plain = [w for w in missing if _PLAIN.fullmatch(w)]
        for i in range(0, len(plain), 8192):
            self._learn_plain(plain[i : i + 8192])
        rest = [w for w in missing if w not in known]
        for i in range(0, len(rest), 4096):
            self._learn(rest[i : i + 4096])
        ids = pa.array(list(map(known.__getitem__, distinct)), pa.large_binary()).take(coded.indices)
        for word in missing:
            if len(word) > LONGEST_CACHED:
                del known[word]
        # The ids of all words lie one after the other.
        _, offsets, raw = ids.buffers()
        bounds = np.frombuffer(offsets, np.int64)[first].tolist()
        raw = memoryview(raw or b"")
        return [bytes(raw[a:b]) for a, b in zip(bounds, bounds[1:])]

    def _learn(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for word, ids in zip(words, found):
            self.known[word] = np.array(ids.ids, "<u4").tobytes()

    def _learn_plain(self, words: list[bytes]) -> None:
        joined = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0]
        ids = np.array(joined.ids, "<u4")
        cuts = np.flatnonzero(self.ends_word[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            return
        raw, bounds = ids.tobytes(), (4 * cuts).tolist()
        self.known.update(zip(words, [raw[a:b] for a, b in zip([0, *bounds], bounds)]))


# One for each worker process: what it remembers outlives the task.
encoder_of = lru_cache(maxsize=2)(WordEncoder)


def pieces(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths into which n tokens are cut."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        j = capacity // rest
        cut = rest if j >= SMALL_CLASS or j * rest >= FULL_ENOUGH * capacity else 1 << (rest.bit_length() - 1)
        out.append(cut)
        rest -= cut
    return out


class _Bins:
    """Open bins by class. A piece is (document, start, length, tokens of the document, ids)."""

    def __init__(self, first: int, capacity: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, piece: tuple) -> None:
        j = self.capacity // piece[2]
        held = self.open.setdefault(j, [])
        held.append(piece)
        if len(held) == j:
            self._close(self.open.pop(j))

    def _close(self, held: list[tuple]) -> None:
        at = 0
        for piece in held:
            self.done.append((*piece, self.next, at))
            at += piece[2]
        self.next += 1

    def finish(self) -> None:
        """The pieces of all open bins together, first fit, largest first."""
        left = sorted((p for held in self.open.values() for p in held), key=lambda p: -p[2])
        bins: list[list[tuple]] = []
        room = np.empty(0, np.int64)
        for piece in left:
            fits = np.flatnonzero(room >= piece[2])
            if len(fits):
                bins[fits[0]].append(piece)
                room[fits[0]] -= piece[2]
            else:
                bins.append([piece])
                room = np.append(room, self.capacity - piece[2])
        for held in bins:
            self._close(held)

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def _packed(batches: Batches, path: str, capacity: int) -> Batches:
    bins = _Bins(TaskContext.get().partitionId() * BINS_PER_TASK, capacity)
    encoder = encoder_of(path)
    end = np.array([END], "<u4").tobytes()

    def rows(done: list[tuple]) -> pa.RecordBatch:
        doc, start, length, tokens, ids, sequence, offset = zip(*done) if done else [()] * 7
        numbers = [pa.array(c, pa.int64()) for c in (doc, start, length, tokens, sequence, offset)]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        return batch(**dict(zip(names, numbers)), ids=pa.array(ids, pa.binary()))

    for part in slices(batches, "text"):
        texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
        for doc, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts)):
            ids += end
            at, n = 0, len(ids) // 4
            for length in pieces(n, capacity):
                bins.add((doc, at, length, n, ids[4 * at : 4 * (at + length)]))
                at += length
        yield rows(bins.take())
    bins.finish()
    yield rows(bins.take())


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    A document (doc_id, text) is its token ids and then id 2; a null text is empty, so it has one
    token. ``ids`` are those of the piece as little-endian 32-bit numbers; pieces of a sequence lie
    from offset 0 without gaps. ``tokenizer`` is the path of a tokenizer file, which every worker
    opens, whose words end at blanks. Repeated rows are packed as often as they occur. Other columns
    are ignored. An empty table has no pieces.
    """
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return map_batches(docs.select("doc_id", "text"), partial(_packed, path=tokenizer, capacity=capacity), schema)
