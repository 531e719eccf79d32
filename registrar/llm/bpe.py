"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer.

Encoding of one word: its bytes form a doubly linked list of symbols; a
priority queue holds the merge rank of every neighbouring pair. The best pair
is taken, its two symbols become one, and the two pairs beside it are queued.
Entries whose symbols have changed since are stale and skipped. Decoding
concatenates the strings of the vocabulary.

The file is a ``tokenizers`` JSON of a word-end BPE: NFC, white space to one
space, lower case per code point, word pattern, byte alphabet, suffix on a
word's last symbol, no decoder (strings joined by one space).
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from registrar.llm.common import Remembered, batches, mapped, texts

#: Encoded chunks and words that a worker keeps in each of two generations (about 150 bytes each).
CHUNKS_KEPT = 150_000
WORDS_KEPT = 300_000

# Fixed values of the tokenizer's file format: white space and the word pattern.
_WHITE = "\u0009-\u000d \u0085   -     　"
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _WHITE + r"\p{L}\p{N}]+")
_ASCII_SPACE = re.compile(rb"[^\x20\x09-\x0d]+")


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes: themselves where printable, else
    the next code point from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file; one per worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        alphabet = byte_alphabet()
        self.inner = [vocab.get(c) for c in alphabet]
        self.last = [vocab.get(c + end) for c in alphabet]
        self.gaps = None in self.inner or None in self.last
        #: rank << 32 | merged symbol, by pair
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[vocab[left], vocab[right]] = rank << 32 | vocab[left + right]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.strings = [""] * size
        for token, i in (*vocab.items(), *self.added.items()):
            self.strings[i] = token
        self.words = Remembered(self._word, WORDS_KEPT)
        self.chunks = Remembered(self.encode_chunk, CHUNKS_KEPT)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merged symbols of one word."""
        get = self.merges.get
        n = len(symbols)
        pairs = list(map(get, zip(symbols, symbols[1:])))  # what the pair that begins here becomes
        bits = max(24, n.bit_length())
        place = (1 << bits) - 1
        queue = [v << bits | i for i, v in enumerate(pairs) if v is not None]
        if not queue:
            return symbols
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs.append(None)
        while queue:
            entry = heappop(queue)
            i, v = entry & place, entry >> bits
            if pairs[i] != v:
                continue  # stale: one of its symbols was merged meanwhile
            j = after[i]
            joined = symbols[i] = v & 0xFFFFFFFF
            pairs[i] = pairs[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                v = pairs[i] = get((joined, symbols[k]))
                if v is not None:
                    heappush(queue, v << bits | i)
            h = before[i]
            if h >= 0:
                v = pairs[h] = get((symbols[h], joined))
                if v is not None:
                    heappush(queue, v << bits | h)
        out, i = [], 0
        while i < n:
            out.append(symbols[i])
            i = after[i]
        return out

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pattern."""
        data = word.encode("utf-8")
        symbols = list(map(self.inner.__getitem__, data))
        symbols[-1] = self.last[data[-1]]
        if self.gaps:  # a byte that is not in the vocabulary is left out
            symbols = [s for s in symbols if s is not None]
        return array("I", self.merge(symbols)).tobytes()

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a sigma has one lower case here
        text = text.lower()
        if text.isalpha():  # one word, as most are
            return self.words[text]
        if text[-1] in ".,;:!?|" and text[:-1].isalpha():
            return self.words[text[:-1]] + self.words[text[-1]]
        return b"".join(map(self.words.__getitem__, _WORD.findall(text)))

    def encode_chunk(self, chunk: bytes) -> bytes:
        """Ids of a text without ASCII white space, 4 bytes each."""
        text = chunk.decode("utf-8")
        if not self.at_added.search(text):
            return self._plain(text)
        return b"".join(array("I", [self.added[part]]).tobytes() if k % 2 else self._plain(part)
                        for k, part in enumerate(self.at_added.split(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers.

        No word, added token or composed character spans ASCII white space,
        so chunks between it are encoded apart and remembered.
        """
        if not text:
            return b""
        return b"".join(map(self.chunks.__getitem__, text.encode("utf-8").split()))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of ``docs`` (doc_id, text, ...),
    with ``decoded`` also the text that ``decode`` makes of the ids, in the
    same worker.

    ``ids`` holds little-endian unsigned 32-bit integers. A null text counts
    as empty and gives no ids; a null doc_id and repeated rows stay as they
    are; other columns are ignored; an empty table gives an empty one. Texts
    are processed whole, one at a time, without a shuffle.
    """
    fields = _FIELDS if decoded else _FIELDS[:3]

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)

        def rows():
            for doc, text in texts(stream):
                ids = c.encode(text)
                row = (doc, len(ids) // 4, ids)
                yield (*row, c.decode(ids)) if decoded else row, 3 * len(ids)
        return batches(rows(), pa.schema([f for f, _ in fields]))

    return docs.select("doc_id", "text").transform(mapped, run, ", ".join(d for _, d in fields))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, n_tokens, ids) with the decoded text added; null
    ids give an empty text."""
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)

        def rows():
            for b in stream:
                for doc, n, ids in zip(b.column("doc_id"), b.column("n_tokens"), b.column("ids")):
                    raw = ids.as_py() or b""
                    yield (doc.as_py(), n.as_py(), raw, c.decode(raw)), 3 * len(raw)
        return batches(rows(), pa.schema([f for f, _ in _FIELDS]))

    return tokens.select("doc_id", "n_tokens", "ids").transform(mapped, run, ", ".join(d for _, d in _FIELDS))


_FIELDS = ((pa.field("doc_id", pa.int64()), "doc_id bigint"), (pa.field("n_tokens", pa.int64()), "n_tokens bigint"),
           (pa.field("ids", pa.binary()), "ids binary"), (pa.field("decoded", pa.string()), "decoded string"))
