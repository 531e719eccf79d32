"""Token ids in binary files of patched frame-of-reference blocks.

A file holds whole documents in ascending doc_id order:

    magic "PFOR1\\0\\0\\0", documents, ids, blocks (unsigned 64-bit each)
    documents x (doc_id signed 64-bit, ids unsigned 64-bit, has doc_id 8-bit), column by column
    blocks x start of the block, unsigned 64-bit, counted from the first block
    blocks

A block holds BLOCK ids (the last one fewer): minimum (32-bit), width and
spare (8-bit each), exceptions (16-bit); the low ``width`` bits of every id
less the minimum, most significant first; then the exceptions' places
(16-bit) and the bits above the width (32-bit). The width is that of the
PERCENTILE-th smallest difference, so outliers don't widen a block. All
numbers are little-endian. The index makes any id reachable by one seek.
"""

from __future__ import annotations

import os
import uuid
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrar.llm.bpe import byte_alphabet
from registrar.llm.common import Remembered, batches, mapped, saved
from registrar.session import scratch_path

BLOCK = 4096
PERCENTILE = 95
#: Ids after which a file is closed; a longer document makes a longer file.
FILE_IDS = 4_000_000
#: Encoded words, and other chunks, that a worker keeps in each of two generations (about 150 bytes each).
WORDS_KEPT = 300_000
CHUNKS_KEPT = 50_000
#: Bytes of texts that are encoded together.
TEXT_BYTES = 16 << 20
#: Marks that a chunk of letters may end in and still be a word and a mark.
MARKS = ".,;:!?|"
#: Letters that are composed and have one lower case.
PLAIN_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"

_MAGIC = b"PFOR1\0\0\0"
_HEAD = np.dtype([("min", "<u4"), ("width", "u1"), ("spare", "u1"), ("exceptions", "<u2")])


# ---- encoding by the tokenizers library ----

def _gathered(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of ``flat``, which have ``sizes``, in the order ``at``, and where each begins, with the end."""
    first = np.cumsum(sizes) - sizes
    n = sizes[at]
    ends = np.concatenate(([0], np.cumsum(n)))
    return flat[np.arange(ends[-1]) + np.repeat(first[at] - ends[:-1], n)], ends


class _Encoder:
    """The library's encoder over Arrow columns. No word, added token or
    composed character spans ASCII white space, so the chunks between it are
    encoded apart: a column's distinct chunks, and of those that are letters
    with or without a mark behind, the distinct words. What a word or another
    chunk gave is remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.words = Remembered(self._word, WORDS_KEPT)
        self.chunks = Remembered(self._chunk, CHUNKS_KEPT)

    def _word(self, word: str) -> bytes:
        """Ids of one lower-case word of plain letters or of one mark."""
        stand_ins = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.alphabet)
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.tokenize(stand_ins)])

    def _chunk(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and their numbers of ids."""
        marked = pc.is_in(pc.utf8_slice_codeunits(chunks, -1), value_set=pa.array(list(MARKS)))
        heads = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        plain = pc.match_substring_regex(heads, PLAIN_WORD)
        words = pc.utf8_lower(heads.filter(plain)).dictionary_encode()
        others = chunks.filter(pc.invert(plain)).to_pylist()
        marks = pc.index_in(pc.utf8_slice_codeunits(chunks.filter(plain), -1), value_set=pa.array(list(MARKS)))
        pieces = [*map(self.words.__getitem__, words.dictionary.to_pylist()), *map(self.chunks.__getitem__, others),
                  *(self.words[m] for m in MARKS), b""]
        nothing, n_words = len(pieces) - 1, len(words.dictionary)
        is_plain = plain.to_numpy(zero_copy_only=False)
        at = np.full((len(chunks), 2), nothing)
        at[is_plain, 0] = words.indices.to_numpy()
        at[~is_plain, 0] = n_words + np.arange(len(others))
        at[is_plain, 1] = marks.fill_null(len(MARKS)).to_numpy() + nothing - len(MARKS)  # the piece behind the marks is empty
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        ids, ends = _gathered(np.frombuffer(b"".join(pieces), dtype="<u4"), sizes, at.ravel())
        return ids, np.diff(ends[::2])

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin, with the end."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        chunks = lists.flatten().dictionary_encode()
        ids, ends = _gathered(*self._distinct(chunks.dictionary), chunks.indices.to_numpy())
        return ids, ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]

    def encode(self, text: str | None) -> bytes:
        return self.encode_column(pa.array([text], pa.string()))[0].tobytes()

    def encode_rows(self, stream: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) of every row; rows of about TEXT_BYTES are encoded together."""
        def together(held: list[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
            docs, texts = (pa.concat_arrays([b.column(c) for b in held]) for c in ("doc_id", "text"))
            ids, ends = self.encode_column(texts)
            for k, doc in enumerate(docs.to_pylist()):
                yield doc, ids[ends[k]:ends[k + 1]].tobytes()

        held, size = [], 0
        for b in stream:
            held.append(b)
            size += b.column("text").nbytes
            if size >= TEXT_BYTES:
                yield from together(held)
                held, size = [], 0
        if held:
            yield from together(held)


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


# ---- the file format ----

def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(block starts, blocks) of an array of unsigned 32-bit ids."""
    blocks = []
    for at in range(0, len(ids), BLOCK):
        part = ids[at:at + BLOCK]
        low = part.min()
        d = part - low
        width = int(np.partition(d, k := (len(d) - 1) * PERCENTILE // 100)[k]).bit_length()
        over = np.flatnonzero(d >> np.uint32(width) if width < 32 else np.zeros(0))
        bits = np.unpackbits(d.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width:]
        head = np.array([(low, width, 0, len(over))], dtype=_HEAD)
        blocks.append(b"".join((head.tobytes(), np.packbits(bits).tobytes(), over.astype("<u2").tobytes(),
                                (d[over] >> np.uint32(min(width, 31))).astype("<u4").tobytes())))
    sizes = np.array([0, *map(len, blocks)], dtype="<u8")
    return np.cumsum(sizes)[:-1].astype("<u8"), b"".join(blocks)


def unpack_block(data: memoryview, n: int) -> np.ndarray:
    """The n ids of the block at the start of ``data``."""
    low, width, _, over = np.frombuffer(data, dtype=_HEAD, count=1)[0]
    width, over, at = int(width), int(over), _HEAD.itemsize
    size = (n * width + 7) // 8
    wide = np.zeros((n, 32), dtype=np.uint8)
    if width:
        wide[:, 32 - width:] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
    d = np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)
    if over:
        places = np.frombuffer(data, "<u2", over, at + size)
        d[places] |= np.frombuffer(data, "<u4", over, at + size + 2 * over) << np.uint32(width)
    return d + low


def file_bytes(docs: list[tuple[int | None, bytes]]) -> bytes:
    """A file's content for (doc_id, ids) pairs."""
    ids = np.frombuffer(b"".join(i for _, i in docs), dtype="<u4")
    starts, blocks = pack(ids)
    return b"".join((
        _MAGIC, np.array([len(docs), len(ids), len(starts)], dtype="<u8").tobytes(),
        np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes(), np.array([len(i) // 4 for _, i in docs], dtype="<u8").tobytes(),
        np.array([d is not None for d, _ in docs], dtype="u1").tobytes(), starts.tobytes(), blocks))


class TokenFile:
    """Random access to one file's content."""

    def __init__(self, data: bytes):
        if data[:8] != _MAGIC:
            raise ValueError("not a token file")
        self.data = memoryview(data)
        docs, self.ids, blocks = map(int, np.frombuffer(data, "<u8", 3, 8))
        at = 32
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.counts = np.frombuffer(data, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.known = np.frombuffer(data, "u1", docs, at + 16 * docs)
        at += 17 * docs
        self.starts = np.frombuffer(data, "<u8", blocks, at)
        self.at = at + 8 * blocks

    def read(self, start: int, n: int) -> np.ndarray:
        """n ids from place ``start`` on; reads only the blocks that hold them."""
        if not n:
            return np.empty(0, dtype=np.uint32)
        first, last = start // BLOCK, (start + n - 1) // BLOCK
        parts = [unpack_block(self.data[self.at + int(self.starts[k]):], min(BLOCK, self.ids - k * BLOCK)) for k in range(first, last + 1)]
        return np.concatenate(parts)[start - first * BLOCK:][:n]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, place of its first id in the file, ids) of every document;
        every block is unpacked once."""
        blocks = (self.read(k * BLOCK, min(BLOCK, self.ids - k * BLOCK)).astype("<u4").tobytes() for k in range(len(self.starts)))
        at, held = 0, b""
        for doc, n, known in zip(self.doc_ids.tolist(), self.counts.tolist(), self.known.tolist()):
            parts, missing = [held[:4 * n]], 4 * n - len(held)
            held = held[4 * n:]
            while missing > 0:
                block = next(blocks)
                parts.append(block[:missing])
                held, missing = block[missing:], missing - len(block)
            yield doc if known else None, at, b"".join(parts)
            at += n


# ---- Spark ----

def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text, ...) and write token files to ``folder``;
    the manifest (part, number, file, docs, ids, start) lists them in order.

    Rows are range-partitioned and sorted by doc_id (nulls last), rows of one
    doc_id by their text; each task writes the files of its range. A file has
    a name of its own per attempt and counts only through the manifest, which
    Spark commits, so a lost executor leaves no half-written result.
    """
    schema = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        number = 0

        def write(held: list[tuple[int | None, bytes]]) -> tuple:
            nonlocal number
            name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.pfor"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(file_bytes(held))
            number += 1
            return part, number - 1, name, len(held), sum(len(i) for _, i in held) // 4

        def rows():
            held, size = [], 0
            for doc, ids in encoder.encode_rows(stream):
                held.append((doc, ids + end))
                size += len(ids) // 4 + 1
                if size >= FILE_IDS:
                    yield write(held), 100
                    held, size = [], 0
            if held:
                yield write(held), 100

        return batches(rows(), schema)

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    files = saved(ordered.transform(mapped, run, "part bigint, number bigint, file string, docs bigint, ids bigint"), "token-manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = files.groupBy("part").agg(F.sum("ids").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    before = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (files.withColumn("within", F.coalesce(F.sum("ids").over(before), F.lit(0))).join(parts, "part")
            .select("part", "number", "file", "docs", "ids", (F.col("base") + F.col("within")).alias("start")))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of the manifest's
    files; ``ids`` as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)

        def rows():
            for b in stream:
                for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist()):
                    with store.open_input_file(f"{root}/{name}") as f:
                        content = TokenFile(f.read())
                    for doc, at, ids in content.documents():
                        yield (doc, start + at, len(ids) // 4, ids), len(ids)
        return batches(rows(), schema)

    files = manifest.select("file", "start")
    return (files.repartition(max(1, min(files.count(), 100_000)), "start")
            .transform(mapped, run, "doc_id bigint, start bigint, n_tokens bigint, ids binary"))


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write token files of ``docs`` to a new folder of the shared storage and
    read them back.

    A null text counts as empty and has only the end id; a null doc_id comes
    last; repeated rows are stored each; other columns are ignored; an empty
    table gives no files and an empty result.
    """
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, path, folder, end_id), folder)
