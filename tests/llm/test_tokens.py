"""BPE and token files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from registrar.llm import bpe, token_io

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAzZÉéñßİΣσ́̀  \t\n\x1c\x85\xa0 'sSlLd12٣½$%&!?€漢字ガ각\x00‍﻿"), max_size=60))
def test_codec_equals_the_library(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_codec_equals_the_library, "lib") else test_codec_equals_the_library.lib
    test_codec_equals_the_library.lib = library
    ids = bpe.codec(PATH).encode(text)
    assert token_io._encoder(PATH).encode(text) == ids
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(library, text)
    assert bpe.codec(PATH).decode(ids) == library.decode(library_ids(library, text), skip_special_tokens=False)


def test_caches_that_overflow_change_nothing(library, monkeypatch):
    """Both generations of the chunk and word caches turn over many times."""
    monkeypatch.setattr(token_io, "CHUNKS_KEPT", 7)
    monkeypatch.setattr(token_io, "WORDS_KEPT", 5)
    monkeypatch.setattr(bpe, "CHUNKS_KEPT", 7)
    monkeypatch.setattr(bpe, "WORDS_KEPT", 5)
    words = [f"{w}{mark}" for w in "the cat Sat on it's größe don't 12ab a-b naïve".split() for mark in ("", ".", "!!", "|", ",,x", "%%%")]
    text = " ".join(words * 3 + words[::-1] + ["y" * 100, "y" * 100])
    want = library_ids(library, text)
    for encoder in (token_io._Encoder(PATH), bpe.Codec(PATH)):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
        assert len(encoder.chunks) <= 7 and len(encoder.words) <= 5 and encoder.words.old


def test_merge_skips_stale_entries():
    c = bpe.codec(PATH)
    word = "aaabaaab" * 50
    want = Tokenizer.from_file(PATH).encode(word, add_special_tokens=False).ids
    assert np.frombuffer(c.encode(word), "<u4").tolist() == want


def test_encode_and_decode_frames(docs, rows, library):
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in found)
    want = []
    for d, t, *_ in rows:
        ids = library_ids(library, t)
        want.append((d is None, d or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)


def test_empty_tables(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0
    assert token_io.round_trip(no_docs, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=9000))
def test_blocks_round_trip(ids):
    ids = np.array(ids, dtype=np.uint32)
    content = token_io.TokenFile(token_io.file_bytes([(5, ids.astype("<u4").tobytes()), (None, b"")]))
    assert content.read(0, len(ids)).tolist() == ids.tolist()
    at = len(ids) // 3
    assert content.read(at, len(ids) // 2).tolist() == ids[at:at + len(ids) // 2].tolist()
    assert [(d, n) for d, n, _ in content.documents()] == [(5, 0), (None, len(ids))]


def test_outliers_do_not_widen_a_block():
    ids = np.arange(4096, dtype=np.uint32) % 16
    ids[[7, 99]] = 1 << 30
    _, blocks = token_io.pack(ids)
    assert len(blocks) == 8 + 4096 * 4 // 8 + 2 * 6


def test_token_files(docs, rows, library, monkeypatch):
    monkeypatch.setattr(token_io, "FILE_IDS", 500)
    found = token_io.round_trip(docs, PATH, 1).collect()
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((d for d, *_ in rows if d is not None)) + [None] * 2
    at = 0
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, []).append(t)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and ids in [[*library_ids(library, t), 1] for t in texts[r.doc_id]]
        at += len(ids)


def test_query_digests(spark):
    from registrar.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: library_ids(library, r.text) for r in docs}
    op1 = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, sf).collect()}
    op7 = {r.doc_id: r for r in QUERIES["op7_token_files"](spark, sf).collect()}
    start = 0
    for d in sorted(ids):
        assert op1[d].n_tokens == len(ids[d])
        assert op1[d].ids_sha256 == hashlib.sha256(np.array(ids[d], "<u4").tobytes()).hexdigest()
        assert op1[d].decoded_sha256 == hashlib.sha256(library.decode(ids[d], skip_special_tokens=False).encode()).hexdigest()
        ended = np.array([*ids[d], 1], "<u4").tobytes()
        assert (op7[d].start, op7[d].n_tokens, op7[d].ids_crc32) == (start, len(ended) // 4, zlib.crc32(ended))
        start += len(ended) // 4
