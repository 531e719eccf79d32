"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary classifier per bit
(naive Bayes over hashed character 1- to 3-grams) predicts that bit of a
text's language; decoding takes the codeword of the least loss, each bit's
logistic loss weighted by how often its classifier was right on that
language in training. The classifiers come from n-gram counts over all
training rows, summed by Spark; only the table of counts per language
(languages x BUCKETS numbers, at most MOST_LANGUAGES) reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped

BUCKETS = 1 << 15
#: Languages a model may have; more labels are refused, not cut.
MOST_LANGUAGES = 200
#: Scale of a classifier's mean log odds per n-gram before the loss.
SHARPNESS = 12.0
#: A text is ambiguous if the two nearest codewords' shares differ by less.
AMBIGUOUS = 0.05
UNKNOWN = "und"
#: Characters looked at a time; counts of all blocks of a text are added up.
BLOCK_CHARS = 1 << 18

_LETTER = re.compile(r"[^\W\d_]")
_is_letter = np.array([chr(i).isalpha() for i in range(0xD800)] + [True] * (0x110000 - 0xD800))


def grams(text: str) -> np.ndarray:
    """Counts of a text's hashed character 1- to 3-grams; everything but
    letters counts as a blank."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(text), BLOCK_CHARS):
        block = text[at:at + BLOCK_CHARS].lower()
        c = np.frombuffer(f" {block} ".encode("utf-32-le"), dtype=np.uint32)
        c = np.where(_is_letter[c], c, np.uint32(32)).astype(np.uint64)
        full = c != 32
        one = c * np.uint64(0x9E3779B97F4A7C15)
        two = (one[:-1] + c[1:]) * np.uint64(0xD6E8FEB86659FD93)
        three = (two[:-1] + c[2:]) * np.uint64(0xBF58476D1CE4E5B9)
        for h, keep in ((one, full), (two, full[:-1] | full[1:]), (three, full[:-2] | full[1:-1] | full[2:])):
            total += np.bincount((h[keep] >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return total


def codewords(n: int) -> np.ndarray:
    """n codewords: all splits of the languages for up to five, else random
    splits of a fixed seed, ten bits per doubling, no bit or word twice."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= 5:
        splits = range(1, 1 << (n - 1))
        bits = np.array([[1 if s >> i & 1 else -1 for s in splits] for i in range(n)], dtype=np.int8)
        return bits
    rng = np.random.default_rng(n)
    while True:
        bits = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, 10 * (n - 1).bit_length()))
        mixed = np.abs(bits.sum(axis=0, dtype=np.int64)) < n
        if mixed.all() and len(np.unique(bits, axis=0)) == n and len(np.unique(bits, axis=1).T) == bits.shape[1]:
            return bits


class Model:
    """Bit classifiers and decoding weights."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)  # every language weighs the same
        bits = []
        for b in range(self.code.shape[1]):
            up, down = share[self.code[:, b] > 0].mean(axis=0), share[self.code[:, b] < 0].mean(axis=0)
            bits.append(np.log(up) - np.log(down))
        self.odds = np.array(bits).T if bits else np.zeros((BUCKETS, 0))
        self.weight = np.ones(self.code.shape, dtype=float)

    def weigh(self, right: np.ndarray) -> None:
        """Decoding weights from each bit's share of right answers per language."""
        total = right.sum(axis=1, keepdims=True)
        self.weight = np.where(total > 0, right / np.where(total > 0, total, 1) * right.shape[1], 1.0)

    def outputs(self, text: str) -> np.ndarray:
        g = grams(text)
        some = np.flatnonzero(g)
        return SHARPNESS * (g[some] @ self.odds[some]) / max(1, g[some].sum())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its share of the decoding weights, whether ambiguous."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        loss = (self.weight * np.logaddexp(0, -self.code * self.outputs(text))).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(loss.argmin())  # of equals the first in alphabetical order
        second = np.partition(share, -2)[-2] if len(share) > 1 else 0.0
        return self.languages[best], float(share[best]), bool(share[best] - second < AMBIGUOUS)


def train(labelled: DataFrame) -> Model:
    """Model of the rows of ``labelled`` (text, lang) with a label and a
    letter. Two passes: n-gram counts, then each bit's share of right answers."""
    rows = labelled.select("text", "lang").where("lang is not null and text is not null")
    languages = [r.lang for r in rows.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    place = {lang: i for i, lang in enumerate(languages)}
    schema = pa.schema([("lang", pa.int32()), ("at", pa.int32()), ("n", pa.int64())])

    def summed(make, width: int) -> np.ndarray:
        """Sums over all rows of the vector that ``make`` gives for each, by language."""
        def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(languages), width), dtype=np.int64)
            for b in stream:
                for text, lang in zip(b.column("text"), b.column("lang")):
                    i, t = place[lang.as_py()], text.as_py()
                    if _LETTER.search(t):
                        total[i] += make(t, i)
            lang, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(at, pa.int32()),
                                              pa.array(total[lang, at], pa.int64())], schema=schema)
        out = np.zeros((len(languages), width), dtype=np.int64)
        sums = rows.transform(mapped, run, "lang int, at int, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n"))
        for r in sums.toLocalIterator():
            out[r.lang, r.at] = r.n
        return out

    if not languages:
        return Model([], np.zeros((0, BUCKETS)))
    model = Model(languages, summed(lambda t, i: grams(t), BUCKETS))
    if model.code.shape[1]:
        shared = rows.sparkSession.sparkContext.broadcast(model)
        model.weigh(summed(lambda t, i: shared.value.outputs(t) * shared.value.code[i] > 0, model.code.shape[1]))
    return model


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with a flag on every fourth of the ids' CRCs; rows without an id are held out."""
    return docs.withColumn("held_out", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(True)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, held_out, text): doc_id, held_out,
    lang_pred, score, ambiguous.

    A null text or one without a letter gives ``und`` and score 0, and so
    does every text if the model knows no language. Whole texts are read;
    nothing but the text matters. Repeated rows and null ids stay; an empty
    table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in stream:
                for doc, out, text in zip(b.column("doc_id"), b.column("held_out"), b.column("text")):
                    yield (doc.as_py(), out.as_py(), *shared.value.predict(text.as_py())), 32
        return batches(rows(), schema)

    return docs.select("doc_id", "held_out", "text").transform(
        mapped,
        run, "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language and no ambiguity, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in stream:
            found = (shared.value.predict(t.as_py()) for t in b.column("text"))
            yield b.filter(pa.array([lang != UNKNOWN and not ambiguous for lang, _, ambiguous in found], type=pa.bool_()))

    return docs.transform(mapped, run, docs.schema)
