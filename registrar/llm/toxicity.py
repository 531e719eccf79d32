"""Toxicity scores by gradient-boosted trees over dense features.

Training, on labelled documents only:

1. A lexicon: for every word and word beginning, in how many toxic and in how
   many other documents it occurs (summed by Spark). Its weight is the lower
   bound of its log odds ratio; the LEXICON_TERMS heaviest stay.
2. Features of each document (``FEATURES``): densities of lexicon hits, hits
   near a second person, capitals, punctuation and obfuscation rates. The rows
   are dealt into FOLDS folds by their text, and a training row's features come
   from the lexicon of the other folds, so no row vouches for itself.
3. Boosted trees (Spark ML) on all folds but the last, and an isotonic
   calibration of their margin on the last.

Scoring is one pass over all documents: features in Arrow batches, trees and
calibration in the JVM. The classifier is fitted on at most TRAIN_ROWS
labelled documents, those of the smallest hashes of their ids; their ids are
what is broadcast to pick them out of the documents without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import Remembered, mapped, saved

#: Labelled documents that the classifier is fitted on, at most.
TRAIN_ROWS = 200_000
FOLDS = 3
#: Terms of a lexicon, and the weights from which a term counts and counts as strong.
LEXICON_TERMS = 2000
LEAST_WEIGHT = 1.0
STRONG = 2.5
#: Toxic documents that a term must occur in.
LEAST_DOCUMENTS = 3
#: Lengths of the word beginnings that are terms too; longer words than MOST_LETTERS count by their beginnings.
BEGINNINGS = (4, 5, 6)
MOST_LETTERS = 32
#: Words between a lexicon hit and a second person that still count as near.
NEAR = 5
#: Score from which a document is predicted as toxic.
THRESHOLD = 0.7
TREES, DEPTH, STEP = 25, 3, 0.3
#: Bytes of texts that are looked at together, and odd words remembered.
TEXT_BYTES = 16 << 20
WORDS_HELD = 100_000

#: Insults that count whatever the labels say.
SEEDS = frozenset("idiot moron scum loser trash stupid dumb pathetic worthless disgusting "
                  "dummkopf abschaum arschloch connard imbécile salaud idiota estúpido imbécil basura".split())
SECOND_PERSON = frozenset("you your yours yourself u ur youre du dich dir dein deine deiner euch ihr "
                          "tu te toi ton tes vous votre vos tú ti tus usted ustedes vosotros".split())
#: Signs that stand in for letters inside a word.
STAND_INS = str.maketrans("013457@$!", "oieastasi")

FEATURES = ("strongest_hit", "strong_hits", "strong_density", "weak_density", "weight_density", "seed_density",
            "near_second_person", "second_person", "shouted_hits", "capitals", "shouted_words", "exclamations",
            "questions", "mark_runs", "obfuscated", "obfuscated_hits", "stretched", "length")

#: Signs that are stripped around a word in bulk, words of plain letters, and letters three times in a row;
#: all other chunks of text go through ``word_of`` one by one.
_AROUND = ".,;:!?|\"'()[]{}%$&*#-–…«»„“”"
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_THRICE = "(?i)" + "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß")

_OUTSIDE = re.compile(r"^[\W_]+|[\W_]+$")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_MARKS = re.compile(r"[!?.#$%&*]{2,}")


@dataclass(frozen=True)
class Word:
    letters: str
    obfuscated: bool
    stretched: bool


def word_of(chunk: str) -> Word:
    """The lower-case word in a chunk of text without white space: signs
    around it go, stand-ins inside it become letters, other signs inside it
    go, and three or more of one letter become one."""
    core = _OUTSIDE.sub("", chunk.lower())
    plain = core.isalpha()
    letters = core if plain else "".join(c for c in core.translate(STAND_INS) if c.isalpha())
    obfuscated = not plain and any(c.isalpha() for c in core) and any(not c.isalpha() and c not in "'’-" for c in core)
    once = _STRETCHED.sub(r"\1", letters)
    return Word(once, obfuscated, once != letters)


def terms(word: str) -> list[str]:
    """The lexicon's entries that a word may match: itself and its beginnings."""
    found = [word] if 1 < len(word) <= MOST_LETTERS else []
    return found + [word[:n] + "*" for n in BEGINNINGS if n < len(word)]


class Words:
    """Words of Arrow columns of chunks."""

    def __init__(self):
        self.odd = Remembered(word_of, WORDS_HELD)

    def of(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(letters, obfuscated, stretched) of ``word_of`` for all chunks."""
        trimmed = pc.utf8_trim(chunks, characters=_AROUND)
        plain = pc.and_(pc.match_substring_regex(trimmed, _PLAIN), pc.invert(pc.match_substring_regex(trimmed, _THRICE)))
        others = [self.odd[c] for c in chunks.filter(pc.invert(plain)).to_pylist()]
        letters = pc.replace_with_mask(pc.utf8_lower(trimmed), pc.invert(plain), pa.array([w.letters for w in others], pa.string()))
        flags = np.zeros((2, len(chunks)), dtype=bool)
        flags[:, ~plain.to_numpy(zero_copy_only=False)] = [[w.obfuscated for w in others], [w.stretched for w in others]]
        return letters, flags[0], flags[1]


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct chunks between ASCII white space, each place's chunk, each
    text's first place, with the end)."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    places = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    flat = lists.flatten()
    empty = pc.equal(flat, "")  # beside white space at a text's ends
    if (some := pc.sum(empty).as_py()):
        gone = np.concatenate(([0], np.cumsum(empty.to_numpy(zero_copy_only=False))))
        places, flat = places - gone[places], flat.filter(pc.invert(empty))
    chunks = flat.dictionary_encode()
    return chunks.dictionary, chunks.indices.to_numpy(), places


class Extractor:
    """Features of columns of texts under one lexicon: each distinct chunk is
    looked up once; what the texts' chunks count for is then summed."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = Words()
        #: by length of the beginning (0: whole words): the terms and their weights
        self.terms = {}
        for n in (0, *BEGINNINGS):
            found = {t.rstrip("*"): w for t, w in lexicon.items() if t.endswith("*") == bool(n) and (not n or len(t) == n + 1)}
            self.terms[n] = pa.array(list(found), pa.string()), np.array([*found.values(), 0.0])

    def _weights(self, letters: pa.Array) -> np.ndarray:
        length = pc.utf8_length(letters).to_numpy()
        best = np.zeros(len(letters))
        for n, (known, weights) in self.terms.items():
            at = pc.index_in(pc.utf8_slice_codeunits(letters, 0, n) if n else letters, value_set=known).fill_null(len(known)).to_numpy()
            fits = length > n if n else (length > 1) & (length <= MOST_LETTERS)
            best = np.maximum(best, np.where(fits, weights[at], 0.0))
        return best

    def _counts(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """What each chunk counts for: (rarely more than nothing, 13 columns; letters and capitals, 2 columns)."""
        letters, obfuscated, stretched = self.words.of(chunks)
        weight = self._weights(letters)
        strong = weight >= STRONG
        upper, alpha = (pc.count_substring_regex(chunks, r).to_numpy() for r in (r"\p{Lu}", r"\p{L}"))
        shouted = (upper > 1) & pc.equal(pc.utf8_upper(chunks), chunks).to_numpy(zero_copy_only=False)
        among = [pc.is_in(letters, value_set=pa.array(sorted(x))).to_numpy(zero_copy_only=False) for x in (SEEDS, SECOND_PERSON)]
        rare = [weight, strong, (weight > 0) & ~strong, *among, strong & shouted, shouted,
                *(pc.count_substring(chunks, c).to_numpy() for c in "!?"),
                pc.match_substring_regex(chunks, _MARKS.pattern).to_numpy(zero_copy_only=False), obfuscated, strong & obfuscated, stretched]
        return np.stack(rare, axis=1).astype(np.float64), np.stack([upper, alpha], axis=1)

    def column(self, texts: pa.Array) -> np.ndarray:
        """One row of features per text."""
        chunks, at, places = _chunks(texts)
        n, out = np.diff(places), np.zeros((len(texts), len(FEATURES)))
        if not len(chunks):
            return out
        rare, common = self._counts(chunks)
        where = np.flatnonzero(rare.any(axis=1)[at])  # few places; all others add nothing
        text_of = np.searchsorted(places, where, side="right") - 1
        found = rare[at[where]]
        total = np.stack([np.bincount(text_of, weights=c, minlength=len(texts)) for c in found.T], axis=1)
        strongest = np.zeros(len(texts))
        np.maximum.at(strongest, text_of, found[:, 0])
        upper, alpha = (np.diff(np.concatenate(([0], np.cumsum(c[at])))[places]) for c in common.T)
        hits, second = found[:, 1] > 0, where[found[:, 4] > 0]
        first, last = np.maximum(where[hits] - NEAR, places[text_of[hits]]), np.minimum(where[hits] + NEAR, places[text_of[hits] + 1] - 1)
        close = np.searchsorted(second, last, side="right") > np.searchsorted(second, first)
        near = np.bincount(text_of[hits][close], minlength=len(texts))
        weight, strong, weak, seeds, you, shouted_hits, shouted, bangs, asks, runs, odd, odd_hits, stretched = total.T
        words = np.maximum(n, 1)
        out[:] = np.stack([strongest, np.log1p(strong), 100 * strong / words, 100 * weak / words, weight / words, 100 * seeds / words,
                           near, you / words, shouted_hits, upper / np.maximum(alpha, 1), shouted / words, bangs / words,
                           asks / words, runs / words, odd / words, odd_hits, stretched / words, np.log1p(n)], axis=1)
        return out

    def features(self, text: str | None) -> list[float]:
        return self.column(pa.array([text], pa.string()))[0].tolist()


def _together(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Record batches whose texts have about TEXT_BYTES."""
    held, size = [], 0
    for b in stream:
        held.append(b)
        size += b.column("text").nbytes
        if size >= TEXT_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held and (rows := pa.Table.from_batches(held).combine_chunks()).num_rows:
        yield rows.to_batches()[0]


@dataclass(frozen=True)
class Model:
    """What ``train`` fits. Without both labels there are no trees, and every score is ``share``."""

    lexicon: dict[str, float]
    share: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def held_out(rows: DataFrame) -> DataFrame:
    """``rows`` with a flag on every third of the ids' CRCs; rows without an id are held out."""
    return rows.withColumn("held_out", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(True)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fold) of the documents that the classifier is fitted on:
    those with a label (of several the largest counts), the TRAIN_ROWS
    smallest hashes of their ids. Equal texts are in one fold."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg((F.max("toxic") > 0).cast("int").alias("label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)  # 16 bytes a row: a broadcast of 4 MB at most
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label", fold.alias("fold"))


def _counts(rows: DataFrame) -> DataFrame:
    """(term, toxic0, clean0, toxic1, ...): documents of each fold and label that a term occurs in."""
    width = 2 * FOLDS
    names = [f"{kind}{k}" for k in range(FOLDS) for kind in ("clean", "toxic")]
    schema = pa.schema([("term", pa.string()), *((n, pa.int64()) for n in names)])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in _together(stream):
            chunks, at, places = _chunks(b.column("text"))
            letters, *_ = words.of(chunks)
            length = pc.utf8_length(letters).to_numpy()
            text_of = np.repeat(np.arange(b.num_rows), np.diff(places))
            sort = 2 * b.column("fold").to_numpy().astype(np.int64) + b.column("label").to_numpy()
            for n in (0, *BEGINNINGS):
                terms = pc.utf8_slice_codeunits(letters, 0, n).dictionary_encode() if n else letters.dictionary_encode()
                fits = length > n if n else (length > 1) & (length <= MOST_LETTERS)
                term_of, known = terms.indices.to_numpy().astype(np.int64), len(terms.dictionary)
                there = fits[at]
                once = np.unique(text_of[there] * known + term_of[at[there]])  # each term once per text
                counts = np.bincount(once % known * width + sort[once // known], minlength=known * width).reshape(-1, width) if known else np.zeros((0, width), int)
                some = np.flatnonzero(counts.any(axis=1))
                named = terms.dictionary.take(pa.array(some))
                named = pc.binary_join_element_wise(named, "*", "") if n else named
                yield pa.RecordBatch.from_arrays([named, *(pa.array(c) for c in counts[some].T)], schema=schema)

    partial = rows.transform(mapped, run, ", ".join(["term string", *(f"{n} bigint" for n in names)]))
    return partial.groupBy("term").agg(*(F.sum(n).alias(n) for n in names))


def _lexicon(counts: DataFrame, sizes: dict[tuple[int, int], int], without: int | None) -> dict[str, float]:
    """The heaviest terms over all folds but one."""
    folds = [k for k in range(FOLDS) if k != without]
    toxic, clean = (sum((F.col(f"{kind}{k}") for k in folds), F.lit(0)) for kind in ("toxic", "clean"))
    n_toxic, n_clean = (sum(sizes.get((k, label), 0) for k in folds) for label in (1, 0))
    odds = F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))
    weight = F.round(odds - F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)), 6)
    best = (counts.where(toxic >= LEAST_DOCUMENTS).select("term", weight.alias("weight")).where(F.col("weight") >= LEAST_WEIGHT)
            .orderBy(F.desc("weight"), "term").limit(LEXICON_TERMS))
    return {r.term: r.weight for r in best.collect()}


def _featured(rows: DataFrame, keep: dict[str, tuple[str, pa.DataType]], lexicons: list[dict[str, float]], fold: str | None) -> DataFrame:
    """``keep`` columns of ``rows`` and their features under the lexicon of their fold."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)
    schema = pa.schema([*((c, t) for c, (_, t) in keep.items()), ("features", pa.list_(pa.float64()))])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractors = [Extractor(x) for x in shared.value]
        for b in _together(stream):
            found = np.zeros((b.num_rows, len(FEATURES)))
            folds = b.column(fold).to_numpy() if fold else np.zeros(b.num_rows, dtype=int)
            for k, extractor in enumerate(extractors):
                mine = np.flatnonzero(folds == k)
                if len(mine):
                    found[mine] = extractor.column(b.column("text").take(pa.array(mine)) if len(mine) < b.num_rows else b.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(FEATURES), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], schema=schema)

    columns = list(dict.fromkeys(["text", *keep, *([fold] if fold else [])]))
    return (rows.select(*columns).transform(mapped, run, ", ".join([*(f"{c} {t}" for c, (t, _) in keep.items()), "features array<double>"]))
            .withColumn("features", array_to_vector("features")))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows of ``labels`` (doc_id, toxic) with a document."""
    rows = saved(labelled(docs, labels), "toxicity-rows")
    sizes = {(r.fold, r.label): r.n for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    n, n_toxic = sum(sizes.values()), sum(v for (_, label), v in sizes.items() if label)
    counts = saved(_counts(rows), "toxicity-terms")
    everything = _lexicon(counts, sizes, None)
    if n_toxic in (0, n):
        return Model(everything, n_toxic / n if n else 0.0)
    lexicons = [_lexicon(counts, sizes, k) for k in range(FOLDS)]
    keep = {"label": ("int", pa.int32()), "fold": ("int", pa.int32())}
    fitted = saved(_featured(rows, keep, lexicons, "fold"), "toxicity-features").withColumn("label", F.col("label").cast("double"))
    last = F.col("fold") == FOLDS - 1
    apart = all(sizes.get((FOLDS - 1, label)) and sum(sizes.get((k, label), 0) for k in range(FOLDS - 1)) for label in (0, 1))
    grower = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=64, minInstancesPerNode=3, seed=7)
    trees = grower.fit(fitted.where(~last) if apart else fitted)  # a few labels that don't fill both sides serve twice
    margins = _margin(trees.transform(fitted.where(last) if apart else fitted))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins.select("margin", "label"))
    return Model(everything, n_toxic / n, trees, calibration)


def _margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("margin", vector_to_array("rawPrediction")[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out, ...): doc_id,
    held_out, score, predicted.

    A null text counts as empty and has a score too. Whole texts are read,
    nothing but the text matters, rows of equal texts have equal scores;
    repeated rows and null ids stay; other columns are ignored; an empty table
    gives an empty one.
    """
    keep = {"doc_id": ("bigint", pa.int64()), "held_out": ("boolean", pa.bool_())}
    if model.trees is None:
        found = docs.select("doc_id", "held_out", F.lit(float(model.share)).alias("score"))
    else:
        margins = _margin(model.trees.transform(_featured(docs, keep, [model.lexicon], None)))
        calibrated = model.calibration.copy().setFeaturesCol("margin").setPredictionCol("score")
        found = calibrated.transform(margins.select("doc_id", "held_out", "margin")).select(
            "doc_id", "held_out", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
