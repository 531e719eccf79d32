"""License scans with a positional index of rare words.

Every template is a run of words with mandatory key phrases at fixed places.
The licence words' document frequencies are counted over the whole corpus; of
each template the two rarest words of its key phrases (highest IDF) are
indexed with their places. A file's licence words are looked up; every place
of an indexed word proposes a start of its template, the starts proposed by
both words are intersected, and the key phrases are verified there. A key
phrase holds both indexed words, so no place of it is missed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped, texts


class Template(NamedTuple):
    label: str
    words: str
    key: str  # the mandatory phrase; "..." stands between phrases that keep their places
    base: bool = False


# The base phrases and the opening words of public licences.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("agpl-3", "gnu affero general public license version 3", "gnu affero general public license version 3"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             "you may not use this file except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that",
             "redistribution and use in source and binary forms"),
    Template("cc-by", "creative commons attribution 4 0 international", "creative commons attribution 4 0"),
    Template("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    Template("gpl-2", "gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             "permission is hereby granted free of charge ... obtaining a copy of this software"),
    Template("mpl-2", "mozilla public license version 2", "mozilla public license version 2"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software released into the public domain"),
)

_SEPARATORS = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else b + 32 if 65 <= b <= 90 else 32
                    for b in range(256))


def file_words(text: str | None) -> list[bytes]:
    """Words of a text: runs of a-z, A-Z lower-cased, 0-9 and code points above 127."""
    return (text or "").encode("utf-8").translate(_SEPARATORS).split()


def _words(phrase: str) -> list[bytes]:
    return phrase.encode("utf-8").split()


def _find(words: list[bytes], phrase: list[bytes]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)


class Index:
    """Postings of the templates' rarest key words."""

    def __init__(self, templates: Iterable[Template], documents: int, frequency: dict[bytes, int]):
        self.templates, self.postings = [], {}
        idf = lambda w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1
        for t, template in enumerate(templates):
            words = _words(template.words)
            phrases = [(_find(words, p), p) for p in map(_words, template.key.split(" ... "))]
            places = [at + k for at, p in phrases for k in range(len(p))]
            rare = sorted(places, key=lambda q: (-idf(words[q]), q))[:2]
            for q in rare:
                self.postings.setdefault(words[q], []).append((t, q))
            weights = [idf(w) for w in words]
            first = phrases[0][0]
            self.templates.append((template, words, phrases, weights, len(rare), first))
        self.rare = frozenset(self.postings)

    def scan(self, words: list[bytes]) -> list[tuple[Template, int, float]]:
        """(template, place of its first key phrase, IDF-weighted share of its words in place) of every match."""
        if self.rare.isdisjoint(words):
            return []
        votes: Counter[tuple[int, int]] = Counter()
        for place, word in enumerate(words):
            if word in self.rare:
                votes.update((t, place - q) for t, q in self.postings[word])
        found = []
        for (t, start), n in votes.items():
            template, own, phrases, weights, need, first = self.templates[t]
            if n < need or any(start + at < 0 or words[start + at:start + at + len(p)] != p for at, p in phrases):
                continue
            same = sum(w for k, w in enumerate(weights) if 0 <= start + k < len(words) and words[start + k] == own[k])
            found.append((template, start + first, same / sum(weights)))
        return found


def frequencies(docs: DataFrame, templates: Iterable[Template] = TEMPLATES) -> tuple[int, dict[bytes, int]]:
    """Number of documents and, for every template word, of those that hold it."""
    vocabulary = frozenset(w for t in templates for w in _words(t.words))
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for _, text in texts(stream):
            held.update(vocabulary.intersection(file_words(text)))
            held[b""] += 1
        return batches((((w, n), 8) for w, n in held.items()), schema)

    sums = (docs.select("doc_id", "text").transform(mapped, run, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())  # one row per template word
    found = {bytes(r.word): r.n for r in sums}
    return found.pop(b"", 0), found


def scan(docs: DataFrame, templates: Iterable[Template] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_words,
    n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of base phrases; first_word and last_word are
    their smallest and largest start (null without one). Labels are distinct,
    sorted, comma-joined and empty without a match; score is the best match's
    IDF-weighted share of template words in place, 0 without one. A null text
    counts as empty; null ids and repeated rows stay; other columns are
    ignored; an empty table gives an empty one.
    """
    templates = tuple(templates)
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates, *frequencies(docs, templates)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc, text in texts(stream):
                words = file_words(text)
                found = shared.value.scan(words)
                base = {(t.words, place) for t, place, _ in found if t.base}
                starts = [place for _, place in base]
                yield (doc, len(words), len(base), min(starts, default=None), max(starts, default=None),
                       ",".join(sorted({t.label for t, _, _ in found if t.base})),
                       ",".join(sorted({t.label for t, _, _ in found})), max((s for _, _, s in found), default=0.0)), 64
        return batches(rows(), schema)

    return docs.select("doc_id", "text").transform(
        mapped,
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
             "base_labels string, labels string, score double")
