"""Toxicity: features and lexicon against plain loops, held-out accuracy, edges."""

import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registrar.llm import toxicity
from registrar.llm.queries import QUERIES

from .conftest import CLASHING

CHUNKS = "you YOU idiot IDIOT!! id1ot i.d.i.o.t moron, dumb? the a xy was stuuuupid stupid ... 12 $$$ don't Übel tu %% trash".split()
LEXICON = {"idiot": 5.0, "moro*": 3.0, "dumb": 1.5, "übel": 2.6}


def plain_features(text):
    """The features by their definitions, one word at a time."""
    chunks = (text or "").split()
    n = len(chunks)
    if not n:
        return [0.0] * len(toxicity.FEATURES)
    words = [toxicity.word_of(c) for c in chunks]
    weight = [max([LEXICON.get(w.letters, 0.0), *(LEXICON.get(w.letters[:k] + "*", 0.0) for k in (4, 5, 6) if k < len(w.letters))]) for w in words]
    strong = [x >= 2.5 for x in weight]
    second = [w.letters in toxicity.SECOND_PERSON for w in words]
    shouted = [c.upper() == c and sum(x.isupper() for x in c) > 1 for c in chunks]
    near = sum(strong[i] and any(second[max(0, i - 5):i + 6]) for i in range(n))
    upper, alpha = sum(x.isupper() for x in text), sum(x.isalpha() for x in text)
    return [max(weight), math.log1p(sum(strong)), 100 * sum(strong) / n, 100 * sum(0 < x < 2.5 for x in weight) / n, sum(weight) / n,
            100 * sum(w.letters in toxicity.SEEDS for w in words) / n, near, sum(second) / n, sum(a and b for a, b in zip(strong, shouted)),
            upper / max(alpha, 1), sum(shouted) / n, text.count("!") / n, text.count("?") / n,
            sum(bool(re.search(r"[!?.#$%&*]{2,}", c)) for c in chunks) / n, sum(w.obfuscated for w in words) / n,
            sum(a and w.obfuscated for a, w in zip(strong, words)), sum(w.stretched for w in words) / n, math.log1p(n)]


@pytest.mark.parametrize("held", [3, 100_000])
def test_features_equal_plain_loops(monkeypatch, held):
    monkeypatch.setattr(toxicity, "WORDS_HELD", held)  # odd words remembered: few, then all
    extractor, rnd, texts = toxicity.Extractor(LEXICON), random.Random(3), [None, " \n "]
    for n in [0, 1, 2, 11, 12, 13, 40, 200] * 5:
        texts.append(" ".join(rnd.choice([*CHUNKS, f"w{rnd.randrange(99)}", "İdiot", "ẞtraße", "Stupiiiid", "«Übel»", "_moron_"]) for _ in range(n)))
    found = extractor.column(pa.array(texts))
    for text, row in zip(texts, found.tolist()):
        assert row == pytest.approx(plain_features(text)), text
        assert extractor.features(text) == pytest.approx(row)
    assert extractor.column(pa.array([], pa.string())).shape == (0, len(toxicity.FEATURES))


def test_words_in_bulk_equal_words_one_by_one():
    rnd = random.Random(4)
    chunks = CHUNKS + ["".join(rnd.choice("aaAbBeEÉéßñ1037@$!.,-_'’*ſıİ漢") for _ in range(rnd.randrange(1, 9))) for _ in range(3000)]
    letters, obfuscated, stretched = toxicity.Words().of(pa.array(chunks))
    got = [toxicity.Word(*x) for x in zip(letters.to_pylist(), obfuscated.tolist(), stretched.tolist())]
    assert got == [toxicity.word_of(c) for c in chunks]


def test_features_of_odd_texts():
    extractor = toxicity.Extractor(LEXICON)
    assert extractor.features(None) == extractor.features(" \n ") == [0.0] * len(toxicity.FEATURES)


def test_words():
    assert toxicity.word_of("Id1ot!!") == toxicity.Word("idiot", True, False)
    assert toxicity.word_of("i.d.i.o.t").letters == "idiot" and toxicity.word_of("STUUUUPID") == toxicity.Word("stupid", False, True)
    assert not toxicity.word_of("don't").obfuscated and toxicity.word_of("...") == toxicity.Word("", False, False)
    assert toxicity.terms("morons") == ["morons", "moro*", "moron*"] and toxicity.terms("x" * 40) == ["xxxx*", "xxxxx*", "xxxxxx*"]


def test_lexicon_equals_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TEXT_BYTES", 400)
    rnd = random.Random(8)
    rows = [(" ".join(rnd.choice(CHUNKS) for _ in range(rnd.randrange(9))), rnd.randrange(2), rnd.randrange(3)) for _ in range(300)]
    counts = toxicity._counts(spark.createDataFrame(rows, "text string, label int, fold int").repartition(4))
    got = {r.term: [r[f"{kind}{k}"] for k in range(3) for kind in ("clean", "toxic")] for r in counts.collect()}
    want = {}
    for text, label, fold in rows:
        for t in {t for c in text.split() for t in toxicity.terms(toxicity.word_of(c).letters)}:
            want.setdefault(t, [0] * 6)[2 * fold + label] += 1
    assert got == want
    sizes = {(k, y): sum(r[1:] == (y, k) for r in rows) for k in range(3) for y in range(2)}
    monkeypatch.setattr(toxicity, "LEAST_WEIGHT", -9.0)
    p, n = (sum(sizes[k, y] for k in (0, 2)) for y in (1, 0))
    weights = {}
    for t, c in want.items():
        a, b = c[1] + c[5], c[0] + c[4]
        if a >= 3:
            weights[t] = math.log((a + .5) / (p + 1)) - math.log((b + .5) / (n + 1)) - math.sqrt(1 / (a + .5) + 1 / (b + .5))
    assert toxicity._lexicon(counts, sizes, 1) == pytest.approx(weights, abs=1e-6)


def test_held_out_documents_of_a_table(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    assert all(found[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) for d in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())
    same = {}
    for d in docs:
        same.setdefault(d.text, set()).add(found[d.doc_id].score)
    assert all(len(s) == 1 for s in same.values())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if found[r.doc_id].held_out]
    toxic, clean = ([found[r.doc_id].score for r in labels if r.toxic == y] for y in (1, 0))
    ordered = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert ordered >= 0.85
    assert sum(s >= 0.7 for s in clean) <= 0.02 * len(clean) and sum(s >= 0.7 for s in toxic) >= 0.5 * len(toxic)


def test_odd_rows(spark, docs, rows, no_docs):
    ids = [d for d, *_ in rows if d is not None]
    labels = [(d, int(k % 3 == 0)) for k, d in enumerate(ids)] + [(ids[1], 1), (None, 1), (ids[2], None), (999_999, 1)]
    given = spark.createDataFrame(labels, "doc_id bigint, toxic int").select("*", *(F.lit("clash").alias(c) for c in CLASHING))
    asked = toxicity.held_out(docs.drop("held_out"))
    found = toxicity.score(asked, toxicity.train(asked.where("not held_out"), given)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, *_ in rows)
    assert all(r.held_out for r in found if r.doc_id is None) and all(0 <= r.score <= 1 for r in found)
    for some in (given.limit(0), given.where("toxic = 0"), given.where("toxic = 1")):
        model = toxicity.train(asked, some)
        assert model.trees is None
        scores = {r.score for r in toxicity.score(asked, model).collect()}
        assert scores == {1.0 if some.where("toxic = 1").count() else 0.0}
        assert toxicity.score(toxicity.held_out(no_docs.drop("held_out")), model).count() == 0
    assert toxicity.train(toxicity.held_out(no_docs.drop("held_out")), given).share == 0.0


def test_bounded_training_sample(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 10)
    labels = docs.where("doc_id is not null").select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.labelled(docs.where("doc_id <> 22"), labels).count() <= 10
