import random

import pytest

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa".split()
#: Names that the operators use inside; a table may have such columns too.
CLASHING = ("row rid norm hash head salt hot first place n size keep_id bands node bucket u root set_id text_key shingles "
            "ids decoded start file part split shard passed slot word held_out lang_pred host path rule found").split()


def prose(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return [rnd.choice(WORDS) + str(rnd.randrange(200)) for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars) with every odd case."""
    base = prose(1, 120)
    near = base[:60] + ["changed"] + base[61:]
    far = base[:60] + prose(2, 60)
    out = [
        (10, " ".join(base), "en"), (4, "\n".join(base), "en"), (11, " ".join(base), None), (12, " ".join(near), "en"),
        (13, " ".join(far), "de"), (14, None, "en"), (15, "", "en"), (16, " \t\n ", "de"), (17, "12 34 !!", None),
        (18, "one two", "de"), (19, "One  two", "de"), (20, "x" * 300_000, None), (21, " ".join(prose(3, 60_000)), "fr"),
        (None, "no id", None), (None, "no id", "de"), (22, "repeated row", "fr"), (22, "repeated row", "fr"),
        (23, None, None), (24, "Größe naïve 漢字 ΑΣ İx <|endoftext|> under the MIT License, end", "de"),
        (25, "Under the MIT license: apache license VERSION 2 cc-by-nc / CC BY NC", "en"),
        (26, "this work is licensed under the GNU General Public License, version 3", "en"), (27, "a\x00b é", "fr"),
    ]
    out += [(100 + k, " ".join(prose(500, 80)), "en") for k in range(200)]  # many copies of one text
    out += [(400 + k, " ".join([*prose(900, 100)[:k], f"edit{k}", *prose(900, 100)[k + 1:]]), "fr") for k in range(60)]
    return [(d, t, lang, "s", None if t is None else len(t)) for d, t, lang in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame = frame.repartition(5, "doc_id").select("*", *(F.lit("clash").alias(c) for c in CLASHING))
    return frame


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
