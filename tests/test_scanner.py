"""Comment-aware splitting: the scanner, its transitions and the prefix scan over splits."""

import random
import re

import pytest

from registrar.sources import scanner
from registrar.sources.scanner import TEXT

CLOSING = "</r>"


def whole(text):
    """Records of a dump by its definition: comments out, CDATA escaped, then cut at the closing tag."""
    def plain(m):
        return "" if m[0].startswith("<!--") else scanner._escaped(m[0][9:-3])
    return re.sub(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", plain, text).split(CLOSING)


def random_dump(rnd, n):
    parts = []
    for _ in range(n):
        parts.append(rnd.choice(["<r><a>1</a></r>", "<r><a>", "x", "</a></r>", "\n", "<!--", "-->", "<!-- </r> -->", "<![CDATA[", "]]>", "<![CDATA[ <b> & </r> ]]>",
                                 "</r>", "<!-- <![CDATA[ -->", "<![CDATA[ <!-- ]]>", "-- >", "]]"]))
    text = "".join(parts)
    open_comment, open_cdata = (re.sub(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "", text).rfind(m) >= 0 for m in ("<!--", "<![CDATA["))
    return None if open_comment or open_cdata else text


def test_scanner_equals_the_definition():
    rnd, seen = random.Random(1), 0
    while seen < 2000:
        text = random_dump(rnd, rnd.randrange(14))
        if text is None:
            continue
        s = scanner.Scanner(CLOSING)
        found = [x for p in text.split(CLOSING) if (x := s.feed(p)) is not None]
        assert found == whole(text), text
        seen += 1


def test_splits_at_any_place_give_the_same_records():
    """Splits scanned apart, their transitions composed, then scanned again from the true starts."""
    rnd, seen, inside = random.Random(2), 0, 0
    while seen < 1500:
        text = random_dump(rnd, rnd.randrange(2, 20))
        if text is None:
            continue
        pieces = text.split(CLOSING)
        cuts = sorted(rnd.randrange(len(pieces) + 1) for _ in range(rnd.randrange(4)))
        splits = [pieces[a:b] for a, b in zip([0, *cuts], [*cuts, len(pieces)]) if b > a]
        state, carry, found = TEXT, "", []
        for split in splits:
            first = scanner.SplitScan(CLOSING)  # as if it began in text
            for p in split:
                first.feed(p) if any(m in p for m in scanner.MARKERS) or first.main.state != TEXT or first.main.carry else first.feed_plain(p)
            true = scanner.SplitScan(CLOSING, state, carry)
            found += [x for p in split if (x := true.feed(p)) is not None]
            to, text_on, replaces = {s: rest for s, *rest in first.transition()}[state]
            inside += state != TEXT
            state, carry = to, text_on if replaces else carry + text_on
            assert (state, carry) == (true.main.state, true.main.carry), (text, splits)
        assert found == whole(text) and state == TEXT
        seen += 1
    assert inside > 300


@pytest.mark.parametrize("size", [40, 64, 300, 10_000])
def test_files_in_small_splits(spark, tmp_path, size):
    rnd, texts = random.Random(3), {}
    for k in range(4):
        while (text := random_dump(rnd, 60)) is None:
            pass
        texts[f"f{k}"] = text + "<!-- " + "<r><a>never</a></r>" * 20 + " --><r><a>last</a></r>"
        (tmp_path / f"f{k}").write_text(texts[f"f{k}"])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        raw = scanner.pieces(spark, [str(tmp_path / f) for f in texts], "r")
        first = scanner.scan(raw, "r")
        found = scanner.starts(first.where("from_state is not null")).collect()
        known = spark.createDataFrame(found, "file string, start bigint, state string, carry string")
        assert size >= 10_000 or known.count()
        rows = scanner.scan(scanner.with_starts(raw, known), "r").where("from_state is null").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    for name, text in texts.items():
        got = sorted(r.value for r in rows if r.file.endswith("/" + name))
        want = whole(text)
        assert got == sorted(want if want[-1] else want[:-1]), name
    assert not any("never" in r.value for r in rows)


def test_one_piece_of_many_comments_takes_linear_time():
    """A file without a closing tag is one piece; walking it must not copy the rest per comment."""
    import time
    piece = "".join(f"<!-- c{k} -->\n" for k in range(120_000)) + "<a>1</a>"
    t0 = time.perf_counter()
    split = scanner.SplitScan("</r>")
    assert split.feed(piece) == "\n" * 120_000 + "<a>1</a>"
    assert split.transition()[0][1:] == (scanner.TEXT, "", True)
    assert time.perf_counter() - t0 < 20


def test_a_section_over_many_pieces_is_carried_in_parts():
    """The carried text must not be copied once per piece."""
    import time
    open_section, n, text = scanner.Scanner("</r>", scanner.CDATA), 20_000, "x" * 2_000
    t0 = time.perf_counter()
    assert all(open_section.feed(text) is None for _ in range(n))
    assert open_section.feed("y]]>z") == (text + "&lt;/r&gt;") * n + "yz"
    assert open_section.carry == "" and time.perf_counter() - t0 < 8
