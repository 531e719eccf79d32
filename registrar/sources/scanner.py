"""Comment-aware splitting of record dumps.

The text source cuts a dump at the element's closing tag, blind to comments
and CDATA sections. A scanner with three states (text, comment, CDATA) runs
over the pieces of a file split in order: comments go, CDATA becomes escaped
text, and pieces that were cut inside either are put together again.

A split's scanner starts in the text state. What the split would have done to
the other start states is kept as its transition (one small row per split),
and the transitions are composed along each file, a prefix scan over splits.
Only if that finds a split that began inside a comment or CDATA section are
the files read again, now with every split's true start state and the text
carried into it. No split is ever read whole, and no file by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code

TEXT, COMMENT, CDATA = "text", "comment", "cdata"
_OPEN = {COMMENT: "<!--", CDATA: "<![CDATA["}
_CLOSE = {COMMENT: "-->", CDATA: "]]>"}
MARKERS = (*_OPEN.values(), *_CLOSE.values())
_KIND = {mark: state for state, mark in _OPEN.items()}
_OPENING = re.compile("|".join(map(re.escape, _KIND)))


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class Scanner:
    """State of one scan. ``feed`` takes the next piece and gives the text of a
    whole record, or None while a comment or CDATA section goes on.

    A piece is walked by position, and what is carried stays in parts until it
    is needed, so the time is linear in the text: a dump without a closing tag
    is one piece per file, and a section may go on over all pieces of a split."""

    def __init__(self, closing: str, state: str = TEXT, carry: str = ""):
        self.closing, self.state, self.held = closing, state, [carry] if carry else []
        self.emitted = False

    @property
    def carry(self) -> str:
        if len(self.held) > 1:
            self.held = ["".join(self.held)]
        return self.held[0] if self.held else ""

    def keep(self, text: str) -> None:
        if text:
            self.held.append(text)

    def feed(self, piece: str) -> str | None:
        at = 0
        while True:
            if self.state == TEXT:
                opening = _OPENING.search(piece, at)
                if opening is None:
                    self.keep(piece[at:])
                    text, self.held, self.emitted = self.carry, [], True
                    return text
                self.keep(piece[at:opening.start()])
                at, self.state = opening.end(), _KIND[opening.group()]
            end = piece.find(_CLOSE[self.state], at)
            if self.state == CDATA:
                self.keep(_escaped(piece[at:end] if end >= 0 else piece[at:] + self.closing))
            if end < 0:
                return None
            at, self.state = end + len(_CLOSE[self.state]), TEXT


class SplitScan:
    """The scanner of one split and, beside it, those of the other start states
    for as long as they differ."""

    def __init__(self, closing: str, state: str = TEXT, carry: str = ""):
        self.main = Scanner(closing, state, carry)
        self.others = {s: Scanner(closing, s) for s in (TEXT, COMMENT, CDATA) if s != state}
        self.start, self.same = state, set()

    def feed(self, piece: str) -> str | None:
        out = self.main.feed(piece)
        for s, other in self.others.items():
            if s not in self.same:
                other.feed(piece)
                if other.state == self.main.state == TEXT and not other.held and not self.main.held:
                    self.same.add(s)  # from here on both do the same
        return out

    def feed_plain(self, text: str) -> None:
        """Pieces without a marker while the main scanner reads text: only a CDATA section that may be open takes them in."""
        self.main.emitted = True
        for s, other in self.others.items():
            if s not in self.same and other.state == CDATA:
                other.keep(_escaped(text + other.closing))
            elif s not in self.same and other.state == TEXT:
                other.held, other.emitted = [], True
                self.same.add(s)

    def transition(self) -> list[tuple[str, str, str, bool]]:
        """(start state, end state, text carried on, whether it replaces what was carried in)."""
        rows = [(self.start, self.main.state, self.main.carry, self.main.emitted)]
        for s, other in self.others.items():
            end = self.main if s in self.same else other
            rows.append((s, end.state, end.carry, end.emitted or s in self.same))
        return rows


def pieces(spark: SparkSession, files: Sequence[str], element: str) -> DataFrame:
    """(file, start, value): the pieces of every split, in order within their split."""
    raw = spark.read.option("lineSep", f"</{element}>").text(list(files))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


_SCANNED = pa.schema([("file", pa.string()), ("start", pa.int64()), ("value", pa.string()), ("from_state", pa.string()),
                      ("to_state", pa.string()), ("replaces", pa.bool_())])
SCANNED_DDL = "file string, start bigint, value string, from_state string, to_state string, replaces boolean"


def scan(raw: DataFrame, element: str) -> DataFrame:
    """Records of ``pieces`` (``from_state`` NULL) and the transitions of every
    split. ``raw`` may name a split's start (state, carry)."""
    closing = f"</{element}>"
    known = "state" in raw.columns
    ship_code(raw.sparkSession)

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at = None, None

        def ended() -> Iterator[pa.RecordBatch]:
            if split is not None:
                rows = [(*at, carry, s, to, replaces) for s, to, carry, replaces in split.transition()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCANNED)], schema=_SCANNED)

        for batch in stream:
            for b in _by_split(batch):
                here = (b.column("file")[0].as_py(), b.column("start")[0].as_py())
                if here != at:
                    yield from ended()
                    state = (b.column("state")[0].as_py() if known else None) or TEXT
                    split, at = SplitScan(closing, state, (b.column("carry")[0].as_py() if known else None) or ""), here
                values = b.column("value")
                marked = any(pc.any(pc.match_substring(values, m)).as_py() for m in MARKERS)
                if not marked and split.main.state == TEXT:
                    if not split.main.held:
                        split.feed_plain(closing.join(values.to_pylist()) if any(
                            s not in split.same and o.state == CDATA for s, o in split.others.items()) else "")
                        yield _records(b.column("file"), b.column("start"), values)
                        continue
                found = [x for v in values.to_pylist() if (x := split.feed(v)) is not None]
                if found:
                    yield _records(pa.array([at[0]] * len(found)), pa.array([at[1]] * len(found), pa.int64()), pa.array(found, pa.string()))
        yield from ended()

    return raw.mapInArrow(run, SCANNED_DDL)


def _records(file: pa.Array, start: pa.Array, values: pa.Array) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays([file, start, values, pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_())], schema=_SCANNED)


def _by_split(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A record batch cut where its split changes."""
    at = 0
    while at < b.num_rows:
        same = pc.and_(pc.equal(b.column("file"), b.column("file")[at]), pc.equal(b.column("start"), b.column("start")[at])).slice(at)
        n = pc.index(same, False).as_py()
        n = n if n >= 0 else b.num_rows - at
        yield b.slice(at, n)
        at += n


def starts(transitions: DataFrame) -> DataFrame:
    """(file, start, state, carry) of the splits that don't begin in the text
    state, and of every file's end that doesn't (start NULL). One row per split
    and start state goes through, ordered within its file."""
    ship_code(transitions.sparkSession)
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("state", pa.string()), ("carry", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, at, state, carry, after = [], None, None, TEXT, "", None

        def step():
            nonlocal state, carry
            if after is not None:
                to, text, replaces = after
                state, carry = to, text if replaces else carry + text

        for b in stream:
            for row in b.to_pylist():
                if (row["file"], row["start"]) != (file, at):
                    step()
                    if row["file"] != file:
                        if file is not None and state != TEXT:
                            out.append((file, None, state, carry))
                        state, carry = TEXT, ""
                    file, at, after = row["file"], row["start"], None
                    if state != TEXT:
                        out.append((file, at, state, carry))
                if row["from_state"] == state:
                    after = (row["to_state"], row["value"], row["replaces"])
        step()
        if file is not None and state != TEXT:
            out.append((file, None, state, carry))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return (transitions.repartition("file").sortWithinPartitions("file", "start", "from_state")
            .mapInArrow(run, "file string, start bigint, state string, carry string"))


def with_starts(raw: DataFrame, known: DataFrame) -> DataFrame:
    """``pieces`` with their split's (state, carry), ordered again within each split."""
    numbered = raw.withColumn("seq", F.monotonically_increasing_id())
    return (numbered.join(known.where("start is not null"), ["file", "start"], "left").repartition("file", "start")
            .sortWithinPartitions("file", "start", "seq").select("file", "start", "value", "state", "carry"))
