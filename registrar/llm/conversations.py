"""Repair of conversation structure over a suffix-shared DAWG.

Every row becomes one symbol, its role's initial and its first fault; a
conversation's symbols in order are its signature. What a conversation's
repair costs depends on its signature alone, so the distinct signatures of all
conversations are minimised from their ends: sorted by their reversed text,
signatures that share an end stand side by side, and the automaton is built
over them in that order. A node is a distinct end of a signature. Its
cost-to-go and first edit are computed once for each state of the grammar
``(s?(ua)+)?`` and stay while the next signatures share it, so the automaton's
register is the path of the signature before, whatever the number of
signatures. The best audit is read off along the path.

Edits are Keep (cost 0), Rerole to the role due (2), Delete (3; required for
blank rows and duplicates) and Insert of an empty text of the role due (2); a
truncated row that stays costs 1. Of equally cheap audits the least in ASCII
order wins, which is the one whose first letter is least, at every step.

On Spark: rows are range-partitioned by (conversation, turn), so a
conversation of any size is cut into pieces of signature; these are put
together, made distinct, range-partitioned by their reversed text, and the
plans found are joined back, salted where a signature is frequent. Only the
last pass, which writes a conversation's repaired text in order, takes one
conversation in one task; it streams, holding one batch and one audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped, saved

WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# Symbols: "A" + 4 * class + fault.
CLASSES = "sua"  # initials with a place in the grammar; others are class 3
SOUND, BLANK, DUPLICATE, CUT = range(4)

# Grammar states: nothing read, system read, user due (may end), assistant due.
START, SYSTEM, USER_DUE, ASSISTANT_DUE = range(4)
#: State after the role that is due has come (by Insert, Rerole or Keep).
AFTER_DUE = (ASSISTANT_DUE, ASSISTANT_DUE, ASSISTANT_DUE, USER_DUE)
_NEVER = 1 << 60


def due(state: int) -> str:
    return "assistant" if state == ASSISTANT_DUE else "user"


def kept(state: int, kind: int) -> int | None:
    """State after a row of the class stays as it is; None if it cannot."""
    if kind == 0:
        return SYSTEM if state == START else None
    if kind == 1:
        return ASSISTANT_DUE if state != ASSISTANT_DUE else None
    return USER_DUE if kind == 2 and state == ASSISTANT_DUE else None


def after(state: int, edit: str, kind: int) -> int:
    return state if edit == "D" else kept(state, kind) if edit == "K" else AFTER_DUE[state]


def _with_inserts(options: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """(cost, first edit) by state once rows may be inserted here; an audit has
    at most two Inserts in a row, as a third would undo nothing."""
    for _ in range(2):
        options = [min(options[s], (INSERT + options[AFTER_DUE[s]][0], "I")) for s in range(4)]
    return options


class Dawg:
    """Automaton over signatures that come sorted by their reversed text."""

    def __init__(self):
        end = [(0, ""), (_NEVER, ""), (0, ""), (_NEVER, "")]
        self.symbols = ""  # of the current path, from the end
        self.nodes = [_with_inserts(end)]  # the current path's nodes, from the end
        self.counts = [(0, 0, 0, 0)]  # blank, duplicate, truncated, illegal from each node to the end
        self.made = 0

    def _node(self, symbol: int, ahead: list[tuple[int, str]]) -> list[tuple[int, str]]:
        kind, fault = divmod(symbol, 4)
        options = []
        for state in range(4):
            best = (DELETE + ahead[state][0], "D")
            if fault in (SOUND, CUT):
                extra = TRUNCATED if fault == CUT else 0
                stay = kept(state, kind)
                if stay is not None:
                    best = min(best, (KEEP + extra + ahead[stay][0], "K"))
                best = min(best, (REROLE + extra + ahead[AFTER_DUE[state]][0], "R"))
            options.append(best)
        return _with_inserts(options)

    def plan(self, signature: str) -> tuple[int, int, int, int, int, str]:
        """(blank, duplicate, truncated, illegal, cost, audit)."""
        path = signature[::-1]
        shared = 0
        for a, b in zip(path, self.symbols):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1:], self.counts[shared + 1:]
        for k in range(shared, len(path)):
            symbol = ord(path[k]) - 65
            self.nodes.append(self._node(symbol, self.nodes[-1]))
            blank, duplicate, truncated, illegal = self.counts[-1]
            kind, fault = divmod(symbol, 4)
            if k:
                illegal += (kind, (ord(path[k - 1]) - 65) // 4) not in ((0, 1), (1, 2), (2, 1))
            self.counts.append((blank + (fault == BLANK), duplicate + (fault == DUPLICATE), truncated + (fault == CUT), illegal))
            self.made += 1
        self.symbols = path
        audit, state, at = [], START, len(path)
        cost = self.nodes[at][state][0]
        while True:
            edit = self.nodes[at][state][1]
            if not edit:
                return (*self.counts[-1], cost, "".join(audit))
            audit.append(edit)
            if edit == "I":
                state = AFTER_DUE[state]
            else:
                at -= 1
                state = after(state, edit, (ord(path[at]) - 65) // 4)


# ---- rows and signatures ----

def _text_key() -> Column:
    return F.unhex(F.sha2("text", 256))


def _order() -> list[Column]:
    """Order of a conversation's rows: by turn, nulls first; rows of one turn by role, then by the SHA-256 of the text."""
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text_key").asc()]


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text); a null role or text is one space."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text_key, symbols): one row per distinct row of a
    turn, with one symbol per copy of it."""
    ended = F.rtrim("text", F.lit(WHITE))
    facts = rows.select("conv_id", "turn", "role", _text_key().alias("text_key"), (ended == "").alias("blank"),
                        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("cut"))
    distinct = facts.groupBy("conv_id", "turn", "role", "text_key").agg(
        F.count("*").cast("int").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    same = "partition by conv_id, role, text_key"
    first = F.expr(f"row_number() over ({same} order by turn asc nulls first) = 1")
    kind = 4 * F.coalesce(*(F.when(F.substring("role", 1, 1) == c, i) for i, c in enumerate(CLASSES)), F.lit(len(CLASSES)))

    def symbol(fault) -> Column:
        return F.char(65 + kind + fault)

    opening = symbol(F.when(F.col("cut"), CUT).otherwise(SOUND))
    repeated = symbol(F.lit(DUPLICATE))
    return distinct.withColumn("first", first).select(
        "conv_id", "turn", "role", "text_key",
        F.when(F.col("blank"), F.repeat(symbol(F.lit(BLANK)), F.col("n")))
        .when(F.col("first"), F.concat(opening, F.repeat(repeated, F.col("n") - 1)))
        .otherwise(F.repeat(repeated, F.col("n"))).alias("symbols"))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature, gaps) of every conversation of ``rows``."""
    marked = saved(symbols(rows), "conversation-symbols")
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("symbols", pa.string()),
                        ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def pieces():
            conv, held, least, most, turns, begun = None, [], None, None, 0, False
            for b in stream:
                for c, turn, text in zip(b.column("conv_id").to_pylist(), b.column("turn").to_pylist(), b.column("symbols").to_pylist()):
                    if begun and c != conv:
                        yield conv, part, "".join(held), least, most, turns
                        held, least, most, turns = [], None, None, 0
                    conv, begun = c, True
                    held.append(text)
                    if turn is not None and turn != most:
                        least, most, turns = turn if least is None else least, turn, turns + 1
            if begun:
                yield conv, part, "".join(held), least, most, turns
        return batches(((p, len(p[2]) + 40) for p in pieces()), schema)

    order = [F.col("conv_id").asc_nulls_first(), *_order()]
    pieces = (marked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "symbols")
              .transform(mapped, run, "conv_id bigint, part int, symbols string, least bigint, most bigint, turns bigint"))
    # A conversation has at most one piece per partition.
    together = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "symbols", "least", "most", "turns"))).alias("p"),
                                             F.min("least").alias("least"), F.max("most").alias("most"))
    # A turn that two pieces share counts once.
    shared = F.expr("size(filter(sequence(1, size(p)), i -> i > 1 and p[i - 1].least = element_at(p, i - 1).most))")
    turns = F.aggregate("p", F.lit(0).cast("bigint"), lambda n, x: n + x["turns"]) - shared
    return together.select("conv_id", F.array_join(F.col("p.symbols"), "").alias("signature"),
                           F.coalesce(F.col("most") - F.col("least") + 1 - turns, F.lit(0)).alias("gaps"))


# ---- plans ----

#: A signature of more than this share of all conversations is joined over SALTS keys.
FREQUENT = 200
SALTS = 64


def plans(found: DataFrame) -> DataFrame:
    """(signature, n, blank, duplicate, truncated, illegal, cost, audit) of the
    distinct signatures of ``found``."""
    schema = pa.schema([("signature", pa.string()), ("n", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dawg = Dawg()

        def rows():
            for b in stream:
                for signature, n in zip(b.column("signature"), b.column("n")):
                    s = signature.as_py()
                    yield (s, n.as_py(), *dawg.plan(s)), 2 * len(s) + 64
        return batches(rows(), schema)

    distinct = saved(found.groupBy("signature").agg(F.count("*").alias("n")), "conversation-signatures")
    backwards = F.reverse("signature")
    return (distinct.repartitionByRange(backwards).sortWithinPartitions(backwards)
            .transform(mapped, run, ", ".join(["signature string", "n bigint", *(f"{c} bigint" for c in _COUNTS), "audit string"])))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def repair_plans(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of
    every conversation of ``rows``."""
    found = saved(signatures(rows), "conversations")
    best = saved(plans(found), "conversation-plans")
    total = best.agg(F.sum("n").alias("total"))
    frequent = (best.join(F.broadcast(total), F.col("n") * FREQUENT > F.col("total"))  # one row; at most FREQUENT hashes
                .select(F.xxhash64("signature").alias("hash")).distinct())
    salted = (found.withColumn("hash", F.xxhash64("signature")).join(F.broadcast(frequent.withColumn("hot", F.lit(True))), "hash", "left")
              .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot"))
    spread = (best.withColumn("hash", F.xxhash64("signature")).join(F.broadcast(frequent.withColumn("hot", F.lit(True))), "hash", "left")
              .withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot", "n"))
    return salted.join(spread, ["hash", "signature", "salt"]).select("conv_id", "gaps", *_COUNTS, "audit")


# ---- repaired conversations ----

class _Repair:
    """Applies one audit to the rows of one conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield due(self.state), ""
            self.state = AFTER_DUE[self.state]
            self.at += 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        kind = CLASSES.find(role[:1]) if role else -1
        if edit != "D":
            yield (role if edit == "K" else due(self.state)), text
        self.state = after(self.state, edit, kind if kind >= 0 else len(CLASSES))


def _streamed(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Every conversation in one partition: its audit, then its rows in order."""
    audits = planned.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                            F.col("audit").alias("text"), F.lit(None).cast("binary").alias("text_key"))
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", _text_key().alias("text_key"))
    return (audits.unionByName(lines).repartition("conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *_order()).select("conv_id", "kind", "role", "text"))


def _repairs(stream: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple[str, str]]]]:
    """(conv_id, repaired rows) of each conversation; the rows come as they are read."""
    def flat():
        for b in stream:
            for conv, kind, role, text in zip(b.column("conv_id"), b.column("kind"), b.column("role"), b.column("text")):
                yield conv.as_py(), kind.as_py(), role.as_py(), text.as_py()

    source = flat()
    ahead = next(source, None)

    def conversation(repair: _Repair):
        nonlocal ahead
        while (ahead := next(source, None)) is not None and ahead[1]:
            yield from repair.row(ahead[2], ahead[3])
        yield from repair.inserts()

    while ahead is not None:
        yield ahead[0], conversation(_Repair(ahead[3]))


def repaired_rows(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) of the repaired conversations."""
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches((((conv, k, role, text), 4 * len(text)) for conv, lines in _repairs(stream)
                        for k, (role, text) in enumerate(lines)), schema)

    return _streamed(rows, planned).transform(mapped, run, "conv_id bigint, position bigint, role string, text string")


def repaired_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): lowercase hex of the repaired rows as lines ``role:text``."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            for conv, lines in _repairs(stream):
                digest, between = hashlib.sha256(), b""
                for role, text in lines:
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
                yield (conv, digest.hexdigest()), 72
        return batches(digests(), schema)

    return _streamed(rows, planned).transform(mapped, run, "conv_id bigint, repaired_sha256 string")


def repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per conv_id of ``conversations`` (conv_id, turn, role, text,
    ...): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. ``rows`` (default: the conversations' own) are what is
    left of them.

    A null role or text is one space, so a null text is blank and a null role
    has to be changed; so has an empty role, which has no initial. Rows of a
    null conv_id are one conversation. Rows without a turn come first and
    count in no gap; rows of one turn come by role, then by the SHA-256 of the
    text, and equal rows are duplicates. A conversation without rows has
    zeros, an empty audit and the hash of the empty string. Texts of any
    length are read whole; other columns are ignored; an empty table gives an
    empty one.
    """
    rows = rows_of(conversations) if rows is None else rows
    planned = saved(repair_plans(rows), "conversation-repairs")
    zeros = [F.lit(0).cast("bigint").alias(c) for c in ("gaps", *_COUNTS)]
    nothing = conversations.select("conv_id").distinct().select("conv_id", *zeros, F.lit("").alias("audit"),
                                                                F.lit(hashlib.sha256().hexdigest()).alias("repaired_sha256"))
    known = [planned.withColumn("repaired_sha256", F.lit(None).cast("string")), repaired_digests(rows, planned)]
    every = nothing.withColumn("rank", F.lit(1))
    for part in known:
        every = every.unionByName(part.withColumn("rank", F.lit(0)), allowMissingColumns=True)
    # The default of a column is what is left when no part names it.
    picked = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("rank"))).alias(c) for c in ("gaps", *_COUNTS, "audit", "repaired_sha256")]
    return every.groupBy("conv_id").agg(*picked)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after damage by crc32("conv_id:turn") % 20:
    0 drops the row, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes
    it the user's. A null conv_id or turn is one space there."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = rows_of(conversations).withColumn("damage", F.crc32(name) % 20).where("damage <> 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(copies).alias("copy")).drop("copy"))
