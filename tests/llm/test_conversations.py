"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from registrar.llm import conversations
from registrar.llm.queries import QUERIES

from .conftest import CLASHING

WHITE = " \t\n\x0b\x0c\r"
TEXTS = ["Fine.", "cut", "what?", "", " \n ", "Go! ", "no end ,"]
ROLES = ["system", "user", "assistant", "tool", "", "User", None]


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Uniform-cost search over edits: (cost, audit, repaired rows)."""
    faults = faults_of(rows)
    queue, done = [(0, "", 0, ())], set()
    while queue:
        cost, audit, i, out = heapq.heappop(queue)
        initials = "".join(r[:1] or "-" for r, _ in out)
        if not re.fullmatch("s?(ua)*u?", initials):
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, list(out)
        if (i, initials[-1:]) in done:
            continue
        done.add((i, initials[-1:]))
        for new in ("user", "assistant"):
            heapq.heappush(queue, (cost + 2, audit + "I", i, (*out, (new, ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, out))
            if faults[i] in ("", "truncated"):
                extra = faults[i] == "truncated"
                heapq.heappush(queue, (cost + extra, audit + "K", i + 1, (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(queue, (cost + 2 + extra, audit + "R", i + 1, (*out, (new, text))))


def brute(told):
    """The result per conv_id of (conv_id, turn, role, text) rows."""
    out, by = {}, {}
    for conv, turn, role, text in told:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [t for t, *_ in rows if t is not None]
        lines = [r[1:] for r in rows]
        faults = faults_of(lines)
        initials = [r[:1] or "-" for r, _ in lines]
        cost, audit, repaired = cheapest(lines)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def brute_damage(told):
    out = []
    for conv, turn, role, text in told:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d:
            row = (conv, turn, "user" if d == 4 else role, "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text)
            out += [row] * (2 if d == 3 else 1)
    return out


EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def held(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


@pytest.fixture(scope="module")
def told():
    rnd = random.Random(21)
    rows = [(c, rnd.choice([None, *range(12)]) if rnd.random() < 0.2 else t, rnd.choice(ROLES if rnd.random() < 0.4 else ROLES[1:3]),
             rnd.choice([*TEXTS, None, f"text {rnd.randrange(9)}."]))
            for c in range(250) for t in range(rnd.randrange(1, 9))]
    rows += [(None, t, "user", "Null id.") for t in range(5)]
    rows += [(900 + c, t, ("user", "assistant")[t % 2], f"Same {t}.") for c in range(150) for t in range(2)]  # a frequent signature
    rows += [(5000, t // 2, ("user", "assistant", "system", "user")[t % 4], f"row {rnd.randrange(400)}" + "." * (t % 3)) for t in range(1500)]
    rows += [(5001, None, "user", "x" * 300_000)] + [(5002, 2**62, "user", "far."), (5002, -2**61, "assistant", "off.")]
    return rows


@pytest.fixture(scope="module")
def frame(spark, told):
    df = spark.createDataFrame(told, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    extra = (*CLASHING, "symbols", "signature", "gaps", "cost", "audit", "kind", "damage", "rank", "text_key")
    return df.select("*", *(F.lit("clash").alias(c) for c in dict.fromkeys(extra)))


def test_plans_equal_the_search():
    rnd = random.Random(22)
    signatures, rows = [], {}
    for _ in range(1500):
        lines = [(rnd.choice([r for r in ROLES if r is not None]), rnd.choice([*TEXTS, f"t{rnd.randrange(5)}."])) for _ in range(rnd.randrange(9))]
        codes = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        s = "".join(chr(65 + 4 * ("sua".index(r[:1]) if r[:1] and r[:1] in "sua" else 3) + codes[f]) for (r, _), f in zip(lines, faults_of(lines)))
        signatures.append(s)
        rows[s] = lines
    dawg = conversations.Dawg()
    for s in sorted(set(signatures), key=lambda s: s[::-1]):
        *_, cost, audit = dawg.plan(s)
        assert (cost, audit) == cheapest(rows[s])[:2], rows[s]
    ends = {s[k:] for s in rows for k in range(len(s))}
    assert dawg.made == len(ends)  # every distinct end is worked out once


def test_odd_conversations(frame, told):
    assert held(conversations.repair(frame)) == brute(told)


def test_pieces_of_one_conversation(spark, frame, told):
    """Range partitions cut the long conversation, and turns, into pieces."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert held(conversations.repair(frame)) == brute(told)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_repaired_rows_follow_the_grammar(frame, told):
    rows = conversations.rows_of(frame)
    planned = conversations.repair_plans(rows)
    got = {}
    for r in conversations.repaired_rows(rows, planned).collect():
        got.setdefault(r.conv_id, []).append((r.position, r.role, r.text))
    want = brute(told)
    for conv, lines in got.items():
        assert [p for p, *_ in lines] == list(range(len(lines)))
        assert re.fullmatch("s?(ua)+", "".join(r[0] for _, r, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest() == want[conv][-1]


def test_no_rows(frame):
    none = frame.limit(0)
    assert conversations.repair(none).count() == 0
    assert set(held(conversations.repair(frame, conversations.rows_of(none))).values()) == {EMPTY}


def test_damage(frame, told):
    got = [tuple(r) for r in conversations.damaged(frame).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_damage(told)))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_of_a_table(spark, sf):
    told = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: EMPTY for c, *_ in told} | brute(brute_damage(told))
    assert held(QUERIES["op13_conversations"](spark, f"/root/testdata/{sf}")) == want
