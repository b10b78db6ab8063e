"""Conversation repair against all sequences of edits, in blocks of any size, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from functools import cache
from hashlib import sha256
from itertools import groupby

import pytest

import __spark_entry__ as contract
from granary.llm import repair
from granary.llm.common import table
from granary.llm.queries import damaged

GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, edit string, cost int"
NOTHING = sha256(b"").hexdigest()


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain(rows):
    """All edits, at most two inserts between turns, by cost and audit. Only what the role initials
    so far can still become matters for the rest, so ends of equal beginnings are shared."""
    marks = faults(rows)
    viable = re.compile(r"s?(ua)*u?")

    @cache
    def rest(i, roles, inserts):
        ways = [(0, "", ())] if i == len(rows) and GOOD.fullmatch(roles) else []

        def take(i, cost, letter, role=None, text=None, inserts=0):
            new = roles + (role[:1] if role is not None else "")
            if viable.fullmatch(new):
                # a pair more or less before the last turn makes no difference
                tail = rest(i, re.sub("(ua)+", "ua", new), inserts)
                if tail:
                    ways.append((cost + tail[0], letter + tail[1], ((f"{role}:{text}",) if role is not None else ()) + tail[2]))

        if inserts < 2:
            for role in ("user", "assistant"):
                take(i, 3, "I", role, "", inserts + 1)
        if i < len(rows):
            _, role, text = rows[i]
            take(i + 1, 4, "D")
            if marks[i] not in ("blank", "duplicate"):
                extra = 3 if marks[i] else 0
                if role:
                    take(i + 1, extra, "K", role, text)
                for new in ("user", "assistant"):
                    take(i + 1, 3 + extra, "R", new, text)
        return min(ways, default=None)

    best = rest(0, "", 0)
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        best[0], best[1], sha256("\n".join(best[2]).encode()).hexdigest(),
    )


def ordered(rows):
    """Turns in the operator's order; nulls are one space."""
    key = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return sorted(key, key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(r[3].encode()).digest()))


def compare(spark, rows, size):
    given = spark.createDataFrame([(*r, "e", 1) for r in rows], SCHEMA).repartition(4)
    got = {r[0]: tuple(r[1:]) for r in repair.summarised(given, given, block_turns=size).collect()}
    by_id = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = {c: plain([r[1:] for r in ordered(own)]) for c, own in ((c, list(g)) for c, g in groupby(by_id, key=lambda r: r[0]))}
    assert got == want


@pytest.mark.parametrize("size", [1, 2, 256])
def test_against_all_edits(spark, size):
    draw = random.Random(size)
    rows = []
    for conv in range(150):
        for turn in range(draw.randrange(1, 6)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool"])
            text = draw.choice(["a.", "b!", f"{turn}?", "cut", " \t", "", "a. \n"])
            rows += [(conv, turn + draw.choice([0, 0, 5]), role, text)] * draw.choice([1, 1, 1, 2])
    compare(spark, rows, size)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "a."), (1, None, None, "b."), (1, 0, "assistant", None), (1, 0, "", "c?"),
        (None, 2, "user", "x."), (None, 2, "user", "x."), (None, 9, "assistant", "y "),
        (2, 3, None, None), (3, None, "assistant", "z. \x0b"), (4, -5, "user", "long " * 100_000 + "."), (4, 7, "Assistant", "!"),
    ]
    compare(spark, rows, 256)
    none = spark.createDataFrame([], SCHEMA)
    assert repair.summarised(none, none).collect() == []
    only = repair.summarised(spark.createDataFrame([(8,), (8,), (None,)], "conv_id long"), none).collect()
    assert sorted(map(tuple, only), key=repr) == [(8, *[0] * 6, "", NOTHING), (None, *[0] * 6, "", NOTHING)]


def test_a_hot_conversation_is_cut_into_blocks(spark):
    """Blocks of one long conversation give what one block gives, and lie in several partitions."""
    draw = random.Random(3)
    rows = [(5, i, draw.choice(["user", "assistant", "user", "system"]), draw.choice([f"{i}.", f"{i}", "same.", " "])) for i in range(4000)]
    rows += [(i, 0, "user", "a.") for i in range(100, 140)]
    given = spark.createDataFrame(rows, SCHEMA.rsplit(", ", 2)[0])
    small, large = (repair.summarised(given, given, block_turns=n).where("conv_id = 5").first() for n in (16, 10_000))
    assert small == large and len(small.audit) >= 4000
    named = repair._named(given, "conv_id", "turn", "role", "text")
    solved = repair.blocks(repair.faulty(named).repartition(8), 16)
    assert solved.where("id = 5").count() > 200


def test_edits_are_the_repaired_turns(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "assistant", "b."), (1, 2, "user", "b"), (1, 3, "user", "c.")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r.edit, r.cost, r.fault, r.given_role, r.role, r.text) for r in repair.edits(given).collect()]
    assert [g[0] for g in got].count("D") + sum(g[4] is not None for g in got) == len(got)
    kept = [g[4][0] for g in got if g[4]]
    assert GOOD.fullmatch("".join(kept)) and sum(g[1] for g in got) == plain([r[1:] for r in rows])[5]


def test_weights_order_as_cost_and_audit():
    turns = [("u", 0), ("a", 1), ("", 0)]
    found = repair.solve(turns, repair.START)
    width = repair.SLOT * len(turns)
    listed = sorted((w >> width, repair.letters_of(w & (1 << width) - 1, 3)) for w in found.values())
    assert listed == [x for _, x in sorted((w, (w >> width, repair.letters_of(w & (1 << width) - 1, 3))) for w in found.values())]


def test_query_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.conv_id: r for r in contract.queries()["op13_repair"](spark, sf).collect()}
    said = table(spark, sf, "conversations").collect()
    assert set(rows) == {r.conv_id for r in said}
    by_id = {}
    for r in sorted(said, key=lambda r: (r.conv_id, r.turn)):
        harm = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", r.text) if harm == 2 else r.text
        one = (r.turn, "user" if harm == 4 else r.role, text)
        by_id.setdefault(r.conv_id, []).extend([one] * (0 if harm == 0 else 2 if harm == 3 else 1))
    for i, own in by_id.items():
        if len(own) <= 6:
            assert tuple(rows[i])[1:] == plain(own)
    assert damaged(table(spark, sf, "conversations")).count() == sum(map(len, by_id.values()))
