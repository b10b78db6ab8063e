"""Personal data: base spans against the plain patterns, EM and classifier on planted spans, odd rows."""

from __future__ import annotations

import random
import re
import time
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as contract
from granary.llm import pii
from granary.llm.common import table

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (
                kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and plain_luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                out.append((kind, *m.span()))
    return out


def test_base_spans_against_the_plain_patterns():
    draw = random.Random(2)
    pieces = ["a", "@", ".", "b-c", "1", "23", " ", "+", "(", ")", "-", "4111 1111 1111 1111", "8.8.8.8", "x@y.z", "+1 555", "999", "ü", "..", "@@", "0000"]
    for _ in range(4000):
        text = "".join(draw.choices(pieces, k=draw.randrange(1, 25)))
        assert sorted(pii.base_spans(text)) == sorted(plain(text)), text


def test_query_base_columns(spark):
    texts = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    rows = contract.queries()["op11_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = sorted(plain(texts[r.doc_id] or ""), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        named = [f"{k}:{b}:{e}" for k, b, e in base]
        assert r.base_sha256 == sha256(",".join(named).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(named) <= set(r.spans.split(",")) or not named


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "1.", "a@", "+1", "@ ", " at ", " at a dot", "1-1 x ", ":a", "(1", "a.", "1.1.1.1 "])
def test_long_texts_take_time_in_line_with_their_length(unit):
    text = unit * (1_000_000 // len(unit))
    began = time.process_time()
    pii.candidates(text)
    assert time.process_time() - began < 20


def test_em_recovers_the_labelers():
    """Five labelers of known reliability, one of them at random, over true and false spans."""
    draw = np.random.default_rng(4)
    right = np.array([0.95, 0.9, 0.8, 0.85, 0.5])
    truth = draw.random(20_000) < 0.3
    ok = draw.random((20_000, 5)) < right
    voted = np.where(ok == truth[:, None], pii.YES, pii.NO)
    codes, where, counts = np.unique(voted @ 3 ** np.arange(4, -1, -1), return_inverse=True, return_counts=True)
    rate, posterior = pii.reliabilities(codes, counts.astype(float))
    assert np.abs(rate[:, 1, pii.YES] - right).max() < 0.03 and np.abs(rate[:, 0, pii.NO] - right).max() < 0.03
    majority = (voted == pii.YES).sum(1) >= 3
    found = posterior[where] >= 0.5
    assert (found == truth).mean() > (majority == truth).mean()


def planted(draw, n):
    """Texts with what they hold beyond the base patterns, and texts with look-alikes."""
    words = "the quick report of this house was written for all and sent later".split()

    def digits(k):
        return "".join(draw.choices("0123456789", k=k))

    def card():
        body = "4" + digits(14)
        return next(body + c for c in "0123456789" if plain_luhn(body + c))

    good = [
        lambda: ("email", "contact", f"jo{digits(2)} [at] mail{digits(1)} [dot] com"),
        lambda: ("email", "mail", f"ann.lee at web{digits(1)} dot org"),
        lambda: ("phone", "call", f"({digits(3)}) {digits(3)}-{digits(4)}"),
        lambda: ("phone", "telefon", f"0049 30 {digits(7)}"),
        lambda: ("ip", "host", f"10[.]{draw.randrange(99)}[.]2[.]{draw.randrange(99)}"),
        lambda: ("card", "card", ".".join(re.findall("....", card()))),
    ]
    bad = [
        lambda: (None, "version", f"2024.{draw.randrange(10, 12)}.{draw.randrange(10, 28)}"),
        lambda: (None, "order", digits(9)),
        lambda: (None, "isbn", f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}"),
        lambda: (None, "look", "at the dotted line"),
        lambda: (None, "date", f"{draw.randrange(10, 28)}/{draw.randrange(10, 12)}/2023"),
    ]
    base = [lambda: (None, "mail", f"x{digits(3)}@mail.example.com"), lambda: (None, "call", f"+1 (499) 555-{digits(4)}"), lambda: (None, "card", card()), lambda: (None, "server", f"8.8.{draw.randrange(9)}.4")]
    out = []
    for i in range(n):
        kind, lead, said = draw.choice(draw.choice([good, bad, base]))()
        head = " ".join([*draw.choices(words, k=6), lead, "the"][: draw.choice([7, 8])])
        out.append((i, f"{head} {said} {' '.join(draw.choices(words, k=4))}.", kind, len(head) + 1, len(head) + 1 + len(said)))
    return out


def test_added_spans_on_planted_texts(spark):
    rows = planted(random.Random(9), 3000)
    given = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string")
    model = pii.fit(given.where("doc_id % 2 = 0"))
    assert set(model.weights) == set(pii.KINDS)
    added = {r.doc_id: [(s.kind, s.begin, s.end) for s in r.pii if not s.base] for r in pii.find(given, model).collect()}
    held = [r for r in rows if r[0] % 2]
    wanted = [r for r in held if r[2]]
    caught = sum((kind, b, e) in added[i] for i, _, kind, b, e in wanted)
    clean = [r for r in held if not r[2]]
    assert caught >= 0.9 * len(wanted)
    assert sum(bool(added[r[0]]) for r in clean) <= 0.05 * len(clean)


def test_added_spans_never_touch_base_ones(spark):
    texts = [f"mail a at b dot com x{i}@y.com (555) 123-4567 +1 555 123 4567 8.8.8.8 1[.]2[.]3[.]4" for i in range(20)]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(given, pii.fit(given)).collect():
        base = [(s.begin, s.end) for s in r.pii if s.base]
        assert all(s.end <= b or e <= s.begin for s in r.pii if not s.base for b, e in base)
        assert sorted((s.kind, s.begin, s.end) for s in r.pii if s.base) == sorted(plain(texts[r.doc_id]))


def test_odd_rows(spark):
    rows = [(1, None, "p"), (1, "", "p"), (None, "é\U0001f600 a@b.co", "p"), (None, "é\U0001f600 a@b.co", "p"), (2, "word " * 300_000 + "x@y.org", "p")]
    given = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    model = pii.fit(given)
    got = [(r.doc_id, [(s.kind, s.begin, s.end) for s in r.pii]) for r in pii.find(given, model).collect()]
    same = (None, [("email", 3, 9)])
    assert sorted(got, key=repr) == sorted([(1, []), (1, []), same, same, (2, [("email", 1_500_000, 1_500_007)])], key=repr)
    none = spark.createDataFrame([], "doc_id long, text string")
    empty = pii.fit(none)
    assert pii.find(none, empty).collect() == [] and empty.weights == {}
    assert len(pii.find(given, empty).where("size(pii) > 0").collect()) == 3
