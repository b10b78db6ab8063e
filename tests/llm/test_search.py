"""Ranked search against scores of all documents, on odd rows, ties and several blocks."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from granary.llm import search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item string, score int, rank string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k):
    """Every document's score for every item."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10, **options):
    given = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = search.ranked(given, asked, k, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(spark, connect(sf), "op12_search", sf) == []


@pytest.mark.parametrize("size", [1 << 20, 40])
def test_against_all_scores(spark, size, monkeypatch):
    draw = random.Random(5)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(draw.randrange(200), " ".join(draw.sample(words, draw.randrange(1, 40)))) for _ in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # more equal scores than places
    items = [(i, " ".join(draw.choices(words, k=draw.randrange(1, 12)))) for i in range(12)] + [(77, docs[7][1])]
    assert found(spark, docs, items, block_bytes=size) == plain(docs, items, 10)


def test_odd_rows(spark):
    docs = [(1, "Cat cat dog"), (1, "Cat cat dog"), (2, None), (3, ""), (4, " .,! "), (None, "cat ÄPFEL"), (None, "cat ÄPFEL"), (5, "dog " * 50_000)]
    items = [(1, "cat"), (1, "dog äpfel"), (2, None), (3, "???"), (4, "cat cat DOG ÄPFEL"), (None, "dog")]
    assert found(spark, docs, items) == plain(docs, items, 10)
    assert found(spark, docs, items, k=1) == plain(docs, items, 1)
    assert found(spark, [], items) == [] == found(spark, docs, []) == found(spark, [(2, None)], items)


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(search, "PIECE", 10)
    text = b"one two three four fivefivefivefive six one"
    assert np.concatenate(list(search.word_numbers(text, {b"one": 0, b"six": 1}))).tolist() == [0, -1, -1, -1, -1, 1, 0]


def test_stops_before_the_lists_end():
    """One document stands far above the rest: most of the long list is never read."""
    texts = [b"rare common common common"] + [b"common " + b"x " * (i % 50 + 5) for i in range(3000)]
    shard = search.Shard(texts, {b"rare": 0, b"common": 1}, np.array([9000, 50]), 3001, 100_000)
    documents, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 1, 1)
    assert documents[scores.argmax()] == 0 and len(documents) < 100
    documents, _ = shard.best(np.array([1]), np.array([1]), 3001, 1)
    assert sorted(documents.tolist()) == list(range(3001))


def test_best_positions_stop_earlier_than_last_read_ones():
    """Direct accesses mark the other list's top as seen, so its best position is beyond what was read."""
    draw = random.Random(1)
    texts = [b"a " * draw.randrange(1, 40) + b"b " * draw.randrange(1, 40) for _ in range(2000)]
    shard = search.Shard(texts, {b"a": 0, b"b": 1}, np.array([100, 100]), 2000, 80_000)
    documents, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 5, 1)
    everything = np.zeros(2000, np.int64)
    for term in (0, 1):
        own = slice(shard.starts[term], shard.starts[term + 1])
        everything[shard.listed_document[own]] += shard.listed_impact[own]
    assert sorted(scores)[-5:] == sorted(everything)[-5:]
    assert len(documents) < 2000
