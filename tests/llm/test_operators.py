"""Each operator against brute force, a round trip or held-out accuracy, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from compare import connect, differences
from granary.llm import ann, bpe, chat, decontam, langid, licenses, lm, sharding, simhash, toxicity
from granary.llm.common import fold, table

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, shard string, n_words string, fp string, ids string"


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, len(text or ""), 1, "s", "w", "f", "x")


LONG = " ".join(f"word{i % 977} the" for i in range(60_000))
ROWS = [
    doc(1, "the quick brown fox jumps over the lazy dog of the house"),
    doc(1, "the quick brown fox jumps over the lazy dog of the house"),
    doc(2, "The Quick brown fox jumps over the lazy dog of the house"),
    doc(3, None, None, None),
    doc(4, ""),
    doc(None, "  \n\t "),
    doc(None, "null id with words"),
    doc(5, LONG, "fr", None),
    doc(6, "!!! ### 123"),
    doc(7, "Zażółć gęślą jaźń   \U0001f600 \x1c x", "pl"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op1_sharding", "op4_decontam", "op5_chat"])
def test_sql(spark, name):
    assert differences(spark, connect(SF), name, SF) == []


def crc(i):
    return zlib.crc32(str(i).encode())


# sharding


def test_shards_hold_the_mixture(spark):
    rows = contract.queries()["op1_sharding"](spark, SMALL).toPandas()
    docs = table(spark, SMALL, "documents").toPandas().set_index("doc_id")
    assert len(rows) == len(docs)
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    sizes = rows.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1
    mixture = rows.assign(source=docs.loc[rows.doc_id, "source"].values).groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (mixture.max(axis=1) - mixture.min(axis=1)).max() <= 2
    assert all(s == len(docs.text[i].encode()) + 1 and c == zlib.crc32(docs.text[i].encode()) for i, s, c in zip(rows.doc_id, rows["size"], rows.text_crc32))


def test_shards_follow_the_plain_definition(spark, odd):
    got = sharding.interleaved_shards(odd, 3).toPandas()
    groups = defaultdict(list)
    for r in ROWS:
        draw = hashlib.md5((f"mixture:{r[0]}" if r[0] is not None else "mixture").encode()).hexdigest()
        groups[r[3]].append((draw, -1 if r[0] is None else r[0], zlib.crc32(r[1].encode()) if r[1] is not None else -1))
    want = sorted(((2 * k + 1) / (2 * len(v)), *x, s or "") for s, v in groups.items() for k, x in enumerate(sorted(v)))
    shards = [i * 3 // len(want) for i in range(len(want))]
    assert Counter(shards) == Counter(got["shard"])
    by_id = Counter((x[2], s) for x, s in zip(want, shards))
    assert by_id == Counter((-1 if pd.isna(i) else int(i), s) for i, s in zip(got.doc_id, got["shard"]))
    assert got[got.doc_id == 3][["size", "text_crc32"]].isna().values.tolist() == [[False, True]]
    assert sharding.interleaved_shards(odd, 40)["shard", "slot"].distinct().count() == len(ROWS)


def test_shards_use_no_python(spark):
    plan = contract.queries()["op1_sharding"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# LM scoring


def lm_words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


def test_lm_base_and_model(spark):
    rows = contract.queries()["op2_lm"](spark, SF).toPandas().set_index("doc_id")
    texts = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    counts = Counter(w for i, t in texts.items() if crc(i) % 7 != 2 for w in lm_words(t))
    total, types = sum(counts.values()), len(counts)
    for i, t in texts.items():
        words, r = lm_words(t), rows.loc[i]
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(i) % 7 == 2, len(words), sum(counts[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(base) and r.score <= 0
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_lm_filter_reads_levels_back():
    keys = np.arange(1, 20_001, dtype=np.uint64)
    levels = np.array([1 + i % 7 for i in range(20_000)])
    found = lm.Filter({0: lm.bits_of(lm.named(lm.BIGRAM, keys), levels)}, 1)
    got = found.levels(lm.BIGRAM, keys)
    assert (got >= levels).all() and (got == levels).mean() > 0.97
    assert (found.levels(lm.BIGRAM, np.arange(10**6, 10**6 + 20_000, dtype=np.uint64)) > 0).mean() < 0.03


def test_lm_bigrams_are_counted_whole(spark):
    texts = ["a b a b c", "a b", "", None, "B A"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    pairs = Counter(p for t in texts for p in zip(["\n", *lm_words(t)], lm_words(t)))
    rows = lm.packed_bigrams(frame, 3).toArrow()
    keys, counts = lm.summed(lm.joined(rows.column("keys"), np.uint64, True), lm.joined(rows.column("counts"), np.uint32))
    assert sorted(counts.tolist()) == sorted(pairs.values()) and len(keys) == len(pairs)


@pytest.mark.parametrize("kind", [np.uint8, np.uint32, np.uint64, np.int64])
def test_lm_packed_numbers_come_back(kind):
    draw = np.random.default_rng(1)
    for size in (0, 1, 5, 1000):
        values = draw.integers(0, np.iinfo(kind).max, size, dtype=kind, endpoint=True)
        assert (lm.restored(lm.squeezed(values), kind) == values).all()
        values.sort()
        assert (lm.restored(lm.squeezed(values, True), kind, True) == values).all()


def test_lm_keeps_rare_bigrams_at_every_size(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT", 16)  # several segments
    filler = ["the cat sat on the mat and the dog sat on the log"] * 40
    phrases = [f"w{i} x{i} y{i} z{i}" for i in range(50)]
    texts = filler + phrases
    model, counts = lm.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    asked = [*phrases, filler[0], "z1 y2 x3 w4", "mat unseen"]
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string").repartition(5), model, counts).collect()}
    words, pairs, follow = Counter(), Counter(), defaultdict(list)
    for t in texts:
        cut = lm_words(t)
        words.update(cut)
        pairs.update(zip(["\n", *cut], cut))
    for (h, _), c in pairs.items():
        follow[h].append(c)
    total, log = sum(words.values()) + len(words) + 1, lambda x: math.log(x) / math.log(lm.BASE)
    want = []
    for t in asked:
        cut, sum_ = lm_words(t), 0.0
        for h, w in zip(["\n", *cut], cut):
            c = pairs[h, w]
            level = 1 + math.floor(log(c) + 1e-9) if c else 0
            size = 1 + math.floor(log(words[h]) + 1e-9) if words[h] else 0
            rest = max(1 - sum(x - lm.DISCOUNT for x in follow[h]) / words[h], 1e-6) if words[h] else 1.0
            seen = max(lm.BASE ** (level - 1) - lm.DISCOUNT, 0) / lm.BASE**size if c else 0.0
            sum_ += math.log10(min(1.0, seen + lm.BASE ** -math.ceil(-log(rest) - 1e-9) * (words[w] + 1) / total))
        want.append(sum_)
    near = [abs(got[i] - x) < 1e-6 for i, x in enumerate(want)]
    assert np.mean(near) > 0.8  # the filter's false positives aside
    assert model.gram_segments > 1 and model.context_segments > 1


def test_lm_odd_rows(spark, odd, empty):
    for train in (odd, empty):
        model, counts = lm.fit(train.select("text"))
        got = lm.score(odd, model, counts).toPandas()
        assert len(got) == len(ROWS) and np.isfinite(got[["base_score", "score"]].values).all()
        assert (got.n_tokens == [len(lm_words(r[1])) for r in ROWS]).sum() == len(ROWS) or sorted(got.n_tokens) == sorted(len(lm_words(r[1])) for r in ROWS)
    assert (got.score == 0).all()  # nothing was learned
    assert lm.score(empty, model, counts).count() == 0


# nearest neighbours


def test_neighbours_reach_the_recall(spark):
    rows = contract.queries()["op3_neighbours"](spark, SMALL).toPandas()
    frame = table(spark, SMALL, "embeddings").toPandas()
    vectors = np.stack(frame.embedding).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = total = 0
    for i in np.flatnonzero(frame.vec_id % 50 == 0):
        cosine = unit @ unit[i]
        cosine[i] = -2
        best = frame.vec_id[np.lexsort((frame.vec_id, -cosine.round(12)))[:5]]
        own = rows[rows.query_id == frame.vec_id[i]].sort_values("rank")
        assert own["rank"].tolist() == [1, 2, 3, 4, 5] and (np.diff(own.score) <= 0).all()
        for j, s in zip(own.vec_id, own.score):
            assert s == pytest.approx(float(cosine[frame.vec_id == j][0]), abs=1e-12)
        hits, total = hits + len(set(best) & set(own.vec_id)), total + 5
    assert hits / total >= 0.9


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [0.0, 1.0]), (None, [1.0, 1.0]), *((i, [-1.0, 0.5]) for i in range(10, 40))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("cell", F.lit(1))
    got = [(r.rank, r.id, round(r.score, 6)) for r in ann.nearest(frame, F.col("id") == 0).orderBy("rank").collect()]
    assert got == [(1, 1, 1.0), (2, 2, 1.0), (3, 9, 0.0), (4, 10, round(-1 / math.sqrt(1.25), 6)), (5, 11, round(-1 / math.sqrt(1.25), 6))]
    assert ann.nearest(frame.limit(0), F.col("id") == 0).count() == 0
    assert ann.nearest(frame.where("vec_id < 2"), F.col("id") == 0).count() == 1


def test_neighbours_repeated_ids(spark):
    """Copies of the query's own id take no other's place, and one id with two vectors is two candidates."""
    rows = [(0, [1.0, 0.0])] * 6 + [(i, [1.0, 0.0]) for i in range(1, 10)] + [(i, [1.0, i / 500]) for i in range(101, 120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.rank, r.id, r.score) for r in ann.nearest(frame, F.col("id") == 0).orderBy("rank").collect()]
    assert got == [(i, i, 1.0) for i in range(1, 6)]
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.5]), (7, [1.0, 0.25]), (7, [1.0, 0.25]), (8, [0.0, 1.0])]
    few = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [r.id for r in ann.nearest(few, F.col("id") == 0).orderBy("rank").collect()] == [7, 7, 8]


# decontamination


def plain_hits(texts, items, window):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    out = []
    cut = [(i, re.findall(pattern, (t or "").translate(LOWER))) for i, t in items]
    for text in texts:
        words, hit, own = re.findall(pattern, (text or "").translate(LOWER)), set(), set()
        for item, own_words in cut:
            n = min(window, len(own_words))
            phrases = {tuple(own_words[k : k + n]) for k in range(len(own_words) - n + 1)} if n else set()
            for k in range(len(words) - n + 1 if n else 0):
                if tuple(words[k : k + n]) in phrases:
                    hit |= set(range(k, k + n))
                    if item is not None:
                        own.add(item)
        out.append((len(words), len(hit), sorted(own)))
    return out


@pytest.mark.parametrize("window,block", [(3, 1 << 20), (4, 8)])
def test_decontamination_against_plain_search(spark, window, block):
    random.seed(window)
    make = lambda n: " ".join(random.choices(["A", "b", "ccc", "é", "x1"], k=n))
    texts = [make(random.randint(0, 60)) for _ in range(60)] + [None, "", "zz zz", "a, B! a; b"]
    items = [("7", make(8)), ("8", make(2)), ("9", ""), ("10", None), (None, make(5)), ("7", make(6)), ("11", "zz"), ("12", make(12))]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id int, text string, spans string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    marked = decontam.mark(docs, bench, window=window, block_bytes=block)
    got = {r.doc_id: (r.n_words, r.h, r["items"]) for r in marked.withColumn("h", decontam.n_hit()).collect()}
    assert [got[i] for i in range(len(texts))] == plain_hits(texts, items, window)
    for r in marked.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.cleaned or "").translate(LOWER))
        assert r.spans or r.cleaned == r.text
        assert len(words) == r.n_words - sum(s.end - s.begin for s in r.spans)


def test_decontamination_holds_one_block_at_a_time(spark, odd):
    """Many blocks leave one Python operator in the last plan; a long item is cut so that no window is lost."""
    words = [f"w{i}" for i in range(300)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "cat dog")], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 10])) for i in range(0, 291)], "doc_id long, text string")
    found = decontam.mark(docs, items, block_bytes=100)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found.where("size(spans) = 1 AND items = array('1')").count() == 291
    for size in (1, 30, 100, 10_000):
        parts = list(decontam.parts_of(" ".join(words), size, 10))
        held = {tuple(p.split()[k : k + 10]) for p in parts for k in range(len(p.split()) - 9)}
        assert held == {tuple(words[k : k + 10]) for k in range(291)}
    assert list(decontam.parts_of(" .. " * 50, 10, 10)) == [""] and list(decontam.parts_of("a" * 50, 10, 10)) == ["a" * 50]


def test_decontamination_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog of the")], "item_id long, text string")
    assert decontam.mark(odd, bench).where("size(spans) > 0").count() == 3
    assert decontam.mark(odd, bench.limit(0)).where("size(spans) = 0").count() == len(ROWS)
    assert decontam.mark(empty, bench).count() == 0


# chat


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> \\", "", None, "a\nb <s>", "[/INST] [INST", "é" * 5, "<<s>>", "[[INST]]"]
    roles = ["user", "assistant", "system", None, "[INST]\n\\n", "<s>"]
    rows = [(c, t, roles[(c + t) % 6], texts[(c * 3 + t) % 10]) for c in range(6) for t in range(10)]
    rows += [(None, None, "user", "x"), (9, 1, "assistant", "y"), (9, 1, "assistant", "y"), (9, None, "user", "z" * 5_000_000)]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("part", F.lit(1)).withColumn("loss", F.lit(2))
    parts = chat.formatted(frame)
    got = {r.conv_id: r for r in chat.read_back(parts).collect()}
    said = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        said[c].append((r or "", x or ""))
    assert set(got) == set(said)
    for c, turns in said.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.formatted(frame.limit(0))).count() == 0


# toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    random.seed(5)
    word = lambda n: "".join(random.choices("abc", k=n))
    entries = [(word(6), False, 1), (word(5), True, 1), (word(7), False, 2), (word(4), True, 0), (word(5), False, 0)]
    matcher = toxicity.Matcher(entries)
    for _ in range(3000):
        w = word(random.randint(0, 10))
        want = []
        for n, (text, stem, errors) in enumerate(entries):
            near = min((distance(text, w[:k]) for k in range(len(w) + 1)), default=9) if stem else distance(text, w)
            if near <= errors:
                want.append((near, n))
        assert matcher(w) == min(want, default=None) or (not w and matcher(w) is None)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = contract.queries()["op6_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.toxic).mean() > 0.97
    assert docs.count() > len(rows)


def test_toxicity_context_and_odd_rows(spark, odd, empty):
    model = toxicity.Lexicon([("idiot", False, 1), ("lowei", True, 0)], [-4.0, 3.0, 3.0, 3.0, 3.0, 0.0], 0.1)
    score = lambda t: [r.toxicity for r in toxicity.score(spark.createDataFrame([(t,)], "text string"), model).collect()][0]
    assert score("you idiot") > 0.5 and score("you idi0t") > 0.5 and score("you 1diot") > 0.5 and score("you idjot") > 0.5
    assert score("a loweixyz here") > 0.5 and score("nothing") < 0.5
    assert score('he called it "idiot" there') < 0.5 < score("he is an idiot there")
    got = toxicity.score(odd.withColumn("toxicity", F.lit("x")), model).toPandas()
    assert len(got) == len(ROWS) and got.toxicity.between(0, 1).all()
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    nothing = toxicity.fit(odd, labels)
    assert toxicity.score(odd, nothing).where("toxicity = 0").count() == len(ROWS)
    assert toxicity.score(empty, nothing).count() == 0
    one_class = toxicity.fit(odd, spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int"))
    assert not one_class.entries


# licenses


def test_licenses_base_places(spark):
    rows = contract.queries()["op7_licenses"](spark, SMALL).toPandas().set_index("doc_id")
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for i, text in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        found = [(k, label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        r = rows.loc[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(found), ",".join(sorted({x[1] for x in found})))
        assert not found or (r.first_word, r.last_word) == (min(found)[0], max(found)[0])
        assert {x[1] for x in found} <= set(r.labels.split(","))


def test_licenses_with_errors(spark, odd, empty):
    scan = licenses.Scanner()
    labels = lambda t: {m[0] for m in scan(t.encode())[2]}
    assert labels("x Licensd under the Apache Licence, version 2.0.") == {"apache"}
    assert labels("the GNU genral publc license") == {"gpl"} and labels("All rigths reserved") == set()
    assert labels("all righs reserved") == {"reserved"} and labels("the general public") == set()
    n, places, notices = scan(b"mit, License\nMIT license")
    assert (n, places) == (4, [("mit", 0), ("mit", 2)])
    assert scan(b"xx licensed under the apache licence version 2 0 yy")[2][0][1:4] == (1, 9, 1)
    for notice in scan.notices:  # every text within the bound is found
        for _ in range(5):
            text = bytearray(notice.text)
            for _ in range(notice.edits):
                text[random.randrange(1, len(text) - 1)] = ord("q")
            assert notice.matches(b" " + bytes(text) + b" ") or b" " in notice.text[:1]
    assert licenses.scan(odd).count() == len(ROWS) and licenses.scan(empty).count() == 0


def test_licenses_every_edited_notice_is_found_beside_others():
    """Insertions, deletions and substitutions within the bound, next to a notice without edits."""
    scan, draw = licenses.Scanner(), random.Random(8)
    for notice in scan.notices:
        for _ in range(12):
            text = list(notice.text.decode())
            for _ in range(draw.randrange(notice.edits + 1)):
                at = draw.choice([i for i in range(1, len(text) - 1) if " " not in text[i - 1 : i + 2]])
                kind = draw.randrange(3)
                text[at : at + (kind > 0)] = [] if kind == 1 else [draw.choice("qxz")]
            edited = "".join(text)
            size = len(edited.split())
            found = scan(f"x {edited} {notice.text.decode()} y".encode())[2]
            own = [m for m in found if m[0] == notice.label]
            whole = size + len(notice.text.split())
            # a shorter notice of the label may stand inside without an edit, and is the better match there
            assert any(m[1] < 1 + size and m[2] > 1 for m in own), edited
            assert any(m[1] > size and m[2] <= 1 + whole and m[3] == 0 for m in own), edited


def test_licenses_places_do_not_hide_each_other():
    scan = licenses.Scanner()
    assert [m[1:4] for m in scan(b"x apache licence apache license x")[2]] == [(1, 3, 1), (3, 5, 0)]


def test_licenses_take_time_in_line_with_the_text():
    began = time.process_time()
    found = licenses.Scanner()(b"apache licence " * 70_000)[2]
    assert len(found) == 70_000 and time.process_time() - began < 20


# BPE


def test_bpe_against_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    random.seed(3)
    odd_letters = [chr(c) for r in ((0, 0x250), (0x300, 0x380), (0x2000, 0x2070), (0x3000, 0x3100), (0x1F600, 0x1F640)) for c in range(*r)]
    texts = ["".join(random.choices(odd_letters, k=random.randint(0, 50))) for _ in range(500)]
    texts += ["".join(random.choices("ab hetin's \n\t0129.,", k=random.randint(0, 60))) for _ in range(1500)]
    texts += ["", None, "a" * 3000, "<|endoftext|> x<|endoftext|><|endoftext|>", " " * 2000 + "x", "hello<|endoftext|"]
    texts += [r.text for r in table(spark, SF, "documents").select("text").collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("decoded", F.lit("x"))
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(frame, path), path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_speculation_is_verified_exactly():
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(4)
    words = ["".join(random.choices("etaoinshrd", k=random.randint(1, 12))).encode() for _ in range(3000)]
    got, failing = vocabulary.encode(words)
    assert got == [vocabulary.merge(w) for w in words] and 0 < failing < len(words)


def test_bpe_merges_in_tables_cuts_latin_texts_and_keeps_frequent_words(monkeypatch):
    import regex

    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(8)
    made = [bytes(draw.choice(b" aaaenrthio\xc3\xa9\xff") for _ in range(draw.randrange(49))) for _ in range(4000)]
    assert [list(x) for x in vocabulary.merge_all(made)] == [vocabulary.merge(w) for w in made]
    assert vocabulary.merge_all([]) == [] and vocabulary.merge_all([b"", b"a"]) == [[], vocabulary.merge(b"a")]
    assert [list(x) for x in vocabulary.encode(made + [b"a" * 49])[0]] == [vocabulary.merge(w) for w in made + [b"a" * 49]]

    encoder, whole = bpe.Encoder(vocabulary), regex.compile(bpe.PATTERN).findall
    for _ in range(4000):
        text = "".join(chr(draw.randrange(256)) if draw.random() < 0.5 else draw.choice("a 'sld\n\t\x85\xa0\x1c12é") for _ in range(30))
        assert encoder.split(text) == whole(text) and encoder.split(text + " œ") == whole(text + " œ")

    monkeypatch.setattr(bpe, "REMEMBERED", 400)
    frequent, asked = [f" often{i}" for i in range(50)], []
    encode = vocabulary.encode
    monkeypatch.setattr(vocabulary, "encode", lambda words: asked.extend(words) or encode(words))
    for i in range(40):
        text = "".join(frequent) + "".join(f" rare{chr(97 + j // 26)}{chr(97 + j % 26)}{'x' * i}" for j in range(60))
        (packed,) = encoder.texts([text])
        assert np.frombuffer(packed, "<u4").tolist() == [t for w in whole(text) for t in vocabulary.merge(w.encode())]
        assert len(encoder.seen) + len(encoder.earlier) < 400 + 2 * 200
    assert asked.count(b" often") == 1


def test_lm_missing_names_cost_few_probes_and_levels_are_exact(monkeypatch):
    made = np.unique(np.random.default_rng(5).integers(0, 1 << 32, 60_000, dtype=np.uint64))
    keys, missing = made[::2], made[1::2]
    levels = 1 + np.arange(len(keys)) % 9
    asked, plain = [], lm.within
    bits = lm.bits_of(lm.named(lm.BIGRAM, keys), levels)

    # every probe of every level, one name at a time
    size, step = 8 * len(bits), 0xD1B54A32D192ED03
    held = np.zeros(size, bool)
    for name, top in zip(lm.named(lm.BIGRAM, keys[:500]).tolist(), levels[:500].tolist()):
        for level in range(1, top + 1):
            one = int(lm.mix(np.array([(name + step * level) % 2**64], np.uint64))[0])
            two = int(lm.mix(np.array([one ^ step], np.uint64))[0]) | 1
            held[[(one + two * i) % 2**64 % size for i in range(lm.PROBES)]] = True
    assert np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)[held].all()

    monkeypatch.setattr(lm, "within", lambda places, size: asked.append(len(places)) or plain(places, size))
    found = lm.Filter({0: bits}, 1).levels(lm.BIGRAM, keys)
    assert (found >= levels).all() and (found == levels).mean() > 0.95
    asked.clear()
    assert (lm.Filter({0: bits}, 1).levels(lm.BIGRAM, missing) == 0).mean() > 0.95
    assert sum(asked) < 2.5 * len(missing)


def test_bpe_odd_rows(spark, odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = bpe.decode(bpe.encode(odd, path), path).toPandas()
    assert sorted(got.decoded) == sorted(r[1] or "" for r in ROWS)
    assert bpe.decode(bpe.encode(empty, path), path).count() == 0


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, name in enumerate(ids):
        if name is not None:
            low[find(i)] = min(low.get(find(i), name), name)
    return [low.get(find(i)) for i in range(len(ids))]


def test_simhash_against_all_pairs(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], zip((f"{p:016x}" for p in prints), plain_components([r.doc_id for r in rows], prints))))
    got = contract.queries()["op9_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(rows)


def test_simhash_links_chains_and_hot_buckets(spark):
    random.seed(6)
    center = random.getrandbits(64)
    prints = {center ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 6))) for _ in range(1500)}
    prints |= {random.getrandbits(64) for _ in range(200)}
    chain = random.getrandbits(64)
    prints |= {chain ^ ((1 << 4 * k) - 1) for k in range(1, 16)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(frame)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    got = defaultdict(set)
    for p, s in zip(prints, signed):
        got[roots.get(s, s)].add(p)
    want = defaultdict(set)
    for p, c in zip(prints, plain_components(prints, prints)):
        want[c].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert edges.count() < 60 * len(prints)


def test_simhash_odd_rows(spark, odd, empty):
    got = simhash.near_duplicates(odd).collect()
    prints = [plain_fingerprint(r[1]) for r in ROWS]
    want = Counter(zip([r[0] for r in ROWS], (f"{p:016x}" for p in prints), plain_components([r[0] for r in ROWS], prints)))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


# language


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    rows = contract.queries()["op10_langid"](spark, "/root/testdata/sf0.1").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.98 and rows.score.between(0, 1).all()
    assert rows.rejected.mean() < 0.01


def test_language_rejects_random_and_mixed_texts(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    learned = langid.fit(docs.where(fold("doc_id", 3) != 1))
    sizes, draw = langid.Sizes(learned), random.Random(1)

    def rejected(text: bytes) -> bool:
        return langid.verdict(sizes.languages, sizes(text), len(text), langid.MARGIN)[2]

    def noise(words: int) -> bytes:
        return " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(words)).encode()

    assert np.mean([rejected(noise(200)) for _ in range(60)]) > 0.9
    assert np.mean([rejected(noise(20)) for _ in range(60)]) > 0.5
    long = [r.text for r in docs.where("length(text) > 2000").select("lang", "text").dropDuplicates(["lang"]).collect()]
    cut = [langid.words_of(t).split() for t in long]
    starts = [[draw.randrange(len(own) - 50) for own in cut] for _ in range(60)]
    mixed = [b" ".join(w for own, a in zip(cut, at) for w in own[a : a + 50]) for at in starts]
    assert np.mean([rejected(t) for t in mixed]) > 0.1


def test_language_odd_rows(spark, odd, empty):
    learned = {"en": b"the house and the dog of the fox over " * 20, "fr": b"le chien et la maison de le renard sur " * 20}
    got = {(r.doc_id, r.text): r for r in langid.identify(odd.withColumn("lang_pred", F.lit(1)), learned).collect()}
    assert {r.lang_pred for (i, _), r in got.items() if i in (3, 4, 6)} == {"und"} and got[(1, ROWS[0][1])].lang_pred == "en"
    assert got[(None, "  \n\t ")].lang_pred == "und" and langid.identify(odd, learned).count() == len(ROWS)
    same = "the le " * 200
    both = langid.identify(spark.createDataFrame([(same,)], "text string"), {"en": b"zzz qqq", "fr": b"zzz qqq"}).first()
    assert both.lang_rejected and both.lang_pred == "en"
    assert langid.fit(empty) == {} and langid.identify(odd, {}).where("lang_pred = 'und'").count() == len(ROWS)
    assert set(langid.fit(odd)) == {"en", "fr", "pl"}
    assert langid.identify(empty, learned).count() == 0


def test_folds_of_null_ids(spark):
    assert [r[0] for r in spark.createDataFrame([(None,), (5,)], "doc_id long").select(fold("doc_id", 3)).collect()] == [-1, crc(5) % 3]
