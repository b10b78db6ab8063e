"""Toxicity by a fuzzy lexicon and the context of its hits.

A lexicon of whole words and word stems is learned from labelled texts, together with the
number of spelling errors at which each entry is still a sure sign. Its trie is intersected with
Levenshtein automata: a state is the set of trie nodes that a word's letters reach with at most
``ERRORS`` edits, and transitions are worked out once, on first use, so a word costs one look-up
a letter. A hit's context window decides how it counts: within quotation marks, or beside a
word of speech, it is a quotation and counts by ``QUOTED`` only. The sums of exact and of
misspelled hits, as such and by text length, give the score through a logistic model.

Defined cases: null and empty texts have no hit and get the score of a text without one. Where the
labelled sample is empty or holds one class, no entry is learned and every score is the smoothed
share of label 1 (0 without labels). A very long text is read whole. Null and repeated ids stay, row by
row; the names of further columns do not matter, as only the named ones are read or replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from granary.llm.common import extended, numbered, rounds, written

#: The bound of the labelled sample, in texts, and of the candidate entries that the driver compares.
SAMPLE, CANDIDATES = 20_000, 10_000
#: Letters of a stem; share of label 1 that an entry needs, and how many nats of evidence for it
#: (that many that chance makes none of a hundred million candidates).
STEM, PRECISION, EVIDENCE, SUPPORT = range(4, 11), 0.9, 18.5, 5
ERRORS = 1
#: Letters from which a misspelling is looked for, and the share of clean texts in which it may occur.
FUZZY_FROM, STRAY = 5, 0.0005
#: Words around a hit that are its context, and what a quoted hit counts.
WINDOW, QUOTED = 6, 0.25
#: Letters and digits, as digits stand in for letters in misspelled terms.
WORD = re.compile(r"[^\W_]+")
OPENING, CLOSING = set("\"“„«‹'‘”"), set("\"”“»›'’")
#: Words of speech in the four languages of the sample tables.
SPEECH = frozenset("said says quote quoted called wrote reported sagte sagt zitat schrieb dit cite écrit dijo dice cita escribió".split())
#: Words and states that a worker remembers.
REMEMBERED, STATES = 100_000, 20_000


@dataclass
class Lexicon:
    """Entries as ``(text, is_stem, errors)``, and the logistic model's weights."""

    entries: list[tuple[str, bool, int]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    prior: float = 0.0


class Matcher:
    """The lexicon's trie, walked by Levenshtein automata that are made deterministic on demand."""

    def __init__(self, entries: list[tuple[str, bool, int]]):
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]
        for number, (text, _, errors) in enumerate(entries):
            node = 0
            self.reach[0] = max(self.reach[0], errors)
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], errors)
            self.ends[node].append(number)
        self._forget()

    def _forget(self) -> None:
        self.states: dict[tuple, int] = {}
        self.sets: list[dict[int, int]] = []
        self.stems: list[tuple[int, int] | None] = []
        self.wholes: list[tuple[int, int] | None] = []
        self.moves: list[dict[str, int]] = []
        self.words: dict[str, tuple[int, int] | None] = {}
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        closed, queue = dict(nodes), list(nodes)
        while queue:  # a letter of the entry that the word lacks
            node = queue.pop()
            for child in self.children[node].values():
                errors = closed[node] + 1
                if errors <= self.reach[child] and errors < closed.get(child, 99):
                    closed[child] = errors
                    queue.append(child)
        key = tuple(sorted(closed.items()))
        if key in self.states:
            return self.states[key]
        number = self.states[key] = len(self.sets)
        ends = [(errors, n) for node, errors in closed.items() for n in self.ends[node] if errors <= self.entries[n][2]]
        self.sets.append(closed)
        self.stems.append(min((e for e in ends if self.entries[e[1]][1]), default=None))
        self.wholes.append(min(ends, default=None))
        self.moves.append({})
        return number

    def _move(self, state: int, letter: str) -> int:
        found: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.reach[node] and errors < found.get(node, 99):
                found[node] = errors

        for node, errors in self.sets[state].items():
            reach(node, errors + 1)  # a letter too many
            for own, child in self.children[node].items():
                reach(child, errors + (own != letter))
        return self._state(found)

    def __call__(self, word: str) -> tuple[int, int] | None:
        """Errors and number of the best entry that the word is, or is an inflection of."""
        if word in self.words:
            return self.words[word]
        if len(self.words) > REMEMBERED or len(self.sets) > STATES:
            self._forget()
        state, best = self.start, None
        for letter in word:
            following = self.moves[state].get(letter)
            if following is None:
                following = self.moves[state][letter] = self._move(state, letter)
            state = following
            if not self.sets[state]:
                break
            if (stem := self.stems[state]) and (best is None or stem < best):
                best = stem
        if self.sets[state] and (whole := self.wholes[state]) and (best is None or whole < best):
            best = whole
        if len(word) <= 40:
            self.words[word] = best
        return best


def is_quoted(text: str, begin: int, end: int) -> bool:
    """Whether the hit stands in quotation marks, or beside a word of speech, within its window."""
    before, after = text[max(0, begin - 12 * WINDOW) : begin], text[end : end + 12 * WINDOW]
    before = " ".join(before.split(" ")[-WINDOW - 1 :])
    after = " ".join(after.split(" ")[: WINDOW + 1])
    marks = any(c in OPENING and not before[i - 1 : i].isalnum() for i, c in enumerate(before)) and any(
        c in CLOSING and not after[i + 1 : i + 2].isalnum() for i, c in enumerate(after)
    )
    return marks or any(w in SPEECH for w in WORD.findall(before)[-WINDOW:])


def hits(text: str, matcher: Matcher) -> tuple[list[tuple[int, int, bool]], int]:
    """``(entry, errors, quoted)`` of every hit, and the number of words."""
    low = text.lower()
    words = WORD.findall(low)
    if not any(matcher(w) is not None for w in set(words)):
        return [], len(words)
    out = []
    for found in WORD.finditer(low):
        if (hit := matcher(found[0])) is not None:
            out.append((hit[1], hit[0], is_quoted(low, found.start(), found.end())))
    return out, len(words)


def features(found: list[tuple[int, int, bool]], n_words: int) -> list[float]:
    exact = sum(QUOTED if quoted else 1.0 for _, errors, quoted in found if not errors)
    fuzzy = sum(QUOTED if quoted else 1.0 for _, errors, quoted in found if errors)
    return [1.0, min(exact, 1.0), np.log1p(exact), min(fuzzy, 1.0), np.log1p(fuzzy), 100.0 * (exact + fuzzy) / (n_words + 20)]


def probability(weights: list[float], row: list[float]) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(np.dot(weights, row), -40, 40))))


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, size: int) -> DataFrame:
    """``label, text`` of at most ``size`` labelled texts, drawn by a hash of the id."""
    chosen = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).where("label in (0, 1)")
    chosen = chosen.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64(F.lit("toxic sample"), "id"), "id").limit(size)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("label", F.coalesce("text", F.lit("")).alias("text"))


def copy_key(text: str) -> int:
    """The smallest hash of the text's word quadruples; copies and near copies mostly share it."""
    words = text.split()
    quads = {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))}
    return min(map(xxhash.xxh64_intdigest, quads)) >> 1


def _with_copy_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rounds(batches, "text"):
        keys = pa.array([copy_key(t) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, keys], ["label", "text", "copy"])


def evidence(toxic: int, clean: int, prior: float) -> float:
    """Nats by which the texts speak for a share of label 1 above the prior one."""
    total = toxic + clean
    parts = [(toxic, prior), (clean, 1 - prior)]
    return sum(n * np.log(n / (total * share)) for n, share in parts if n) if toxic > total * prior else 0.0


def _candidates(rows: DataFrame, prior: float) -> dict[tuple[str, bool], set[int]]:
    """Words and stems that mark label 1, with the contexts (the words beside them) in which they do.

    Copies of a text give one context however many they are, so contexts and not texts are what
    a candidate is judged by in the end.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rounds(batches, "text"):
            counts: Counter = Counter()
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = {w for w in WORD.findall(text.lower()) if STEM[0] <= len(w) <= 40}
                own = {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEM if n <= len(w)}
                counts.update((label, *x) for x in own)
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.bool_()),
                 pa.array([counts[k] * (k[0] == 1) for k in keys], pa.int64()), pa.array([counts[k] * (k[0] == 0) for k in keys], pa.int64())],
                ["entry", "stem", "toxic", "clean"],
            )

    counted = rows.mapInArrow(spread, "entry string, stem boolean, toxic long, clean long").groupBy("entry", "stem")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = counted.where((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
    top = {
        (r.entry, r.stem): r.clean
        for r in counted.orderBy(F.desc("toxic"), "entry", "stem").limit(CANDIDATES).collect()
        if evidence(r.toxic, r.clean, prior) >= EVIDENCE
    }

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(top)
        for batch in rounds(batches, "text"):
            found: dict[tuple[str, bool], set[int]] = {}
            for text in batch.column("text").to_pylist():
                words = ["", *WORD.findall(text.lower()), ""]
                for i in range(1, len(words) - 1):
                    word = words[i]
                    own = known & {(word, False), *((word[:n], True) for n in STEM)}
                    if own:
                        context = xxhash.xxh64_intdigest(f"{words[i - 1]} {words[i + 1]}") >> 1
                        for entry in own:
                            found.setdefault(entry, set()).add(context)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.bool_()),
                 pa.array([sorted(v) for v in found.values()], pa.list_(pa.int64()))], ["entry", "stem", "contexts"],
            )

    toxic = rows.where("label = 1").mapInArrow(held, "entry string, stem boolean, contexts array<long>")
    out: dict[tuple[str, bool], set[int]] = {}
    for row in toxic.toLocalIterator():
        out.setdefault((row.entry, row.stem), set()).update(row.contexts)
    return {entry: seen for entry, seen in out.items() if evidence(len(seen), top[entry], prior) >= EVIDENCE}


def chosen(candidates: dict[tuple[str, bool], set[int]]) -> list[tuple[str, bool]]:
    """The candidates of most contexts, without those whose contexts others have nearly all had.

    Of equally good ones the longer is taken, and of a word and a stem of the same letters the word.
    """
    out: list[tuple[str, bool]] = []
    had: set[int] = set()
    for entry, seen in sorted(candidates.items(), key=lambda x: (-len(x[1]), -len(x[0][0]), x[0][1], x[0][0])):
        if len(seen - had) > 0.5 * len(seen):
            out.append(entry)
            had |= seen
    return out


def _measured(rows: DataFrame, entries: list[tuple[str, bool, int]]) -> list[tuple[int, list[int], list[float]]]:
    """Label, misspelled entries and features of each text of the sample."""
    shared = rows.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in rounds(batches, "text"):
            found = [hits(t, matcher) for t in batch.column("text").to_pylist()]
            strays = pa.array([sorted({n for n, errors, _ in x if errors}) for x, _ in found], pa.list_(pa.int32()))
            values = pa.array([features(x, n) for x, n in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), strays, values], ["label", "strays", "row"])

    return [(r.label, r.strays, r.row) for r in rows.mapInArrow(run, "label int, strays array<int>, row array<double>").collect()]


def logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> list[float]:
    """Weights by Newton's method; every feature but the constant is kept from going negative."""
    weights = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        penalty = np.full(len(weights), ridge)
        gradient = rows.T @ (p - labels) + penalty * weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights = weights - step
        weights[1:] = np.maximum(weights[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return weights.tolist()


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", size: int = SAMPLE) -> Lexicon:
    """Learn from at most ``size`` labelled texts; what the driver gets is bounded by that and ``CANDIDATES``.

    Texts that share the smallest hash of their word quadruples are taken to be copies, of which one is used.
    """
    rows = sample(docs, labels, id_column, text_column, label_column, size)
    rows = rows.mapInArrow(_with_copy_key, "label int, text string, copy long").dropDuplicates(["label", "copy"]).select("label", "text")
    rows = written(rows, "toxic-sample")  # read several times from here on
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    prior = (toxic + 0.5) / (toxic + clean + 1) if toxic or clean else 0.0
    if not toxic or not clean:
        return Lexicon(prior=prior)
    found = chosen(_candidates(rows, toxic / (toxic + clean)))
    entries = [(text, stem, ERRORS if len(text) >= FUZZY_FROM else 0) for text, stem in found]
    measured = _measured(rows, entries)
    strays = Counter(n for label, found, _ in measured if label == 0 for n in found)
    kept = [(text, stem, 0 if strays[n] > STRAY * clean else errors) for n, (text, stem, errors) in enumerate(entries)]
    if kept != entries:
        measured = _measured(rows, kept)
    x, y = np.array([row for *_, row in measured]), np.array([label for label, *_ in measured], float)
    weights = logistic(x, y)
    # few texts are misspelled in a sample: a misspelled hit then counts as an exact one
    for exact, fuzzy in ((1, 3), (2, 4)):
        if x[:, fuzzy].astype(bool).sum() < SUPPORT:
            weights[fuzzy] = weights[exact]
    return Lexicon(kept, weights, prior)


def score(docs: DataFrame, lexicon: Lexicon, text_column: str = "text") -> DataFrame:
    """The rows with ``toxicity`` (0 to 1) and ``toxic_hits``, the sorted entries found; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept, schema = extended(docs, "toxicity double, toxic_hits array<string>")
    where, names = kept.columns.index(text_column), schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        matcher = Matcher(model.entries)
        for whole in batches:
            for batch in rounds([numbered(whole)], str(where)):
                scores, found = [], []
                for text in batch.column(where).to_pylist():
                    own, n = hits(text or "", matcher)
                    scores.append(probability(model.weights, features(own, n)) if model.weights else model.prior)
                    found.append(sorted({model.entries[i][0] for i, _, _ in own}))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.string()))], names
                )

    return kept.mapInArrow(run, schema)
