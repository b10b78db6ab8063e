"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

Every text gives candidate spans of four kinds. *Base* spans follow one strict pattern for each kind and are always kept. Between
them looser patterns find more candidates: addresses with ``at`` and ``dot`` spelled out, defanged or long-form network addresses,
card numbers in other groupings or lengths, phone numbers without a plus. Five labelers vote yes, no or not at all on each
candidate: the strict pattern, a common written form, a gazetteer (top-level domains, reserved ranges, issuers, dialling
prefixes), a check of the value (lengths, octets, Luhn, digits) and the words before it.

``fit`` counts, over all documents, how often each combination of votes and shape occurs; expectation-maximisation estimates
each labeler's reliability and every combination's posterior, and a logistic span classifier is trained on these. A kind has at
most 3^5 votes times 2^6 shapes, so what reaches the driver is bounded at any size. ``find`` keeps a candidate beyond the
base ones where the classifier gives it at least one half.

Defined cases: a null or empty text has no span. Repeated rows and null ids are kept row by row. Spans are in code points, the end
excluded; base spans of one kind never overlap, those of two kinds may; an added span overlaps no base span, and of added ones that overlap the
likelier, then earlier stays. A long text is searched whole in time in line with its length. With an empty table, or none of a
kind, only base spans are found. Columns named like the new one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.llm.common import extended, numbered, rounds

KINDS = ("email", "ip", "card", "phone")
# The strict patterns, written so that a search is linear. An address is found by its @ and extended
# to the left; four numbers begin where a run of digits begins.
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Looser patterns. 64 and 63 are the longest local part and label an address may have.
LABEL = r"[A-Za-z0-9-]{1,63}"
AT, DOT = r"[\[({]\s?(?i:at)\s?[\])}]", r"(?:\s?[\[({]\s?(?i:dot)\s?[\])}]\s?|\s(?i:dot)\s)"
SPELLED = re.compile(rf"(?:\s?{AT}\s?{LABEL}(?:(?:{DOT}|\.){LABEL})+|\s(?i:at)\s{LABEL}(?:{DOT}{LABEL})+|\s?@\s?{LABEL}(?:(?:{DOT}|\.){LABEL})+)(?![A-Za-z0-9-])")
LEFT = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
MARKED = re.compile(rf"@|{DOT}|{AT}")
DEFANGED = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\{\.\})[0-9]{1,3}){3}(?![0-9A-Za-z])")
LONG_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
CHAIN = re.compile(r"(?<![0-9A-Za-z])[(]?[0-9](?:[ ().\-‐-―_/]{0,2}[0-9])++")
PHONE_FORM = re.compile(r"\([0-9]{2,5}\) ?[0-9]{3,4}[- .]?[0-9]{3,5}|[0-9]{3}([-. ])[0-9]{3}\1[0-9]{4}|00[1-9][0-9]{0,2}[ ./()-].*|0[0-9]{2,4}[/ -][0-9]{5,9}")
CARD_FORM = re.compile(r"[0-9]{4}([^0-9]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([^0-9]?)[0-9]{6}\2[0-9]{5}")
DATE_FORM = re.compile(r"(?:19|20)[0-9]{2}([-./])[01]?[0-9]\1[0-3]?[0-9].*|[0-3]?[0-9]([-./])[01]?[0-9]\2(?:19|20)[0-9]{2}.*")
WORD = re.compile(r"[^\W\d_]+")

# Gazetteers.
DOMAINS = frozenset(
    "com org net edu gov mil int info biz name io co ai app dev me tv eu us uk ca au nz ie de at ch fr be nl lu it es pt br mx ar cl pl cz se no dk fi ru ua jp cn kr in za".split()
)
RESERVED = ("0.", "127.", "224.", "239.", "240.", "255.")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "6011", "65", "35", "2221", "2720", "62")
DIALLING = ("001", "0049", "0033", "0034", "0044", "0039", "0043", "0041", "0031", "0032", "0052", "0055", "0086", "0091")
NEAR = {
    "email": frozenset("email mail emails mails contact write reach address adresse correo courriel kontakt schreib escribe".split()),
    "ip": frozenset("ip ips ipv address host server login from adresse dirección serveur".split()),
    "card": frozenset("card cards visa mastercard amex credit debit payment karte kreditkarte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone telefon teléfono téléphone call mobile cell fax handy ring dial llama appelez".split()),
}
AGAINST = frozenset("version release isbn issn doi order invoice serial id page pages section chapter figure date build ticket item sku".split())
BEFORE = 5  # words before a span that the context labeler reads
ABSTAIN, YES, NO = range(3)
LABELERS, SHAPES = 5, 6


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the strict patterns, leftmost and without overlaps within a kind."""
    out, end = [], 0
    for m in HOST.finditer(text) if "@" in text else ():
        begin = m.start()
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < m.start():
            out.append(("email", begin, m.end()))
        end = m.end() if begin < m.start() else end
    for m in IP.finditer(text):
        if all(len(p) < 4 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() > 15 and 16 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(digits_of(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def loose_spans(text: str, begin: int, end: int, spelled: bool) -> Iterator[tuple[str, int, int]]:
    """Further candidates between two base spans."""
    if spelled:
        last = begin
        for m in SPELLED.finditer(text, begin, end):
            left = LEFT.search(text[max(last, m.start() - 64) : m.start()])
            if left:
                yield "email", m.start() - len(left[0]), m.end()
                last = m.end()
    for pattern in (DEFANGED, LONG_IP):
        for m in pattern.finditer(text, begin, end):
            yield "ip", *m.span()
    for m in CHAIN.finditer(text, begin, end):
        whole = m.end() == len(text) or not text[m.end()].isalnum()
        digits = digits_of(m[0]) if whole and m.end() - m.start() > 6 else ""
        if 7 <= len(digits) <= (15 if digits.startswith(DIALLING) else 12):
            yield "phone", *m.span()
        elif 13 <= len(digits) <= 19:
            yield "card", *m.span()


@dataclass(frozen=True)
class Candidate:
    kind: str
    begin: int
    end: int
    base: bool
    votes: int  # a ternary digit for each labeler
    shape: int  # a bit for each property


def votes_of(kind: str, said: str, base: bool, words: deque) -> list[int]:
    """Votes of the five labelers."""
    bare = said.lower()
    digits = digits_of(said)
    near = YES if NEAR[kind].intersection(words) else NO if AGAINST.intersection(words) else ABSTAIN
    strict = YES if base else ABSTAIN
    if kind == "email":
        labels = [x for x in re.split(r"[^a-z0-9-]+|\bdot\b", bare) if x]
        form = YES if base or re.search(r"[\[({]\s?at\s?[\])}]", bare) else NO if re.search(r"@\s|\s@", bare) else ABSTAIN
        listed = YES if labels and labels[-1] in DOMAINS else NO
        check = YES if len(labels) >= 3 and all(len(x) < 64 for x in labels) else NO
    elif kind == "ip":
        parts = re.split(r"[^0-9a-f]+", bare)
        form = YES if base or "[" in said or ":" in said else ABSTAIN
        listed = NO if len(parts) == 4 and ".".join(parts).startswith(RESERVED) else YES
        check = YES if len(parts) == 8 or all(x.isdigit() and int(x) <= 255 for x in parts) else NO
    elif kind == "card":
        form = YES if CARD_FORM.fullmatch(said) else NO if DATE_FORM.fullmatch(said) else ABSTAIN
        listed = YES if digits.startswith(ISSUERS) else NO
        check = YES if luhn(digits) else NO
    else:
        form = YES if base or PHONE_FORM.fullmatch(said) else NO if DATE_FORM.fullmatch(said) or said.isdigit() else ABSTAIN
        listed = YES if said.startswith(("+", "(")) or digits.startswith(DIALLING) else ABSTAIN
        check = YES if 9 <= len(digits) <= 15 else NO
    return [strict, form, listed, check, near]


def shape_of(text: str, said: str, begin: int, end: int) -> list[bool]:
    """Properties that no labeler reads."""
    marks = {c for c in said if not c.isalnum()}
    return [
        begin == 0 or text[begin - 1].isspace(),
        end == len(text) or text[end].isspace() or text[end] in ".,;:!?)",
        len(marks) <= 1,
        bool(marks & set("()[]{}")),
        any(c.isalpha() for c in said),
        len(said) > 16,
    ]


def candidates(text: str) -> list[Candidate]:
    """All candidates with their votes, by begin."""
    base = sorted(base_spans(text), key=lambda s: (s[1], s[2]))
    found = [(*s, True) for s in base]
    at, spelled = 0, MARKED.search(text) is not None
    for begin, end in [*((b, e) for _, b, e in base), (len(text), len(text))]:
        if begin > at:
            found += [(*s, False) for s in loose_spans(text, at, begin, spelled)]
        at = max(at, end)
    found.sort(key=lambda s: (s[1], s[2]))
    words, reading, out = deque(maxlen=BEFORE), WORD.finditer(text) if found else iter(()), []
    waiting = next(reading, None)
    for kind, begin, end, is_base in found:
        while waiting and waiting.end() <= begin:
            words.append(waiting[0].lower())
            waiting = next(reading, None)
        said = text[begin:end]
        votes = shape = 0
        for vote in votes_of(kind, said, is_base, words):
            votes = votes * 3 + vote
        for bit in shape_of(text, said, begin, end):
            shape = shape * 2 + bit
        out.append(Candidate(kind, begin, end, is_base, votes, shape))
    return out


def ballots(codes: np.ndarray) -> np.ndarray:
    """Votes of every pattern, one column for each labeler."""
    return codes[:, None] // 3 ** np.arange(LABELERS - 1, -1, -1) % 3


def inputs(votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Rows for the span classifier: votes as yes less no, whether there is one, the shape's bits, and one."""
    own = ballots(votes)
    bits = shapes[:, None] >> np.arange(SHAPES - 1, -1, -1) & 1
    return np.hstack([(own == YES).astype(float) - (own == NO), own != ABSTAIN, bits, np.ones((len(own), 1))])


def reliabilities(votes: np.ndarray, counts: np.ndarray, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: each labeler's votes given no or yes, and every pattern's posterior of yes.

    One pseudo-count for each vote, three for a right one, says that a labeler is rather right than wrong."""
    own = ballots(votes)
    posterior = 1 / (1 + np.exp(-((own == YES).sum(1) - (own == NO).sum(1)).astype(float)))
    rate = np.zeros((LABELERS, 2, 3))
    for _ in range(steps):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        for j in range(LABELERS):
            for y in (0, 1):
                n = np.bincount(own[:, j], weights=weight[y], minlength=3) + 1
                n[YES if y else NO] += 2
                rate[j, y] = n / n.sum()
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        log = np.log(prior)[:, None] + sum(np.log(rate[j][:, own[:, j]]) for j in range(LABELERS))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done = np.abs(new - posterior).max(initial=0) < 1e-9
        posterior = new
        if done:
            break
    return rate, posterior


def classifier(rows: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    weights = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (counts * (target - p)) - ridge * weights
        curve = (rows * (counts * p * (1 - p))[:, None]).T @ rows + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass(frozen=True)
class Model:
    """Classifier weights and labelers' reliabilities of each kind that was seen."""

    weights: dict[str, np.ndarray]
    rates: dict[str, np.ndarray]

    def score(self, kind: str, votes: int, shape: int) -> float:
        """Likelihood that a span is personal data; 0 for a kind that was not seen."""
        if kind not in self.weights:
            return 0.0
        return float(1 / (1 + np.exp(-inputs(np.array([votes]), np.array([shape]))[0] @ self.weights[kind])))


def fit(docs: DataFrame, text_column: str = "text") -> Model:
    """The model of all rows; only counts of vote and shape patterns come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in rounds(batches, "text"):
            for text in batch.column("text").to_pylist():
                seen.update((c.kind, c.votes, c.shape) for c in candidates(text or ""))
        columns = list(zip(*((*key, n) for key, n in seen.items()), strict=True)) or [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["kind", "votes", "shape", "n"])

    found = docs.select(F.col(text_column).alias("text")).mapInArrow(run, "kind string, votes long, shape long, n long")
    rows = found.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n")).orderBy("kind", "votes", "shape").collect()
    weights, rates = {}, {}
    for kind in KINDS:
        own = np.array([(r.votes, r.shape, r.n) for r in rows if r.kind == kind], np.int64).reshape(-1, 3)
        if len(own):
            rates[kind], posterior = reliabilities(own[:, 0], own[:, 2].astype(float))
            weights[kind] = classifier(inputs(own[:, 0], own[:, 1]), posterior, own[:, 2].astype(float))
    return Model(weights, rates)


def decide(found: list[Candidate], score: Callable[[str, int, int], float]) -> list[tuple[str, int, int, bool, float]]:
    """``(kind, begin, end, base, score)`` of the spans kept, by kind as listed, then begin."""
    base = [(c.kind, c.begin, c.end, True, 1.0) for c in found if c.base]
    likely = []
    for c in found:
        if not c.base:
            likelihood = score(c.kind, c.votes, c.shape)
            if likelihood >= 0.5:
                likely.append((c.kind, c.begin, c.end, False, likelihood))
    # added spans lie between base ones; among themselves the likelier goes first
    added: list[tuple[str, int, int, bool, float]] = []
    for one in sorted(likely, key=lambda s: s[1]):
        if added and one[1] < added[-1][2]:
            if one[4] > added[-1][4]:
                added[-1] = one
            continue
        added.append(one)
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1]))


NEW = "pii array<struct<kind:string,begin:long,end:long,base:boolean,score:double>>"
SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])
NAMES = [SPAN.field(i).name for i in range(SPAN.num_fields)]


def find(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows with ``pii``: their spans by kind as listed, then begin."""
    kept, schema = extended(docs, NEW)
    where, names = kept.columns.index(text_column), schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = cache(model.score)  # a bounded number of patterns
        for whole in batches:
            for batch in rounds([numbered(whole)], str(where)):
                spans = [[dict(zip(NAMES, s, strict=True)) for s in decide(candidates(t or ""), score)] for t in batch.column(where).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, pa.list_(SPAN))], names)

    return kept.mapInArrow(run, schema)
