"""Scoring texts by a bigram model whose counts lie in a log-frequency Bloom filter.

A count is quantised on a logarithmic scale, and an n-gram of level q is put into the filter
once for each of the levels 1 to q. Its level is read back by asking for level 1, 2, ... until one is
missing. The filter holds three kinds of entries: bigrams, the counts of their contexts, and
the contexts' back-off weights. A bigram (h, w) that is found has the probability

    max(c(h, w) - D, 0) / c(h) + g(h) p(w),

and one that is not found g(h) p(w); g(h) is what the discounts and the bigrams that are not stored
leave over, and p(w) the add-one unigram model, from exact counts. Levels are rounded so that
probabilities come out too small rather than too large.

Every bigram is stored, also one that is seen once, at every size of the corpus, and nothing of the model is
broadcast or collected. The filter lies in segments of about ``SEGMENT`` entries, whose number grows
with the corpus. A slice of texts sends its distinct bigrams and words to the segments that hold them, packed by
segment, and the levels and exact counts that come back meet the slice again: work and traffic
grow in line with the input, and a hot word or context is asked for once a slice.

Defined cases: a null text is an empty one, which is a single end token. Without training texts every
token has probability 1. A text of any length is counted and scored whole, repeated rows and null ids
row by row. Only the id, the text and the training condition are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from granary.llm.common import SPACE_TABLE, encoded, rounds, written

END = b"\n"
SEED = 42
#: The step of the logarithmic scale, the discount, bits for each level of an entry, and probes.
BASE, DISCOUNT, BITS, PROBES = math.sqrt(2), 0.75, 10, 5
#: Entries of one segment, tokens that a task counts at a time, words that it remembers, and bytes of a slice of texts.
SEGMENT, BUFFER, REMEMBERED, SLICE = 1 << 20, 2_000_000, 200_000, 4 << 20
#: Keys that are hashed and looked up at a time.
BLOCK = 1 << 14
BIGRAM, CONTEXT, BACKOFF = 1, 2, 3
#: What segments answer: levels of bigrams, levels of words as contexts, their back-off weights and exact counts.
ANSWERS = ("bigram", "context", "backoff", "count")


class Hashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, SEED)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def words_of(text: bytes) -> list[bytes]:
    words = text.translate(SPACE_TABLE).split()
    words.append(END)
    return words


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit integers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def named(kind: int, keys: np.ndarray) -> np.ndarray:
    """Entries' names: keys of different kinds do not meet."""
    return mix(keys.astype(np.uint64) ^ np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def strides(names: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of each entry at a level begin, and how far one is from the next."""
    step = np.uint64(0xD1B54A32D192ED03)
    one = mix(names + np.uint64(int(step) * level & (1 << 64) - 1))
    return one, mix(one ^ step) | np.uint64(1)


def within(places: np.ndarray, size: np.uint64) -> np.ndarray:
    """Bits within a segment: the remainder, by a division that numpy does in vectors."""
    return (places - places // size * size).view(np.int64)


class Filter:
    """Segments of bits; a name's segment is fixed by its low half."""

    def __init__(self, segments: dict[int, bytes], count: int):
        self.segments = [np.frombuffer(segments.get(i, b"\0"), np.uint8) for i in range(max(1, count))]

    def levels(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """Levels by repeated membership probes; 0 where an entry is not in the filter."""
        out = np.zeros(len(keys), np.uint8)
        for start in range(0, len(keys), BLOCK):
            names, block = named(kind, keys[start : start + BLOCK]), out[start : start + BLOCK]
            if len(self.segments) == 1:
                block[:] = read_levels(self.segments[0], names)
                continue
            segment = names % np.uint64(len(self.segments))
            for i in np.unique(segment).tolist():
                block[segment == i] = read_levels(self.segments[i], names[segment == i])
        return out


def read_levels(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Levels of names in one segment, probe by probe: most names that are missing are so at the first."""
    out, at, level, size = np.zeros(len(names), np.uint8), np.arange(len(names)), 1, np.uint64(8 * len(bits))
    while len(at):
        place, stride = strides(names, level)
        for probe in range(PROBES):
            if probe:
                place = place + stride
            bit = within(place, size)
            there = ((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).view(bool)
            if not there.all():
                at, names, place, stride = at[there], names[there], place[there], stride[there]
        out[at] = level
        level += 1
    return out


@dataclass
class Model:
    """The filter's segments as tables ``segment, bits``, of bigrams and of contexts, and the corpus' totals."""

    grams: DataFrame
    contexts: DataFrame
    gram_segments: int
    context_segments: int
    tokens: int
    types: int


def count_words(texts: DataFrame) -> DataFrame:
    """``token, c`` over the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "c"])
            counts.clear()
            return done

        for batch in rounds(batches, "text", 1 << 20):
            for text in encoded(batch.column("text")):
                counts.update(words_of(text))
            if len(counts) > REMEMBERED:
                yield out()
        yield out()

    return texts.mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def keys_of(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Bigrams as context and word of 32 bits each; a text's first word follows an end."""
    low = hashes & np.uint64(0xFFFFFFFF)
    before = np.empty_like(low)
    before[1:] = low[:-1]
    before[firsts] = np.uint64(xxhash.xxh64_intdigest(END, SEED) & 0xFFFFFFFF)
    return before << np.uint64(32) | low


def dealt(keys: np.ndarray, count: int, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """The order of keys by segment, and there by ``within``; the segments, and where each begins and ends in that order."""
    segment = segment_of(keys, count)
    if within is None:
        # numbers of 16 bits are sorted by radix
        order = np.argsort(segment.astype(np.uint16) if count <= 1 << 16 else segment, kind="stable")
    elif within.dtype == np.uint32 and count <= 1 << 32:
        order = np.argsort(segment.astype(np.uint64) << np.uint64(32) | within)
    else:
        order = np.lexsort((within, segment))
    return order, *runs(segment[order])


def segment_of(keys: np.ndarray, count: int) -> np.ndarray:
    mixed, count = mix(keys), np.uint64(count)
    return (mixed - mixed // count * count).astype(np.int64)


def runs(ordered: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Distinct values of an ordered array, and where each begins and ends."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))
    return ordered[starts], list(zip(starts.tolist(), [*starts[1:].tolist(), len(ordered)], strict=True)) if len(ordered) else []


def short(keys: np.ndarray) -> np.ndarray:
    """32 bits of each bigram, by which its segment knows it: among 2 ** 20 entries one unseen bigram in 4,000 meets
    another's, beside the filter's own share of about one in a hundred."""
    return mix(keys ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def packed_bigrams(texts: DataFrame, segments: int) -> DataFrame:
    """``segment, keys, counts``: tasks' sorted keys and their counts as packed arrays, one row for each segment of the keys."""

    def pack(keys: np.ndarray) -> pa.RecordBatch:
        found, counts = np.unique(keys, return_counts=True)
        order, own, cuts = dealt(found, segments)
        found, counts = found[order], counts[order].astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()), *(pa.array([squeezed(x[a:b], i == 0) for a, b in cuts], pa.binary()) for i, x in enumerate((found, counts)))],
            ["segment", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = Hashes(), [], 0
        for batch in rounds(batches, "text", 1 << 20):
            cut = [words_of(t) for t in encoded(batch.column("text"))]
            lengths = np.array([len(w) for w in cut])
            values = np.fromiter(map(hashes.__getitem__, chain.from_iterable(cut)), np.uint64, int(lengths.sum()))
            held.append(keys_of(values, np.cumsum(lengths) - lengths))
            size += len(values)
            if size > BUFFER:
                yield pack(np.concatenate(held))
                held, size = [], 0
        if held:
            yield pack(np.concatenate(held))

    return texts.mapInArrow(run, "segment long, keys binary, counts binary")


def squeezed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers as compressed byte planes; ascending ones by their differences, whose high planes are empty."""
    plain = np.diff(values, prepend=values.dtype.type(0)) if ascending else values
    planes = np.ascontiguousarray(plain).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def restored(packed: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    plain = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(plain, dtype=kind) if ascending else plain


def joined(column: pa.ChunkedArray, kind: type, ascending: bool = False) -> np.ndarray:
    """Packed arrays one after another; nulls are passed over."""
    return np.concatenate([np.empty(0, kind), *(restored(x, kind, ascending) for x in column.to_pylist() if x is not None)])


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and sums of each of the values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[starts], *(np.add.reduceat(x[order].astype(np.int64), starts) if len(keys) else x.astype(np.int64) for x in values)


def count_levels(counts: np.ndarray) -> np.ndarray:
    """Levels of counts on the logarithmic scale, rounded down."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def bits_of(names: np.ndarray, levels: np.ndarray) -> bytes:
    """A segment of the filter: its entries, once for each level."""
    size = -(-int(levels.sum()) * BITS // 8) * 8
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        names, levels = names[levels >= level], levels[levels >= level]
        for start in range(0, len(names), BLOCK):
            place, stride = strides(names[start : start + BLOCK], level)
            for _ in range(PROBES):
                bits[within(place, np.uint64(size))] = True
                place += stride
    return np.packbits(bits, bitorder="little").tobytes() or b"\0"


def bigram_segments(texts: DataFrame, segments: int, context_segments: int) -> DataFrame:
    """``segment, bits`` of all bigrams, and for each segment of contexts what it is to add up: ``deal, keys, c, n``.

    Counts are exact and whole in a segment; its bits are set where they were counted. Of each context it sends the sum
    and the number of its bigrams, so a hot context is one entry of each segment.
    """

    def total(group: pa.Table) -> pa.Table:
        keys, sums = summed(joined(group.column("keys"), np.uint64, True), joined(group.column("counts"), np.uint32))
        bits = bits_of(named(BIGRAM, short(keys)), count_levels(sums))
        contexts, c, n = summed(keys >> np.uint64(32), sums, np.ones(len(sums), np.int64))
        order, own, cuts = dealt(contexts, context_segments)
        parts = [x[order] for x in (contexts.astype(np.uint32), c.astype(np.uint64), n.astype(np.uint32))]
        none = [None] * len(cuts)
        return pa.table({
            "segment": pa.array([group.column("segment")[0].as_py(), *none], pa.int64()),
            "bits": pa.array([bits, *none], pa.binary()),
            "deal": pa.array([None, *own.tolist()], pa.int64()),
            **{name: pa.array([None, *(squeezed(x[a:b], name == "keys") for a, b in cuts)], pa.binary()) for name, x in zip(("keys", "c", "n"), parts, strict=True)},
        })

    done = packed_bigrams(texts, segments).groupBy("segment")
    return done.applyInArrow(total, "segment long, bits binary, deal long, keys binary, c binary, n binary")


def low(hashes: np.ndarray) -> np.ndarray:
    return hashes & np.uint64(0xFFFFFFFF)


def word_rows(counts: DataFrame, segments: int) -> DataFrame:
    """``segment, h, c`` of words; those of one context key share a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = (mix(low(batch.column("h").to_numpy().view(np.uint64))) % np.uint64(segments)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(segment), batch.column("h"), batch.column("c")], ["segment", "h", "c"])

    return counts.select(F.xxhash64("token").alias("h"), "c").mapInArrow(run, "segment long, h long, c long")


def context_segments(parts: DataFrame, words: DataFrame) -> DataFrame:
    """``segment, bits`` of contexts' counts and back-off weights."""

    def build(key: tuple, own: pa.Table, group: pa.Table) -> pa.Table:
        seen, c, n = summed(joined(own.column("keys"), np.uint32, True).astype(np.uint64), *(joined(own.column(x), k) for x, k in (("c", np.uint64), ("n", np.uint32))))
        names, whole = summed(low(group.column("h").to_numpy().view(np.uint64)), group.column("c").to_numpy())
        place = np.minimum(np.searchsorted(names, seen), max(0, len(names) - 1))
        there = names[place] == seen if len(names) else np.zeros(len(seen), bool)
        seen, c, n, whole = seen[there], c[there], n[there], whole[place[there]]
        rest = np.maximum(1 - (c - DISCOUNT * n) / whole, 1e-6)
        backoff = np.ceil(-np.log(rest) / math.log(BASE) - 1e-9).astype(np.int64)
        bits = bits_of(np.concatenate((named(CONTEXT, seen), named(BACKOFF, seen))), np.concatenate((count_levels(whole), backoff)))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits], pa.binary())})

    sent = parts.where("deal IS NOT NULL").select(F.col("deal").alias("segment"), "keys", "c", "n")
    return sent.groupBy("segment").cogroup(words.groupBy("segment")).applyInArrow(build, "segment long, bits binary")


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the column ``text``, and the table ``token, c`` of all exact counts."""
    counts = written(count_words(texts), "lm-words")
    tokens, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # a segment of contexts gets a part from each segment of bigrams; four of these for one keep it small
    segments, few = max(1, -(-tokens // SEGMENT)), max(1, -(-tokens // (4 * SEGMENT)))
    parts = written(bigram_segments(texts, segments, few), "lm-bigrams")
    contexts = written(context_segments(parts, word_rows(counts, few)), "lm-contexts")
    return Model(parts.where("segment IS NOT NULL").select("segment", "bits"), contexts, segments, few, tokens, types), counts


def slices_of(source: DataFrame) -> DataFrame:
    """``slice, ids, lengths, words, tokens``: of each slice of the columns ``id, text`` the distinct words' hashes, and each token's place in them, by byte planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = Hashes(), TaskContext.get().partitionId() << 32
        for batch in rounds(batches, "text", SLICE):
            cut = [words_of(t) for t in encoded(batch.column("text"))]
            lengths = np.array([len(w) for w in cut], np.int64)
            values = np.fromiter(map(hashes.__getitem__, chain.from_iterable(cut)), np.uint64, int(lengths.sum()))
            words, tokens, times = np.unique(values, return_inverse=True, return_counts=True)
            # the most frequent first, so that most numbers are small
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), "<u4")
            place[order] = np.arange(len(order))
            words, tokens = words[order], place[tokens].view(np.uint8).reshape(-1, 4).T
            ids = pa.ListArray.from_arrays(pa.array([0, len(cut)], pa.int32()), pa.concat_arrays([batch.column("id")]))
            planes = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(tokens).tobytes())
            packed = [pa.array([x], pa.binary()) for x in (lengths.tobytes(), words.tobytes(), planes)]
            yield pa.RecordBatch.from_arrays([pa.array([number]), ids, *packed], ["slice", "ids", "lengths", "words", "tokens"])
            number += 1

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"slice long, ids array<{kind}>, lengths binary, words binary, tokens binary")


def bigrams_of(lengths: bytes, words: bytes, tokens: bytes) -> tuple[np.ndarray, ...]:
    """A slice's lengths, words and tokens, and each token's bigram."""
    lengths, words = np.frombuffer(lengths, np.int64), np.frombuffer(words, np.uint64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(tokens), np.uint8).reshape(4, -1)
    tokens = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return lengths, words, tokens, keys_of(words[tokens], np.cumsum(lengths) - lengths)


def unpacked(lengths: bytes, words: bytes, tokens: bytes) -> tuple[np.ndarray, ...]:
    """A slice's lengths, words and tokens, its distinct bigrams in order, and each token's place in them."""
    *parts, bigrams = bigrams_of(lengths, words, tokens)
    return *parts, *np.unique(bigrams, return_inverse=True)


def asked_for(keys: np.ndarray, segments: int, of_words: bool) -> tuple[np.ndarray, tuple]:
    """What is asked for each key, and the keys' deal with what is asked in ascending order."""
    asked = keys if of_words else short(keys).astype(np.uint32)
    return asked, dealt(low(keys) if of_words else keys, segments, asked)


def requests(slices: DataFrame, segments: int, of_words: bool) -> DataFrame:
    """``segment, slice, keys``: the words or bigrams that each slice asks each segment for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, *packed = (batch.column(x)[i].as_py() for x in range(4))
                if of_words:
                    asked, (order, own, cuts) = asked_for(np.frombuffer(packed[1], np.uint64), segments, True)
                    asked = asked[order]
                else:  # the same order, by values alone
                    keys = np.unique(bigrams_of(*packed)[3])
                    both = np.sort(segment_of(keys, segments).astype(np.uint64) << np.uint64(32) | short(keys))
                    asked, (own, cuts) = low(both).astype(np.uint32), runs((both >> np.uint64(32)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.full(len(own), number)), pa.array([squeezed(asked[a:b], True) for a, b in cuts], pa.binary())],
                    ["segment", "slice", "keys"],
                )

    return slices.select("slice", "lengths", "words", "tokens").mapInArrow(run, "segment long, slice long, keys binary")


def asked_in(group: pa.Table, kind: type) -> list[np.ndarray]:
    """Keys of each of the group's requests."""
    return [restored(x, kind, True) for x in group.column("keys").to_pylist()]


def answers(group: pa.Table, asked: list[np.ndarray], found: list[tuple[str, np.ndarray]]) -> pa.Table:
    """The group's requests with what was found for their keys: a packed array for each column."""
    ends = np.cumsum([len(x) for x in asked], dtype=np.int64).tolist()
    cuts = list(zip([0, *ends[:-1]], ends, strict=True))
    packed = {name: pa.array([squeezed(x[a:b]) for a, b in cuts], pa.binary()) for name, x in found}
    none = pa.nulls(group.num_rows, pa.binary())
    return pa.table({"slice": group.column("slice"), "segment": group.column("segment"), **{x: packed.get(x, none) for x in ANSWERS}})


def answer_bigrams(asked: pa.Table, held: pa.Table) -> pa.Table:
    bits = held.column("bits").to_pylist()
    keys = asked_in(asked, np.uint32)
    levels = Filter({0: bits[0]} if bits else {}, 1).levels(BIGRAM, np.concatenate([np.empty(0, np.uint32), *keys]))
    return answers(asked, keys, [("bigram", levels)])


def answer_words(asked: pa.Table, held: pa.Table) -> pa.Table:
    """Words' exact counts, and their levels as contexts."""
    keys, (bits, c) = asked_in(asked, np.uint64), (held.column(x) for x in ("bits", "c"))
    hashes = np.concatenate([np.empty(0, np.uint64), *keys])
    own = [x for x in bits.to_pylist() if x is not None]
    segment = Filter({0: own[0]} if own else {}, 1)
    is_word = np.asarray(c.is_valid())
    names, sums = summed(held.column("h").filter(pa.array(is_word)).to_numpy().view(np.uint64), c.filter(pa.array(is_word)).to_numpy())
    place = np.minimum(np.searchsorted(names, hashes), max(0, len(names) - 1))
    count = np.where(names[place] == hashes, sums[place], 0) if len(names) else np.zeros(len(hashes), np.int64)
    levels = [(name, segment.levels(kind, low(hashes))) for name, kind in (("context", CONTEXT), ("backoff", BACKOFF))]
    return answers(asked, keys, [*levels, ("count", count.astype(np.int64))])


def score_slice(lengths: np.ndarray, words: np.ndarray, tokens: np.ndarray, keys: np.ndarray, where: np.ndarray,
                levels: np.ndarray, by_word: list[np.ndarray], total: int) -> list[np.ndarray]:
    """Of each text: tokens, known ones, and the sums of log10 under the unigram and the bigram model."""
    size, left, count = by_word
    before = np.searchsorted(low(words)[by_low := np.argsort(low(words), kind="stable")], keys >> np.uint64(32))
    # a text's first word follows an end, which is a word of every slice
    context_of = by_low[before]
    known = size[context_of] > 0
    power = BASE ** np.arange(-255.0, 256)
    seen = np.maximum(power[levels + 254] - DISCOUNT, 0) / power[size + 255][context_of]
    seen = np.where((levels > 0) & known, seen, 0.0)
    weight = power[255 - left][context_of]
    share = (count + 1.0) / total
    own = np.log10(np.minimum(1.0, seen[where] + weight[where] * share[tokens]))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    add = lambda x: np.bincount(owner, weights=x, minlength=len(lengths))
    return [lengths, add(count[tokens] > 0).astype(np.int64), add(np.log10(share)[tokens]), add(own)]


def score(docs: DataFrame, model: Model, counts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, base_score, score`` of every text, in log10."""
    grams, few, total = model.gram_segments, model.context_segments, model.tokens + model.types + 1
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    slices = written(slices_of(source), "lm-slices")
    kind = source.schema["id"].dataType.simpleString()
    schema = "slice long, segment long, " + ", ".join(f"{x} binary" for x in ANSWERS)
    none = F.lit(None)
    of_words = model.contexts.select("segment", "bits", none.cast("long").alias("h"), none.cast("long").alias("c")).unionAll(
        word_rows(counts, few).select("segment", none.cast("binary").alias("bits"), "h", "c")
    )
    found = [
        requests(slices, n, words).groupBy("segment").cogroup(held.groupBy("segment")).applyInArrow(answer, schema)
        for n, words, held, answer in ((grams, False, model.grams, answer_bigrams), (few, True, of_words, answer_words))
    ]

    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        ids, *packed = (own.column(x)[0] for x in ("ids", "lengths", "words", "tokens"))
        parts = unpacked(*(x.as_py() for x in packed))
        got = got.sort_by("segment")
        by_key, by_word = (asked_for(x, n, words)[1][0] for x, n, words in ((parts[3], grams, False), (parts[1], few, True)))

        def back(name: str, kind: type, order: np.ndarray) -> np.ndarray:
            out = np.empty(len(order), np.int64)
            out[order] = joined(got.column(name), kind)
            return out

        words = [back(name, kind, by_word) for name, kind in (("context", np.uint8), ("backoff", np.uint8), ("count", np.int64))]
        done = score_slice(*parts, back("bigram", np.uint8, by_key), words, total)
        return pa.table({"id": ids.values, **{x: pa.array(v) for x, v in zip(("n_tokens", "n_known", "base_score", "score"), done, strict=True)}})

    scored = slices.groupBy("slice").cogroup(found[0].unionAll(found[1]).groupBy("slice")).applyInArrow(
        run, f"id {kind}, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumnRenamed("id", id_column)
