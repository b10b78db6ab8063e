"""Benchmark decontamination with an FM-index for each shard of training text.

A shard is a slice of documents. Its words become numbers of the benchmark's vocabulary; only runs of such
words that are long enough to hold a window are indexed, as no window lies elsewhere. Over them stand
a suffix array, its Burrows-Wheeler transform in a wavelet matrix, and every eighth suffix
position. All windows are searched backwards together through the matrix's ranks,
their occurrences located by steps to the next sampled position, and the words they cover
merged to removal spans.

The benchmark's items are taken in blocks of at most 4 MB, a longer item in parts that share a window's words less one. Every
block is a pass of its own: its result is written and its broadcast dropped before the next one is read, so no more than one
block is held by the driver or a worker, about 25 times its bytes. A benchmark of one block is searched without a table between.

Defined cases: a null or empty text has no words, no spans and stays as it is. An item without a
word matches nothing, one of fewer words than a window is one window as a whole, and an
item without an id marks words but is not listed. Equal items, items that share windows, ties and repeated
documents are each reported in full. A long text lies in a shard of its own. An empty benchmark
or an empty table gives no span or no row. Columns other than the named ones pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from granary.llm.common import WORD_TABLE, encoded, extended, numbered, rounds, written

WINDOW, SAMPLED, SHARD, BLOCK_BYTES = 10, 8, 4 << 20, 4 << 20
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Windows:
    """The distinct windows of a block of items, as rows of word numbers from 1."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in items if item is not None})
        number = {item: i for i, item in enumerate(self.items)}
        of: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            words = (text or "").encode().translate(WORD_TABLE).split()
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            length = min(size, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                of.setdefault(tuple(ids[i : i + length]), set()).update([number[item]] if item is not None else [])
        self.lengths = np.array([len(w) for w in of], np.int64)
        self.words = np.zeros((len(of), size), np.int64)
        for row, window in zip(self.words, of, strict=True):
            row[: len(window)] = window
        self.owners = [sorted(x) for x in of.values()]


class Index:
    """FM-index of word numbers in runs that end with a 0 each."""

    def __init__(self, text: np.ndarray, top: int):
        self.n, self.text = len(text), text
        order = self._suffixes(text)
        before = text[order - 1]  # the first suffix's predecessor is the last 0
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 2))))
        self.levels = []
        self.bits = max(1, int(top).bit_length())
        row = before
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit)))
            zeros = self.n - int(ones[-1])
            self.levels.append((level, ones, zeros))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        self.before = before
        begins = np.concatenate(([True], text[:-1] == 0))  # a walk back never leaves a run
        kept = (order % SAMPLED == 0) | begins[order]
        self.sampled = np.where(kept, order, -1)

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Positions in suffix order by prefix doubling; every 0 is a letter of its own."""
        n, ends = len(text), np.flatnonzero(text == 0)
        rank = text + len(ends)
        rank[ends] = np.arange(len(ends))
        step = 1
        order = np.argsort(rank, kind="stable")
        while True:
            key = rank[order]
            fresh = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                return order
            following = np.zeros(n, np.int64)
            following[:-step] = rank[step:] + 1
            rank = rank * (n + 1) + following
            order = np.argsort(rank, kind="stable")
            step *= 2

    def rank(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each word stands before the place in the transform."""
        low = np.zeros(len(word), np.int64)
        for level, ones, zeros in self.levels:
            one = (word >> level) & 1 == 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - low

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur, and the range of suffixes that begin with each."""
        on = np.arange(len(windows.lengths))
        low, high = np.zeros(len(on), np.int64), np.full(len(on), self.n, np.int64)
        step = 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(on):
            left = windows.lengths[on] - step
            word = windows.words[on, left]
            low = self.first[word] + self.rank(word, low)
            high = self.first[word] + self.rank(word, high)
            alive = low < high
            whole = alive & (left == 0)
            done.append((on[whole], low[whole], high[whole]))
            more = alive & ~whole
            on, low, high = on[more], low[more], high[more]
            step += 1
        return tuple(np.concatenate([d[i] for d in done]) if done else np.zeros(0, np.int64) for i in range(3))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by stepping back to the next sampled one."""
        out, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(rows):
            known = self.sampled[rows]
            have = known >= 0
            out[at[have]] = known[have] + steps
            rows, at = rows[~have], at[~have]
            word = self.before[rows]
            rows = self.first[word] + self.rank(word, rows)
            steps += 1
        return out


def search_shard(texts: list[bytes], windows: Windows) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Of each text: its number of words, the merged spans of words hit, and the items that hit them."""
    get = windows.vocabulary.get
    counts, parts = [], []
    for text in texts:
        words = text.translate(WORD_TABLE).split()
        counts.append(len(words))
        parts += [np.fromiter(map(get, words, repeat(0)), np.int64, len(words)), np.zeros(1, np.int64)]
    out: list[tuple[int, list[tuple[int, int]], list[int]]] = [(n, [], []) for n in counts]
    if not len(windows.lengths) or not any(counts):
        return out
    whole = np.concatenate(parts)
    known = np.concatenate(([0], (whole > 0).astype(np.int8), [0]))
    begins, ends = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
    long = ends - begins >= windows.lengths.min()
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return out
    lengths = ends - begins + 1  # with the 0 behind the run
    starts = np.cumsum(lengths) - lengths
    place = np.repeat(begins - starts, lengths) + np.arange(int(lengths.sum()))
    index = Index(whole[place], len(windows.vocabulary))
    found, low, high = index.search(windows)
    if not len(found):
        return out
    sizes = high - low
    rows = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    which = np.repeat(found, sizes)
    at = place[index.locate(rows)]
    edge = np.zeros(len(whole) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + windows.lengths[which], -1)
    hit = np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8), [0]))
    span_begins, span_ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
    firsts = np.cumsum([n + 1 for n in counts]) - [n + 1 for n in counts]
    owner = np.searchsorted(firsts, span_begins, "right") - 1
    for doc, begin, end in zip(owner.tolist(), (span_begins - firsts[owner]).tolist(), (span_ends - firsts[owner]).tolist(), strict=True):
        out[doc][1].append((begin, end))
    docs = np.searchsorted(firsts, at, "right") - 1
    items: dict[int, set[int]] = {}
    for doc, window in np.unique(np.stack((docs, which), 1), axis=0).tolist():
        items.setdefault(doc, set()).update(windows.owners[window])
    for doc, own in items.items():
        out[doc][2].extend(sorted(own))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def parts_of(text: str | None, size: int, window: int) -> Iterator[str | None]:
    """The item, or its words in parts of about ``size`` bytes, so that each window lies whole in one of them."""
    if len(text or "") <= size:
        yield text
        return
    words = text.encode().translate(WORD_TABLE).split()
    if len(words) <= window:
        yield b" ".join(words).decode()
        return
    at = 0
    while at + window - 1 < len(words):
        end, held = at, 0
        while end < len(words) and (held < size or end - at < window):
            held += len(words[end]) + 1
            end += 1
        yield b" ".join(words[at : end + window - 1]).decode()
        at = end


def blocks(benchmark: DataFrame, item_column: str, text_column: str, size: int, window: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in blocks of about ``size`` bytes; one block is on the driver at a time."""
    rows = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        for text in parts_of(row.text, size, window):
            block.append((row.item, text))
            held += len(text or "") + 16
            if held > size:
                yield block
                block, held = [], 0
    if block:
        yield block


ADDED = "n_words long, spans array<struct<begin:long,end:long>>, items array<string>, cleaned string"
SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])


def mark(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows with ``n_words``, ``spans`` (of hit words, the end excluded), ``items`` (ids as sorted strings) and
    ``cleaned``, the text without the spans; columns of these names are replaced."""
    kept, _ = extended(docs, ADDED)
    columns = kept.columns
    out = kept.withColumns({
        "n_words": F.lit(None).cast("long"),
        "spans": F.array().cast("array<struct<begin:long,end:long>>"),
        "items": F.array().cast("array<string>"),
        "cleaned": F.lit(None).cast("string"),
    })
    last: list[tuple[str | None, str | None]] = []
    for block in blocks(benchmark, item_column, item_text, block_bytes, window):
        if last:
            searched, shared = _pass(out, Windows(last, window), columns, text_column)
            out = written(searched, "decontam")
            shared.destroy()
        last = block
    return _pass(out, Windows(last, window), columns, text_column)[0]


def _pass(df: DataFrame, windows: Windows, columns: list[str], text_column: str) -> tuple[DataFrame, Broadcast]:
    """The rows searched for one block, and the block's broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(windows)
    where = columns.index(text_column)
    schema = extended(df, ADDED)[1]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for batch in rounds([numbered(whole)], str(where), SHARD):
                found = search_shard(encoded(batch.column(where)), own)
                spans, items = [], []
                for (_, new, hits), old, listed in zip(found, *(batch.column(len(columns) + i).to_pylist() for i in (1, 2)), strict=True):
                    spans.append([{"begin": b, "end": e} for b, e in merged([*new, *((s["begin"], s["end"]) for s in old)])])
                    items.append(sorted({*listed, *(own.items[i] for i in hits)}))
                texts = batch.column(where)
                if any(spans):
                    texts = pa.array([cut(t, s) if s else t for t, s in zip(texts.to_pylist(), spans, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(columns)], pa.array([n for n, *_ in found], pa.int64()),
                     pa.array(spans, pa.list_(SPAN)), pa.array(items, pa.list_(pa.string())), texts], names
                )

    return df.mapInArrow(run, schema), shared


def n_hit() -> Column:
    """Words in the spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def cut(text: str, spans: list[dict[str, int]]) -> str:
    """The text without the spans' words and what stands between them."""
    found = list(WORD.finditer(text.translate(LOWER)))
    out, at = [], 0
    for span in spans:
        out.append(text[at : found[span["begin"]].start()])
        at = found[span["end"] - 1].end()
    return "".join([*out, text[at:]])


LOWER = {c: c + 32 for c in range(65, 91)}
