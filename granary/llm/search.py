"""Ranked lexical search by the Best Position Algorithm.

A shard is a slice of documents. For each term that a query can ask for, it has a list of
impacts, highest first, and direct access by document. A query reads its terms' lists in step. Each
document met is looked up in all lists, which gives its whole score and marks its positions there as seen.
The best position of a list is the last one up to which all are seen; no unseen document scores more
than the impacts at the best positions together. The search ends when that sum is strictly
below the k-th score, so documents that tie with the k-th are never missed. A task carries each query's k-th
score from shard to shard; a rank over the tasks' results ends the search.

Queries come in blocks of a bounded size, which is what the driver and a broadcast hold; each
block is a counting pass and a searching pass over the documents, and its results are written before the
next block is read.

A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))`` and a document's score the sum over the query's terms, repeats
included, of ``w * (10^9 tf div (1000 tf + 8 m))`` with ``m = 25 + 75 n N div L``, in 64-bit integers.

Defined cases: a null or empty text, and one without a term, is no document and is counted nowhere; as a query it
finds nothing. Every row is a document or a query of its own, also where ids repeat. Equal scores go by ascending id, null ids
last. Long texts are read whole, in pieces. Further columns are not read. Empty tables give no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from heapq import nsmallest
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from granary.llm.common import WORD_TABLE, encoded, rounds, written

SHARD, BLOCK_BYTES, PIECE, STEP = 16 << 20, 1 << 20, 4 << 20, 16
DOCUMENTS, WORDS = -1, -2  # rows of the counting pass beside the terms' own


class Queries:
    """A block of queries: their distinct terms by number, and each query's terms with repeats."""

    def __init__(self, rows: list[tuple[object, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.terms: list[tuple[np.ndarray, np.ndarray]] = []
        for _, text in rows:
            words = (text or "").encode().translate(WORD_TABLE).split()
            own = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)
            self.terms.append(np.unique(own, return_counts=True))


def blocks(items: DataFrame, size: int) -> Iterator[list[tuple[object, str | None]]]:
    """Queries in blocks of about ``size`` bytes; a longer text is a block of its own."""
    block, held = [], 0
    for name, text in items.toLocalIterator():
        if block and held + len(text or "") > size:
            yield block
            block, held = [], 0
        block.append((name, text))
        held += len(text or "") + 16
    if block:
        yield block


def word_numbers(text: bytes, vocabulary: dict[bytes, int]) -> Iterator[np.ndarray]:
    """Numbers of the text's words in order, -1 for others, piece by piece."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        words = text[at:end].split()
        yield np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
        at = end


def postings(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and ``term, document, frequency`` in the order of terms and documents."""
    lengths, keys = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        for numbers in word_numbers(text.translate(WORD_TABLE), vocabulary):
            lengths[i] += len(numbers)
            keys.append(numbers[numbers >= 0] * len(texts) + i)
    key, frequency = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_counts=True)
    return lengths, key // max(len(texts), 1), key % max(len(texts), 1), frequency


class Shard:
    """Impact lists of a slice of documents."""

    def __init__(self, texts: list[bytes], vocabulary: dict[bytes, int], weights: np.ndarray, documents: int, words: int):
        lengths, self.term, document, frequency = postings(texts, vocabulary)
        self.size = len(texts)
        self.key = self.term * self.size + document
        m = 25 + 75 * lengths * documents // words
        self.impact = weights[self.term] * (1_000_000_000 * frequency // (1000 * frequency + 8 * m[document]))
        order = np.lexsort((document, -self.impact, self.term))
        self.listed_document, self.listed_impact = document[order], self.impact[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.starts = np.searchsorted(self.term, np.arange(len(weights) + 1))
        self.seen = np.zeros(len(order), bool)

    def best(self, terms: np.ndarray, repeats: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them the k best and all that tie with the k-th; those below ``floor`` may be missing."""
        begins, ends = self.starts[terms], self.starts[terms + 1]
        alive = ends > begins
        terms, repeats, begins, ends = terms[alive], repeats[alive], begins[alive], ends[alive]
        for begin, end in zip(begins, ends, strict=True):
            self.seen[begin:end] = False
        scored = np.zeros(self.size, bool)
        documents, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        first_unseen, read, step = begins.copy(), begins.copy(), STEP
        while len(terms):
            upto = np.minimum(read + step, ends)
            fresh = np.unique(np.concatenate([self.listed_document[a:b] for a, b in zip(read, upto, strict=True)]))
            read, step = upto, 2 * step
            fresh = fresh[~scored[fresh]]
            scored[fresh] = True
            wanted = terms[:, None] * self.size + fresh
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            found = self.key[at] == wanted
            self.seen[self.place[at[found]]] = True
            documents.append(fresh)
            scores.append((np.where(found, self.impact[at], 0) * repeats[:, None]).sum(axis=0))
            threshold = 0
            for i, end in enumerate(ends):
                unseen = self.seen[first_unseen[i] : end]
                first_unseen[i] = end if unseen.all() else first_unseen[i] + int(unseen.argmin())
                if first_unseen[i] < end:  # the impact at the best position, the one before
                    threshold += int(self.listed_impact[first_unseen[i] - 1] * repeats[i])
            done = np.concatenate(scores)
            kth = int(np.partition(done, len(done) - k)[len(done) - k]) if len(done) >= k else 0
            if threshold < max(kth, floor) or (first_unseen == ends).all():
                break
        return np.concatenate(documents), np.concatenate(scores)


class Tops:
    """The best of each query so far, as ``(-score, no id, id)``."""

    def __init__(self, queries: Queries, k: int):
        self.queries, self.k = queries, k
        self.rows: list[list[tuple[int, bool, object]]] = [[] for _ in queries.terms]

    def take(self, shard: Shard, ids: list) -> None:
        for i, (terms, repeats) in enumerate(self.queries.terms):
            own = self.rows[i]
            floor = -own[-1][0] if len(own) == self.k else 1
            documents, scores = shard.best(terms, repeats, self.k, floor)
            good = scores >= floor
            if good.any():
                new = ((-s, ids[d] is None, ids[d]) for d, s in zip(documents[good].tolist(), scores[good].tolist(), strict=True))
                # a null id never meets another in a comparison of ids
                self.rows[i] = nsmallest(self.k, [*own, *new], key=lambda r: r if r[2] is not None else (r[0], r[1]))


def _counts(docs: DataFrame, queries) -> dict[int, int]:
    """Documents, words, and the documents that hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = queries.value.vocabulary
        held = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in rounds(batches, "text", SHARD):
            lengths, term, *_ = postings(encoded(batch.column("text")), vocabulary)
            held[: len(vocabulary)] += np.bincount(term, minlength=len(vocabulary))
            held[DOCUMENTS] += np.count_nonzero(lengths)
            held[WORDS] += lengths.sum()
        number = np.arange(len(held))
        number[[DOCUMENTS, WORDS]] = DOCUMENTS, WORDS
        yield pa.RecordBatch.from_arrays([pa.array(number[held > 0]), pa.array(held[held > 0])], ["term", "n"])

    found = docs.select("text").mapInArrow(run, "term long, n long")
    return {row.term: row.n for row in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item, rank, id, score``: the k best documents of every item, named as the id columns are."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    asked = items.select(F.col(item_column).alias("item"), F.col(item_text).alias("text"))
    item, name = asked.schema["item"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()
    done = []
    for block in blocks(asked, block_bytes):
        queries = docs.sparkSession.sparkContext.broadcast(Queries(block))
        counts = _counts(rows, queries)
        if DOCUMENTS in counts:
            found = _search(rows, queries, counts, k, f"number long, id {name}, score long")
            best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
            found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            names = docs.sparkSession.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"number long, item {item}")
            done.append(written(found.join(names, "number").select("item", "rank", "id", "score"), "search"))
        queries.destroy()
    if not done:
        done = [rows.sparkSession.createDataFrame([], f"item {item}, rank int, id {name}, score long")]
    return reduce(DataFrame.unionAll, done).withColumnsRenamed({"item": item_column, "id": id_column})


def _search(rows: DataFrame, queries, counts: dict[int, int], k: int, schema: str) -> DataFrame:
    documents, words = counts[DOCUMENTS], counts[WORDS]
    weights = np.zeros(len(queries.value.vocabulary), np.int64)
    for term, n in counts.items():
        if term >= 0:
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    given = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = queries.value
        tops, kind = Tops(own, k), None
        for batch in rounds(batches, "text", SHARD):
            kind = batch.schema.field("id").type
            shard = Shard(encoded(batch.column("text")), own.vocabulary, given.value, documents, words)
            tops.take(shard, batch.column("id").to_pylist())
        if kind is None:
            return
        out = [(i, name, -score) for i, found in enumerate(tops.rows) for score, _, name in found]
        columns = list(zip(*out, strict=True)) or [()] * 3
        kinds = (pa.int64(), kind, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["number", "id", "score"])

    return rows.mapInArrow(run, schema)
