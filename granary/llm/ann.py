"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample: a node splits its sample at the median of its projection on the
difference of two of its members. Every vector is indexed: it goes down each tree to a leaf. A query goes
down all trees at once, through one priority queue of the branches not taken, ordered by the sum of squared
distances from the planes on their wrong side, until it has reached the share ``probed`` of all leaves,
and ``LEAST`` of them at least. Within each leaf the
candidates are ranked by exact cosines in double precision, in blocks, and only a query's
best few of all its leaves in a task leave that task.

Leaves are dealt by tree and leaf and, where many vectors fall into one, by a salt, so no task holds
more than about ``LEAF_ROWS`` of a leaf at a time. Of equal vectors only the ``k + 1`` smallest ids
are indexed, as others cannot be among the nearest ``k``; so common vectors do not fill a leaf.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows without an id; of vectors of several lengths only those as long as the query are
compared. Equal scores go to the smaller id. Rows of one id and one vector count once; those of one id and several
vectors are candidates each, and as queries share one list of the nearest to any of them. With no more than k
candidates all are returned; an empty table gives no row. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.llm.common import written

#: The bound of the sample that the trees are fitted on.
SAMPLE = 16_384
TREES, LEAF, PROBED, LEAST, NEAREST = 12, 256, 0.08, 48, 5
LEAF_ROWS = 4096
SLACK = 1e-9
#: Candidates that a task holds before it cuts them down to each query's best.
HELD = 400_000


class Tree:
    """Splitting planes in arrays; a negative child is a leaf."""

    def __init__(self, sample: np.ndarray, leaf: int, seed: int):
        random = np.random.default_rng(seed)
        self.normals: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(sample, leaf, random)
        width = sample.shape[1]
        self.normals = np.array(self.normals, np.float32).reshape(-1, width)
        self.cuts, self.children = np.array(self.cuts), np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, rows: np.ndarray, leaf: int, random: np.random.Generator) -> int:
        if len(rows) > leaf:
            for _ in range(3):
                one, other = rows[random.choice(len(rows), 2, replace=False)]
                normal = one - other
                size = np.linalg.norm(normal)
                if size == 0:
                    continue
                normal = normal / size
                value = rows @ normal
                cut = float(np.median(value))
                right = value > cut
                if 0 < right.sum() < len(rows):
                    number = len(self.normals)
                    self.normals.append(normal)
                    self.cuts.append(cut)
                    self.children.append([0, 0])
                    self.children[number] = [self._grow(rows[~right], leaf, random), self._grow(rows[right], leaf, random)]
                    return number
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        node = np.full(len(rows), self.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            right = np.einsum("ij,ij->i", rows[inner], self.normals[at]) > self.cuts[at]
            node[inner] = self.children[at, right.astype(int)]
        return -node


class Forest:
    def __init__(self, sample: np.ndarray, leaf: int, trees: int, seed: int = 1):
        self.width = sample.shape[1]
        self.trees = [Tree(sample, leaf, seed + i) for i in range(trees)]

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row (first axis) in every tree."""
        return np.stack([t.leaf_of(rows) for t in self.trees], 1) if len(rows) else np.zeros((0, len(self.trees)), np.int64)

    def probe(self, query: np.ndarray, probes: int) -> list[tuple[int, int]]:
        """The first ``probes`` leaves, as tree and leaf, in the order of the shared queue."""
        margins = [(t.normals @ query - t.cuts).tolist() for t in self.trees]
        children = [t.children.tolist() for t in self.trees]
        queue = [(0.0, i, t.root) for i, t in enumerate(self.trees)]
        out = []
        while queue and len(out) < probes:
            far, tree, node = heapq.heappop(queue)
            while node >= 0:
                margin = margins[tree][node]
                near, other = children[tree][node][margin > 0], children[tree][node][margin <= 0]
                heapq.heappush(queue, (far + margin * margin, tree, other))
                node = near
            out.append((tree, -node))
        return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width) if len(column) else np.zeros((0, width))


def foremost(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of query, id and score the k best different ones of each query."""
    query, ids, score = (np.concatenate([f[i] for f in found]) for i in range(3))
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    other = np.ones(len(query), bool)
    other[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    query, ids, score = query[other], ids[other], score[other]
    begins = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
    place = np.arange(len(query)) - np.repeat(begins, np.diff(np.append(begins, len(query))))
    kept = place < k
    return query[kept], ids[kept], score[kept]


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vec`` of the vectors that take part; floats stay floats, which are the same numbers as doubles."""
    single = vectors.schema[vector_column].dataType.simpleString() == "array<float>"
    vec = F.col(vector_column) if single else F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return rows.where(F.col("id").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))


def nearest(vectors: DataFrame, queries: Column, id_column: str = "vec_id", vector_column: str = "embedding",
            k: int = NEAREST, trees: int = TREES, leaf: int = LEAF, probed: float = PROBED, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, id, score`` of each query's nearest found; ``queries`` is a condition on ``id``."""
    good = usable(vectors, id_column, vector_column)
    widths = [r.n for r in good.select(F.size("vec").alias("n")).distinct().orderBy("n").collect()]
    found = [_of_width(written(good.where(F.size("vec") == n), "vectors"), n, queries, k, trees, leaf, probed, sample) for n in widths]
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    out = found[0] if found else empty
    for other in found[1:]:
        out = out.unionAll(other)
    return out


def _of_width(rows: DataFrame, width: int, queries: Column, k: int, trees: int, leaf: int, probed: float, sample: int) -> DataFrame:
    spark = rows.sparkSession
    # copies of a vector beyond the k + 1 smallest ids, one of which may be the query's own, are never among the nearest
    alike, same = Window.partitionBy("vec").orderBy("id"), Window.partitionBy("vec", "id").orderBy("id")
    indexed = rows.withColumn("copy", F.dense_rank().over(alike)).where(F.col("copy") <= k + 1)
    indexed = indexed.withColumn("copy", F.row_number().over(same)).where("copy = 1").drop("copy")
    indexed = written(indexed, "indexed")
    bound = max(64, min(sample, (64 << 20) // (8 * width)))
    drawn = indexed.orderBy(F.xxhash64(F.lit("forest"), "id", "vec"), "id").limit(bound).select("vec").toArrow()
    fitted = matrix(drawn.column("vec").combine_chunks(), width)
    fitted = fitted / np.linalg.norm(fitted, axis=1, keepdims=True)
    total = indexed.count()
    # leaves of about the same number of vectors at every size, as far as the sample can tell them apart
    share = max(2, round(leaf * len(fitted) / max(1, total)))
    grown = Forest(fitted, share, trees)
    probes = max(LEAST, math.ceil(probed * sum(t.leaves for t in grown.trees)))
    forest = spark.sparkContext.broadcast(grown)
    # vectors in a leaf and so its salts: the sample's leaves are even, a leaf has about total / leaves vectors
    salts = max(1, math.ceil(total * share / max(1, len(fitted)) / LEAF_ROWS))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                values = matrix(part.column("vec"), width)
                unit = values / np.linalg.norm(values, axis=1, keepdims=True)
                leaves = forest.value.leaves(unit)
                n, m = leaves.shape
                where = np.repeat(np.arange(n), m)
                cell = (np.tile(np.arange(m), n) << 40 | leaves.ravel()).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), part.column("id").take(pa.array(where)), part.column("vec").take(pa.array(where))], ["cell", "id", "vec"]
                )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                values = matrix(part.column("vec"), width)
                unit = values / np.linalg.norm(values, axis=1, keepdims=True)
                cells = [forest.value.probe(u, probes) for u in unit]
                where = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
                cell = np.array([t << 40 | x for c in cells for t, x in c], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), part.column("id").take(pa.array(where)), part.column("vec").take(pa.array(where))], ["cell", "id", "vec"]
                )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell, queries first: a query's best candidates of all the task's blocks."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        cell, asked, asked_vec, block, block_vec = None, [], [], [], []

        def best() -> None:
            nonlocal size
            if not asked or not block:
                return
            names, ids = np.array(asked), np.array(block)
            q, v = np.stack(asked_vec), np.stack(block_vec)
            q_size, v_size = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
            for at in range(0, len(q), 256):
                rough = (q[at : at + 256] / q_size[at : at + 256, None]) @ (v / v_size[:, None]).T
                rough[names[at : at + 256, None] == ids[None, :]] = -2
                count = min(k, rough.shape[1])
                least = np.partition(rough, -count, axis=1)[:, -count] - SLACK
                row, column = np.nonzero((rough >= np.maximum(least, -1.5)[:, None]))
                row += at
                # summed in one fixed order, so that equal vectors have equal scores in every block
                score = (q[row] * v[column]).sum(1) / (q_size[row] * v_size[column])
                held.append((names[row], ids[column], score))
                size += len(score)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], ["query_id", "id", "score"])

        for batch in batches:
            values = matrix(batch.column("vec"), width)
            for key, is_row, name, vec in zip(*(batch.column(c).to_pylist() for c in ("cell", "indexed", "id")), values, strict=True):
                if key != cell:
                    best()
                    if size > HELD:
                        held[:] = [foremost(held, k)]
                        size = len(held[0][0])
                        if size > HELD // 2:
                            yield out()
                            size = 0
                    cell, asked, asked_vec, block, block_vec = key, [], [], [], []
                if not is_row:
                    asked.append(name)
                    asked_vec.append(vec)
                elif asked:
                    block.append(name)
                    block_vec.append(vec)
                    if len(block) >= LEAF_ROWS:
                        best()
                        block, block_vec = [], []
        best()
        if held:
            held[:] = [foremost(held, k)]
            yield out()

    kind = f"cell long, id long, vec {rows.schema['vec'].dataType.simpleString()}"
    salt = F.pmod(F.xxhash64("id", "vec"), F.lit(salts)).cast("int")
    homes = indexed.mapInArrow(home, kind).withColumn("indexed", F.lit(True)).withColumn("salt", salt)
    asked = rows.where(queries).mapInArrow(probe, kind).withColumn("indexed", F.lit(False))
    asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = homes.unionByName(asked).repartition("cell", "salt").sortWithinPartitions("cell", "salt", "indexed")
    # a salt is part of the cell from here on
    both = both.withColumn("cell", F.col("cell") * salts + F.col("salt")).select("cell", "indexed", "id", "vec")
    candidates = both.mapInArrow(rank, "query_id long, id long, score double")
    # copies found in several trees have one score; rows that share an id are told apart by it
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = candidates.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
