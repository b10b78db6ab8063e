"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints of 64 bits are cut into three segments. Two that differ in at most ``radius`` bits
differ in at most ``radius // 3`` of one of the segments, so every distinct fingerprint is put
into a table under its three segments and looked up in those tables under every value of the small
Hamming ball around them. A bucket's fingerprints are compared in full; only the links
of a spanning forest leave it, as many as it has members at most, and never all pairs. Components of
those links are found by hooking to the smallest neighbour, with the links of every round written
to the shared folder.

Equal fingerprints are one node, so thousands of copies cost one row. A bucket is an array of 8-byte
integers: hot buckets stay small, and a search in one drops each member it has reached.

Defined cases: a null text and one without a word have fingerprint zero, which links like any
other. Fewer words than a shingle make one shingle of them all. A null id is carried along; it
is no component's name unless the whole component has no other, and then that is null.
Repeated rows and ties share a component. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from granary.llm.common import SPACE_TABLE, encoded, rounds, written

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Low bit and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """A bit is 1 where more than half of the shingles' hashes have it."""
    words = text.translate(SPACE_TABLE).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE) -> DataFrame:
    """``id, fp``: the fingerprint as a signed long with the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rounds(batches, "text"):
            found = np.array([fingerprint(t, size) for t in encoded(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], ["id", "fp"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fp long")


def ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(width), n)]


def forest(members: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that connect what lies within ``radius`` bits, directly or over others.

    Each member is compared once with those that no search has reached yet.
    """
    left, right, rest = [], [], members
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = np.bitwise_count(rest ^ one) <= radius
            if near.any():
                reached = rest[near]
                left += [one] * len(reached)
                right += reached.tolist()
                queue += reached.tolist()
                rest = rest[~near]
    return left, right


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all within ``radius`` bits."""
    def keys(part: int, reach: int) -> list[Column]:
        low, width = SEGMENTS[part]
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        return [F.lit(part << 32) + value.bitwiseXOR(F.lit(mask)) for mask in ball(width, reach)]

    parts = range(len(SEGMENTS))
    homes = distinct.select(F.explode(F.array(*(k for i in parts for k in keys(i, 0)))).alias("key")).distinct()
    probes = distinct.select("fp", F.explode(F.array(*(k for i in parts for k in keys(i, radius // len(SEGMENTS))))).alias("key"))
    wanted = probes.join(homes, "key", "left_semi").select("key", "fp")
    sorted_rows = wanted.repartition("key").sortWithinPartitions("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out(members: list[np.ndarray]) -> list[tuple[list[int], list[int]]]:
            found = np.unique(np.concatenate(members).view(np.uint64))
            return [forest(found, radius)] if len(found) > 1 else []

        for batch in batches:
            keys, values = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero(np.diff(keys)) + 1
            done = []
            for part_keys, part in zip(np.split(keys, cuts), np.split(values, cuts), strict=True):
                if not len(part):
                    continue
                if key is not None and part_keys[0] != key:
                    if len(held) > 1 or len(held[0]) > 1:
                        done += out(held)
                    held = []
                key = part_keys[0]
                held.append(part)
            yield _pairs(done)
        if held:
            yield _pairs(out(held))

    found = sorted_rows.mapInArrow(run, "a long, b long")
    return found.distinct()


def _pairs(found: list[tuple[list[int], list[int]]]) -> pa.RecordBatch:
    sides = [np.array([x for pair in found for x in pair[i]], np.uint64).view(np.int64) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(s) for s in sides], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node reachable.

    Large-star and small-star rounds in turn: each halves what is left of long paths, and every
    round's links are written to the shared folder, where a lost executor's tasks find them.
    """
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    current = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    while True:
        near = both(current)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(down, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").unionAll(
            joined.select("a", F.col("low").alias("b"))
        ).distinct()
        following = written(small, "links")
        if _alike(current, following):
            return following.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                following.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        current = following


def _alike(one: DataFrame, other: DataFrame) -> bool:
    """Whether two sets of links are the same: their counts and sums of hashes."""
    seal = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
    return seal(one) == seal(other)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """``id, fingerprint, component_id`` of every document: its component's smallest id."""
    marked = written(fingerprints(docs, id_column, text_column), "fingerprints")
    groups = marked.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(links(marked.select("fp").distinct(), radius))
    named = groups.join(roots, groups.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of_fp = named.join(lowest, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
