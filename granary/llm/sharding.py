"""Shards of equal row counts whose mixture of sources is that of the whole.

Rows of each source are shuffled by a seeded hash and ranked; the rank divided by the source's size
is a row's place between 0 and 1. Ordered by that place, the sources are interleaved in
proportion everywhere, so cutting the order into equal runs gives every shard the same mixture.

No source, however large, is ranked in one task: hash ranges cut each source, and place ranges
cut the order, into about the square root of the row count; counts of the ranges give every
range its first rank, and rows are only numbered within a range. All steps are DataFrame
functions; texts are read once, and only ids, sizes and checksums are shuffled.

Defined cases: a null text has size 1 (no byte, plus 1) and a null checksum; a null source is a
source of its own; null ids are allowed. Rows that are equal in every respect are
interchangeable. More shards than rows leave some shards empty; an empty table gives no row.
Only the named columns are read, so other names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from granary.llm.common import written

SEED = "mixture"


def interleaved_shards(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text",
                       source_column: str = "source", seed: str = SEED) -> DataFrame:
    """``id, size, text_crc32, source, place, shard, slot``: shards differ by one row at most.

    ``place`` is the numerator of the fractional rank over twice the source's size; ``slot`` counts
    a shard's rows from 0 in the order of the interleaving.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_column).cast("string")))
    base = docs.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        (F.coalesce(F.octet_length(text_column), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_column).alias("text_crc32"),
        digest.alias("draw"),
    )
    base = written(base, "shard-rows")
    rows = base.count()
    ranges = max(1, math.isqrt(rows))
    first_bits = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    base = base.withColumn("cut", F.shiftright(first_bits * ranges, 32))

    counts = base.groupBy("source", "cut").agg(F.count("*").alias("n"))
    own = Window.partitionBy("source")
    offsets = counts.select(
        "source", "cut",
        F.coalesce(F.sum("n").over(own.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(own).alias("of_source"),
    )
    joined = base.alias("r").join(
        offsets.alias("o"), F.expr("r.source <=> o.source AND r.cut = o.cut"), "inner"
    ).select("r.*", "before", "of_source")
    order = ["draw", "id", "text_crc32", "size"]
    rank = F.col("before") + F.row_number().over(Window.partitionBy("source", "cut").orderBy(*order))
    ranked = joined.withColumn("place", 2 * rank - 1)
    ranked = written(ranked.select("id", "size", "text_crc32", "source", "draw", "place", "of_source"), "shard-ranks")

    # the fraction place / (2 * of_source), compared exactly in integers for the range and in digits for the order
    ranked = ranked.withColumn("cut", F.expr(f"place * {ranges}L div (2 * of_source)"))
    fraction = (F.col("place").cast("decimal(18,0)") / (2 * F.col("of_source")).cast("decimal(18,0)")).alias("fraction")
    sizes = ranked.groupBy("cut").agg(F.count("*").alias("n"))
    starts = sizes.select(
        "cut", F.coalesce(F.sum("n").over(Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    placed = ranked.join(starts, "cut").withColumn("fraction", fraction)
    ties = ["fraction", "draw", "source", "id", "text_crc32", "size"]
    position = F.col("before") + F.row_number().over(Window.partitionBy("cut").orderBy(*ties)) - 1
    total = max(1, rows)
    out = placed.withColumn("position", position).withColumn("shard", F.expr(f"CAST(position * {shards} div {total} AS INT)"))
    # the first position of shard k is the smallest p with p * shards >= k * rows
    return out.select(
        "id", "size", "text_crc32", "source", "place", "shard",
        F.expr(f"position - (shard * {total}L + {shards - 1}) div {shards}").alias("slot"),
    ).withColumnRenamed("id", id_column)
