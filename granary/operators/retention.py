"""Which entries have outlived their retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.skew import keyed_join, with_run

PARTS = 64
RANKED = 1000  # fixed value: the engine's own limit for ranks below a shuffle
KEEP = 7  # fixed value: entries kept per directory unless configured


def expired_entries(
    listing: DataFrame,
    keep_n: int = KEEP,
    root: str = "root",
    path: str = "path",
    modified: str = "modified",
) -> DataFrame:
    """Entries of each root beyond its newest ``keep_n``; equal times go by path.

    Up to ``RANKED`` entries of a root, the engine keeps ranks below the shuffle: entries are ranked within parts of
    their root, and of each part only the newest are ranked within the root. Beyond that the listing is cut into
    runs in this order; their counts say which run of a root holds the last entry kept, and only that run is ranked. Either
    way a root with most of the files is worked on by many tasks.
    """
    if keep_n < 1:
        return listing
    if keep_n > RANKED:
        return _expired_by_counts(listing, keep_n, root, path, modified)
    order = [F.col(modified).desc(), F.col(path)]
    part = F.pmod(F.xxhash64(path, modified), F.lit(PARTS)).alias("_part")
    newest = Window.partitionBy(root).orderBy(*order)
    last_kept = (
        listing.select(root, path, modified, part)
        .withColumn("_rank", F.row_number().over(Window.partitionBy(root, "_part").orderBy(*order)))
        .where(F.col("_rank") <= keep_n)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == keep_n)
        .select(root, F.col(modified).alias("_time"), F.col(path).alias("_path"))
    )
    older = (F.col(modified) < F.col("_time")) | (
        (F.col(modified) == F.col("_time")) & (F.col(path) > F.col("_path"))
    )
    joined = keyed_join(listing, last_kept, [root], "inner", null_safe=True)
    return joined.where(older).select(*listing.columns)


def _expired_by_counts(listing: DataFrame, keep_n: int, root: str, path: str, modified: str) -> DataFrame:
    """The same by distributed selection, for any ``keep_n``; entries without a time are the oldest."""
    age = -F.unix_micros(F.col(modified).cast("timestamp"))
    order = [F.col(modified).isNull(), age, F.col(path)]
    placed = with_run(listing, [F.col(root), *order])
    counts = placed.groupBy(root, "_run").agg(F.count("*").alias("_n"))
    # a root has at most as many rows here as there are runs
    upto = F.sum("_n").over(Window.partitionBy(root).orderBy("_run"))
    counts = counts.withColumn("_before", upto - F.col("_n")).where(F.col("_before") + F.col("_n") > keep_n)
    kept = F.greatest(F.lit(keep_n) - F.col("_before"), F.lit(0)).alias("_kept")
    joined = keyed_join(placed, counts.select(root, "_run", kept), [root, "_run"], "inner", null_safe=True)
    rank = F.row_number().over(Window.partitionBy(root, "_run").orderBy(*order))
    cut = joined.where("_kept > 0").withColumn("_rank", rank).where("_rank > _kept")
    return joined.where("_kept = 0").select(*listing.columns).unionAll(cut.select(*listing.columns))


def kept_days(df: DataFrame, keep_n: int, day: str = "etl_date") -> DataFrame:
    """The newest ``keep_n`` days of a table, one row each."""
    return df.select(day).where(F.col(day).isNotNull()).distinct().orderBy(
        F.col(day).desc()
    ).limit(keep_n)


def apply_retention(df: DataFrame, keep_n: int = KEEP, day: str = "etl_date") -> DataFrame:
    """Rows of the newest ``keep_n`` days.

    The days kept are ``keep_n`` rows, so they are broadcast; on a table partitioned by day
    they prune its partitions.
    """
    return df.join(F.broadcast(kept_days(df, keep_n, day)), day, "left_semi").select(*df.columns)
