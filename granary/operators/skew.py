"""Joins and look-ahead that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Heavy keys are looked for with one frequent-items sketch per slice of the key
# hash: a map task sends at most SLICES * TRACKED counters, whatever the data size.
SLICES = 64
TRACKED = 1000
TOP = 200

# A key is heavy when it holds this share of the rows, and at least MIN_ROWS.
SHARE = 1e-4
MIN_ROWS = 1_000_000

LIST_ROWS = 20_000

# Runs of an ordered table: the most, the sampled rows for each, and up to how many ends are compared in nested conditions.
MAX_SPLITS = 4096
SAMPLED = 20
FEW_CUTS = 64


def will_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate lets it broadcast this side unasked."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """One long per key, equal for keys that join."""

    def part(name: str) -> Column:
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            return column + F.lit(0.0)  # -0.0 joins with 0.0
        return column

    return F.xxhash64(*[part(name) for name in keys])


def heavy_keys(
    df: DataFrame, keys: Sequence[str], share: float = SHARE, min_rows: int = MIN_ROWS
) -> dict[int, int]:
    """Hashes of heavy keys with the number of parts each should be cut into.

    The answer is approximate and only ever steers the plan: a key wrongly
    left out, or wrongly named, costs time and never changes a result.
    """
    slices = (
        df.select(key_hash(df, keys).alias("h"))
        .groupBy(F.pmod("h", F.lit(SLICES)).alias("slice"))
        .agg(F.expr(f"approx_top_k(h, {TOP}, {TRACKED})").alias("top"), F.count("*").alias("n"))
        .collect()
    )
    floor = max(min_rows, share * sum(row.n for row in slices))
    return {
        item["item"]: int(-(-item["count"] // floor))
        for row in slices
        for item in row.top
        if item["count"] >= floor
    }


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool
) -> DataFrame:
    """Join on columns of the same names; ``null_safe`` lets NULL match NULL."""
    keys = list(keys)
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in keys})
    same = [F.col(f"`{name}`").eqNullSafe(F.col(f"`_right_{name}`")) for name in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{name}" for name in keys])


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    share: float = SHARE,
    min_rows: int = MIN_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join where ``left`` may be skewed.

    A semi or anti join is a plain one: both its shuffles are the join's own, so a hot left
    key is split at run time. For other joins ``right`` must have at most one row per key.
    A small right side is broadcast by the planner and nothing is shuffled. Otherwise the rows of heavy left keys meet the few right rows they need in a
    broadcast join (one right row per heavy key, so its size is bounded) and
    only the rest is shuffled. NULL keys hash like any other and are split off
    too once they are heavy.
    """
    keys = list(keys)
    same_types(left, right, keys)
    if how in ("left_semi", "left_anti") or will_broadcast(right):
        return join_on(left, right, keys, how, null_safe)
    heavy = list(heavy_keys(left, keys, share, min_rows))
    if not heavy:
        return join_on(left, right, keys, how, null_safe)
    in_left = key_hash(left, keys).isin(heavy)
    in_right = key_hash(right, keys).isin(heavy)
    rest = join_on(left.where(~in_left), right.where(~in_right), keys, how, null_safe)
    few = F.broadcast(right.where(in_right))
    hot = join_on(left.where(in_left), few, keys, how, null_safe)
    return rest.unionByName(hot)


def same_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    for name in keys:
        if left.schema[name].dataType != right.schema[name].dataType:
            raise TypeError(f"join key {name} has different types on the two sides")


def is_local(df: DataFrame) -> bool:
    """Whether the rows are in the plan itself, so that taking them starts no job."""
    return df._jdf.queryExecution().optimizedPlan().getClass().getSimpleName() == "LocalRelation"


def fetched(listed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A list's distinct rows, taken out of their query once, so that several joins can use them.

    A list of more than ``LIST_ROWS`` stays a query.
    """
    entries = listed.select(*columns)
    if is_local(entries):
        return entries
    rows = entries.distinct().limit(LIST_ROWS + 1).toArrow()
    if rows.num_rows > LIST_ROWS:
        return entries
    # rows from an Arrow table are in the plan; from a list of tuples they are a query that the planner takes for a large one
    return listed.sparkSession.createDataFrame(rows, entries.schema)


def listed_join(
    left: DataFrame, listed: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """Semi or anti join with a list of partitions or the like; NULL matches NULL.

    The planner's estimate for such a list is far too high, as it comes from counting
    files or rows. So up to ``LIST_ROWS`` entries are fetched and broadcast; a longer list is
    joined as any other side.
    """
    same_types(left, listed, keys)
    entries = fetched(listed, keys)
    if is_local(entries):
        return join_on(left, F.broadcast(entries.distinct()), keys, how, null_safe=True)
    return keyed_join(left, entries.distinct(), keys, how, null_safe=True)


def rows_without_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``.

    When ``df`` is small and ``other`` is not, ``other`` is first cut down to the
    keys of ``df`` by a broadcast semi join, so its rows are never shuffled.
    """
    keys = list(keys)
    wanted = df.select(*keys).distinct()
    known = other.select(*keys)
    if will_broadcast(wanted) and not will_broadcast(known):
        # at most the keys of df, which are within the broadcast limit
        found = known.join(F.broadcast(wanted), keys, "left_semi").distinct()
        return df.join(F.broadcast(found), keys, "left_anti")
    return keyed_join(df, known, keys, "left_anti")


def with_run(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Add ``_run``: the number of the run a row lies in when all rows stand in this order, nulls first.

    The runs are about equally long, as their ends come from ``SAMPLED`` rows for each, those of the
    smallest hashes. They are fetched, so a row's run is the same wherever it is computed again, and only the balance
    depends on the sample. Rows that are equal in ``order`` share a run.
    """
    spark = df.sparkSession
    parts = min(MAX_SPLITS, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [c.alias(f"_{i}") for i, c in enumerate(order)]
    kinds = [f.dataType for f in df.select(*fields).schema]
    # an instant's text is not unique, its number is
    fields = [F.unix_micros(c).alias(f"_{i}") if isinstance(k, T.TimestampType) else c.alias(f"_{i}")
              for i, (c, k) in enumerate(zip(order, kinds))]
    keys = df.select(*fields)
    kinds = [f.dataType for f in keys.schema]
    chosen = keys.orderBy(F.xxhash64(*keys.columns), *keys.columns).limit(SAMPLED * parts).orderBy(*keys.columns)
    rows = [tuple(row) for row in chosen.select(*[F.col(c).cast("string") for c in keys.columns]).collect()]
    ends = list(dict.fromkeys(rows[SAMPLED::SAMPLED]))
    here = F.struct(*fields)
    cuts = [F.struct(*[F.lit(v).cast(k).alias(f"_{i}") for i, (v, k) in enumerate(zip(end, kinds))]) for end in ends]

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(here < cuts[mid], search(lo, mid)).otherwise(search(mid + 1, hi))

    if len(cuts) <= FEW_CUTS:
        return df.withColumn("_run", search(0, len(cuts)))
    listed, steps = F.array(*cuts), [1 << i for i in reversed(range(len(cuts).bit_length()))]
    passed = F.aggregate(
        F.array(*[F.lit(step) for step in steps]), F.lit(0),
        lambda at, step: F.when(F.try_element_at(listed, at + step) <= here, at + step).otherwise(at),
    )
    return df.withColumn("_run", passed)


def next_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    parts: int | None = None,
) -> DataFrame:
    """Add ``next_<column>`` from the following row of the same key.

    All rows are cut into runs by key, order and tie, so a key of most rows is spread, also where they share one
    time. The last row of a key in a run takes the first row of the run behind it, if that is the key's.
    """
    keys, order, columns = list(keys), list(order), list(columns)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    follower = F.struct(*[F.col(f"`{name}`") for name in columns])
    key, place = (F.struct(*[F.col(f"`{name}`") for name in names]) for names in (keys, [*keys, *order]))
    placed = with_run(df, [F.col(f"`{name}`") for name in (*keys, *order)], parts)
    inside = placed.withColumn("_next", F.lead(follower).over(Window.partitionBy("_run", *keys).orderBy(*order)))
    # one row for each run, handed to the run before it
    firsts = placed.groupBy("_run").agg(F.min_by(F.struct(key.alias("key"), follower.alias("row")), place).alias("_first"))
    before = F.coalesce(F.lag("_run").over(Window.orderBy("_run")), F.lit(-1))
    firsts = firsts.select(before.alias("_run"), "_first")
    joined = inside.join(F.broadcast(firsts), "_run", "left")
    handed = F.when(F.col("_first")["key"].eqNullSafe(key), F.col("_first")["row"])
    found = joined.withColumn("_next", F.coalesce("_next", handed))
    return found.select(*df.columns, *[F.col("_next")[name].alias(f"next_{name}") for name in columns])
