"""Load modes: each takes the delivered rows and the target's rows and returns
the target's next state. Nothing is written here; see ``sources.store``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import is_true, replaced_day
from granary.functions.columns import as_column
from granary.operators.skew import keyed_join, rows_without_match, will_broadcast

BUCKET, SYSTEM, ETL_DATE = "bucket_id", "system_id", "etl_date"
LOAD_TYPES = ("full", "add", "merge", "update")


def with_audit(df: DataFrame, system_id: str, etl_date: str | Column) -> DataFrame:
    """Append the audit columns; ``etl_date`` is a fixed day or a column."""
    day = F.lit(etl_date) if isinstance(etl_date, str) else etl_date
    return df.withColumns(
        {BUCKET: F.uuid(), SYSTEM: F.lit(system_id), ETL_DATE: day.cast("string")}
    )


def load_full(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Replace everything; the target only lends its column order."""
    return src.select(*[f"`{name}`" for name in tgt.columns])


def load_add(
    src: DataFrame,
    tgt: DataFrame,
    day: str | Column,
    etl_date: str,
    def_etl_date: str | None = None,
) -> DataFrame:
    """Drop the target rows of the replaced day, then append all source rows."""
    gone = as_column(day) == F.lit(replaced_day(etl_date, def_etl_date))
    return tgt.where(~is_true(gone)).unionByName(src)


def load_update(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop target rows whose key was delivered, then append all source rows."""
    keys = list(keys)
    kept = keyed_join(tgt, src.select(*keys), keys, "left_anti")
    return kept.select(*tgt.columns).unionByName(src)


def load_merge(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], etl_date: str, day: str = ETL_DATE
) -> DataFrame:
    """Upsert that leaves newer target rows alone.

    A matched target row whose day is not after ``etl_date`` takes the source's
    non-key values and the new day and keeps its bucket and system id; a newer one
    stays as it is. Source rows without a match are added. Columns that only the source has
    are appended. A key delivered twice fails the query; rows with a NULL in their key match
    nothing and stay or are added as they are.

    The target is never re-keyed as a whole for a small delivery: it is streamed
    past the broadcast source once, and its key column once more to find which
    source rows are new. For a large one both sides are shuffled once, in one full join.
    """
    keys = list(keys)
    given = [name for name in src.columns if name not in keys]
    columns = [*tgt.columns, *(name for name in given if name not in tgt.columns)]
    known = reduce(and_, [F.col(f"`{name}`").isNotNull() for name in keys])
    values = F.struct(F.lit(True).alias("_given"), *[f"`{name}`" for name in given])
    twice = F.raise_error(F.concat(F.lit("merge key delivered twice: "), F.to_json(F.struct(*keys))))
    new = (
        src.where(known)
        .groupBy(*keys)
        .agg(F.count("*").alias("_count"), F.first(values).alias("_new"))
        .select(*keys, F.when(F.col("_count") > 1, twice).otherwise(F.col("_new")).alias("_new"))
    )
    held = tgt.where(known).withColumn("_held", F.lit(True))
    small = will_broadcast(src)
    joined = held.join(new, keys, "left" if small else "full_outer")
    added = F.col("_held").isNull()
    fresh = is_true(F.col("_new").isNotNull() & (F.col(day) <= F.lit(etl_date)))

    def merged(name: str) -> Column:
        old = F.col(f"`{name}`") if name in tgt.columns else F.lit(None)
        delivered = F.col("_new")[name] if name in given else F.lit(None)
        if name in keys:
            return F.col(f"`{name}`")
        if name == day:
            return F.when(added, delivered).when(fresh, F.lit(etl_date)).otherwise(old).alias(name)
        taken = added if name in (BUCKET, SYSTEM) or name not in given else added | fresh
        return F.when(taken, delivered).otherwise(old).alias(name)

    out = joined.select(*[merged(name) for name in columns])
    if small:
        rest = rows_without_match(new, held, keys)
        rest = rest.select(*keys, *[F.col("_new")[name].alias(name) for name in given])
        out = out.unionByName(rest, allowMissingColumns=True)
    out = out.unionByName(tgt.where(~known), allowMissingColumns=True)
    return out.unionByName(src.where(~known), allowMissingColumns=True).select(*columns)


def load_initial(src: DataFrame, registered: bool, exists: bool) -> DataFrame:
    """First load of a table: the target must be absent."""
    if exists:
        state = "registered already" if registered else "not registered but exists"
        raise ValueError(f"initial load refused: target is {state}")
    return src


def apply_load(
    src: DataFrame,
    tgt: DataFrame | None,
    load_type: str,
    etl_date: str,
    keys: Sequence[str] = (),
    day: str | Column | None = None,
    def_etl_date: str | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """Next state of a target under one of the four load types.

    ``day`` is the user's day expression; without one an ``add`` load goes by
    the audit day.
    """
    if load_type not in LOAD_TYPES:
        raise ValueError(f"unknown load type {load_type!r}")
    if load_type in ("merge", "update") and not keys:
        raise ValueError(f"load type {load_type} needs a key")
    if tgt is None:
        return load_initial(src, registered=False, exists=False)
    if load_type == "merge":
        if partitioned:
            raise ValueError("merge does not work on partitioned targets, use update")
        return load_merge(src, tgt, keys, etl_date)
    if load_type == "update":
        return load_update(src, tgt, keys)
    if load_type == "add":
        return load_add(src, tgt, ETL_DATE if day is None else day, etl_date, def_etl_date)
    return load_full(src, tgt)


def reconcile_counts(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    load_type: str | Column = "full",
) -> DataFrame:
    """Declared against loaded rows per table.

    Both sides hold one row per key, with ``expected`` and ``loaded``. A difference
    fails the load, except for merge where it is a warning.
    """
    mode = F.lit(load_type) if isinstance(load_type, str) else load_type
    loaded = F.coalesce(F.col("loaded"), F.lit(0)).cast("long")
    joined = expected.join(actual, list(keys), "left")
    return joined.withColumns(
        {
            "loaded": loaded,
            "diff": loaded - F.col("expected"),
            "status": F.when(loaded == F.col("expected"), "ok")
            .when(mode == "merge", "warning")
            .otherwise("failed"),
        }
    )
