"""Change detection, export and import as row operators.

A manifest is a small DataFrame with one row per partition or predicate:
``table_name, partition_name, action, predicate, schema_json, row_count`` and, for tables with
partition columns, their values as JSON in ``partition_values``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import day_of, is_true, join_fields
from granary.operators.skew import fetched, join_on, listed_join

CHANGED, EMPTY, UNCHANGED, MISSING = "changed", "empty", "unchanged", "missing"

# Result codes of change detection.
CHANGE_CODES = {MISSING: -3, EMPTY: -2, CHANGED: -1, UNCHANGED: 0}

MANIFEST_COLUMNS = (
    "table_name",
    "partition_name",
    "action",
    "predicate",
    "schema_json",
    "row_count",
)


def detect_changes(
    known: DataFrame,
    listing: DataFrame,
    etl_date: str,
    keys: Sequence[str] = ("partition_name",),
    present: DataFrame | None = None,
) -> DataFrame:
    """State of every known partition by its files.

    ``listing`` has ``length`` and ``modified`` per file. ``changed``: a file was modified on
    or after the day, which wins over ``empty``: no files or no bytes. A partition whose
    directory is gone is ``missing``; without ``present``, the directories that exist,
    that means one with no file listed.
    """
    keys = list(keys)
    files = listing.groupBy(*keys).agg(
        F.max("modified").alias("modified"),
        F.sum("length").alias("bytes"),
        F.count("*").alias("files"),
    )
    joined = join_on(known.select(*keys).distinct(), files, keys, "left", null_safe=True)
    here = F.col("files").isNotNull()
    if present is not None:
        seen = present.select(*keys).distinct().withColumn("_present", F.lit(True))
        joined = join_on(joined, seen, keys, "left", null_safe=True)
        here = here | is_true(F.col("_present"))
    state = (
        F.when(~here, MISSING)
        .when(is_true(day_of("modified") >= F.lit(etl_date)), CHANGED)
        .when(F.coalesce("bytes", F.lit(0)) == 0, EMPTY)
        .otherwise(UNCHANGED)
    )
    code = F.when(state == MISSING, CHANGE_CODES[MISSING])
    for name in (EMPTY, CHANGED, UNCHANGED):
        code = code.when(state == name, CHANGE_CODES[name])
    return joined.select(
        *keys,
        state.alias("state"),
        code.alias("code"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )


def partition_changes(
    inventory: DataFrame, listing: DataFrame, etl_date: str, keys: Sequence[str]
) -> DataFrame:
    """State of every partition that an earlier export told the far side of or that has files today.

    One of the inventory without a file today, dropped or emptied, is ``missing``.
    """
    known = inventory.select(*keys).unionByName(listing.select(*keys))
    return detect_changes(known, listing, etl_date, keys)


def export_all(df: DataFrame) -> DataFrame:
    """Full unload: every row; the importing side truncates first."""
    return df


def export_auto(
    df: DataFrame, changes: DataFrame, keys: Sequence[str] = ("partition_name",)
) -> DataFrame:
    """Rows of the changed partitions only.

    For a directory-partitioned table the semi join on partition columns becomes
    dynamic partition pruning, so unchanged partitions are not read.
    """
    changed = changes.where(F.col("state") == CHANGED)
    return listed_join(df, changed, keys, "left_semi").select(*df.columns)


def fill_predicate(predicate: str, etl_date: str) -> str:
    """A user predicate with its day filled in."""
    return predicate.replace("${etl_date}", etl_date)


def export_sql(df: DataFrame, predicate: str, etl_date: str) -> DataFrame:
    """Rows a user predicate selects."""
    return df.where(fill_predicate(predicate, etl_date))


def export_rows(
    df: DataFrame, mode: str, etl_date: str, day: str = "etl_date", sep: str = "#&",
    compat: bool = False,
) -> DataFrame:
    """Rows as joined text, all of them (``all``) or those of one day (any other mode)."""
    chosen = df if mode == "all" else df.where(F.col(day) == F.lit(etl_date))
    return chosen.select(join_fields(df, sep, compat).alias("value"))


def manifest(
    counts: DataFrame, table: str, action: str | Column, predicate: Column, schema_json: str,
    name: Column | None = None, values: Column | None = None,
) -> DataFrame:
    """Manifest rows from ``partition_name, row_count``, or from other columns that give the name."""
    return counts.select(
        F.lit(table).alias("table_name"),
        (F.col("partition_name") if name is None else name).alias("partition_name"),
        *([] if values is None else [values.alias("partition_values")]),
        (F.lit(action) if isinstance(action, str) else action).alias("action"),
        predicate.alias("predicate"),
        F.lit(schema_json).alias("schema_json"),
        F.col("row_count").cast("long").alias("row_count"),
    )


def plan_export(
    changes: DataFrame, counts: DataFrame, predicates: DataFrame, table: str, schema_json: str,
    keys: Sequence[str] = ("partition_name",), name: Column | None = None, values: Column | None = None,
    missing: str = MISSING,
) -> DataFrame:
    """Manifest of an automatic export.

    Changed partitions are replaced on the far side, empty ones truncated there, missing
    ones reported, or what ``missing`` says; unchanged ones do not appear. ``counts`` has exported rows and
    ``predicates`` the row predicate per partition, by ``keys`` in which NULL is a value.
    """
    action = (
        F.when(F.col("state") == CHANGED, "replace")
        .when(F.col("state") == EMPTY, "truncate")
        .otherwise(missing)
    )
    rows = join_on(changes.where(F.col("state") != UNCHANGED), counts, keys, "left", null_safe=True)
    rows = join_on(rows, predicates, keys, "left", null_safe=True).fillna(0, ["row_count"])
    return manifest(rows, table, action, F.col("predicate"), schema_json, name, values)


def import_partition(
    staged: DataFrame, tgt: DataFrame, actions: DataFrame,
    keys: Sequence[str] = ("partition_name",),
) -> DataFrame:
    """Clear the partitions the manifest lists, then add the staged rows.

    Rows staged for a partition that the manifest does not replace are not taken.
    """
    listed = fetched(actions.where(F.col("action").isin("replace", "truncate")), [*keys, "action"])
    replaced = listed.where(F.col("action") == "replace")
    kept = listed_join(tgt, listed, keys, "left_anti").select(*tgt.columns)
    new = listed_join(staged, replaced, keys, "left_semi").select(*tgt.columns)
    return kept.unionByName(new)


def import_sql(staged: DataFrame, tgt: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Delete target rows any manifest predicate selects, then add the staged rows.

    A row for which a predicate is NULL is kept, as DELETE does.
    """
    kept = tgt
    for predicate in predicates:
        kept = kept.where(~is_true(predicate))
    return kept.unionByName(staged.select(*tgt.columns))
