"""Table exchange between two warehouses: export to a bundle, import from it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import is_true
from granary.operators import exchange as ops
from granary.operators import schema
from granary.operators.layout import NO_VALUE
from granary.operators.skew import fetched, listed_join
from granary.sources import exchange as bundles
from granary.sources import files, store

ALL = "all"


def partition_label(keys: Sequence[str]) -> Column:
    """``a=1/b=2`` of a row, for people to read; only the values say which partition it is."""
    parts = [
        F.concat(F.lit(f"{key}="), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(NO_VALUE)))
        for key in keys
    ]
    return F.concat_ws("/", *parts)


def directory_value(path: Column, key: str) -> Column:
    """Value of a key in a file's path, as text: unescaped, NULL for the directory without one."""
    name = F.regexp_extract(path, f"/{re.escape(key)}=([^/]*)/(?:[^/=]+=[^/]*/)*[^/]*$", 1)
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name != NO_VALUE, plain)


def table_changes(
    spark: SparkSession, root: str, etl_date: str, keys: Sequence[str], schema: T.StructType,
    inventory: DataFrame | None = None,
) -> DataFrame:
    """Change state of every partition of a table, by its values in ``keys``, or of the whole table.

    ``inventory`` has the partitions of the export before; those that are gone come out as missing.
    """
    base = store.current_path(spark, root)
    listing = files.list_files(spark, base)
    if not keys:
        listing = listing.withColumn("partition_name", F.lit(ALL))
        whole = spark.createDataFrame([(ALL,)], "partition_name string")
        return ops.detect_changes(whole, listing, etl_date, present=whole)
    listing = listing.withColumns(
        {key: directory_value(F.col("path"), key).cast(schema[key].dataType) for key in keys}
    )
    if inventory is None:
        inventory = listing
    return ops.partition_changes(inventory, listing, etl_date, keys)


def values_text(keys: Sequence[str]) -> Column:
    """Partition values as JSON text; a missing value is NULL."""
    return F.to_json(F.struct(*[F.col(f"`{key}`").cast("string").alias(key) for key in keys]))


def values_of(plan: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Manifest rows with the partition values as columns of the table's types."""
    parsed = F.from_json("partition_values", T.StructType([T.StructField(key, T.StringType()) for key in keys]))
    return plan.withColumn("_values", parsed).select(
        "action", *[F.col("_values")[key].cast(schema[key].dataType).alias(key) for key in keys]
    )


def export_table(
    spark: SparkSession,
    root: str,
    bundle: str,
    table: str,
    mode: str,
    etl_date: str,
    partition_by: Sequence[str] = (),
    predicate: str | None = None,
    previous: str | None = None,
) -> None:
    """Export a table: ``all`` of it, what changed (``auto``) or what a predicate selects
    (``sql``).

    A bundle of a partitioned table keeps the list of its partitions. The next export compares it with the
    partitions of its own day, so that those dropped or emptied since are truncated on the far side
    too. ``previous`` is the bundle of the export before, where that is another one.
    """
    store.finish_swap(spark, root)  # files are listed
    rows = store.read_table(spark, root)
    schema_json = rows.schema.json()
    keys = list(partition_by)
    if mode not in ("all", "auto", "sql"):
        raise ValueError(f"unknown export mode {mode!r}")
    if mode == "sql":
        if predicate is None:
            raise ValueError("an sql export needs a predicate")
        chosen = ops.export_sql(rows, predicate, etl_date)
        text = F.lit(ops.fill_predicate(predicate, etl_date))

        def plan(written: DataFrame) -> DataFrame:
            counts = written.agg(F.count("*").alias("row_count"))
            counts = counts.withColumn("partition_name", F.lit(ALL))
            return ops.manifest(counts, table, "delete_where", text, schema_json)

        bundles.write_bundle(chosen, plan, bundle, keys, mode)
        return

    known = f"{previous or bundle}/{bundles.INVENTORY}"
    inventory = store.read_table(spark, known) if keys and store.table_exists(spark, known) else None
    by = keys or ["partition_name"]
    changes = table_changes(spark, root, etl_date, keys, rows.schema, inventory)
    # taken once: which partitions to read, what to write in the manifest and the next inventory
    changes = fetched(changes.select(*by, "state"), [*by, "state"])
    held = changes.where(F.col("state").isin(ops.CHANGED, ops.UNCHANGED))
    if mode == "all":
        here = F.col("state").isin(ops.CHANGED, ops.UNCHANGED) | F.lit(not keys)
        changes = changes.withColumn("state", F.when(here, ops.CHANGED).otherwise(F.col("state")))
    changed = changes.where(F.col("state") == ops.CHANGED)
    chosen = ops.export_auto(rows, changed, keys) if keys else rows
    if mode == "auto" and not keys and changed.isEmpty():
        chosen = rows.where("false")
    nothing_left = bool(keys) and held.isEmpty()

    def plan(written: DataFrame) -> DataFrame:
        source = written if keys else written.withColumn("partition_name", F.lit(ALL))
        counts = source.groupBy(*by).agg(F.count("*").alias("row_count"))
        none = changes.select(*by, F.lit(None).cast("string").alias("predicate"))
        names = (partition_label(keys), values_text(keys)) if keys else ()
        found = ops.plan_export(changes, counts, none, table, schema_json, by, *names, missing="truncate")
        if not nothing_left:
            return found
        whole = spark.createDataFrame([(ALL, 0)], "partition_name string, row_count long")
        cleared = ops.manifest(whole, table, "truncate", F.lit(None).cast("string"), schema_json)
        return found.unionByName(cleared, allowMissingColumns=True)

    bundles.write_bundle(chosen, plan, bundle, keys, mode, held.select(*keys) if keys else None)


def import_table(
    spark: SparkSession,
    bundle: str,
    root: str,
    partition_by: Sequence[str] = (),
    remove: Sequence[str] = (),
) -> None:
    """Bring a target in line with a bundle, by what the bundle's manifest says."""
    keys = list(partition_by)
    if not store.table_exists(spark, root):
        bundles.import_create(spark, bundle, root, remove, keys)
        return
    staged = bundles.read_bundle(spark, bundle)
    plan = bundles.read_manifest(spark, bundle)
    tgt = store.read_table(spark, root)
    agreed = schema.agreed_schema(staged.schema, tgt.schema, remove)
    staged = schema.conform(staged, tgt.schema, remove).select(*agreed.names)
    # one row for each exported partition: its action, and its values or predicate
    columns = ["partition_name", "action", "predicate", "partition_values"]
    plan = fetched(plan.select(*columns), columns)
    predicates = [row.predicate for row in plan.where("action = 'delete_where'").select("predicate").distinct().collect()]
    whole = plan.where((F.col("partition_name") == ALL) & F.col("action").isin("replace", "truncate"))
    if predicates:
        tgt = schema.evolve_add_columns(tgt, agreed.fields[len(tgt.schema) :]).select(*agreed.names)
        if not keys:
            store.publish(ops.import_sql(staged, tgt, predicates), root)
            return
        # only partitions that lose or gain rows are rewritten
        lost = tgt.where(reduce(or_, [is_true(p) for p in predicates]))
        touched = lost.select(*keys).union(staged.select(*keys)).distinct()
        held = listed_join(tgt, touched, keys, "left_semi").select(*agreed.names)
        store.replace_partitions(ops.import_sql(staged, held, predicates), root, keys, touched)
    elif bundles.bundle_mode(spark, bundle) == ALL or not whole.isEmpty():
        store.publish(staged, root, keys)  # the far side is truncated first
    elif keys:
        listed = fetched(values_of(plan, keys, tgt.schema).where(F.col("action").isin("replace", "truncate")), [*keys, "action"])
        if listed.isEmpty():
            return
        chosen = listed_join(staged, listed.where("action = 'replace'"), keys, "left_semi")
        store.replace_partitions(chosen.select(*agreed.names), root, keys, listed.select(*keys))
