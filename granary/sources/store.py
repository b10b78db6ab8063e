"""Target tables on a path: ORC in versioned directories with a small pointer file.

A new state is written beside the current one and becomes visible by one rename of the
pointer, so a reader, a failed job or a re-run never meets half a table. Replacing partitions is such
a state too: the new rows are staged, the pointer names the stage and from then on readers take them
in place of the old partitions. The engine's dynamic partition overwrite then brings them into the
version; a run cut short there is carried out again, from the stage, by the next writer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.skew import join_on, listed_join
from granary.sources import files

POINTER, STAGE = "CURRENT", "stage-"


def table_exists(spark: SparkSession, root: str) -> bool:
    return files.exists(spark, f"{root}/{POINTER}")


def pointer(spark: SparkSession, root: str) -> dict:
    """Version and schema of the table as it stands, a stage that is not yet part of the version, and notes."""
    return json.loads(files.read_small(spark, f"{root}/{POINTER}"))


def set_pointer(spark: SparkSession, root: str, version: str, schema: T.StructType, **rest: object) -> None:
    note = {"version": version, "schema": schema.jsonValue(), **{k: v for k, v in rest.items() if v is not None}}
    files.write_small(spark, f"{root}/{POINTER}", json.dumps(note))


def current_path(spark: SparkSession, root: str) -> str:
    """Directory of the table's current version."""
    return f"{root}/{pointer(spark, root)['version']}"


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by partition before a write without piling a big one onto one task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def stored_schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """Schema as read back: partition columns last, everything nullable."""
    fields = [f for f in df.schema if f.name not in partition_by]
    fields += [df.schema[name] for name in partition_by]
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])


def write_target(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    n_files: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write an ORC table directory, partitioned and sized."""
    out = df.repartition(n_files) if n_files else spread(df, partition_by)
    out.write.mode(mode).partitionBy(*partition_by).orc(path)


def publish(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), n_files: int | None = None,
    notes: Mapping[str, object] | None = None,
) -> str:
    """Make ``df`` the table's new state. It may read the table itself. ``notes`` are kept with the pointer.

    The version before stays for readers that are under way; older ones are deleted.
    """
    spark = df.sparkSession
    held = files.children(spark, root)
    versions = [name for name in held if name.startswith("v")]
    now = pointer(spark, root)["version"] if POINTER in held else None
    number = 1 + max([int(name[1:]) for name in versions], default=0)
    name = f"v{number:08d}"
    write_target(df, f"{root}/{name}", partition_by, n_files)
    set_pointer(spark, root, name, stored_schema(df, partition_by), notes=notes)
    for old in held:  # a stage was meant for the version before
        if old.startswith(STAGE) or old in versions and old != now:
            files.delete(spark, f"{root}/{old}")
    return f"{root}/{name}"


def read_table(
    spark: SparkSession,
    root: str,
    predicate: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Scan the table's current version; filters and columns reach the scan.

    The stored schema keeps partition values in their own type, and files older than a
    column read NULL for it.
    """
    now = pointer(spark, root)
    schema = T.StructType.fromJson(now["schema"])
    df = spark.read.schema(schema).orc(f"{root}/{now['version']}")
    if "stage" in now:
        staged, touched = _staged(spark, root, now)
        df = listed_join(df, touched, now["by"], "left_anti").unionByName(staged)
    if predicate:
        df = df.where(predicate)
    return df.select(*columns) if columns else df


def _staged(spark: SparkSession, root: str, now: dict) -> tuple[DataFrame, DataFrame]:
    """Rows waiting for the version, and the partitions that they replace or that are cleared."""
    schema = T.StructType.fromJson(now["schema"])
    keys = T.StructType([schema[key] for key in now["by"]])
    stage = f"{root}/{now['stage']}"
    return spark.read.schema(schema).orc(f"{stage}/data"), spark.read.schema(keys).parquet(f"{stage}/touched")


def replace_partitions(
    df: DataFrame, root: str, partition_by: Sequence[str], cleared: DataFrame | None = None,
    notes: Mapping[str, object] | None = None,
) -> None:
    """Replace only the partitions that occur in ``df``; drop ``cleared`` ones without rows.

    ``df`` may read the table. The new state is there, for readers, with the pointer's rename, and
    becomes part of the version after it.
    """
    spark = df.sparkSession
    keys = list(partition_by)
    if not table_exists(spark, root):
        publish(df, root, keys, notes=notes)
        return
    finish_swap(spark, root)
    for name in files.children(spark, root):
        if name.startswith(STAGE):  # of a run that was cut short before it counted
            files.delete(spark, f"{root}/{name}")
    stage = f"{STAGE}{uuid.uuid4().hex}"
    write_target(df, f"{root}/{stage}/data", keys)
    schema = stored_schema(df, keys)
    filled = spark.read.schema(schema).orc(f"{root}/{stage}/data").select(*keys).distinct()
    gone = []
    if cleared is not None:
        emptied = join_on(cleared.select(*keys).distinct(), filled, keys, "left_anti", True)
        filled = filled.unionByName(emptied)
        held = listed_join(read_table(spark, root), emptied, keys, "left_semi")
        where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        names = [F.element_at(F.split(where, "/"), i - 1 - len(keys)) for i in range(len(keys))]
        gone = [row.dir for row in held.select(F.concat_ws("/", *names).alias("dir")).distinct().collect()]
    filled.write.parquet(f"{root}/{stage}/touched")
    now = pointer(spark, root)
    known = T.StructType.fromJson(now["schema"])
    # a delivery may bring columns; it never loses any
    wider = schema if set(schema.names) - set(known.names) else known
    kept = {**now.get("notes", {}), **(notes or {})} or None
    set_pointer(spark, root, now["version"], wider, notes=kept, stage=stage, by=keys, gone=gone)
    finish_swap(spark, root)


def finish_swap(spark: SparkSession, root: str) -> None:
    """Make staged partitions part of the version, if there are any. Doing it again changes nothing."""
    now = pointer(spark, root)
    if "stage" not in now:
        return
    version = f"{root}/{now['version']}"
    staged, _ = _staged(spark, root, now)
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*now["by"]).orc(version)
    for directory in now["gone"]:  # partitions without rows, which an overwrite cannot name
        files.delete(spark, f"{version}/{directory}")
    set_pointer(spark, root, now["version"], T.StructType.fromJson(now["schema"]), notes=now.get("notes"))
    files.delete(spark, f"{root}/{now['stage']}")


def retain_partitions(spark: SparkSession, root: str, key: str, keep_n: int) -> list[str]:
    """Drop all but the ``keep_n`` greatest partitions of a day-partitioned table.

    Directories are dropped whole; no row is read or rewritten.
    """
    finish_swap(spark, root)
    target = current_path(spark, root)
    names = sorted(n for n in files.children(spark, target) if n.startswith(f"{key}="))
    dropped = names[: max(0, len(names) - keep_n)]
    for name in dropped:
        files.delete(spark, f"{target}/{name}")
    return dropped


def append(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to the current version; columns they bring along are added to the table."""
    spark = df.sparkSession
    if not table_exists(spark, root):
        publish(df, root, partition_by)
        return
    finish_swap(spark, root)  # or it would take the place of these rows
    now = pointer(spark, root)
    write_target(df, f"{root}/{now['version']}", partition_by, mode="append")
    known = T.StructType.fromJson(now["schema"])
    added = [f for f in stored_schema(df, partition_by) if f.name not in known.names]
    if added:
        split = len(known) - len(partition_by)
        wider = T.StructType(known.fields[:split] + added + known.fields[split:])
        set_pointer(spark, root, now["version"], wider, notes=now.get("notes"))


def load_external(df: DataFrame, root: str, mode: str) -> None:
    """The three external load modes on a path table: ``all`` replaces, ``add`` appends and
    anything else inserts into a table that must be empty or absent."""
    spark = df.sparkSession
    if mode == "all":
        publish(df, root)
    elif mode == "add":
        append(df, root)
    else:
        if table_exists(spark, root) and not read_table(spark, root).isEmpty():
            raise ValueError("insert into a table that is not empty")
        publish(df, root)
