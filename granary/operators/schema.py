"""Declared schemas: reading them from DDL, comparing them, and bringing rows in line."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import DEFAULT_TYPE_NAMES, resolve_type

# Fixed patterns of the delivered DDL, on lower-cased lines with single blanks.
COLUMN_NAME = r'^"?([\w$#]+)"?'
COLUMN_TYPE = r'^"?[\w$#]+"? (\w+(?: ?\([^)]*\))?)'
BODY_END = r"^\)|^(constraint .*)?primary key"
PRIMARY_KEY = r"^(?:constraint \S+ )?primary key ?\(([^)]*)\)"
TABLE_NAME = r'^create table "?([\w.$#]+)"?'
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
COMMENT = r"^comment on {} (\S+) is '?(.*?)'?;?$"


def extract_schema(ddl: DataFrame, text: str = "value") -> DataFrame:
    """Ordered columns of every delivered ``create table`` script.

    ``ddl`` has one script per row; its other columns are kept. Adds ``table_name, pos,
    column_name, column_type, is_key, comment, table_comment``. Names and comments come out
    in lower case. A script is a few hundred lines, so each is taken apart within its row.
    """
    lines = F.filter(
        F.transform(
            F.split(F.lower(F.col(text)), "\n"),
            lambda line: F.trim(F.regexp_replace(line, r"\s+", " ")),
        ),
        lambda line: line != "",
    )

    def first_where(array: Column, test) -> Column:
        return F.array_position(F.transform(array, test), F.lit(True)).cast("int")

    def comments(kind: str) -> Column:
        pattern = COMMENT.format(kind)
        found = F.transform(
            F.filter("_lines", lambda line: line.rlike(pattern)),
            lambda line: F.struct(
                F.regexp_extract(line, pattern, 1).alias("key"),
                F.regexp_extract(line, pattern, 2).alias("value"),
            ),
        )
        # of several comments on one name the last one holds
        return F.aggregate(
            found,
            F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")),
            lambda known, one: F.map_concat(
                F.map_filter(known, lambda name, _: name != one["key"]),
                F.map_from_arrays(F.array(one["key"]), F.array(one["value"])),
            ),
        )

    kept = [name for name in ddl.columns if name != text]
    body = (
        ddl.select(*kept, lines.alias("_lines"))
        .withColumn("_create", first_where(F.col("_lines"), lambda line: line.rlike(TABLE_NAME)))
        .withColumn("_body", F.slice("_lines", F.greatest("_create", F.lit(1)), F.size("_lines")))
        .withColumn("_open", first_where(F.col("_body"), lambda line: line.contains("(")))
        .withColumn(
            "_rest",
            F.when(F.col("_open") > 0, F.slice("_body", F.col("_open") + 1, F.size("_body"))),
        )
        .withColumn("_stop", first_where(F.col("_rest"), lambda line: line.rlike(BODY_END)))
        .select(
            *kept,
            F.regexp_extract(
                F.try_element_at(F.filter("_lines", lambda line: line.rlike(TABLE_NAME)), F.lit(1)), TABLE_NAME, 1
            ).alias("table_name"),
            F.when(F.col("_stop") == 0, F.col("_rest"))
            .otherwise(F.slice("_rest", 1, F.greatest(F.col("_stop") - 1, F.lit(0))))
            .alias("_columns"),
            F.split(
                F.regexp_replace(
                    F.regexp_extract(
                        F.coalesce(
                            F.try_element_at(
                                F.filter("_lines", lambda line: line.rlike(PRIMARY_KEY)), F.lit(1)
                            ),
                            F.lit(""),
                        ),
                        PRIMARY_KEY,
                        1,
                    ),
                    r'[" ]',
                    "",
                ),
                ",",
            ).alias("_keys"),
            comments("column").alias("_column_comments"),
            comments("table").alias("_table_comments"),
        )
    )
    line = F.col("_line")
    name = F.regexp_extract(line, COLUMN_NAME, 1)
    # The outer form keeps the planner from testing the array for emptiness below, which
    # would take every script apart twice.
    return (
        body.select("*", F.posexplode_outer("_columns").alias("pos", "_line"))
        .where("pos is not null")
        .withColumn("column_name", name)
        .select(
            *kept,
            "table_name",
            "pos",
            "column_name",
            F.replace(F.regexp_extract(line, COLUMN_TYPE, 1), F.lit(" "), F.lit("")).alias(
                "column_type"
            ),
            (F.array_contains("_keys", F.col("column_name")) | line.contains("primary key")).alias(
                "is_key"
            ),
            F.try_element_at(
                "_column_comments", F.concat_ws(".", "table_name", "column_name")
            ).alias("comment"),
            F.try_element_at("_table_comments", F.col("table_name")).alias("table_comment"),
        )
    )


def spark_schema(
    columns: Sequence[tuple[str, str, str | None]],
    names: Mapping[str, str] = DEFAULT_TYPE_NAMES,
) -> T.StructType:
    """Declared ``(name, type, comment)`` as a Spark schema, comments as field metadata."""
    fields = []
    for name, declared, comment in columns:
        kind = T.DataType.fromDDL(resolve_type(declared, names))
        fields.append(
            T.StructField(name, kind, metadata={"comment": comment} if comment else None)
        )
    return T.StructType(fields)


def cast_to_target(
    df: DataFrame,
    columns: Sequence[tuple[str, str]],
    names: Mapping[str, str] = DEFAULT_TYPE_NAMES,
    failed: str | None = None,
) -> DataFrame:
    """Bring text columns to their declared types.

    A value that cannot be cast becomes NULL; ``failed`` names a column that lists
    which ones did, so bad values can be counted in the same pass.
    """
    kinds = {name: resolve_type(kind, names) for name, kind in columns}
    casts = {name: _cast(F.col(name), kind).alias(name) for name, kind in kinds.items()}
    kept = [F.col(name) for name in df.columns if name not in casts]
    if not failed:
        return df.select(*casts.values(), *kept)
    # cast once, then look at both values
    given = [F.col(name).alias(f"_given_{name}") for name, kind in kinds.items() if kind != "string"]
    both = df.select(*casts.values(), *kept, *given)
    bad = [
        F.when(F.col(f"_given_{name}").isNotNull() & F.col(name).isNull(), F.lit(name))
        for name, kind in kinds.items()
        if kind != "string"
    ]
    found = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return both.select(*casts, found.alias(failed), *kept)


def _cast(text: Column, kind: str) -> Column:
    """Cast that yields NULL for a bad value. Whole numbers are looked at first, as a failing
    cast of those raises and catches an error for each value."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.when(text.rlike(WHOLE_NUMBER), text.try_cast(kind))
    return text.try_cast(kind)


def schema_drift(
    current: DataFrame, registry: DataFrame, table: str = "table_name"
) -> DataFrame:
    """Compare delivered schemas with the registry, position by position.

    Both sides hold ``table, pos, column_name, column_type``, unique on table and position.
    ``change`` is ``same``, ``renamed``, ``retyped``, ``removed`` or ``appended``.
    """
    old = registry.select(
        table,
        "pos",
        F.col("column_name").alias("old_name"),
        F.col("column_type").alias("old_type"),
    )
    new = current.select(table, "pos", "column_name", "column_type")
    change = (
        F.when(F.col("column_name").isNull(), "removed")
        .when(F.col("old_name").isNull(), "appended")
        .when(F.col("column_name") != F.col("old_name"), "renamed")
        .when(F.col("column_type") != F.col("old_type"), "retyped")
        .otherwise("same")
    )
    return new.join(old, [table, "pos"], "full").withColumn("change", change)


def registry_as_of(
    registry: DataFrame, deliveries: DataFrame, table: str = "table_name", day: str = "etl_date", changed: str = "date_change"
) -> DataFrame:
    """The registered columns of each delivery's table as they stood on the delivery's day.

    A registry row holds from its ``changed`` day until a later one of the same table and position; of
    one day the greatest name and type count. ``deliveries`` has a table and a day per row. Tables without a row by then do not appear.
    """
    days = deliveries.select(table, day).distinct()
    valid = registry.join(days, table).where(F.col(changed) <= F.col(day))
    newest = Window.partitionBy(table, day, "pos").orderBy(F.desc(changed), F.desc("column_name"), F.desc("column_type"))
    return valid.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def drift_verdict(drift: DataFrame, table: str = "table_name") -> DataFrame:
    """One row per table: ``error``, ``initial`` (nothing registered), ``appended`` or ``same``.

    ``bad_pos`` is the first position that breaks the rule that schemas only grow at
    their end.
    """
    broken = F.col("change").isin("removed", "renamed", "retyped")
    return (
        drift.groupBy(table)
        .agg(
            F.min(F.when(broken, F.col("pos"))).alias("bad_pos"),
            F.count(F.when(F.col("change") == "appended", 1)).alias("appended"),
            F.count("old_name").alias("registered"),
        )
        .select(
            table,
            F.when(F.col("bad_pos").isNotNull(), "error")
            .when(F.col("registered") == 0, "initial")
            .when(F.col("appended") > 0, "appended")
            .otherwise("same")
            .alias("verdict"),
            "bad_pos",
            "appended",
        )
    )


def evolve_add_columns(df: DataFrame, new_columns: Sequence[T.StructField]) -> DataFrame:
    """Append columns; existing rows read NULL."""
    present = {name.lower() for name in df.columns}
    added = {
        field.name: F.lit(None).cast(field.dataType)
        for field in new_columns
        if field.name.lower() not in present
    }
    return df.withColumns(added) if added else df


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.VarcharType, T.CharType))


def agreed_schema(
    src: T.StructType, target: T.StructType, remove: Sequence[str] = ()
) -> T.StructType:
    """Target schema after an import: text columns may widen, new ones come last.

    Fails where the source is shorter, a name differs or a type differs other than
    in text length. Removed columns count on neither side.
    """
    dropped = {name.lower() for name in remove}
    fields = [field for field in src if field.name.lower() not in dropped]
    if len(fields) < len(target):
        raise ValueError("source has fewer columns than the target")
    out = []
    for new, old in zip(fields, target):
        if new.name.lower() != old.name.lower():
            raise ValueError(f"source column {new.name} stands where the target has {old.name}")
        kind = old.dataType
        if new.dataType != old.dataType:
            if not (is_text(new.dataType) and is_text(old.dataType)):
                raise ValueError(f"column {new.name}: {new.dataType} does not match {kind}")
            kind = new.dataType
        out.append(T.StructField(old.name, kind, True, old.metadata))
    return T.StructType(out + fields[len(target) :])


def conform(df: DataFrame, target: T.StructType, remove: Sequence[str] = ()) -> DataFrame:
    """Rows in the agreed schema's names and order."""
    agreed = agreed_schema(df.schema, target, remove)
    return remove_fields(df, remove).toDF(*agreed.names)


def remove_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Leave out configured columns; the rest keep their order."""
    dropped = {name.lower() for name in names}
    return df.select(*[f"`{name}`" for name in df.columns if name.lower() not in dropped])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.where("n > 1")


def check_merge_key(
    df: DataFrame, keys: Sequence[str], declared: Sequence[str]
) -> DataFrame:
    """One row that says whether a configured key equals the declared one and is unique."""
    same = [k.strip().lower() for k in keys] == [k.strip().lower() for k in declared]
    return duplicate_keys(df, keys).agg(
        F.lit(same).alias("matches_declared"),
        F.count("*").alias("duplicate_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail where a merge source holds a key twice."""
    if not keys:
        raise ValueError("a key is needed")
    if duplicate_keys(df, keys).limit(1).count():
        raise ValueError(f"source key {', '.join(keys)} is not unique")
