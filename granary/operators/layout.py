"""Partition assignment and sizing."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce
from itertools import groupby
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, StructField, StructType

from granary.functions import is_true, parse_day, shift_day
from granary.functions.columns import as_column
from granary.operators.skew import listed_join

MINVALUE, MAXVALUE = "MINVALUE", "MAXVALUE"

# Sizing defaults of the layout rules.
BUCKET_MB = 70
MAX_BUCKETS = 60
PARTITION_DAYS = 49
COMPRESSION_RATIO = 10
MAX_SPAN_DAYS = 365 * 30

FEW_BOUNDS = 64


def intervals(uppers: Sequence) -> list[tuple]:
    """Lower and upper bound of every partition in one column; a repeated bound keeps its interval."""
    runs = [(upper, len(list(run))) for upper, run in groupby(uppers)]
    lowers = [MINVALUE, *(upper for upper, _ in runs)]
    return [(lower, upper) for lower, (upper, size) in zip(lowers, runs) for _ in range(size)]


def within(column: str, lower, upper) -> Column:
    """Whether a value lies in ``[lower, upper)``; nothing lies below MINVALUE, and NULL nowhere."""
    value = F.col(column)
    parts = [F.lit(False)] if upper == MINVALUE else [value.isNotNull()]
    parts += [] if lower == MINVALUE else [value >= F.lit(lower)]
    parts += [] if upper in (MINVALUE, MAXVALUE) else [value < F.lit(upper)]
    return reduce(and_, parts)


def range_conditions(columns: Sequence[str], bounds: Sequence[tuple]) -> list[tuple[str, Column]]:
    """Condition of each range partition; ``bounds`` are ordered ``(name, (upper, ...))``."""
    by_column = [intervals([uppers[i] for _, uppers in bounds]) for i in range(len(columns))]
    return [
        (name, reduce(and_, (within(c, *by_column[i][at]) for i, c in enumerate(columns))))
        for at, (name, _) in enumerate(bounds)
    ]


# Fixed value: the directory value that stands for NULL and for empty text.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def label_values(label: str) -> dict[str, str | None]:
    """``a=1/b=x%2Fy`` as names and values: unescaped, None for the name that stands for no value."""
    parts = (part.split("=", 1) for part in label.split("/"))
    return {unquote(name): None if value == NO_VALUE else unquote(value) for name, value in parts}


def listed_filter(column: str, kind: DataType, values: set[str | None]) -> Column:
    """A filter that reaches the scan: the values themselves where they are few, else their range, so that the
    plan does not grow with the list."""
    held = sorted(v for v in values if v is not None)
    typed = [F.lit(v).cast(kind) for v in held] if len(held) <= FEW_BOUNDS else []
    if not held:
        inside = F.lit(False)
    elif typed:
        inside = F.col(column).isin(*typed)
    elif isinstance(kind, NumericType):
        numbers = sorted(held, key=Decimal)
        inside = F.col(column).between(F.lit(numbers[0]).cast(kind), F.lit(numbers[-1]).cast(kind))
    elif isinstance(kind, (StringType, DateType)):
        inside = F.col(column).between(F.lit(held[0]).cast(kind), F.lit(held[-1]).cast(kind))
    else:
        inside = F.col(column).isNotNull()
    return inside | F.col(column).isNull() if None in values else inside


def range_label(col: Column, bounds: Sequence[tuple]) -> Column:
    """Partition name for one column under ascending bounds, by binary search.

    No join and no shuffle, log2(n) comparisons per row: nested conditions for a few
    bounds, a fold over halving steps for many, which would outgrow compiled code.
    """
    steps = [(name, uppers[0]) for name, uppers in bounds if uppers[0] != MINVALUE]
    steps = [s for i, s in enumerate(steps) if i == 0 or s[1] != steps[i - 1][1]]
    beyond = F.lit(None).cast("string")
    if steps and steps[-1][1] == MAXVALUE:
        beyond = F.lit(steps.pop()[0])
    uppers = [upper for _, upper in steps]
    if uppers != sorted(uppers):
        raise ValueError("range bounds must be ascending")
    labels = [F.lit(name) for name, _ in steps] + [beyond]

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return labels[lo]
        mid = (lo + hi) // 2
        return F.when(col < F.lit(uppers[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    if len(uppers) <= FEW_BOUNDS:
        return F.when(col.isNotNull(), search(0, len(uppers)))
    sorted_bounds = F.array(*[F.lit(upper) for upper in uppers])
    halving = [1 << i for i in reversed(range(len(uppers).bit_length()))]

    def descend(passed: Column, step: Column) -> Column:
        at = passed + step
        further = F.try_element_at(sorted_bounds, at) <= col
        return F.when(further, at).otherwise(passed)

    passed = F.aggregate(F.array(*[F.lit(step) for step in halving]), F.lit(0), descend)
    return F.when(col.isNotNull(), F.element_at(F.array(*labels), passed + 1))


def many_ranges(df: DataFrame, columns: Sequence[str], bounds: Sequence[tuple]) -> Column | None:
    """Partition name by many bounds on several columns: the first column's runs by halving, then those of one run.

    Within a run the second column is halved too where its bounds ascend there, else looked through. The bounds are
    one JSON literal, so the plan stays as it is however many there are. None where the first column's bounds do not ascend.
    """
    numeric = [isinstance(df.schema[c].dataType, NumericType) for c in columns]

    def plain(value, i: int):
        """A bound as JSON of its column's type."""
        return value if numeric[i] and not isinstance(value, Decimal) else str(value)

    by_column = [intervals([uppers[i] for _, uppers in bounds]) for i in range(len(columns))]
    runs: list[tuple[object, list[dict]]] = []
    for at, (name, _) in enumerate(bounds):
        first = by_column[0][at][1]
        if not runs or runs[-1][0] != first:
            runs.append((first, []))
        rest = [own[at] for own in by_column[1:]]
        if first == MINVALUE or any(hi == MINVALUE or lo == MAXVALUE for lo, hi in rest):
            continue  # nothing lies there
        entry = {"name": name}
        for i, (lo, hi) in enumerate(rest):
            entry |= {f"lo{i}": None if lo == MINVALUE else plain(lo, i + 1), f"hi{i}": None if hi == MAXVALUE else plain(hi, i + 1)}
        runs[-1][1].append(entry)
    runs = [(first, entries) for first, entries in runs if first != MINVALUE]
    uppers = [first for first, _ in runs if first != MAXVALUE]
    if uppers != sorted(set(uppers)) or [first for first, _ in runs[: len(uppers)]] != uppers:
        return None
    kinds = [df.schema[c].dataType.simpleString() for c in columns]
    fields = ", ".join(f"lo{i}: {kind}, hi{i}: {kind}" for i, kind in enumerate(kinds[1:]))
    ends = F.from_json(F.lit(json.dumps([plain(u, 0) for u in uppers])), f"array<{kinds[0]}>")
    held = F.from_json(F.lit(json.dumps([entries for _, entries in runs])), f"array<array<struct<name: string, {fields}>>>")

    def halving(size: int, passes: Callable[[Column], Column]) -> Column:
        """How many of the first entries are passed."""
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(size.bit_length()))])
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(passes(at + step), at + step).otherwise(at))

    first, rest = F.col(columns[0]), [F.col(c) for c in columns[1:]]
    run = F.try_element_at(held, halving(len(uppers), lambda at: F.try_element_at(ends, at) <= first) + 1)

    def inside(entry: Column) -> Column:
        parts = [c.isNotNull() for c in rest]
        for i, c in enumerate(rest):
            parts += [entry[f"lo{i}"].isNull() | (c >= entry[f"lo{i}"]), entry[f"hi{i}"].isNull() | (c < entry[f"hi{i}"])]
        return reduce(and_, parts)

    second = [[uppers[1] for _, uppers in own] for _, own in groupby(bounds, key=lambda b: b[1][0])]
    ascending = all(own[: len(held_)] == sorted(set(held_)) and own[len(held_) :] in ([], [MAXVALUE])
                    for own in second for held_ in [[u for u in own if u not in (MINVALUE, MAXVALUE)]])
    if len(columns) == 2 and ascending:
        longest = max((len(entries) for _, entries in runs), default=0)
        at = halving(longest, lambda at: F.try_element_at(run, at)["hi0"] <= rest[0])
        entry = F.try_element_at(run, at + 1)
        return F.when(first.isNotNull() & inside(entry), entry["name"])
    return F.when(first.isNotNull(), F.try_element_at(F.filter(run, inside), F.lit(1))["name"])


def assign_range_partition(
    df: DataFrame, columns: Sequence[str], bounds: Sequence[tuple], label: str = "partition_name"
) -> DataFrame:
    """Add the range partition each row belongs to; NULL where it is in none."""
    if len(columns) == 1:
        return df.withColumn(label, range_label(F.col(columns[0]), bounds))
    if len(bounds) > FEW_BOUNDS:
        found = many_ranges(df, columns, bounds)
        if found is not None:
            return df.withColumn(label, found)
    cases = [F.when(condition, F.lit(name)) for name, condition in range_conditions(columns, bounds)]
    return df.withColumn(label, F.coalesce(*cases))


def filter_list_partitions(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows of the listed ``a=1/b=2`` partitions, which all name the same columns in any order.

    Labels are those of directories: values are escaped, and the default name is NULL. Each column's listed values
    are a filter that reaches the scan and prunes partitions; which of them belong together is then a semi join
    with the list, whatever its length.
    """
    if not labels:
        return df.limit(0)
    listed = [label_values(label) for label in labels]
    names = list(listed[0])
    if any(set(values) != set(names) for values in listed):
        raise ValueError("listed partitions name different columns")
    rows = list(dict.fromkeys(tuple(values[name] for name in names) for values in listed))
    wanted = df.sparkSession.createDataFrame(rows, StructType([StructField(n, StringType()) for n in names]))
    wanted = wanted.select(*[F.col(n).cast(df.schema[n].dataType).alias(n) for n in names])
    pruned = [listed_filter(n, df.schema[n].dataType, {r[i] for r in rows}) for i, n in enumerate(names)]
    return listed_join(df.where(reduce(and_, pruned)), wanted, names, "left_semi").select(*df.columns)


def partition_summary(tables: DataFrame, partitions: DataFrame, buckets: DataFrame) -> DataFrame:
    """Newest and oldest partition and bucket count of every table.

    ``partitions`` holds ``table, partition_name, range_start, range_end``. Ranges
    that start with ``M`` are left out before the join, so their tables stay in the
    result.
    """
    newest = F.max(F.struct("range_start", "range_end")).alias("newest")
    ranges = (
        partitions.where(~F.col("range_start").startswith("M"))
        .groupBy("table")
        .agg(
            F.max("partition_name").alias("partition_name"),
            newest,
            F.min(F.struct("range_start", "range_end"))["range_end"].alias("oldest_end"),
        )
        .select(
            "table",
            "partition_name",
            F.col("newest.range_start").alias("newest_start"),
            F.col("newest.range_end").alias("newest_end"),
            "oldest_end",
        )
    )
    counts = buckets.groupBy("table").agg(F.max("bucket_number").alias("bucket_number"))
    return tables.select("table").distinct().join(ranges, "table", "left").join(
        counts, "table", "left"
    )


def day_histogram(src: DataFrame, day: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows per day; a NULL day fails the query."""
    checked = F.coalesce(
        as_column(day), F.raise_error(F.lit("the partition column holds NULL")).cast("string")
    )
    return src.groupBy(*by, checked.alias("day")).agg(F.count("*").alias("n"))


def pack_day_partitions(
    histogram: DataFrame,
    total_mb: float | Column,
    max_mb: float | Column,
    by: Sequence[str] = (),
) -> DataFrame:
    """Cut a table's days into range partitions of about ``max_mb``.

    Days are taken in order and their share of ``total_mb`` is added up. The day that
    reaches the limit closes the partition and is its exclusive upper bound, so its own
    rows open the next one. The last upper bound lies after the last day.

    The fold runs over the histogram, one entry per calendar day and table, never over
    rows. Text that is no calendar day fails the query, so the list cannot outgrow the calendar.
    """
    last = F.try_element_at("days", F.lit(-1))["day"]
    first = F.try_element_at("days", F.lit(1))["day"]
    part = "struct<partition_name:string,lower:string,upper:string,row_count:bigint>"
    size = F.lit(1.0) * as_float(total_mb)
    limit = as_float(max_mb)

    def step(state: Column, entry: Column) -> Column:
        rows = state["rows"] + entry["n"]
        start = F.when(state["rows"] == 0, entry["day"]).otherwise(state["start"])
        at_end = entry["day"] == last
        mb = size * rows / F.col("all_rows")
        # the last partition is as wide as its own days times the room left in it
        width = F.datediff(parse_day(last), parse_day(start)) * F.floor(limit / mb) + 1
        roomy = F.date_add(parse_day(start), F.least(width, F.lit(MAX_SPAN_DAYS)).cast("int"))
        upper = F.when(
            at_end,
            F.date_format(F.greatest(roomy, F.date_add(parse_day(last), 1)), "yyyyMMdd"),
        ).otherwise(entry["day"])
        close = at_end | (mb >= limit)
        closed = F.array(
            F.struct(
                F.concat(F.lit("partition_"), start).alias("partition_name"),
                state["lower"].alias("lower"),
                upper.alias("upper"),
                rows.alias("row_count"),
            ).cast(part)
        )
        return F.struct(
            F.when(close, F.lit(0).cast("long")).otherwise(rows).alias("rows"),
            F.when(close, F.lit(None).cast("string")).otherwise(start).alias("start"),
            F.when(close, upper).otherwise(state["lower"]).alias("lower"),
            F.when(close, F.concat(state["parts"], closed)).otherwise(state["parts"]).alias("parts"),
        )

    empty = F.struct(
        F.lit(0).cast("long").alias("rows"),
        F.lit(None).cast("string").alias("start"),
        shift_day(first, -1).alias("lower"),
        F.array().cast(f"array<{part}>").alias("parts"),
    )
    no_day = F.raise_error(F.concat(F.lit("not a calendar day: "), F.col("day"))).cast("string")
    checked = F.when(parse_day("day").isNotNull(), F.col("day")).otherwise(no_day)
    days = histogram.withColumn("day", checked).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("day", "n"))).alias("days"),
        F.sum("n").alias("all_rows"),
    )
    folded = days.where(F.size("days") > 0).select(
        *by, F.aggregate("days", empty, step, lambda state: state["parts"]).alias("parts")
    )
    return folded.select(*by, F.inline("parts")).select(
        *by, "partition_name", "lower", "upper"
    )


def as_float(value: float | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def packed_bounds(parts: DataFrame) -> list[tuple]:
    """Packed partitions as bounds for ``assign_range_partition`` (one row each)."""
    rows = parts.select("partition_name", "upper").orderBy("upper").collect()
    return [(row.partition_name, (row.upper,)) for row in rows]


def load_initial_partitioned(
    src: DataFrame,
    day: str,
    total_mb: float,
    max_mb: float,
    label: str = "partition_name",
) -> DataFrame:
    """First load of a day-partitioned table: every row with its packed partition.

    One pass over the day column plans the layout, a second labels the rows; the rows
    themselves are not shuffled.
    """
    parts = pack_day_partitions(day_histogram(src, day), total_mb, max_mb)
    return src.withColumn(label, range_label(as_column(day), packed_bounds(parts)))


def text_size_mb(total_bytes: Column, ratio: float = COMPRESSION_RATIO) -> Column:
    """Expected stored size of a text delivery."""
    return total_bytes / 1024 / 1024 / F.lit(float(ratio))


def file_count(size_mb: Column, bucket_mb: int = BUCKET_MB) -> Column:
    """Files of an unpartitioned table."""
    return (F.floor(size_mb / bucket_mb) + 1).cast("int")


def file_count_partitioned(
    size_mb: Column,
    days: Column,
    bucket_mb: int = BUCKET_MB,
    span_days: int = PARTITION_DAYS,
    max_buckets: int = MAX_BUCKETS,
) -> Column:
    """Files of one partition spanning ``span_days`` average days."""
    span_mb = F.least(size_mb / days * span_days, F.lit(float(max_buckets * bucket_mb)))
    return (F.floor(span_mb / bucket_mb) + 1).cast("int")


def size_output(df: DataFrame, size_mb: float, bucket_mb: int = BUCKET_MB) -> DataFrame:
    """Spread rows evenly over the number of files an unpartitioned table gets."""
    return df.repartition(int(size_mb // bucket_mb) + 1)


def next_partition_bound(
    stats: DataFrame,
    etl_date: str | Column,
    incoming_mb: float | Column,
    bucket_mb: int = BUCKET_MB,
) -> DataFrame:
    """Upper bound of the partition to open for ``etl_date``.

    ``stats`` holds ``newest_start, newest_end, newest_mb, bucket_number`` per table.
    The new partition spans as many days as fill all buckets at the newest partition's
    rate, thirty years at most. NULL while the day still fits the newest partition.
    """
    day = F.lit(etl_date) if isinstance(etl_date, str) else etl_date
    start = F.when(F.col("newest_start") == MINVALUE, F.col("newest_end")).otherwise(
        F.col("newest_start")
    )
    days = F.datediff(parse_day("newest_end"), parse_day(start))
    last_mb = F.when(F.col("newest_mb") > 0, F.col("newest_mb")).otherwise(as_float(incoming_mb))
    per_day = last_mb.cast("double") / (days + 1)
    room = (F.col("bucket_number") * bucket_mb).cast("double")
    span = F.coalesce(F.floor(F.try_divide(room, per_day)) + 1, F.lit(MAX_SPAN_DAYS))
    span = F.least(span, F.lit(MAX_SPAN_DAYS)).cast("int")
    opens = is_true(day >= F.col("newest_end"))
    return stats.withColumns(
        {"span_days": span, "next_bound": F.when(opens, shift_day(day, span))}
    )
