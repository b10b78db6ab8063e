"""Questions to an item table and its status ledger, both of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.columns import as_column
from granary.operators.skew import keyed_join, next_in_order

RUNNING, SUCCESS, ERROR, ERROR_AGAIN = "running", "success", "error", "error1"


def enabled_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("enabled") == "1") if "enabled" in items.columns else items


def keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys)


def unprocessed(
    items: DataFrame,
    ledger: DataFrame,
    keys: Sequence[str],
    day: str | None = None,
    scope: str | None = None,
    ids: Sequence | None = None,
    day_col: str = "etl_date",
    status_col: str = "task_status",
    scope_col: str = "batch_id",
    id_col: str = "job_id",
) -> DataFrame:
    """Enabled items without a ledger row for the day.

    ``scope`` counts only one batch's rows; an item another batch is still running is left
    out all the same. ``ids`` restricts the items.
    """
    items = enabled_items(items)
    if ids is not None:
        items = items.where(F.col(id_col).isin(list(ids)))
    done = ledger.where(F.col(status_col).isNotNull())
    if day is not None:
        done = done.where(F.col(day_col) == day)
    if scope is not None:
        done = done.where((F.col(scope_col) == scope) | (F.col(status_col) == RUNNING))
    return keyed_join(items, keys_of(done, keys), keys, "left_anti").select(*items.columns)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ended: str | Column,
    tie: Sequence[str],
    now: Column | None = None,
) -> DataFrame:
    """Newest row of every key; a row still open counts as ended ``now``.

    The rank filter is applied before the shuffle as well as after it, so a map task sends
    one row per key however often the key occurs.
    """
    at = as_column(ended)
    if now is not None:
        at = F.coalesce(at, now)
    order = [at.desc(), *[F.col(name).desc() for name in tie]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def retryable(
    items: DataFrame, latest: DataFrame, keys: Sequence[str], status_col: str = "task_status"
) -> DataFrame:
    """Items whose latest ledger row is absent or an error."""
    items = enabled_items(items)
    settled = latest.where(F.col(status_col).isNotNull() & (F.col(status_col) != ERROR))
    return keyed_join(items, keys_of(settled, keys), keys, "left_anti").select(*items.columns)


def in_state(
    ledger: DataFrame,
    state: str,
    day: str,
    ids: Sequence | None = None,
    status_col: str = "task_status",
    day_col: str = "etl_date",
    id_col: str = "job_id",
) -> DataFrame:
    """Ledger rows in a state on a day."""
    rows = ledger.where((F.col(status_col) == state) & (F.col(day_col) == day))
    return rows if ids is None else rows.where(F.col(id_col).isin(list(ids)))


def failed_items(
    items: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    status_col: str = "task_status",
    failed: str = ERROR_AGAIN,
) -> DataFrame:
    """Enabled items whose latest status is failure in the retry pass."""
    items = enabled_items(items)
    bad = keys_of(latest.where(F.col(status_col) == failed), keys)
    return keyed_join(items, bad, keys, "left_semi").select(*items.columns)


def gated(
    items: DataFrame,
    upstream: DataFrame,
    ledger: DataFrame,
    keys: Sequence[str],
    strict: bool = True,
    status_col: str = "task_status",
) -> DataFrame:
    """Items let through by their upstream.

    Strict: the item's own upstream unload exists and has a row that did not fail. Otherwise the
    plain EXISTS, which lets every item through as soon as upstream has any row.
    """
    items = enabled_items(items)
    if not strict:
        return items.where(upstream.select(F.lit(1)).exists())
    good = keys_of(ledger.where(F.col(status_col) != ERROR), keys)
    open_gate = keys_of(upstream, keys).join(good, list(keys), "left_semi")
    return keyed_join(items, open_gate, keys, "left_semi").select(*items.columns)


def allowed(column: str, values: Sequence) -> Column:
    """Violation: a value outside the set, or none."""
    return ~F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def required_if(condition: str | Column, column: str) -> Column:
    """Violation: an empty or missing value where the condition holds."""
    missing = F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")
    return F.coalesce(as_column(condition), F.lit(False)) & missing


def validate_rows(
    df: DataFrame, rules: Mapping[str, Column], reasons: str = "reasons"
) -> DataFrame:
    """Add the names of the rules each row violates; empty for a valid row."""
    found = [F.when(violation, F.lit(name)) for name, violation in rules.items()]
    return df.withColumn(reasons, F.array_compact(F.array(*found)))


def top_by_priority(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` items in priority order; end the order with a unique column."""
    return df.orderBy(*order).limit(k)


def run_durations(
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    carry: Sequence[str] = (),
    started: str | Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Seconds from every start event to the key's next event.

    ``started`` selects start events after the pairing; ``carry`` names columns taken from
    the following event, such as its status.
    """
    paired = next_in_order(events, keys, [at, tie], [at, *carry], parts)
    ended = F.unix_micros(F.col(f"next_{at}").cast("timestamp"))
    began = F.unix_micros(F.col(at).cast("timestamp"))
    out = paired.withColumn(
        "used_seconds", F.floor((ended - began) / 1_000_000).cast("long")
    )
    return out if started is None else out.where(as_column(started))


def runs_by_id(
    events: DataFrame, run_id: str, at: str, status: str
) -> DataFrame:
    """One row per run from its start and end events; open runs have no end."""
    ended = F.col(status) != RUNNING
    return events.groupBy(run_id).agg(
        F.min(F.when(~ended, F.col(at))).alias("start_time"),
        F.max(F.when(ended, F.col(at))).alias("end_time"),
        F.max_by(status, at).alias("task_status"),
    )


ISSUE_COLUMNS = ("issue_type", "level", "subject", "detail")


def issue(kind: str, level: str, subject: Column, detail: Column) -> list[Column]:
    """Columns of an issue row, for ``select``."""
    return [
        F.lit(kind).alias("issue_type"),
        F.lit(level).alias("level"),
        subject.cast("string").alias("subject"),
        detail.cast("string").alias("detail"),
    ]


def issues(*frames: DataFrame) -> DataFrame:
    """Typed, levelled warnings of several checks in one table."""
    return reduce(DataFrame.unionByName, [frame.select(*ISSUE_COLUMNS) for frame in frames])


def completion_check(parts: DataFrame, keys: Sequence[str], succeeded: str | Column) -> DataFrame:
    """Whether all started parts of each table succeeded."""
    return (
        parts.groupBy(*keys)
        .agg(
            F.count("*").alias("started"),
            F.count(F.when(as_column(succeeded), 1)).alias("succeeded"),
        )
        .withColumn("complete", F.col("started") == F.col("succeeded"))
    )
