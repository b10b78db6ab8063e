"""One delivery from landing files to a published target."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import DEFAULT_TYPE_NAMES, replaced_day
from granary.operators import layout, ledger, loads, schema
from granary.operators.skew import keyed_join, listed_join
from granary.sources import files, landing, store


@dataclass(frozen=True)
class LoadJob:
    """What the job configuration says about one table."""

    table: str
    system_id: str
    name: str
    load_type: str
    keys: Sequence[str] = ()
    day: str | None = None  # day of a row in an add load; the load day without one
    def_etl_date: str | None = None
    bucket_mb: int = layout.BUCKET_MB
    type_names: Mapping[str, str] = field(default_factory=lambda: DEFAULT_TYPE_NAMES)


@dataclass(frozen=True)
class LoadResult:
    expected: int
    loaded: int
    status: str
    warnings: tuple[str, ...]
    columns: tuple[tuple[str, str], ...] = ()  # as declared, for ``register``
    issues: tuple[tuple[str, str, str], ...] = ()  # type, level and text of each warning, for the warning log


WARNING = "warning"
PARTITION = "load_partition"
FAILED = "_failed"  # names of the values of a row that do not fit their type
BOUNDS = "bounds"  # note with the upper bounds of a day-partitioned target, published with its data


def registered_columns(registry: DataFrame | None, table: str) -> list[tuple[str, str]]:
    """Registered columns of one table, in order (one row per column)."""
    if registry is None:
        return []
    rows = registry.where(F.col("table_name") == table).orderBy("pos").collect()
    return [(row.column_name, row.column_type) for row in rows]


def register(registry: DataFrame, table: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """The registry with the columns of a table's latest delivery, for the caller to store.

    It holds a row per column of each table, so only as many rows are made here as the table is wide.
    """
    rows = [(table, pos, name, kind) for pos, (name, kind) in enumerate(columns)]
    new = registry.sparkSession.createDataFrame(rows, "table_name string, pos int, column_name string, column_type string")
    others = registry.where(~F.col("table_name").eqNullSafe(F.lit(table)))
    return others.unionByName(new, allowMissingColumns=True).select(*registry.columns)


REGISTRY = "table_name string, pos int, column_name string, column_type string, date_change string"


def stored_registry(spark: SparkSession, registry_root: str, table: str) -> DataFrame:
    """All registry rows of one table, each valid from its ``date_change``."""
    if not store.table_exists(spark, registry_root):
        return spark.createDataFrame([], REGISTRY)
    return store.read_table(spark, registry_root).where(F.col("table_name") == table)


def check_growth(
    declared: Sequence[tuple[str, str]], registered: Sequence[tuple[str, str]], table: str
) -> list[str]:
    """Added columns of one table; fails where the schema did anything but grow at its end."""
    if len(declared) < len(registered):
        raise ValueError(f"{table}: delivered schema lost columns")
    for pos, (new, old) in enumerate(zip(declared, registered)):
        if new != old:
            raise ValueError(f"{table}: column {pos} was {old} and is now {new}")
    return [name for name, _ in declared[len(registered) :]] if registered else []


def run_load(
    spark: SparkSession,
    job: LoadJob,
    history: str,
    etl_date: str,
    root: str,
    registry: DataFrame | None = None,
    registry_root: str | None = None,
) -> LoadResult:
    """Load one archived delivery.

    Reads the declared count and schema, compares the schema with the registry, casts the
    rows and counts them; a count that is not the declared one is an error and leaves the target as
    it was. So is a row whose key does not fit its type; elsewhere such a value becomes NULL, with a warning. Then the
    target is brought to its next state. A merge takes any count, and warns where the rows it
    inserted or updated are not as many as declared.

    A registry kept at ``registry_root`` is looked up as of the delivery's day, so an old day is loaded again under its own
    schema (columns that came later are NULL), and gets the delivery's new columns once the load has succeeded.
    """
    paths = landing.history_paths(history, etl_date, job.system_id, job.name)
    issues: list[tuple[str, str, str]] = []

    def warn(kind: str, text: str, level: str = WARNING) -> None:
        issues.append((kind, level, text))

    def result(status: str, loaded: int) -> LoadResult:
        return LoadResult(expected_rows, loaded, status, tuple(text for *_, text in issues), tuple(columns), tuple(issues))

    end = spark.read.text(paths["end"], wholetext=True)
    expected = end.select(landing.expected_count("value").alias("n")).first()
    expected_rows = -1 if expected is None else expected.n
    ddl = spark.read.text(paths["sql"], wholetext=True)
    declared = schema.extract_schema(ddl).orderBy("pos").collect()
    if not declared:
        raise ValueError(f"{job.table}: the declaration names no column")
    columns = [(row.column_name, row.column_type) for row in declared]
    exists = store.table_exists(spark, root)
    known = None
    if registry_root:
        known = stored_registry(spark, registry_root, job.table)
        delivered = spark.createDataFrame([(job.table, etl_date)], "table_name string, etl_date string")
        registry = schema.registry_as_of(known, delivered)
    registered = registered_columns(registry, job.table)
    added = check_growth(columns, registered, job.table)
    if added:
        warn("columns_added", "columns added: " + ", ".join(added))
    if registry is not None and not registered and exists and (known is None or known.isEmpty()):
        raise ValueError(f"{job.table} is not registered but its target exists")

    text_schema = schema.spark_schema([(n, "varchar2", None) for n, _ in columns])
    rows = landing.read_landing(spark, paths["txt"], text_schema, corrupt=True)
    typed = schema.cast_to_target(rows, columns, job.type_names, failed=FAILED)
    day = F.expr(job.day).cast("string") if job.day else etl_date
    for row in declared:
        if row.comment:
            typed = typed.withMetadata(row.column_name, {"comment": row.comment})

    # the text is parsed and its rows numbered only once, whatever is read from them below
    delivery = f"{root}/delivery"
    staged = loads.with_audit(typed, job.system_id, day)
    store.write_target(staged, delivery, mode="overwrite")
    staged = spark.read.schema(staged.schema).orc(delivery)
    key = [row.column_name for row in declared if row.is_key]
    keyed = F.arrays_overlap(FAILED, F.array(*[F.lit(name) for name in {*key, *job.keys}]).cast("array<string>"))
    found = staged.agg(
        F.count("*").alias("n"), F.count_if(F.size(FAILED) > 0).alias("bad"), F.count(landing.CORRUPT).alias("odd"),
        F.count_if(keyed).alias("keyless"),
    ).first()
    src = staged.drop(FAILED, landing.CORRUPT)
    if known is not None and exists:
        held = store.read_table(spark, root)
        src = schema.evolve_add_columns(src, [f for f in held.schema.fields if f.name != PARTITION])
    loaded = found.n
    if found.bad:
        warn("bad_values", f"{found.bad} rows hold values that do not fit their type")
    if found.odd:
        warn("odd_lines", f"{found.odd} lines have another number of fields")
    if job.load_type in ("merge", "update") and list(job.keys) != key:
        warn("other_key", f"load key {list(job.keys)} is not the declared key {key}")
    if found.keyless:
        warn("bad_keys", f"{found.keyless} rows have no key of its type", ledger.ERROR)
    if found.keyless or job.load_type != "merge" and loaded != expected_rows:
        # nothing is changed by a delivery that is not whole
        files.delete(spark, delivery)
        return result("error", loaded)

    if job.load_type == "merge":
        schema.require_unique(src, job.keys)
        if exists:
            newer = store.read_table(spark, root).where(F.col(loads.ETL_DATE) > etl_date)
            loaded -= keyed_join(src, newer.select(*job.keys), job.keys, "left_semi").count()
    size_mb = files.total_bytes(spark, paths["txt"]) / 1024 / 1024 / layout.COMPRESSION_RATIO
    by_day = exists and BOUNDS in store.pointer(spark, root).get("notes", {})
    if job.load_type == "add" and not exists:
        _first_days(job, src, etl_date, root, size_mb)
    elif job.load_type == "add":
        _append_days(job, src, etl_date, root, size_mb)
    elif not exists:
        store.publish(src, root, n_files=int(size_mb // job.bucket_mb) + 1)
    elif job.load_type == "update" and by_day:
        _update_days(job, src, etl_date, root, size_mb)
    else:
        tgt = _wide_enough(store.read_table(spark, root), src).select(*src.columns)
        state = loads.apply_load(src, tgt, job.load_type, etl_date, job.keys, partitioned=by_day)
        if by_day:
            bounds = _bounds_for(job, etl_date, root, size_mb, spark)
            store.publish(_labelled(state, bounds), root, [PARTITION], notes={BOUNDS: bounds})
        else:
            store.publish(state, root)
    if known is not None and len(columns) > len(registered):
        new = [(job.table, pos, *column, etl_date) for pos, column in enumerate(columns) if pos >= len(registered)]
        store.append(spark.createDataFrame(new, REGISTRY), registry_root)
    files.delete(spark, delivery)
    if loaded != expected_rows:
        warn("other_count", f"declared {expected_rows} rows, loaded {loaded}")
    return result("success", loaded)


def _wide_enough(tgt: DataFrame, src: DataFrame) -> DataFrame:
    """The target with the columns the delivery has appended."""
    return schema.evolve_add_columns(tgt, src.schema.fields)


def _first_days(
    job: LoadJob, src: DataFrame, etl_date: str, root: str, size_mb: float
) -> None:
    """Create the day-partitioned target: pack its days, keep the bounds, write once."""
    spark = src.sparkSession
    histogram = layout.day_histogram(src, loads.ETL_DATE)
    days = histogram.count()
    span_mb = min(
        size_mb / max(days, 1) * layout.PARTITION_DAYS, float(layout.MAX_BUCKETS * job.bucket_mb)
    )
    bounds = layout.packed_bounds(layout.pack_day_partitions(histogram, size_mb, span_mb))
    if not bounds:  # an empty first delivery
        day = replaced_day(etl_date, "T-2")
        bounds = [(f"partition_{day}", (day,))]
    store.publish(_labelled(src, bounds), root, [PARTITION], notes={BOUNDS: bounds})


def _bounds_for(
    job: LoadJob, etl_date: str, root: str, size_mb: float, spark: SparkSession
) -> list[tuple]:
    """Bounds of a day-partitioned target; a day past the newest opens a partition.

    They count once they are published with the rows that need them."""
    notes = store.pointer(spark, root).get("notes", {})
    if BOUNDS not in notes:
        raise ValueError(f"{job.table} is not partitioned by day")
    bounds = [(name, tuple(upper)) for name, upper in notes[BOUNDS]]
    name, (end,) = bounds[-1]
    if etl_date < end:
        return bounds
    start = bounds[-2][1][0] if len(bounds) > 1 else layout.MINVALUE
    newest = f"{store.current_path(spark, root)}/{PARTITION}={name}"
    stats = spark.range(1).select(
        F.lit(start).alias("newest_start"),
        F.lit(end).alias("newest_end"),
        F.lit(files.total_bytes(spark, newest) / 1024 / 1024).alias("newest_mb"),
        F.lit(layout.MAX_BUCKETS).alias("bucket_number"),
    )
    bound = layout.next_partition_bound(stats, etl_date, size_mb, job.bucket_mb).first()
    bounds.append((f"partition_{etl_date}", (bound.next_bound,)))
    return bounds


def _labelled(df: DataFrame, bounds: Sequence[tuple]) -> DataFrame:
    inside = layout.assign_range_partition(df, [loads.ETL_DATE], bounds, PARTITION)
    outside = F.raise_error(F.concat(F.lit("no partition for day "), F.col(loads.ETL_DATE)))
    return inside.withColumn(PARTITION, F.coalesce(PARTITION, outside.cast("string")))


def _append_days(
    job: LoadJob, src: DataFrame, etl_date: str, root: str, size_mb: float
) -> None:
    """Append to a day-partitioned target, rewriting only partitions that lose or gain rows."""
    spark = src.sparkSession
    store.finish_swap(spark, root)
    bounds = _bounds_for(job, etl_date, root, size_mb, spark)
    gone = replaced_day(etl_date, job.def_etl_date)
    home = next((name for name, (upper,) in bounds if gone < upper), None)
    new = _labelled(src, bounds)
    gaining = new.select(PARTITION).distinct().collect()
    touched = sorted({row[PARTITION] for row in gaining} | ({home} if home else set()))
    held = store.read_table(spark, root).where(F.col(PARTITION).isin(touched))
    held = _wide_enough(held, new).select(*new.columns)
    state = loads.load_add(new, held, loads.ETL_DATE, etl_date, job.def_etl_date)
    cleared = spark.createDataFrame([(name,) for name in touched], f"{PARTITION} string")
    store.replace_partitions(state, root, [PARTITION], cleared=cleared, notes={BOUNDS: bounds})


def _update_days(
    job: LoadJob, src: DataFrame, etl_date: str, root: str, size_mb: float
) -> None:
    """Keyed update of a day-partitioned target: only partitions that hold a delivered key or
    gain rows are rewritten."""
    spark = src.sparkSession
    store.finish_swap(spark, root)
    bounds = _bounds_for(job, etl_date, root, size_mb, spark)
    new = _labelled(src, bounds)
    tgt = _wide_enough(store.read_table(spark, root), new).select(*new.columns)
    keys = list(job.keys)
    losing = keyed_join(tgt, new.select(*keys), keys, "left_semi")
    touched = losing.select(PARTITION).unionByName(new.select(PARTITION)).distinct()
    held = listed_join(tgt, touched, [PARTITION], "left_semi")
    state = loads.load_update(new, held, keys)
    store.replace_partitions(state, root, [PARTITION], cleared=touched, notes={BOUNDS: bounds})


# Fixed value: characters of a message that the job log keeps.
INFO_LIMIT = 5000

LOG_SCHEMA = (
    "id string, batch_id string, job_id string, task_status string, table_name string, "
    "etl_date string, src_count long, tar_count long, event_time timestamp_ntz, job_info string"
)


WARN_SCHEMA = (
    "warn_id string, run_id string, warn_type string, warn_level string, warn_info string, table_name string, "
    "etl_date string, warn_time timestamp_ntz"
)


def open_runs(log: DataFrame, table: str, etl_date: str) -> DataFrame:
    """Runs of a table and day that have started and not ended."""
    day = log.where((F.col("table_name") == table) & (F.col("etl_date") == etl_date))
    return ledger.runs_by_id(day, "id", "event_time", "task_status").where("end_time is null")


def run_logged(
    spark: SparkSession,
    job: LoadJob,
    history: str,
    etl_date: str,
    root: str,
    log_root: str,
    batch_id: str,
    registry: DataFrame | None = None,
    second_try: bool = False,
    warn_root: str | None = None,
) -> LoadResult | None:
    """``run_load`` with its start and end appended to a job log, and its warnings to a table of their own.

    Does nothing while another run of the table and day is open. A failure is logged, as
    ``error1`` in the retry pass, and raised again.
    """
    exists = store.table_exists(spark, log_root)
    if exists and not open_runs(store.read_table(spark, log_root), job.table, etl_date).isEmpty():
        return None
    run_id = uuid.uuid4().hex

    def log(status: str, expected: int = -1, loaded: int = 0, info: str = "") -> None:
        row = (run_id, batch_id, job.name, status, job.table, etl_date, expected, loaded,
               datetime.now(timezone.utc).replace(tzinfo=None), info[:INFO_LIMIT])
        store.append(spark.createDataFrame([row], LOG_SCHEMA), log_root)

    failed = ledger.ERROR_AGAIN if second_try else ledger.ERROR
    log(ledger.RUNNING)
    try:
        result = run_load(spark, job, history, etl_date, root, registry)
    except Exception as error:
        log(failed, info=str(error))
        raise
    status = ledger.SUCCESS if result.status == "success" else failed
    if warn_root and result.issues:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = [(uuid.uuid4().hex, run_id, *issue, job.table, etl_date, now) for issue in result.issues]
        store.append(spark.createDataFrame(rows, WARN_SCHEMA), warn_root)
    log(status, result.expected, result.loaded, "; ".join(result.warnings))
    return result
