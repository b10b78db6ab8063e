"""Deliveries picked up as they arrive, with Structured Streaming's file source.

The checkpoint records which files were seen, so each is handled once; a batch that is
re-run after a failure carries the same id, which the sinks below rely on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from granary.sources.files import exists as files_exist, list_files
from granary.sources.landing import SEPARATOR, bundle_files, expected_count, landing_options

BATCH = "batch_id"


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = SEPARATOR,
    pattern: str = "*.txt",
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Rows of text files as they arrive below a path.

    ``archive`` moves files away some time after they were handled; it is housekeeping and
    says nothing about whether a delivery is ready.
    """
    reader = (
        spark.readStream.schema(schema)
        .options(**landing_options(sep))
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path)


def stream_ready(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """One row per delivery whose END file has arrived, with its declared count."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", "*.END")
        .option("recursiveFileLookup", "true")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    ends = reader.load(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return bundle_files(ends).select(
        "path", "etl_date", "system_id", "name", expected_count("value").alias("expected")
    )


def run_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Handle everything that has arrived by now, in as many batches as limits ask for.

    States of deliveries are rows of the mode ``update``."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that writes each batch under its id; a re-run replaces it."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn(BATCH, F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .orc(path)
        )

    return handle


KINDS = ("END", "SQL", "txt")
STATE_PARTITIONS = 8  # a key's state is a few paths, so few partitions hold many deliveries
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
DELIVERY = "etl_date string, system_id string, name string, status string, " + ", ".join(f"`{k}` string" for k in KINDS)


def note_blank_ends(spark: SparkSession, path: str, notes: str) -> None:
    """Name END files of zero bytes, which no file stream reports, in files that one does.

    Files noted before are left out; an END noted twice changes nothing.
    """
    blank = list_files(spark, path, "*.END").where("length = 0").select(F.col("path").alias("value"))
    if files_exist(spark, notes):
        blank = blank.join(spark.read.text(notes), "value", "left_anti")
    blank.repartition(1).write.mode("append").text(notes)  # names of files


def delivery_step(
    patience_ms: int,
) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """What a delivery's state becomes with the files that arrived for it."""

    def row(key: tuple, status: str, paths: tuple) -> pd.DataFrame:
        return pd.DataFrame([(*key, status, *paths)], columns=["etl_date", "system_id", "name", "status", *KINDS])

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *paths, done = state.get if state.exists else (None, None, None, False)
        now = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            if done:  # its files will not come again
                state.remove()
                return
            state.setTimeoutTimestamp(now + patience_ms)
            yield row(key, "late", tuple(paths))
            return
        for frame in frames:
            now = max(now, int(frame["millis"].max()))
            for kind, path in zip(frame["kind"], frame["path"], strict=True):
                paths[KINDS.index(kind)] = paths[KINDS.index(kind)] or path
        whole = all(paths)
        status = "repeated" if done else "ready" if whole else "waiting"
        state.update((*paths, whole))
        state.setTimeoutTimestamp(now + patience_ms)
        yield row(key, status, tuple(paths))

    return step


def stream_deliveries(
    spark: SparkSession, path: str, notes: str, patience: timedelta = timedelta(hours=1), files_per_batch: int | None = None
) -> DataFrame:
    """State of each delivery that a batch brings a file of, or that has waited for ``patience``.

    A delivery's state holds which of its three files have come. It is ``ready`` once, with the last of them;
    a file that comes again after that makes it ``repeated``, and while one is missing it is ``waiting`` or,
    after the time-out, ``late``. What was ready is forgotten after a time-out. Time is that of the batches in which
    files arrive, so a replay sees the same time, and old files are as good as new ones. Contents are not read.
    ``notes`` are those of ``note_blank_ends``.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", STATE_PARTITIONS)
    reader = own.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    noted = own.readStream.schema("value string").text(notes).select(F.col("value").alias("path"))
    arrived = bundle_files(reader.load(path).select("path").unionByName(noted))
    arrived = arrived.withColumn("at", F.current_timestamp()).withColumn("millis", F.unix_millis("at")).withWatermark("at", "0 seconds")
    state = ", ".join(f"`{k}` string" for k in KINDS) + ", done boolean"
    return arrived.groupBy("etl_date", "system_id", "name").applyInPandasWithState(
        delivery_step(int(patience.total_seconds() * 1000)), DELIVERY, state, "update", GroupStateTimeout.EventTimeTimeout
    )


def ready_rows(ready: DataFrame, schema: T.StructType, sep: str = SEPARATOR) -> DataFrame:
    """Rows of the ready deliveries of a batch, with their keys and declared count (-1 for a blank END).

    The paths, three for each delivery, come to the driver, as any scan's do.
    """
    spark = ready.sparkSession
    paths = ready.select("txt", "END").collect()
    keys = ["etl_date", "system_id", "name"]
    ends = spark.read.text([r.END for r in paths], wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    declared = bundle_files(ends).select(*keys, expected_count("value").alias("expected"))
    rows = spark.read.schema(schema).options(**landing_options(sep)).csv([r.txt for r in paths])
    file = rows.select("*", F.col("_metadata.file_path").alias("path"))
    named = bundle_files(file).select(*schema.names, *keys)
    listed = F.broadcast(declared)  # one row for each delivery of the batch
    return named.join(listed, keys, "left").fillna(-1, ["expected"])


def load_ready(
    receipts: str, load: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """Batch handler: loads what is ready and leaves a receipt for it.

    A delivery with a receipt of another batch is not loaded again, also where its state has been forgotten; a
    re-run of the same batch loads the same and writes the same receipts. Receipts belong to one checkpoint, whose
    batches have these numbers.
    """
    keys = ["etl_date", "system_id", "name"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ready = batch.where("status = 'ready'")
        if files_exist(spark, receipts):
            others = spark.read.schema(f"{DELIVERY}, {BATCH} long").orc(receipts).where(F.col(BATCH) != batch_id)
            ready = ready.join(others, keys, "left_anti")
        ready = ready.cache()
        try:
            if not ready.isEmpty():
                load(ready, batch_id)
                append_once(receipts)(ready, batch_id)
        finally:
            ready.unpersist()

    return handle
