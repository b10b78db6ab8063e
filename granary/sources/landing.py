"""Landing deliveries: ``<name>.txt`` rows, ``<name>.SQL`` declaration, ``<name>.END`` count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.columns import as_column
from granary.operators.skew import keyed_join
from granary.sources import files

SEPARATOR = "#&"
CORRUPT = "_corrupt_record"

# Fixed values: <root>/<day>/<SYSTEM>/<name>.<kind>, in history one or two directories deeper,
# of which the inner one is then called data.
DELIVERED = r"/\d{8}/[^/]+/(?:[^/]+/(?:data/)?)?[^/]+\.(?:txt|SQL|END)$"


def landing_options(sep: str = SEPARATOR, encoding: str = "UTF-8") -> dict[str, str]:
    """Reader options of delivered text; quotes are ordinary characters."""
    return {
        "sep": sep,
        "encoding": encoding,
        "quote": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def read_landing(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    sep: str = SEPARATOR,
    encoding: str = "UTF-8",
    corrupt: bool = False,
) -> DataFrame:
    """Delimited text under a declared schema. An empty field reads as NULL.

    With ``corrupt`` lines of the wrong shape are kept whole in ``_corrupt_record``.
    """
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(**landing_options(sep, encoding))
    return reader.csv(path if isinstance(path, str) else list(path))


def bundle_files(listing: DataFrame) -> DataFrame:
    """Delivery day, system, name and kind of each listed file; other files are dropped.

    The day is the outermost directory that can be it, which is the leftmost match.
    """
    parts = F.split("_own", "/")
    file = F.element_at(parts, -1)
    kind = F.substring_index(file, ".", -1)
    found = listing.withColumn("_own", F.regexp_extract("path", DELIVERED, 0)).where("_own <> ''")
    return found.select(
        *listing.columns,
        F.element_at(parts, 2).alias("etl_date"),
        F.element_at(parts, 3).alias("system_id"),
        F.substring(file, F.lit(1), F.length(file) - 1 - F.length(kind)).alias("name"),
        kind.alias("kind"),
    )


def landing_manifest(current: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """State of every delivery from the file listings.

    A delivery is ``ready`` once its END, SQL and TXT are there, and ``ready_history`` when
    END is missing but was archived before. Otherwise the state names what is missing.
    """
    keys = ["etl_date", "system_id", "name"]
    seen = bundle_files(current.select("path")).withColumn("archived", F.lit(False))
    if history is not None:
        seen = seen.unionByName(
            bundle_files(history.select("path")).withColumn("archived", F.lit(True))
        )

    def has(kind: str, archived: bool = False) -> Column:
        here = (F.col("kind") == kind) & (F.col("archived") == F.lit(archived))
        return F.coalesce(F.bool_or(here), F.lit(False))

    return (
        seen.groupBy(*keys)
        .agg(
            has("END").alias("has_end"),
            has("SQL").alias("has_sql"),
            has("txt").alias("has_txt"),
            has("END", archived=True).alias("in_history"),
        )
        .withColumn(
            "status",
            F.when(~F.col("has_end") & F.col("in_history"), "ready_history")
            .when(~F.col("has_end"), "no_end")
            .when(~F.col("has_sql"), "no_sql")
            .when(~F.col("has_txt"), "no_txt")
            .otherwise("ready"),
        )
    )


def expected_count(text: str | Column) -> Column:
    """Row count an END file declares; -1 when it is blank, NULL when it is no number."""
    digits = F.trim(F.regexp_replace(as_column(text), r"[\r\n]", ""))
    return F.when(digits == "", F.lit(-1)).otherwise(digits.try_cast("int"))


def whole_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Small text files below a root, one row each."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.text(root, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def read_expected_counts(spark: SparkSession, root: str) -> DataFrame:
    """Declared row count of every delivery below a root."""
    listing = files.list_files(spark, root, "*.END")
    blank = listing.where("length = 0").select("path", F.lit("").alias("value"))
    ends = whole_files(spark, root, "*.END").unionByName(blank)
    return bundle_files(ends).select(
        "etl_date", "system_id", "name", expected_count("value").alias("expected")
    )


def read_declarations(spark: SparkSession, root: str) -> DataFrame:
    """Text of every declaration below a root, for ``schema.extract_schema``."""
    scripts = whole_files(spark, root, "*.SQL")
    return bundle_files(scripts).select("etl_date", "system_id", "name", "value")


def archive_landing(spark: SparkSession, ready: DataFrame, current: str, history: str) -> int:
    """Move each ready delivery's files to history, replacing an older copy.

    Moves are renames in the file system's catalog; no data passes through Spark. The END
    file goes last, so an interrupted move leaves the delivery to be picked up again.
    """
    moved = 0
    rows = ready.where("status = 'ready'").select("etl_date", "system_id", "name")
    for row in rows.collect():  # one row per delivery, fetched before anything moves
        source = f"{current}/{row.etl_date}/{row.system_id}/{row.name}"
        target = f"{history}/{row.etl_date}/{row.system_id}/{row.name}"
        files.move(spark, f"{source}.txt", f"{target}/data/{row.name}.txt")
        files.move(spark, f"{source}.SQL", f"{target}/{row.name}.SQL")
        files.move(spark, f"{source}.END", f"{target}/{row.name}.END")
        moved += 1
    return moved


DELIVERY = ["etl_date", "system_id", "name"]


def archive_deliveries(spark: SparkSession, ready: DataFrame, current: str, archive: str) -> None:
    """Copy the lines of ready deliveries to dated archive partitions, then write a receipt for each.

    Tasks read and write the lines; a partition is replaced as a whole, so a repeated run or task changes nothing.
    A delivery is archived once its receipt is there: its declared count and declaration, the lines found in the
    archive and their digest, which does not depend on their order.
    """
    keys = ready.where("status = 'ready'").select(*DELIVERY)

    def files_of(pattern: str) -> DataFrame:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        found = bundle_files(reader.load(current).select("path", F.col("_metadata.file_path").alias("file")))
        return found.join(keys, DELIVERY, "left_semi").select("file", *DELIVERY)

    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(current)
    lines = text.select("value", F.col("_metadata.file_path").alias("file"))
    wanted = keyed_join(lines, files_of("*.txt"), ["file"], "inner").select("value", *DELIVERY)
    writer = wanted.hint("rebalance", *DELIVERY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*DELIVERY).orc(f"{archive}/lines")
    held = archived_lines(spark, archive).join(keys, DELIVERY, "left_semi").groupBy(*DELIVERY)
    counts = held.agg(F.count("*").alias("lines"), content_digest("value"))
    ends = read_expected_counts(spark, current)
    scripts = read_declarations(spark, current).withColumnRenamed("value", "declaration")
    receipts = keys.join(ends, DELIVERY).join(scripts, DELIVERY).join(counts, DELIVERY, "left").fillna(0, ["lines"])
    receipts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*DELIVERY).orc(f"{archive}/receipts")


def archived_lines(spark: SparkSession, archive: str) -> DataFrame:
    return spark.read.schema("value string, etl_date string, system_id string, name string").orc(f"{archive}/lines")


def archive_receipts(spark: SparkSession, archive: str) -> DataFrame:
    """One row for each archived delivery."""
    schema = "expected int, declaration string, lines long, digest decimal(38,0), etl_date string, system_id string, name string"
    return spark.read.schema(schema).orc(f"{archive}/receipts")


def content_digest(*columns: str) -> Column:
    """Sum of row hashes: equal for equal rows in any order and any split, and of parts the sum."""
    return F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest")


def verify_content(sent: DataFrame, received: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare the rows of two trees by ``keys``, a file's name or the like: ``ok``, ``missing``, ``extra``, ``rows_differ``
    or ``content_differs``.

    The trees may be cut, ordered, encoded and compressed in other ways. Each side is one pass; what is joined are counts and
    digests.
    """
    keys = list(keys)

    def summed(df: DataFrame, side: str) -> DataFrame:
        content = [c for c in df.columns if c not in keys]
        counted = df.groupBy(*keys).agg(F.count("*").alias("rows"), content_digest(*content))
        return counted.withColumnsRenamed({"rows": f"{side}_rows", "digest": f"{side}_digest"})

    left, right = summed(sent, "sent"), summed(received, "received")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in keys]
    joined = left.join(renamed, same, "full")
    status = (
        F.when(F.col("received_rows").isNull(), "missing")
        .when(F.col("sent_rows").isNull(), "extra")
        .when(F.col("sent_rows") != F.col("received_rows"), "rows_differ")
        .when(F.col("sent_digest") != F.col("received_digest"), "content_differs")
        .otherwise("ok")
    )
    here = F.col("sent_rows").isNotNull()
    named = [F.when(here, F.col(f"`{k}`")).otherwise(F.col(f"`_right_{k}`")).alias(k) for k in keys]
    return joined.select(*named, "sent_rows", "received_rows", status.alias("status"))


def history_paths(history: str, etl_date: str, system_id: str, name: str) -> dict[str, str]:
    """Where an archived delivery's files are."""
    base = f"{history}/{etl_date}/{system_id}/{name}"
    return {
        "txt": f"{base}/data/{name}.txt",
        "sql": f"{base}/{name}.SQL",
        "end": f"{base}/{name}.END",
    }


def transcode_text(
    spark: SparkSession, src: str, dst: str, from_charset: str, to_charset: str = "UTF-8"
) -> None:
    """Copy lines while changing their encoding.

    Works for charsets that keep the ASCII line feed. Charsets beyond Spark's default list
    need ``spark.sql.legacy.javaCharsets``.
    """
    raw = spark.read.text(src).select(F.col("value").cast("binary").alias("raw"))
    text = F.decode("raw", from_charset)
    if to_charset.upper() != "UTF-8":
        text = F.encode(text, to_charset).cast("string")
    raw.select(text.alias("value")).write.mode("overwrite").text(dst)


def verify_transfer(sent: DataFrame, received: DataFrame, checksum: bool = False) -> DataFrame:
    """Compare two listings by relative path: ``ok``, ``missing``, ``extra``, ``size_differs``
    or, with ``checksum``, ``content_differs``."""
    columns = ["length", "md5"] if checksum else ["length"]
    left = sent.select("path", *[F.col(c).alias(f"sent_{c}") for c in columns])
    right = received.select("path", *[F.col(c).alias(f"received_{c}") for c in columns])
    status = (
        F.when(F.col("received_length").isNull(), "missing")
        .when(F.col("sent_length").isNull(), "extra")
        .when(F.col("sent_length") != F.col("received_length"), "size_differs")
    )
    if checksum:
        status = status.when(F.col("sent_md5") != F.col("received_md5"), "content_differs")
    return left.join(right, "path", "full").withColumn("status", status.otherwise("ok"))
