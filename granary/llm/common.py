"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from granary.sources.files import shared_dir

#: Lower-cases A-Z and turns every byte outside 0-9, a-z and non-ASCII into a space.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
#: Every ASCII white-space byte (9 to 13 and 32) to a space, A-Z to lower case; 28 to 31 stay letters.
SPACE_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 32 or 9 <= c <= 13 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for a null id, so that no fold holds it."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts, F.lit(-1))


def rounds(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # the worker stays for later tasks


def extended(docs: DataFrame, ddl: str) -> tuple[DataFrame, StructType]:
    """The rows without columns that clash with the new ones of ``ddl``, and the schema with both."""
    new = StructType.fromDDL(ddl)
    kept = docs.drop(*new.fieldNames())
    return kept, StructType([*kept.schema.fields, *new.fields])


def numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with its columns named by position, so that no name matters."""
    return pa.RecordBatch.from_arrays(batch.columns, [str(i) for i in range(batch.num_columns)])


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the folder that all executors share and read back from there."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
