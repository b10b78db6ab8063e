"""Retention of landing, history and export directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from granary.operators import retention
from granary.sources import files


def drop_expired(
    spark: SparkSession, roots: Sequence[str], keep_n: int = retention.KEEP
) -> list[str]:
    """Delete the entries of each root beyond its newest ``keep_n``."""
    expired = retention.expired_entries(files.list_entries(spark, roots), keep_n)
    dropped = [row.path for row in expired.select("path").toLocalIterator()]
    for path in dropped:
        files.delete(spark, path)
    return dropped
