"""Column helpers shared by the operators. Days are ``yyyyMMdd`` strings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FORMAT = "yyyyMMdd"


def as_column(value: str | Column) -> Column:
    """A column as is; text is taken as a SQL expression."""
    return value if isinstance(value, Column) else F.expr(value)


def day_of(col: str | Column) -> Column:
    """Date or timestamp to its day string."""
    return F.date_format(as_column(col), DAY_FORMAT)


def parse_day(col: str | Column) -> Column:
    """Day string to date; NULL where the text is not a calendar day."""
    return F.try_to_date(as_column(col), DAY_FORMAT)


def shift_day(col: str | Column, days: int | Column) -> Column:
    """Day string moved by a number of days."""
    return F.date_format(F.date_add(parse_day(col), days), DAY_FORMAT)


def is_true(condition: str | Column) -> Column:
    """A predicate with NULL counted as false."""
    return F.coalesce(as_column(condition), F.lit(False))


def replaced_day(etl_date: str, def_etl_date: str | None = None) -> str:
    """The day a daily append replaces: ``etl_date``, or n-1 days earlier for ``T-n``."""
    if not def_etl_date or not def_etl_date.strip():
        return etl_date
    back = int(def_etl_date.strip()[2:].strip()) - 1
    return (datetime.strptime(etl_date, "%Y%m%d") - timedelta(days=back)).strftime("%Y%m%d")


def join_fields(df: DataFrame, sep: str, compat: bool = False) -> Column:
    """All columns of a row as one line.

    NULL becomes an empty field, so every line keeps its field count. With
    ``compat`` NULL fields are left out altogether, as ``concat_ws`` does.
    """
    fields = [F.col(f"`{name}`").cast("string") for name in df.columns]
    if not compat:
        fields = [F.coalesce(field, F.lit("")) for field in fields]
    return F.concat_ws(sep, *fields)
