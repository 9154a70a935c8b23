"""Timeliness: share of rows delivered for the expected date.

The expected date is ``as_of + offset days`` (``"days:-1"`` = yesterday).  It
is a Column, so a run date of ``None`` is the session's ``current_date()``
evaluated inside the plan, and tests pin it with ``as_of``.

How a row's date is compared depends on the column type, decided when the
plan is built:

* DATE: equality;
* TIMESTAMP / TIMESTAMP_NTZ: its calendar day (``to_date``), so a timestamp
  column matches for the whole day, not only at midnight;
* STRING: equality with the ``yyyy-MM-dd`` text, as written in the catalog's
  date format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.dates import expected_date


def _day_matches(df: DataFrame, column: str, expected: Column) -> Column:
    c = F.col("`" + column.replace("`", "``") + "`")
    dtype = df.select(c).schema[0].dataType
    if isinstance(dtype, T.DateType):
        return c == expected
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c) == expected
    if isinstance(dtype, T.StringType):
        return c == F.date_format(expected, "yyyy-MM-dd")
    raise TypeError(f"timeliness column {column!r} has type {dtype.simpleString()}; need date, timestamp or string")


def timeliness(
    df: DataFrame,
    date_column: str,
    offset: str | int = "days:-1",
    as_of=None,
    database: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """One row: database, table, date_column, expected_date, count_data,
    count_timely, timeliness_pct (NULL for an empty table).

    One aggregate pass; the percentage is ``count_timely / count_data * 100``.
    """
    exp = expected_date(as_of, offset)
    agg = df.agg(
        F.count(F.lit(1)).alias("count_data"),
        F.count_if(_day_matches(df, date_column, exp)).alias("count_timely"),
    )
    return agg.select(
        F.lit(database).cast("string").alias("database"),
        F.lit(table).cast("string").alias("table"),
        F.lit(date_column).alias("date_column"),
        F.date_format(exp, "yyyy-MM-dd").alias("expected_date"),
        F.col("count_data"),
        F.col("count_timely"),
        (F.try_divide(F.col("count_timely"), F.col("count_data")) * 100).cast("double").alias("timeliness_pct"),
    )


def on_time_rows(df: DataFrame, date_column: str, offset: str | int = "days:-1", as_of=None) -> DataFrame:
    """The rows dated on the expected day."""
    return df.filter(_day_matches(df, date_column, expected_date(as_of, offset)))
