"""Availability: which intervals of a span have rows, and how many.

A table that is delivered every day (or hour, week, month) should have rows for each
interval of a span of recent days.  The span is a calendar generated in the plan, so
intervals without a single row are found: one scan of the table, cut to the span by a
condition that prunes partitions, one map-side combined count per interval, and a left
join of the calendar with these counts (both as many rows as intervals).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.dates import date_between, expected_date

#: Interval units and the format in which an interval is shown.
UNITS = {"hours": "yyyy-MM-dd HH:00", "days": "yyyy-MM-dd", "weeks": "yyyy-MM-dd", "months": "yyyy-MM"}


def availability(
    df: DataFrame,
    date_column: str,
    until: str | int = "days:-8",
    latest: str | int = "days:-1",
    unit: str = "days",
    as_of=None,
    database: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """One row per interval of the days ``as_of + until`` to ``as_of + latest``, both included:
    database, table, date_column, interval (text), count_data, available (any rows).

    ``unit`` is hours, days, weeks (from Monday) or months; the first and last week or month
    are counted as far as they lie in the span.  Text dates (``yyyy-MM-dd``) have days at
    best: hours need a timestamp.  Rows with a NULL date or outside the span count nowhere; a
    span that ends before it begins has no intervals.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}, not {unit!r}")
    first, after = expected_date(as_of, until), F.date_add(expected_date(as_of, latest), 1)
    dtype = df.select(F.col("`" + date_column.replace("`", "``") + "`")).schema[0].dataType
    if unit == "hours" and not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"hours need a timestamp; {date_column!r} is {dtype.simpleString()}")
    one = unit[:-1]
    start = lambda c: F.date_trunc(one, c.cast("timestamp_ntz"))
    counts = (
        df.where(date_between(df, date_column, first, after))
        .groupBy(start(F.col("`" + date_column.replace("`", "``") + "`")).alias("_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    last = F.expr(f"INTERVAL 1 {one}")
    calendar = df.sparkSession.range(1).select(
        first.cast("timestamp_ntz").alias("_first"), after.cast("timestamp_ntz").alias("_after")
    )
    steps = F.sequence(start(F.col("_first")), F.col("_after") - F.expr("INTERVAL 1 SECOND"), last)
    calendar = calendar.select(F.explode(F.when(F.col("_first") < F.col("_after"), steps)).alias("_at"))
    return calendar.join(counts, "_at", "left").select(
        F.lit(database).cast("string").alias("database"),
        F.lit(table).cast("string").alias("table"),
        F.lit(date_column).alias("date_column"),
        F.date_format("_at", UNITS[unit]).alias("interval"),
        F.coalesce("_n", F.lit(0)).alias("count_data"),
        F.col("_n").isNotNull().alias("available"),
    )


def missing_intervals(available: DataFrame) -> DataFrame:
    """The intervals of :func:`availability` that have no rows."""
    return available.where("NOT available").drop("count_data", "available")
