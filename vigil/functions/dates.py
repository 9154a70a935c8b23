"""Expected-delivery dates.

Catalogs write a delivery offset as ``"<unit>:<n>"``, e.g. ``"days:-1"`` for
"yesterday's data".  Only ``days`` is defined; anything else is rejected
rather than silently read as days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_offset(spec: str | int) -> int:
    """``"days:-1"`` -> -1.  A bare integer is taken as days."""
    if isinstance(spec, int):
        return spec
    text = str(spec).strip()
    if ":" not in text:
        return int(text)
    unit, _, n = text.partition(":")
    if unit.strip().lower() != "days":
        raise ValueError(f"unsupported delivery offset unit {unit!r} in {spec!r}; only 'days'")
    return int(n.strip())


def as_of_column(as_of: str | _dt.date | Column | None) -> Column:
    """The run date as a DateType Column; ``None`` means the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.to_date(F.lit(str(as_of)))


def expected_date(as_of=None, offset: str | int = 0) -> Column:
    """``as_of + n days`` as a DateType Column."""
    return F.date_add(as_of_column(as_of), parse_offset(offset))


def date_between(df: DataFrame, column: str, first: Column, after: Column) -> Column:
    """TRUE for rows whose date lies in [``first``, ``after``), two dates.

    The column itself is compared with constants, never wrapped in a function, so the
    condition prunes partitions of a date column and is pushed to the files of any:

    * DATE: the dates themselves;
    * TIMESTAMP / TIMESTAMP_NTZ: the two midnights;
    * STRING: the dates as ``yyyy-MM-dd`` text, in which text order is date order.
    """
    c = F.col("`" + column.replace("`", "``") + "`")
    dtype = df.select(c).schema[0].dataType
    if isinstance(dtype, T.StringType):
        first, after = F.date_format(first, "yyyy-MM-dd"), F.date_format(after, "yyyy-MM-dd")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        first, after = first.cast(dtype), after.cast(dtype)
    elif not isinstance(dtype, T.DateType):
        raise TypeError(f"date column {column!r} has type {dtype.simpleString()}; need date, timestamp or string")
    return (c >= first) & (c < after)


def checked_day(df: DataFrame, column: str, offset: str | int = 0, as_of=None) -> Column:
    """TRUE for rows dated on the day ``as_of + offset``; see :func:`date_between`."""
    day = expected_date(as_of, offset)
    return date_between(df, column, day, F.date_add(day, 1))
