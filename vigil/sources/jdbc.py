"""JDBC reads and appends, set up for parallelism.

A plain ``spark.read.jdbc(url, table)`` is a single task pulling the whole
table over one connection.  Reads here are split on a numeric, date or
timestamp column (``partitionColumn`` / ``lowerBound`` / ``upperBound`` /
``numPartitions``) or on explicit ``predicates``; when only the column is
known, it is cut into slices of equal row count by one query of the database.
Appends go out from every partition of the result with ``batchsize`` rows
per round trip.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Connections that a read or a write opens at once, unless told otherwise.
CONNECTIONS = 16

#: Catalog spellings of reader options -> Spark's option names.  Catalogs may set these alone:
#: where a read goes and with whose rights is the caller's to say.
_OPTION_ALIASES = {
    "fetch_size": "fetchsize",
    "fetchsize": "fetchsize",
    "partition_column": "partitionColumn",
    "partitionColumn": "partitionColumn",
    "lower_bound": "lowerBound",
    "lowerBound": "lowerBound",
    "upper_bound": "upperBound",
    "upperBound": "upperBound",
    "num_partitions": "numPartitions",
    "numPartitions": "numPartitions",
    "query_timeout": "queryTimeout",
    "queryTimeout": "queryTimeout",
}

#: Catalog keys that describe a connection in words but are not reader options.
_DESCRIPTIVE = {"type", "credentials_key"}

#: Options of a split read.
_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "predicates", "split")


def _flatten_catalog_options(catalog_options: dict | None) -> dict:
    """``read_conf: {options: {...}}`` and top-level keys -> Spark reader options.

    Raises for anything else than the options above: a catalog cannot name another ``url``,
    ``dbtable``, ``query`` or ``driver`` and so send the caller's credentials elsewhere.
    """
    out = {}
    if not catalog_options:
        return out
    nested = ((catalog_options.get("read_conf") or {}).get("options")) or {}
    flat = {k: v for k, v in catalog_options.items() if k not in ("read_conf",) and k not in _DESCRIPTIVE}
    for src in (flat, nested):
        for k, v in src.items():
            if k not in _OPTION_ALIASES:
                raise ValueError(f"a catalog may not set the reader option {k!r}; it may set {sorted(_OPTION_ALIASES)}")
            if v is not None:
                out[_OPTION_ALIASES[k]] = v
    return out


def reader_options(
    url: str,
    table: str,
    properties: dict | None = None,
    catalog_options: dict | None = None,
    fetchsize: int | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    predicates: list[str] | None = None,
    split: str | None = None,
) -> dict:
    """All options of one JDBC read as a dict (``predicates`` and ``split`` kept under those keys)."""
    opts = {"url": url, "dbtable": table}
    opts.update({k: v for k, v in (properties or {}).items() if v is not None})
    opts.update(_flatten_catalog_options(catalog_options))
    if fetchsize is not None:
        opts["fetchsize"] = fetchsize
    if partition_column is not None:
        opts["partitionColumn"] = partition_column
    if lower_bound is not None:
        opts["lowerBound"] = lower_bound
    if upper_bound is not None:
        opts["upperBound"] = upper_bound
    if num_partitions is not None:
        opts["numPartitions"] = num_partitions
    if predicates:
        opts["predicates"] = list(predicates)
    if split:
        opts["split"] = split
    return {k: (str(v) if k != "predicates" else v) for k, v in opts.items()}


def literal(value) -> str:
    """A value of a split column as SQL text."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"cannot split at {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def cuts_query(table: str, column: str, parts: int) -> str:
    """SQL for the database: the least value of each of ``parts`` slices of equal row count
    (a window function, so most databases can run it; ``parts`` rows come back)."""
    return (
        f"SELECT MIN(v) AS cut FROM (SELECT {column} AS v, NTILE({int(parts)}) OVER (ORDER BY {column}) AS slice "
        f"FROM {table} WHERE {column} IS NOT NULL) ranked GROUP BY slice"
    )


def equi_depth_predicates(column: str, cuts: list) -> list[str]:
    """One condition per slice between ``cuts``; together they hold every row once, NULLs with the
    first slice.  A value that fills several slices is one slice: a condition cannot split it."""
    points = sorted(set(cuts))[1:]  # the first slice begins below everything
    if not points:
        return []
    first = f"{column} < {literal(points[0])} OR {column} IS NULL"
    between = [f"{column} >= {literal(a)} AND {column} < {literal(b)}" for a, b in zip(points, points[1:])]
    return [first, *between, f"{column} >= {literal(points[-1])}"]


def split_column(schema: T.StructType) -> str | None:
    """The first column that rows can be split on: a whole number, a date or a timestamp."""
    kinds = (T.LongType, T.IntegerType, T.ShortType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return next((f.name for f in schema.fields if isinstance(f.dataType, kinds)), None)


def _load(spark: SparkSession, opts: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**opts).load()


def read(spark: SparkSession, opts: dict) -> DataFrame:
    """Load with :func:`reader_options`' result, over at most ``numPartitions`` (default
    :data:`CONNECTIONS`) connections.

    * ``predicates``: one task each.
    * ``partitionColumn`` with both bounds: Spark's equal strides.
    * ``partitionColumn`` alone: slices of equal row count, cut at quantiles that the
      database computes, so skewed columns are read evenly too.
    * neither: with ``split="auto"`` the first whole number, date or timestamp column is
      split that way; otherwise, or without such a column, one task reads the table.
    """
    plain = {k: v for k, v in opts.items() if k not in _SPLIT}
    predicates, column = opts.get("predicates"), opts.get("partitionColumn")
    if not predicates and column and "lowerBound" in opts and "upperBound" in opts:
        return _load(spark, {"numPartitions": str(CONNECTIONS), **{k: v for k, v in opts.items() if k != "split"}})
    if not predicates and column is None and opts.get("split") == "auto":
        column = split_column(_load(spark, plain).schema)
    if not predicates and column is not None:
        query = cuts_query(opts["dbtable"], column, int(opts.get("numPartitions", CONNECTIONS)))
        probe = _load(spark, {**{k: v for k, v in plain.items() if k != "dbtable"}, "query": query})
        predicates = equi_depth_predicates(column, [r[0] for r in probe.collect()])  # numPartitions rows
    if not predicates:  # nothing to split on, or an empty table
        return _load(spark, plain)
    url, table = plain.pop("url"), plain.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=predicates, properties=plain)


def columns(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> list[str]:
    return _load(spark, reader_options(url, table, properties)).columns


def transaction(spark: SparkSession, url: str, properties: dict | None, statements: list[str]) -> None:
    """Run the statements on one connection, all or none."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    driver = (properties or {}).get("driver")
    if driver:  # the driver itself: DriverManager does not see classes that were added to the session
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        made = jvm.java.lang.Class.forName(driver, True, loader).getDeclaredConstructor().newInstance()
        connection = made.connect(url, props)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, props)
    all_or_none(connection, statements)


def all_or_none(connection, statements: list[str]) -> None:
    """Execute on an open JDBC connection and close it; any failure rolls everything back."""
    try:
        connection.setAutoCommit(False)
        try:
            for sql in statements:
                statement = connection.createStatement()
                try:
                    statement.executeUpdate(sql)
                finally:
                    statement.close()
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def append(df: DataFrame, url: str, table: str, properties: dict | None = None, batchsize: int = 10_000,
           num_partitions: int | None = None, mode: str = "append") -> None:
    """``INSERT`` the rows of ``df`` into ``table`` (created if missing; ``mode="overwrite"``:
    emptied first).

    ``num_partitions`` (default :data:`CONNECTIONS`) caps concurrent connections; it is applied
    as a ``repartition`` so the computation before the write keeps its parallelism (the
    writer's own option would ``coalesce`` the last stage).
    """
    props = {k: str(v) for k, v in (properties or {}).items()}
    props["batchsize"] = str(batchsize)
    df.repartition(num_partitions or CONNECTIONS).write.mode(mode).jdbc(url, table, properties=props)
