"""Resolving a catalog's (database, table) to a DataFrame.

A resolver is any callable ``(TableRef) -> DataFrame``.  Provided:

* :class:`PathTables` - files laid out by a path pattern (parquet by default);
* :class:`SessionTables` - tables of the session catalog (``spark.table``);
* :class:`JdbcTables` - a database over JDBC, with parallel partitioned reads;
* :class:`MappedTables` - an explicit mapping, e.g. to DataFrames derived in code.

A section role that is absent from the catalog has no table (``None``); a
table that fails to load raises - an error is never turned into "no table".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.plans.catalog import TableRef
from vigil.sources import jdbc as _jdbc


class PathTables:
    """``pattern`` is formatted with ``database`` and ``table``,
    e.g. ``"/data/{database}/{table}"`` or ``"/root/testdata/sf0.01/{table}.parquet"``."""

    def __init__(self, spark: SparkSession, pattern: str, format: str = "parquet", options: dict | None = None):
        self.spark, self.pattern, self.format, self.options = spark, pattern, format, dict(options or {})

    def __call__(self, ref: TableRef) -> DataFrame:
        path = self.pattern.format(database=ref.database or "", table=ref.table)
        return self.spark.read.format(self.format).options(**self.options).load(path)


class SessionTables:
    """Tables registered in the session catalog (metastore or temp views)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __call__(self, ref: TableRef) -> DataFrame:
        return self.spark.table(ref.qualified)


class MappedTables:
    """``{"db.table" or "table": DataFrame | callable() -> DataFrame}``."""

    def __init__(self, mapping: dict):
        self.mapping = dict(mapping)

    def __call__(self, ref: TableRef) -> DataFrame:
        for key in (ref.qualified, ref.table):
            if key in self.mapping:
                v = self.mapping[key]
                return v() if callable(v) else v
        raise KeyError(f"no table mapped for {ref.qualified}")


class JdbcTables:
    """A JDBC database; ``url`` is formatted with ``database``.

    Credentials and driver class come from the caller (``properties``), never
    from the catalog.  Reader options in the catalog entry (``fetch_size`` /
    ``fetchsize``, ``partition_column``...) and ``partitioning`` given here
    make the read parallel; see :func:`vigil.sources.jdbc.reader_options`.  Without any,
    ``split="auto"`` (the default) picks a column to split on; ``None`` reads in one task.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict | None = None,
        partitioning: dict | None = None,
        fetchsize: int | None = None,
        split: str | None = "auto",
    ):
        self.spark, self.url, self.split = spark, url, split
        self.properties = dict(properties or {})
        self.partitioning = dict(partitioning or {})
        self.fetchsize = fetchsize

    def __call__(self, ref: TableRef) -> DataFrame:
        part = self.partitioning.get(ref.qualified) or self.partitioning.get(ref.table) or {}
        opts = _jdbc.reader_options(
            url=self.url.format(database=ref.database or ""),
            table=ref.table,
            properties=self.properties,
            catalog_options=ref.options,
            fetchsize=self.fetchsize,
            split=self.split,
            **part,
        )
        return _jdbc.read(self.spark, opts)


Resolver = Callable[[TableRef], DataFrame]


def resolve(resolver: Resolver, ref: TableRef | None) -> DataFrame | None:
    return None if ref is None else resolver(ref)
