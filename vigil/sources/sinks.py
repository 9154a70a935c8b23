"""Result sinks and the shared working folder.

Measures produce DataFrames; a sink appends them to named result tables:

* completeness rows of every section go to ``df_dqu_completeness`` in ONE
  append (sections are unioned first);
* an accuracy report goes to ``df_dqu_accuracy_<source table>_to_<target table>``.

A sink is any object with ``append(df, name)``.  A sink that also has ``publish`` and
``published`` takes part in runs: ``append(df, name, run_id)`` puts rows aside and
``publish(spark, run_id, names)`` shows all of them in one step, so a run can be repeated
until it succeeds and its rows are there once.  Provided: :class:`PathSink` (files) and
:class:`JdbcSink` (a database), both with runs, and :class:`SessionSink` (``saveAsTable`` in
the session catalog, plain appends).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources import jdbc as _jdbc

COMPLETENESS_TABLE = "df_dqu_completeness"

#: Column that numbers the rows of a staging table.
_ROW = "vigil_row"


def accuracy_table(source_table: str, target_table: str) -> str:
    return f"df_dqu_accuracy_{source_table}_to_{target_table}"


def new_run_id() -> str:
    return uuid.uuid4().hex


def _checked_id(run_id: str) -> str:
    """A run id is part of folder and table names: letters, digits, ``_`` and ``-`` only."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
        raise ValueError(f"a run id has letters, digits, _ and - only, not {run_id!r}")
    return run_id


class PathSink:
    """Result tables as files (parquet by default): ``<root>/<name>/run=r-<run id>/``.

    An append is two steps.  ``append(df, name, run_id)`` writes the rows into the run's own
    folder, replacing what an earlier attempt of the run left there; ``publish`` writes one
    manifest, ``<root>/_runs/<run id>``, that makes all tables of the run visible at once.
    ``read`` returns the rows of published runs only, so a run that died half-way shows
    nothing, and running it again with its id gives each row once.  Without a run id an
    append is a run of its own, published right away.
    """

    _MANIFEST = "run string, name string"

    def __init__(self, root: str, format: str = "parquet"):
        self.root, self.format = root.rstrip("/"), format

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def append(self, df: DataFrame, name: str, run_id: str | None = None) -> None:
        run = _checked_id(new_run_id() if run_id is None else run_id)
        df.write.mode("overwrite").format(self.format).save(f"{self.path(name)}/run=r-{run}")
        if run_id is None:
            self.publish(df.sparkSession, run, [name])

    def publish(self, spark: SparkSession, run_id: str, names: list[str]) -> None:
        """Make the run's tables visible; a manifest is one file, which appears whole or not at all."""
        rows = [(f"r-{_checked_id(run_id)}", n) for n in names]
        manifest = spark.createDataFrame(rows, self._MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").json(f"{self.root}/_runs/{run_id}")

    def _manifests(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._MANIFEST).json(f"{self.root}/_runs/*")

    def published(self, spark: SparkSession, run_id: str) -> bool:
        try:
            return not self._manifests(spark).where(F.col("run") == f"r-{run_id}").isEmpty()
        except AnalysisException:  # no run yet
            return False

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        runs = self._manifests(spark).where(F.col("name") == name).select("run").distinct()
        return spark.read.format(self.format).load(self.path(name)).join(runs, "run", "left_semi").drop("run")


class JdbcSink:
    """Result tables of a database.

    With a run id an append goes to a staging table ``<name>__<run id>``, written anew by
    every attempt; ``publish`` then runs, in one transaction, one ``INSERT ... SELECT`` per
    table and one row into ``runs_table``.  A transaction that did not commit leaves the
    result tables as they were, and a run that is in ``runs_table`` is not inserted again.
    The rows are numbered in a written copy before they are sent, and inserted DISTINCT with
    their number, so rows that a repeated task sent twice count once.

    Without a run id rows go straight to the table, as a plain JDBC append: a repeated task may
    then repeat its rows.  ``num_partitions`` bounds the connections.
    """

    def __init__(self, url: str, properties: dict | None = None, batchsize: int = 10_000,
                 num_partitions: int | None = None, runs_table: str = "vigil_runs"):
        self.url, self.properties = url, dict(properties or {})
        self.batchsize, self.num_partitions = batchsize, num_partitions or _jdbc.CONNECTIONS
        self.runs_table = runs_table

    def _send(self, df: DataFrame, name: str, mode: str = "append") -> None:
        _jdbc.append(df, self.url, name, self.properties, self.batchsize, self.num_partitions, mode)

    def _staging(self, name: str, run_id: str) -> str:
        return f"{name}__{_checked_id(run_id).replace('-', '_')}"

    def append(self, df: DataFrame, name: str, run_id: str | None = None) -> None:
        if run_id is None:
            return self._send(df, name)
        numbered = stage(df, df.sparkSession, name).withColumn(_ROW, F.monotonically_increasing_id())
        self._send(numbered, self._staging(name, run_id), "overwrite")
        self._send(df.limit(0), name)  # makes the result table, if it is missing

    def publish(self, spark: SparkSession, run_id: str, names: list[str]) -> None:
        inserts = []
        for name in names:
            staging = self._staging(name, run_id)
            columns = ", ".join(c for c in _jdbc.columns(spark, self.url, staging, self.properties) if c != _ROW)
            inserts.append(
                f"INSERT INTO {name} ({columns}) SELECT {columns} FROM (SELECT DISTINCT * FROM {staging}) staged"
            )
        inserts.append(f"INSERT INTO {self.runs_table} (run_id) VALUES ('{_checked_id(run_id)}')")
        _jdbc.transaction(spark, self.url, self.properties, inserts)
        drops = [f"DROP TABLE {self._staging(name, run_id)}" for name in names]
        _jdbc.transaction(spark, self.url, self.properties, drops)

    def published(self, spark: SparkSession, run_id: str) -> bool:
        self._send(spark.createDataFrame([], "run_id string"), self.runs_table)  # makes the table, if it is missing
        runs = _jdbc.read(spark, _jdbc.reader_options(self.url, self.runs_table, self.properties))
        return not runs.where(F.col("run_id") == run_id).isEmpty()


class SessionSink:
    """Tables of the session catalog; a plain append, so a run that is repeated repeats its rows."""

    def __init__(self, database: str | None = None, format: str | None = None):
        self.database, self.format = database, format

    def append(self, df: DataFrame, name: str) -> None:
        w = df.write.mode("append")
        if self.format:
            w = w.format(self.format)
        w.saveAsTable(f"{self.database}.{name}" if self.database else name)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared working folder: ``spark.checkpoint.dir``.

    It is read from the session.  Only when it is unset *and* the session runs
    in local mode (tests) is a local folder created and registered; on a
    cluster an unset value is an error, never a machine-local fallback.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the conf is all there is
        if conf:
            return conf
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder shared by the cluster")
    d = sc.getCheckpointDir()
    if d:
        return d
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="vigil-checkpoint-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def stage(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it back.

    Used for inputs that several measures read (a JDBC table scanned by
    completeness, timeliness and accuracy): the database is read once, every
    later plan reads the files, and the lineage ends at the written table, so
    a lost executor re-reads files instead of re-querying the database.
    """
    path = os.path.join(shared_dir(spark), "vigil-staged", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
