"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.sources.sinks import shared_dir

#: Java / Spark SQL regex of one white-space character: 0x20 and 0x09-0x0D.
WS = r"[\x20\x09-\x0D]"


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared folder."""
    return os.path.join(shared_dir(spark), "vigil-llm", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    The lineage ends at the written table, so a lost executor re-reads files,
    and plans that use the rows twice compute them once.  The folders belong
    to the run; whoever owns ``spark.checkpoint.dir`` empties it.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array):
    """The values of a string column as ``bytes`` (None for null), one at a time."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py()
