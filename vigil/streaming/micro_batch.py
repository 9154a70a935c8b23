"""Scoring a stream: the batch scorecard applied to every micro-batch.

There is no streaming measure of its own.  A table that grows by appends
(a landing folder, a Kafka topic) is scored the way a batch run scores a
table - one completeness scorecard per micro-batch - and the rows are
written under ``<root>/<result table>/batch_id=<n>``.  Each micro-batch
overwrites only its own folder, so a batch that is retried after a failure
replaces its earlier partial output instead of appending twice; with the
stream's checkpoint in the shared folder, a restarted query resumes at the
first unfinished batch.

Batch numbers belong to a checkpoint, so results and checkpoint go together: the
default checkpoint lies beside the results, and a checkpoint without history is
refused over a root that already holds batches, which it would overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vigil.functions.rules import NULL_LABEL
from vigil.operators.completeness import scorecard
from vigil.sources.sinks import COMPLETENESS_TABLE


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def score_micro_batches(
    stream: DataFrame,
    rules,
    root: str,
    database: str | None = None,
    table: str | None = None,
    name: str = COMPLETENESS_TABLE,
    checkpoint: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    label: str = NULL_LABEL,
    format: str = "parquet",
) -> StreamingQuery:
    """Start the streaming query; returns it (call ``awaitTermination`` or ``stop``)."""
    spark = stream.sparkSession
    root = root.rstrip("/")
    ckpt, out = checkpoint or f"{root}/_checkpoints/{name}", f"{root}/{name}"
    if _exists(spark, out) and not _exists(spark, f"{ckpt}/offsets"):
        raise ValueError(f"{out} holds batches of another checkpoint than {ckpt}, which would be overwritten")

    def each(batch: DataFrame, batch_id: int) -> None:
        card = scorecard(batch, rules, database, table, label=label)
        # the batch id is the folder name, read back as a partition column
        card.write.mode("overwrite").format(format).save(f"{out}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
