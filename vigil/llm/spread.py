"""Numbering, joining and telling apart rows when keys are many or one key holds many rows."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import materialize


def positions(rows: DataFrame, group: str, order: list, name: str) -> DataFrame:
    """``rows`` with ``_pos``: the row's place (from 0) in its group under ``order``.

    The rows are sorted over all tasks by range, so a large group is cut into many
    slices; only slice counts (at most one per task and group) are summed along a
    group.  Rows equal in group and order get their places in any order.
    """
    keys = [F.col(group), *order]
    ranged = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_slice", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    slices = ranged.groupBy(group, "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(
        Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = slices.select(group, "_slice", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return ranged.join(slices, [group, "_slice"]).withColumn("_pos", F.col("_at") + F.col("_shift")).drop(
        "_slice", "_at", "_shift"
    )


def lookup(rows: DataFrame, key: str, table: DataFrame, parts: int = 64) -> DataFrame:
    """``rows.join(table, key, "left")`` for a ``table`` unique in ``key``.

    A key's rows are dealt to ``parts`` salts; the table is joined to the salts in use,
    then to the rows by key and salt, so a task gets one salt's share of a hot key.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(parts)))
    used = salted.select(key, "_salt").distinct().join(table, key)
    return salted.join(used, [key, "_salt"], "left").drop("_salt")


#: Bits of a membership filter: so many a key, and at most 8 MB.
BITS_A_KEY = 16
MOST_BITS = 1 << 26
#: Bits of one row of Spark's bitmap functions.
_ROW_BITS = 1 << 15


def told_apart(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may have one of the keys, rows that have none of them).

    ``keys`` (one column) should be few beside ``rows`` and written out.  Their hashed bits are
    broadcast, at most :data:`MOST_BITS` of them, so the rows that have none are found
    without a shuffle; the others, few more than those that do, are left to an exact join.
    With more keys than the bits tell apart more rows are left to it, never fewer.
    """
    named = keys.columns[0]
    bits = min(MOST_BITS, max(_ROW_BITS, 1 << ceil(log2(BITS_A_KEY * max(1, keys.count())))))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    taken = keys.select(slot(F.col(named)).alias("_slot")).groupBy(F.expr(f"_slot div {_ROW_BITS}").alias("_bucket"))
    taken = materialize(taken.agg(F.expr(f"bitmap_construct_agg(_slot % {_ROW_BITS})").alias("_map")), "filter")
    byte = F.conv(F.hex(F.expr(f"substring(_map, CAST(_slot % {_ROW_BITS} div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    placed = rows.withColumn("_slot", slot(key)).withColumn("_bucket", F.expr(f"_slot div {_ROW_BITS}"))
    marked = placed.join(F.broadcast(taken), "_bucket", "left")
    hit = F.coalesce((F.call_function("shiftright", byte, (F.col("_slot") % 8).cast("int")) % 2) == 1, F.lit(False))
    return marked.where(hit).select(*rows.columns), marked.where(~hit).select(*rows.columns)
