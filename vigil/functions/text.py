"""Ordered text aggregation: a group's values as one text, or as parts of bounded size.

A rule's failing values can be asked for as one text (a JSON list sorted by count,
or a ``|``-joined list).  Two forms:

* :func:`ordered_concat` makes one cell per group.  A cell is made, whole, by one task, and
  Spark caps it at 2 GB; so the task may as well gather and sort the group's texts
  itself, at several times the cell's memory.  One shuffle of the distinct values,
  and nothing else: the form for results that someone reads.
* :func:`ordered_parts` makes rows of bounded size that concatenate to the same text, for
  groups of any size: a global sort cuts even a single huge group into slices, byte
  offsets are summed over slices and then within them, and no task ever holds
  more than a part and its share of the sorted rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.rules import sql_string


def ordered_concat(
    df: DataFrame,
    group: str,
    order: list[str],
    text: str,
    sep: str,
    prefix: str = "",
    suffix: str = "",
    alias: str = "text",
) -> DataFrame:
    """Per ``group``: ``prefix + join(text ordered by order, sep) + suffix``.

    ``order`` lists ascending sort keys and ``text`` the piece of text, both
    as SQL expressions over ``df`` (negate a number to sort it descending).
    Rows with NULL text are skipped (``listagg`` leaves them out).  Groups without
    texts do not appear; callers fill them with their own empty value.  One task
    gathers a group's texts: see :func:`ordered_parts` for groups of any size.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    slim = df.selectExpr(f"{group} AS _g", *[f"{o} AS {k}" for o, k in zip(order, keys)], f"{text} AS _t")
    whole = f"listagg(_t, {sql_string(sep)}) WITHIN GROUP (ORDER BY {', '.join(keys)}) AS _all"
    return slim.groupBy("_g").agg(F.expr(whole)).where("_all IS NOT NULL").selectExpr(
        f"_g AS {group}", f"concat({sql_string(prefix)}, _all, {sql_string(suffix)}) AS {alias}"
    )


def ordered_parts(
    df: DataFrame,
    group: str,
    order: list[str],
    text: str,
    sep: str,
    keep: Callable[[DataFrame], DataFrame],
    prefix: str = "",
    suffix: str = "",
    part_bytes: int = 16 << 20,
) -> DataFrame:
    """The texts of :func:`ordered_concat` cut into rows: (group, part, text).

    A group's texts in the order of ``part`` concatenate to its one text.  ``part`` is
    the number of the block of ``part_bytes`` bytes in which a part's first piece begins
    (so numbers rise, with gaps after longer pieces); a part ends with the piece that
    reaches the end of its block.  No task holds more of a group than a part and
    its share of the sorted rows.

    The offsets are running sums at two levels: the slices of a global sort are summed by
    themselves, then the slices' sums (at most one per task and group).  Both need the
    slices to be the same rows, so ``keep`` writes the sorted rows and reads them back.
    """
    if part_bytes < 1:
        raise ValueError("part_bytes must be positive")
    keys = [f"_k{i}" for i in range(len(order))]
    sliced = keep(
        df.selectExpr(f"{group} AS _g", *[f"{o} AS {k}" for o, k in zip(order, keys)], f"{text} AS _t")
        .orderBy("_g", *keys).selectExpr("*", f"octet_length(_t) + {len(sep.encode())} AS _n", "spark_partition_id() AS _s")
        .where("_n IS NOT NULL")
    )
    slices = sliced.groupBy("_g", "_s").agg(F.sum("_n").alias("_bytes"))
    along = Window.partitionBy("_g").orderBy("_s")
    slices = slices.select(
        "_g", "_s",
        F.coalesce(F.sum("_bytes").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_bytes").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    inside = Window.partitionBy("_g", "_s").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        sliced.withColumn("_end", F.sum("_n").over(inside)).join(slices, ["_g", "_s"])
        .withColumn("_end", F.col("_before") + F.col("_end"))
        .selectExpr("_g", *keys, "_t", "_end = _total AS _last", f"(_end - _n) div {part_bytes} AS part")
    )
    sep_sql = sql_string(sep)
    parts = placed.groupBy("_g", "part").agg(
        F.expr(f"listagg(_t, {sep_sql}) WITHIN GROUP (ORDER BY {', '.join(keys)}) AS _piece"), F.max("_last").alias("_last")
    )
    return parts.selectExpr(
        f"_g AS {group}", "part",
        f"concat(CASE WHEN part = 0 THEN {sql_string(prefix)} ELSE {sep_sql} END, _piece, "
        f"CASE WHEN _last THEN {sql_string(suffix)} ELSE '' END) AS text",
    )
