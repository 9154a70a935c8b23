"""Deletion of repeated line runs by a suffix array over line ids.

A document is the sequence of its lines that have a word.  Equal lines get equal
ids; the suffixes of all documents' sequences are sorted by *prefix doubling*:
from the ranks of all suffixes by their first ``2^k`` lines follow the ranks by
their first ``2^(k+1)``, as the order of the pairs (rank here, rank ``2^k`` lines
further).  Suffixes with one rank at a level form an interval of the suffix array
whose longest common prefix is at least ``2^k`` lines; an interval of one suffix
cannot repeat anything and is dropped, so only repeated lines stay in play.

The longest common prefix intervals are wanted for runs of ``min_words`` words or
more.  Such a run is covered by the shortest windows of ``min_words`` words that
begin, or end, at each of its lines; two windows of ``m`` lines are equal iff the
ranks of their first and of their last ``2^k`` lines are (``2^k <= m < 2^(k+1)``).
Windows of ``min_words`` words have at most ``min_words`` lines, so the number of
doublings does not depend on the corpus.  Overlapping windows make up the maximal
runs; of equal windows the first stays, and the lines of the later ones go.

All of it is DataFrame functions.  Ranks come from a distributed sort of distinct
pairs (sorted rows numbered in order, partition by partition), never from one
task; a pair held by a third of all lines is one row there.
"""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize
from vigil.llm.spread import told_apart

#: Java regex of a word, and of a line that has one.
WORD = r"[^\x20\x09-\x0D]+"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _worded(lines: Column) -> Column:
    """The numbers (from 0) of the lines that have a word."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(WORD))


def _ranked(rows: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows with ``rank``, a number in the order of ``cols`` (with gaps)."""
    return rows.orderBy(*cols).withColumn("rank", F.monotonically_increasing_id())


def _levels(lines: DataFrame, most: int) -> list[DataFrame]:
    """Per level k the rows (d, pos, rank) of the repeated prefixes of ``2^k`` lines."""
    again = materialize(
        _ranked(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "key"), "line-ids"
    )
    level = materialize(lines.join(again, "key").select("d", "pos", "n_words", "rank"), "level")
    levels, reach = [level], 1
    while 2 * reach <= most:
        here, there = level.select("d", "pos", F.col("rank").alias("r1")), level.select(
            "d", (F.col("pos") - reach).alias("pos"), F.col("rank").alias("r2")
        )
        pairs = materialize(here.join(there, ["d", "pos"]), "pairs")
        again = materialize(
            _ranked(pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r1", "r2"),
                    "r1", "r2"), "ranks",
        )
        level = materialize(pairs.join(again, ["r1", "r2"]).select("d", "pos", "rank"), "level")
        if level.isEmpty():
            break
        levels.append(level)
        reach *= 2
    return levels


def _windows(level: DataFrame, min_words: int) -> DataFrame:
    """(d, pos, m): the shortest windows of ``min_words`` words that begin or end at a
    repeated line and hold repeated lines only."""
    def shortest(part):
        return F.aggregate(
            part, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("m")),
            lambda a, x: F.when(a["n"] >= min_words, a).otherwise(
                F.struct((a["n"] + x["n_words"]).alias("n"), (a["m"] + 1).alias("m"))
            ),
        )

    # a document's own repeated lines
    runs = level.groupBy("d").agg(F.array_sort(F.collect_list(F.struct("pos", "n_words"))).alias("a"))
    at = runs.select("d", "a", F.posexplode("a").alias("i", "x"))
    both = at.select(
        "d", "a", "i", F.col("x.pos").alias("p"),
        shortest(F.slice("a", F.col("i") + 1, F.lit(min_words))).alias("forth"),
        shortest(F.reverse(F.slice("a", F.greatest(F.col("i") - (min_words - 2), F.lit(1)),
                                   F.least(F.col("i") + 1, F.lit(min_words))))).alias("back"),
    )
    forth, back = F.col("forth.m"), F.col("back.m")
    begins = both.where(F.col("forth.n") >= min_words).where(
        F.get("a", F.col("i") + forth - 1)["pos"] - F.col("p") == forth - 1
    ).select("d", F.col("p").alias("pos"), forth.alias("m"))
    ends = both.where(F.col("back.n") >= min_words).where(
        F.col("p") - F.get("a", F.col("i") - back + 1)["pos"] == back - 1
    ).select("d", (F.col("p") - back + 1).alias("pos"), back.alias("m"))
    return begins.union(ends).distinct()


def _once(source: DataFrame) -> DataFrame:
    """One row per ``d``.  Only rows whose ``d`` comes more than once are shuffled."""
    copied = materialize(source.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d"), "copies")
    several, single = told_apart(source, F.col("d"), copied)
    return single.union(several.dropDuplicates(["d"]))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(d, lines): per document the numbers (among its lines with a word) of the lines
    to delete.  ``d`` is (id is null, id, hash of the text): documents come in its
    order, and rows equal in id and text are one document."""
    source = _once(
        docs.select(_key(id_col, text_col).alias("d"), F.col(text_col).cast("string").alias("_text")).where(
            F.col("_text").isNotNull()
        )
    )
    split = source.select("d", _lines(F.col("_text")).alias("_lines"))
    numbered = split.select("d", "_lines", F.posexplode(_worded(F.col("_lines"))).alias("pos", "_i"))
    line = F.get("_lines", F.col("_i"))
    lines = numbered.select(
        "d", "pos", F.unhex(F.sha2(line.cast("binary"), 256)).alias("key"),
        F.regexp_count(line, F.lit(WORD)).cast("long").alias("n_words"),
    )
    levels = _levels(lines, min_words)
    ranks = levels[0].select(F.lit(0).alias("k"), "d", "pos", "rank")
    for k, level in enumerate(levels[1:], start=1):
        ranks = ranks.union(level.select(F.lit(k), "d", "pos", "rank"))
    power = F.array(*[F.lit(floor(log2(m))) for m in range(1, min_words + 1)])
    windows = _windows(levels[0], min_words).withColumn("k", F.get(power, F.col("m") - 1))
    first = ranks.withColumnRenamed("rank", "r1")
    last = ranks.select("k", "d", F.col("pos").alias("tail"), F.col("rank").alias("r2"))
    named = materialize(
        windows.join(first, ["k", "d", "pos"])
        .withColumn("tail", F.col("pos") + F.col("m") - F.expr("shiftleft(1, k)"))
        .join(last, ["k", "d", "tail"]).select("d", "pos", "m", "r1", "r2"), "windows",
    )
    # an interval's first window in document order; intervals of one window are none
    place = F.struct("d", "pos")
    firsts = named.groupBy("m", "r1", "r2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = named.join(materialize(firsts, "intervals"), ["m", "r1", "r2"]).where(place != F.col("first"))
    gone = later.select("d", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("m") - 1)).alias("pos")).distinct()
    return gone.groupBy("d").agg(F.collect_list("pos").alias("lines"))


def _key(id_col: str, text_col: str) -> Column:
    return F.struct(
        F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("h"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """The input's rows with the later copies of repeated line runs of ``min_words``
    words or more deleted from the text, plus ``n_lines`` (lines with a word) and
    ``n_removed``; the row's columns stand in the struct ``_doc`` (text replaced).

    Of equal runs the first stays, by id (null ids last), then by a hash of the
    text, then by line.  Lines without a word do not interrupt a run and are never
    deleted.  A run may lie within one document; it never crosses documents.  Null
    texts stay null and empty texts empty; rows equal in id and text are one document
    and keep or lose lines together; extra columns pass through, whatever their names.
    An empty table gives an empty table.
    """
    gone = materialize(repeated_lines(docs, id_col, text_col, min_words), "gone")
    text = F.col(f"_doc.`{text_col}`").cast("string")
    whole = docs.select(_key(id_col, text_col).alias("d"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    # few documents lose lines: the others are not shuffled
    losing, whole = told_apart(whole, F.col("d"), gone.select("d"))
    whole = losing.join(gone, "d", "left").unionByName(whole.withColumn("lines", F.lit(None).cast(gone.schema["lines"].dataType)))
    split = whole.select("_doc", "lines", _lines(text).alias("_lines"))
    found = split.select(
        "_doc", "lines", "_lines", F.coalesce(_worded(F.col("_lines")), F.array().cast("array<int>")).alias("_worded")
    )
    dropped = F.transform("lines", lambda p: F.get("_worded", p))
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), dropped), lambda i: F.get("_lines", i)
    )
    field = docs.schema[text_col].name
    new = F.when(F.col("lines").isNull(), text).otherwise(F.array_join(left, "\n"))
    return found.select(
        F.col("_doc").withField(f"`{field}`", new).alias("_doc"),
        F.size("_worded").cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
    )


def dedup_lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """:func:`dedup_lines` as plain rows of ``docs``."""
    return dedup_lines(docs, id_col, text_col, min_words).select("_doc.*")
