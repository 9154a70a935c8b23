"""Sum a per-word value over every document's words.

The words of a corpus are looked up in a table with one row per distinct word.
Documents hold few distinct words that are common (a bounded head of the table
covers most occurrences) and many that are rare:

* the *head* - words at least as frequent as a threshold that is read off a
  histogram of the counts, so that never more than ``limit`` words qualify - is
  sent to the tasks, which sum it up while they read the documents;
* every other word is joined: (document, word, frequency) rows meet the table's
  rows on the word.  A word outside the head has at most about 1 / ``limit`` of
  all occurrences (or more than 64 bytes), so no key of that join is hot.

Both parts are exact, at every size of the corpus.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most words of the head and most bytes of one: at most 8 MB in all.
HEAD_WORDS = 131_072
HEAD_BYTES = 64


def word_counts(docs: DataFrame, text_col: str, words_of) -> DataFrame:
    """(word, n): how often each distinct word occurs in all documents.

    ``words_of(text)`` gives a text's words; null texts are skipped.  Each task
    counts its own documents first, so a frequent word is one row per task and
    half a million distinct words.
    """
    slim = docs.select(F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    counts.update(words_of(text))
                if len(counts) > 500_000:
                    yield out()
                    counts = Counter()
        yield out()

    return slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_head(table: DataFrame, value: str, limit: int = HEAD_WORDS):
    """(head, rest): a dict word -> value of the most frequent short words, at most
    ``limit`` of them, and the table of all others.  ``table`` is (word, n, value)."""
    short = F.octet_length("word") <= HEAD_BYTES
    sizes = table.where(short).groupBy(F.floor(F.log2("n")).alias("b")).count().collect()  # a row per power of two
    total, least = 0, None
    for b, count in sorted(((r["b"], r["count"]) for r in sizes), reverse=True):
        total += count
        if total > limit:
            break
        least = 2**b
    if least is None:
        return {}, table
    head = short & (F.col("n") >= least)
    return {r["word"]: r[value] for r in table.where(head).select("word", value).collect()}, table.where(~head)


def document_sums(docs: DataFrame, id_col: str, text_col: str, words_of, head: dict, rest: DataFrame, value: str,
                  unknown: float = 0, extra=None, per_batch=None) -> DataFrame:
    """Per input row: ``id_col``, ``n_bytes``, ``n_words``, ``found`` (the words that
    have a value) and ``total`` (the sum of their values, ``unknown`` for others).

    ``extra(text)`` is added to ``total``; ``per_batch(batch)`` gives a double per row
    of an Arrow batch (row, id, text), returned as ``per_row``.  Null texts are empty texts.  A row is
    told from others by its place in the input, so repeated rows and repeated or
    null ids give a row each.
    """
    spark = docs.sparkSession
    kind = "double" if dict(rest.dtypes)[value] == "double" else "long"
    arrow = pa.float64() if kind == "double" else pa.int64()
    known = spark.sparkContext.broadcast(head)
    slim = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
    )
    id_type = slim.schema["_id"].dataType.simpleString()

    def run(batches):
        values = known.value
        for batch in batches:
            where, words, times, first, base, hits, counts, sizes = [], [], [], [], [], [], [], []
            per_row = pa.array(per_batch(batch) if per_batch else [0.0] * batch.num_rows, pa.float64())
            for k, text in enumerate(batch.column(2)):
                text = text.as_py() or ""
                bag = words_of(text)
                total, met, start = (extra(text) if extra else 0), 0, len(where)
                for w, n in Counter(bag).items():
                    v = values.get(w)
                    if v is None:
                        where.append(k)
                        words.append(w)
                        times.append(n)
                    else:
                        total += n * v
                        met += n
                if start == len(where):  # every document has at least one row
                    where.append(k)
                    words.append(None)
                    times.append(0)
                blank = [0] * (len(where) - start - 1)
                first += [1, *blank]
                base += [total, *blank]
                hits += [met, *blank]
                counts += [len(bag), *blank]
                sizes += [len(text.encode("utf-8")), *blank]
            at = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(words, pa.string()),
                 pa.array(times, pa.int64()), pa.array(first, pa.int32()), pa.array(base, arrow),
                 pa.array(hits, pa.int64()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()),
                 per_row.take(at)],
                ["_row", "_id", "word", "_times", "_first", "_base", "_hits", "_words", "_bytes", "_per_row"],
            )

    rows = slim.mapInArrow(
        run, f"_row long, _id {id_type}, word string, _times long, _first int, _base {kind}, _hits long, "
        "_words long, _bytes long, _per_row double",
    ).select(
        "_row", "word", "_times",
        # a document without rest words has no word to meet: spread by its row
        F.when(F.col("word").isNull(), F.col("_row")).otherwise(F.lit(-1)).alias("_salt"),
        F.when(F.col("_first") == 1, F.struct("_id", "_base", "_hits", "_words", "_bytes", "_per_row")).alias("_doc"),
    )
    table = rest.select("word", F.lit(-1).cast("long").alias("_salt"), F.col(value).alias("_value"))
    joined = rows.withColumn("word", F.coalesce("word", F.lit(""))).join(table, ["word", "_salt"], "left")
    n, v = F.col("_times"), F.col("_value")
    return (
        joined.groupBy("_row").agg(
            F.max(F.col("_doc")).alias("_doc"),
            F.sum(n * F.coalesce(v, F.lit(unknown).cast(kind))).alias("_rest"),
            F.sum(F.when(v.isNotNull(), n).otherwise(0)).alias("_met"),
        )
        .select(
            F.col("_doc._id").alias(id_col), F.col("_doc._bytes").alias("n_bytes"),
            F.col("_doc._words").alias("n_words"), (F.col("_doc._hits") + F.col("_met")).alias("found"),
            (F.col("_doc._base") + F.col("_rest")).alias("total"), F.col("_doc._per_row").alias("per_row"),
        )
    )
