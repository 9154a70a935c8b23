"""Token counts without token ids.

1. Every distinct word of the corpus (as the tokenizer's pattern splits it) is
   found once, and its pieces are counted once.
2. Per document, the frequencies of its words are joined to those counts and
   summed (:mod:`vigil.llm.lookup`: a bounded head in the tasks, the rest by a
   join on the word).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.bpe import automaton
from vigil.llm.common import materialize
from vigil.llm.lookup import document_sums, split_head, word_counts


def _words(tokenizer: str):
    def words(text: str) -> list[str]:
        a = automaton(tokenizer)
        return [w for special, s in a.pieces(text) if not special for w in a.split(s)]

    return words


def _specials(tokenizer: str):
    return lambda text: sum(special for special, _ in automaton(tokenizer).pieces(text))


def piece_counts(words: DataFrame, tokenizer: str) -> DataFrame:
    """(word, n, pieces): the number of tokens of each distinct word."""

    def run(batches):
        a = automaton(tokenizer)
        for batch in batches:
            raw = sorted((w.as_py().encode("utf-8"), k) for k, w in enumerate(batch.column(0)))
            pieces = [0] * len(raw)
            for (_, k), ids in zip(raw, a.ids_of(b for b, _ in raw)):
                pieces[k] = len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pieces, pa.int64())], ["word", "n", "pieces"]
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, pieces long")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per input row: ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (``n_tokens > limit``), without special tokens added; the tokenizer's special
    strings inside a text count as one token each, as the library reads them.

    Null texts are empty texts (0 tokens).  Repeated rows, repeated and null ids
    give one row each; whole texts are counted, however long; other columns of
    ``docs`` play no part.  An empty table gives an empty table.
    """
    words = _words(tokenizer)
    table = materialize(piece_counts(word_counts(docs, text_col, words), tokenizer), "pieces")
    head, rest = split_head(table, "pieces")
    sums = document_sums(docs, id_col, text_col, words, head, rest, "pieces", extra=_specials(tokenizer))
    return sums.select(
        id_col, "n_bytes", F.col("total").alias("n_tokens"), (F.col("total") > limit).alias("over_limit")
    )
