"""Quality rules with risk-controlled thresholds.

Every rule scores a document (larger is worse) and rejects it above a cutoff.
Cutoffs are not set by hand: they are taken from a fixed ladder per rule, with
labelled documents as the holdout, so that of each stratum's good documents no
more than ``limit`` are falsely rejected, with confidence ``1 - delta`` for all
strata and rules together:

* a rule may falsely reject ``limit / rules`` of a stratum's good documents;
* a cutoff that falsely rejects ``k`` of the ``n`` labelled good documents of a
  stratum is *certified* if the exact binomial probability of ``k`` or fewer
  false rejections, were their rate at that limit, is at most
  ``delta / (strata * rules)`` (Bonferroni over strata and rules);
* the ladder is climbed from the most lenient cutoff and left at the first that
  is not certified (fixed-sequence testing: no correction within a ladder);
* of the certified cutoffs the one that separates bad from good labelled
  documents best (share of bad rejected less :data:`FALSE_COST` times the share of
  good rejected) is used, the most lenient of equals; if none does any good, or
  none is certified, the rule is off in that stratum.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import WS, materialize
from vigil.llm.spread import told_apart

#: Rules: name, score over the feature columns.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
}
#: Each rule's ladder of cutoffs, most lenient first.
LADDER = [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]

SYMBOLS = "[^#*$%&|<>]+"
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
#: What a false rejection costs, in caught bad documents.
FALSE_COST = 20


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text."""
    size = WINDOW
    starts = lambda w: F.sequence(F.lit(1), F.size(w) - (size - 1))

    def covered(w):
        # windows sorted by their words; those with an equal neighbour, by position
        windows = F.array_sort(F.transform(starts(w), lambda i: F.struct(
            F.array_join(F.slice(w, i, F.lit(size)), " ").alias("w"), i.alias("i"))))
        repeated = lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, k: x["w"].eqNullSafe(F.get(s, k - 1)["w"]) | x["w"].eqNullSafe(F.get(s, k + 1)["w"])),
            lambda x: x["i"]))
        return F.aggregate(
            _let(windows, repeated),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    # the exact count is made only where hashes of the windows say that two may be equal
    hashed = _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: _let(
            F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)])),
            lambda x: F.size(F.array_distinct(x)) < F.size(x),
        ),
    )
    return F.when((n > size) & F.when(n > size, hashed), covered(words)).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame, text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """Per row the columns of ``keep`` and ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_lines`` (lines with a word), ``n_dup_lines``, ``n_repeat_words`` (long) and
    ``base_failed``.  Null texts have no words."""
    keep = keep or {}
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        *[c.alias(k) for k, c in keep.items()],
        F.array_remove(F.split(text, f"{WS}+"), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
    )
    n = F.size("_words")
    counted = split.select(
        *keep, n.cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words"), n).alias("n_repeat_words"),
    )
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )


def _binomial_cdf(k: str, n: str, p: str) -> str:
    """SQL: P(X <= k) for X ~ Binomial(n, p), for k below n * p: the last term by
    logarithms, times the sum of the terms over the last one."""
    return (
        f"transform(array(aggregate(filter(sequence(0L, {k}), i -> i > 0), named_struct('c', 0D, 's', 1D), "
        f"(a, i) -> named_struct('c', a.c + ln(({n} - {k} + i) / i), "
        f"'s', 1D + i * (1 - {p}) / (({n} - i + 1) * {p}) * a.s))), "
        f"t -> exp(t.c + {k} * ln({p}) + ({n} - {k}) * ln(1 - {p}) + ln(t.s)))[0]"
    )


def thresholds(labelled: DataFrame, limit: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(stratum, cutoffs): per stratum of the labelled documents an array of each
    rule's cutoff, in the order of :data:`RULES` (null: off).

    ``labelled`` has ``_stratum``, ``_good`` (boolean) and the feature columns.
    """
    share = limit / len(RULES)
    scores = F.array(*[
        F.struct(F.lit(i).alias("rule"), sum(F.expr(f"CAST({s} > {c} AS INT)") for c in LADDER).alias("level"))
        for i, s in enumerate(RULES.values())
    ])
    counts = (
        labelled.select("_stratum", "_good", F.explode(scores).alias("r"))
        .groupBy("_stratum", "r.rule", "r.level")
        .agg(F.count_if(F.col("_good")).alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    )
    # from here on a row per stratum, rule and rung: rung j rejects who exceeds the j-th cutoff and so all after it
    rungs = F.explode(F.sequence(F.lit(1), F.lit(len(LADDER)))).alias("rung")
    above = F.col("level") > len(LADDER) - F.col("rung")
    table = (
        counts.select("*", rungs).groupBy("_stratum", "rule", "rung").agg(
            F.sum("good").alias("n"), F.sum("bad").alias("m"),
            F.sum(F.when(above, F.col("good")).otherwise(0)).alias("k"),
            F.sum(F.when(above, F.col("bad")).otherwise(0)).alias("hit"),
        )
        .crossJoin(F.broadcast(counts.agg(F.count_distinct(F.coalesce("_stratum", F.lit("\0"))).alias("strata"))))
        .withColumn("ok", F.expr(
            f"CASE WHEN k < n * {share!r}D THEN {_binomial_cdf('k', 'n', f'{share!r}D')} <= "
            f"{delta!r}D / (strata * {len(RULES)}) ELSE false END"
        ))
    )
    ladder = Window.partitionBy("_stratum", "rule").orderBy("rung")
    gain = F.col("hit") / F.greatest("m", F.lit(1)) - FALSE_COST * F.col("k") / F.greatest("n", F.lit(1))
    certified = table.withColumn("certified", F.min("ok").over(ladder)).where("certified").withColumn("gain", gain)
    cutoff = F.get(F.array(*[F.lit(c) for c in LADDER]), F.col("rung") - 1)
    best = certified.where("gain > 0").groupBy("_stratum", "rule").agg(
        F.max_by(cutoff, F.struct("gain", -F.col("rung"))).alias("cutoff")
    )
    return best.groupBy("_stratum").agg(*[
        F.max(F.when(F.col("rule") == i, F.col("cutoff"))).alias(f"_cut_{name}") for i, name in enumerate(RULES)
    ])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", good_col: str = "quality", limit: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Per input row: id, the features, ``base_failed`` and ``kept`` (false where the
    base rules fail or a certified cutoff of the row's stratum is exceeded).

    ``labels`` (``id_col``, ``good_col`` 1 or 0) may cover any part of the documents;
    null labels are no labels, a document with several is good if all say so.  Only
    labelled documents that pass the base rules are the holdout.  Null texts have no
    words (they fail the base rules); a null stratum is a stratum of its own; null
    ids have no label; repeated rows give a row each, and count one by one in the
    holdout; extra columns are ignored.  Without labels the base rules alone decide.
    """
    return _judged(docs, labels, id_col, text_col, stratum_col, good_col, limit, delta)


def _row_key(id_col: str, text_col: str, stratum_col: str) -> Column:
    """128 bits of SHA-256 of what a row's verdict follows from: its id, its stratum and its text."""
    known = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    parts = [known(c) for c in (id_col, stratum_col, text_col)]
    sizes = [F.length(c).cast("string") for c in parts[:2]]
    return F.substring(F.sha2(F.concat_ws(":", *sizes, *parts), 256), 1, 32)


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, stratum_col: str, good_col: str,
            limit: float, delta: float, **keep: Column) -> DataFrame:
    """The columns of :func:`judge`, and those of ``keep``."""
    row = {"_id": F.col(id_col), "_stratum": F.col(stratum_col).cast("string"), **keep}
    found = materialize(features(docs, text_col, row), "features")
    marks = (
        labels.where(F.col(good_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg((F.min(good_col) > 0).alias("_good"))
    )
    numbers = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    labelled = found.where(~F.col("base_failed")).select("_id", "_stratum", *numbers).join(marks, "_id")
    cuts = materialize(thresholds(labelled, limit, delta), "thresholds").withColumnRenamed("_stratum", "_of")
    exceeded = F.lit(False)
    for name, score in RULES.items():
        exceeded = exceeded | F.coalesce(F.expr(score) > F.col(f"_cut_{name}"), F.lit(False))
    # one row per stratum: Spark broadcasts it by its own size check, or joins by key
    out = found.join(cuts, F.col("_stratum").eqNullSafe(F.col("_of")), "left")
    return out.select(
        F.col("_id").alias(id_col), *numbers, "base_failed", (~F.col("base_failed") & ~exceeded).alias("kept"), *keep
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang", good_col: str = "quality", limit: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps.

    Only keys and features are written.  Rows that are surely not rejected, by a bitmap of the rejected
    keys, pass without a shuffle; the others are joined by key.
    """
    key = _row_key(id_col, text_col, stratum_col)
    judged = _judged(docs, labels, id_col, text_col, stratum_col, good_col, limit, delta, _key=key)
    rejected = materialize(judged.where("NOT kept").select("_key").distinct(), "rejected")
    whole = docs.select(key.alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    maybe, rest = told_apart(whole, F.col("_key"), rejected)
    return maybe.join(rejected, "_key", "left_anti").select("_doc.*").unionAll(rest.select("_doc.*"))
