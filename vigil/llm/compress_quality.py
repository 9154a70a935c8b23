"""Quality by compression: a text looks like the class whose dictionary compresses it best.

Two Zstandard dictionaries are built, one from good and one from bad labelled texts.
Every text, cut into pieces of ``PIECE`` bytes so that the dictionary and not the
text's own past decides, is compressed whole with both.  The difference of the two
sizes, over the text's bytes, is the evidence; a rising curve (isotonic regression)
fitted on other labelled rows turns it into the probability of a good label.

* Only labelled rows with ``crc32(id as text) % folds != 0`` teach anything.  Half of
  them (by a hash of the id) give the dictionaries, the other half the curve, so the
  curve sees texts that the dictionaries have not.
* The dictionaries are fitted on a bounded sample, in the order of a hash: at most
  ``sample_docs`` ids a class, and ``sample_pieces`` pieces of their texts.  The curve
  and the mean evidence use every labelled row of their half.
* Short texts have little evidence: :data:`SHRINK` bytes of average text are added to each.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import materialize, text_bytes

PIECE = 1024
DICT_BYTES = 1 << 18
LEVEL = 3
SHRINK = 32
SAMPLE_DOCS = 4000
SAMPLE_PIECES = 12_000

#: Steps of the evidence at which rows are counted for the curve.
STEP = 1 / 4096


def _pieces(text: bytes | None):
    for at in range(0, len(text or b""), PIECE):
        yield text[at:at + PIECE]


def _cut(batches):
    """Arrow batches (key, good, text) -> (good, order, piece), order a hash of key and place."""
    for batch in batches:
        good, order, out = [], [], []
        for key, label, text in zip(batch["_key"], batch["_good"], text_bytes(batch["_text"])):
            for no, piece in enumerate(_pieces(text)):
                good.append(label.as_py())
                order.append(hashlib.blake2b(b"%s:%d" % (str(key.as_py()).encode(), no), digest_size=16).digest())
                out.append(piece)
        yield pa.RecordBatch.from_arrays(
            [pa.array(good, pa.bool_()), pa.array(order, pa.binary()), pa.array(out, pa.binary())],
            names=["good", "order", "piece"],
        )


def build_dictionary(pieces: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary of at most ``size`` bytes; the pieces themselves where
    they are too few for training."""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[:size]


def _compressor(dictionary: bytes):
    made = zstandard.ZstdCompressionDict(dictionary)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=made, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _sizes(good: bytes, bad: bytes):
    """Batches (id, text) -> (id, bytes, excess): how many bytes more the bad dictionary needs."""

    def run(batches):
        by_good, by_bad = _compressor(good), _compressor(bad)
        for batch in batches:
            n, excess = [], []
            for text in text_bytes(batch["_text"]):
                n.append(len(text or b""))
                excess.append(sum(len(by_bad.compress(p)) - len(by_good.compress(p)) for p in _pieces(text)))
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(n, pa.int64()), pa.array(excess, pa.int64())], names=["_id", "n", "excess"]
            )

    return run


def fit_curve(counts) -> list[tuple[float, float]]:
    """Knots (evidence, probability of good), both rising, from rows (evidence, good, count).

    Isotonic regression by pooling neighbours that are out of order; a knot is a pool's
    mean.  Probabilities keep 1 / (rows + 2) from 0 and 1.  One class, or no rows, gives
    one knot.
    """
    bins: dict[float, list] = {}
    for x, good, n in counts:
        bins.setdefault(x, [0, 0])[bool(good)] += n
    pools: list[list] = []  # sum of evidence, good, rows
    for x in sorted(bins):
        bad, good = bins[x]
        pools.append([x * (bad + good), good, bad + good])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    total = sum(p[2] for p in pools)
    margin = 1 / (total + 2)
    return [(s / n, margin + (1 - 2 * margin) * g / n) for s, g, n in pools] or [(0.0, 0.5)]


def _on_curve(x: Column, knots) -> Column:
    """The straight lines through the knots, level before the first and after the last."""
    out = F.lit(knots[0][1])
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out = F.when(x > x0, F.least(F.lit(y0 + 0.0) + (x - x0) * ((y1 - y0) / (x1 - x0)), F.lit(y1))).otherwise(out)
    return out


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             good_col: str = "quality", folds: int = 5, cutoff: float = 0.3,
             sample_docs: int = SAMPLE_DOCS, sample_pieces: int = SAMPLE_PIECES) -> DataFrame:
    """Per row of ``docs``: id, ``held_out`` (its labels were not used), ``n_bytes``, ``evidence``
    (bytes saved by the good dictionary over the bad one, a byte of text), ``score`` (0 to 1,
    the probability of a good label) and ``predicted`` (1 from ``cutoff`` on).

    Null texts are empty; an empty text has the average evidence.  Null ids are in no fold
    that is held out and have no label; null labels are no labels, an id whose labels
    contradict each other has none.  Repeated rows give a row each.  Without labels, or with
    those of one class, every score is the smoothed share of good labels (a half without any).  Only the id and
    the text of ``docs`` are read, and the id decides nothing but the fold.
    """
    spark = docs.sparkSession
    fold = lambda c: F.crc32(F.col(c).cast("string")) % folds
    marks = (
        labels.where(F.col(id_col).isNotNull() & F.col(good_col).isNotNull())
        .groupBy(F.col(id_col).alias("_key")).agg(F.min(good_col).alias("lo"), F.max(good_col).alias("hi"))
        .where("(lo > 0) = (hi > 0)").select("_key", (F.col("lo") > 0).alias("_good"))
        .where(fold("_key") != 0).withColumn("_h", F.xxhash64("_key", F.lit(11)))
    )
    marks = materialize(marks.withColumn("_teach", F.pmod("_h", F.lit(2)) == 0), "quality-labels")
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    )

    def dictionary(good: bool) -> bytes:
        # at most sample_docs ids and sample_pieces pieces of 1 KB come to the driver, at any size
        chosen = marks.where(F.col("_teach") & (F.col("_good") == good)).orderBy("_h", "_key").limit(sample_docs)
        cut = rows.join(F.broadcast(chosen), F.col("_id") == F.col("_key")).select("_key", "_good", "_text")
        cut = cut.mapInArrow(_cut, "good boolean, order binary, piece binary")
        return build_dictionary([bytes(r["piece"]) for r in cut.orderBy("order", "piece").limit(sample_pieces).collect()])

    schema = T.StructType([
        T.StructField("_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("excess", T.LongType()),
    ])
    sized = materialize(rows.mapInArrow(_sizes(dictionary(True), dictionary(False)), schema), "quality-sizes")
    taught = sized.join(marks.where("NOT _teach"), F.col("_id") == F.col("_key")).select("_good", "n", "excess")
    mean = taught.agg(F.try_divide(F.sum("excess"), F.sum("n"))).first()[0] or 0.0
    evidence = (F.col("excess") + SHRINK * F.lit(float(mean))) / (F.col("n") + SHRINK)
    counts = taught.groupBy(F.round(evidence / STEP).alias("bin"), "_good").agg(F.count(F.lit(1)).alias("rows"))
    # bins of the evidence: a few thousand rows, whatever the corpus
    knots = fit_curve([(r["bin"] * STEP, r["_good"], r["rows"]) for r in counts.collect()])
    held = F.coalesce(fold("_id") == 0, F.lit(False))
    out = sized.select(
        F.col("_id").alias(id_col), held.alias("held_out"), F.col("n").alias("n_bytes"), evidence.alias("evidence")
    ).withColumn("score", _on_curve(F.col("evidence"), knots))
    return out.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
