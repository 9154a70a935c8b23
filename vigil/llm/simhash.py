"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance ``d`` or less share a *variant*: a value within
half of ``d`` of both (for an odd ``d``, within (d+1)/2 of one and (d-1)/2 of the
other).  Every distinct fingerprint therefore stands for all its variants within
half the radius, rows meet on variants, and the members of a variant are linked.

All variants of a fingerprint are far more bytes than the fingerprint.  They are
shuffled by their leading bits: a fingerprint is sent once to every bucket of
variants that holds some of its own (one per way to flip at most half the radius
of the bucket's key bits) and its variants in that bucket are written out there,
sorted, and compared.  The number of key bits follows the number of distinct
fingerprints, so a bucket's variants fit a task at any size of the input, and no
bucket is as wide as a popular text: a text's copies are one fingerprint.

The members of a variant form a clique, so linking each to the smallest is enough
to keep the components whole; a bucket returns a forest of its links, never pairs.
Every link is verified by its bit distance.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import materialize
from vigil.llm.components import components
from vigil.llm.spread import told_apart

#: Variants that one bucket holds on average.
BUCKET_VARIANTS = 3_000_000


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text: ASCII letters in lower case, words split at
    ASCII white space, shingles of ``shingle`` words (a shorter text is one
    shingle), XXH64 with seed 42; a bit is set if over half the hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    counts = np.zeros(64, np.int64)
    h = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        pairs = zip(starts[at:min(n, at + (1 << 16))].tolist(), last[at:at + (1 << 16)].tolist())
        hashes = np.array([h(joined[a:b], 42) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def row_key(id_col: str, text_col: str) -> Column:
    """(id is null, id, 128 bits of SHA-256 of the text): rows with one key are copies of one row."""
    return F.struct(
        F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"),
        F.substring(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256), 1, 32).alias("h"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """Per row: ``_id``, ``_key`` (:func:`row_key`) and ``_fp`` (the fingerprint as a signed long)."""
    slim = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), row_key(id_col, text_col).alias("_key")
    )
    keep = [f for f in slim.schema.fields if f.name != "_text"]

    def run(batches):
        for batch in batches:
            fps = [_signed(fingerprint((t.as_py() or "").encode("utf-8"), shingle)) for t in batch.column(1)]
            columns = [batch.column(f.name) for f in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps, pa.int64())], [*(f.name for f in keep), "_fp"])

    return slim.mapInArrow(run, T.StructType([*keep, T.StructField("_fp", T.LongType())]))


def _flips(bits: int, most: int) -> list[np.ndarray]:
    """By number of flips 0..most: all masks of so many of ``bits`` low bits."""
    return [
        np.array([sum(1 << b for b in c) for c in combinations(range(bits), k)], np.uint64)
        for k in range(most + 1)
    ]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (per index the smallest of its class) after linking ``a`` with ``b``."""
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _bucket_links(fps: np.ndarray, key: int, key_bits: int, max_bits: int) -> np.ndarray:
    """For the sorted fingerprints of one bucket: per fingerprint the smallest one
    (by index) that it is linked to, directly or not, through this bucket's variants."""
    near, far = max_bits // 2, max_bits - max_bits // 2
    low_bits = 64 - key_bits
    mask = np.uint64((1 << low_bits) - 1) if low_bits < 64 else np.uint64(2**64 - 1)
    shift = np.uint64(low_bits)
    high = (fps >> shift) if key_bits else np.zeros_like(fps)
    used = np.bitwise_count(high ^ np.uint64(key))
    low = fps & mask
    size = sum(int((used == d).sum()) * comb(low_bits, k) for d in range(far + 1) for k in range(far - d + 1))
    if size > 2 * BUCKET_VARIANTS and low_bits > 8:  # a crowded corner: one sub-bucket after the other
        root = np.arange(len(fps))
        more = min(8, ceil(log2(size / BUCKET_VARIANTS)))
        for sub in range(key << more, (key + 1) << more):
            at = np.flatnonzero(np.bitwise_count((fps >> np.uint64(low_bits - more)) ^ np.uint64(sub)) <= far)
            if len(at) > 1:
                root = _merge(root, at, at[_bucket_links(fps[at], sub, key_bits + more, max_bits)])
        return root
    flips = _flips(low_bits, far)
    variants, owners, close = [], [], []
    index = np.arange(len(fps), dtype=np.int32)
    for d in range(far + 1):
        at = index[used == d]
        for k in range(far - d + 1):
            variants.append((low[at][:, None] ^ flips[k][None, :]).ravel())
            owners.append(np.repeat(at, len(flips[k])))
            close.append(np.full(len(owners[-1]), d + k <= near))
    variant, owner, close = np.concatenate(variants), np.concatenate(owners), np.concatenate(close)
    order = np.argsort(variant)
    variant = variant[order]
    same = variant[1:] == variant[:-1]
    # positions of variants with several owners only
    shared = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    root = np.arange(len(fps))
    if not len(shared):
        return root
    variant, owner, close = variant[shared], owner[order[shared]], close[order[shared]]
    begins = np.flatnonzero(np.concatenate(([True], variant[1:] != variant[:-1])))
    lengths = np.diff(np.append(begins, len(variant)))
    # any member within the smaller radius is in reach of all members
    anchor = np.repeat(np.minimum.reduceat(np.where(close, owner, len(fps)), begins), lengths)
    ok = (anchor < len(fps)) & (anchor != owner)
    pairs = np.unique(owner[ok].astype(np.int64) * len(fps) + anchor[ok])
    a, b = pairs // len(fps), pairs % len(fps)
    true = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    return _merge(root, a[true], b[true])


def links(distinct: DataFrame, max_bits: int = 4, count: int | None = None) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``_fp`` at ``max_bits`` or fewer
    differing bits, as many as keep the components whole."""
    half = max_bits - max_bits // 2
    count = distinct.count() if count is None else count
    variants = count * sum(comb(64, k) for k in range(half + 1))
    key_bits = max(2, min(48, ceil(log2(max(1, variants / BUCKET_VARIANTS)))))

    def route(batches):
        masks = np.concatenate(_flips(key_bits, half))
        for batch in batches:
            fps = batch.column(0).to_numpy().astype(np.int64)
            keys = ((fps.view(np.uint64) >> np.uint64(64 - key_bits))[:, None] ^ masks[None, :]).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int64)), pa.array(np.repeat(fps, len(masks)))], ["_key", "_fp"]
            )

    def meet(key, rows):
        fps = np.sort(rows.column("_fp").to_numpy().astype(np.int64).view(np.uint64))
        root = _bucket_links(fps, key[0].as_py(), key_bits, max_bits)
        at = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"u": pa.array(fps[at].view(np.int64)), "v": pa.array(fps[root[at]].view(np.int64))})

    routed = distinct.select("_fp").mapInArrow(route, "_key long, _fp long")
    return routed.groupBy("_key").applyInArrow(meet, "u long, v long")


def _classes(rows: DataFrame, key: Column, max_bits: int) -> DataFrame:
    """(_fp, _least): per distinct fingerprint ``_fp`` of ``rows`` the least ``key`` of its component."""
    distinct = materialize(rows.groupBy("_fp").agg(F.min(key).alias("_first")), "distinct")
    nodes = components(links(distinct, max_bits))
    rooted = distinct.join(nodes, distinct["_fp"] == nodes["node"], "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root")
    )
    whole = rooted.groupBy("_root").agg(F.min("_first").alias("_least"))
    return materialize(rooted.join(whole, "_root").select("_fp", "_least"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """Per input row: ``id_col``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the
    smallest id reachable through links of at most ``max_bits`` differing bits, its own
    included) and ``keep`` (true for one row of each component: the smallest id, of equal
    ids any one).

    Null and empty texts and texts of white space have fingerprint zero and are
    linked like any other.  Ids may repeat; null ids stay null, come last, and do
    not name a component unless it has no other (then it is null).  Whole texts
    are read, however long; extra columns are ignored, whatever their names.  An
    empty table gives an empty table.
    """
    rows = materialize(
        fingerprints(docs, id_col, text_col, shingle).drop("_key").withColumn("_row", F.monotonically_increasing_id()),
        "fingerprints",
    )
    place = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    return rows.join(_classes(rows, place, max_bits), "_fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_least.id").alias("component_id"),
        (F.col("_least.row") == F.col("_row")).alias("keep"),
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each group of :func:`near_duplicates`: the row that ``keep`` marks, of
    rows equal in id and text any one.

    Only keys and fingerprints are written.  Rows whose key is neither to go nor repeated (nearly
    all) pass without a shuffle; the others are joined by key.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle).select("_key", "_fp"), "fingerprints")
    counted = rows.groupBy("_key", "_fp").agg(F.count(F.lit(1)).alias("n")).join(
        _classes(rows, F.col("_key"), max_bits), "_fp"
    )
    special = materialize(
        counted.select("_key", (F.col("_key") == F.col("_least")).alias("keep"), "n").where("NOT keep OR n > 1"), "losers"
    )
    keyed = docs.select(row_key(id_col, text_col).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    maybe, rest = told_apart(keyed, F.col("_key"), special.select("_key"))
    told = maybe.join(special, "_key", "left")
    once = told.where("keep").dropDuplicates(["_key"])
    return told.where("keep IS NULL").select("_doc.*").unionAll(once.select("_doc.*")).unionAll(rest.select("_doc.*"))
