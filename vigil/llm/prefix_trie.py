"""A trie of conversations: every distinct prefix of turns is a node.

Turns are named by a digest, and a conversation becomes rows of ``width`` positional
columns ``t0, t1, ...`` (one row per block of turns).  ``GROUP BY up, ROLLUP (t0, t1,
...)`` aggregates all prefixes of a block together; ``grouping_id`` tells a prefix's
length.  Conversations that are longer go on in the next block, grouped by ``up``, the
digest of the prior block's full-length node.  A second ROLLUP, over the nodes and from
the last block to the first, sums leaves and savings over subtrees.

What keeps it even: copies of a whole conversation are counted once, under the smallest
id; from a node with one distinct conversation below it the rest of that conversation
is a path and is written out directly, so blocks are grouped only as deep as different
conversations agree; long conversations are cut into chunks of blocks for every join; a
node's parent is looked up with salts.  The digest of a node's ending ids is a sequence
by its definition: ids are sorted over all tasks and strung together there, and one task
a node hashes the strings one after the other.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import materialize
from vigil.llm.spread import lookup, positions

#: Turns a block.
WIDTH = 8
#: Blocks (or turns) of one conversation that are handled under one key.
CHUNK = 4096
#: Bytes of ids strung together before they go to the node's task.
FRAGMENT = 1 << 16

_EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turns_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, _pos, _tid): every turn in its place, named by 16 bytes of SHA-256 over role
    and text and 4 bytes that hold the text's length in UTF-8.

    Turns are ordered by ``turn_col``, nulls first; equal ones by role, then by name.  Null
    roles and texts are empty.  Rows without a conversation id belong to none and are left out.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = _digest(
        F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8")
    )
    size = F.unhex(F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    slim = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("_turn"), role.alias("_role"),
        F.concat(named, size).alias("_tid"),
    )
    order = [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_tid")]
    return positions(slim, "conv_id", order, "turns").select("conv_id", "_pos", "_tid")


def splice(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt from the first ``head`` turns of conversation ``base`` (fewer
    if it has fewer, none if it is absent) and its own turns after its first ``head``.

    ``base`` and ``head`` (at most ``most``) are expressions over ``conv_id``.  Returns the new
    turns and all ids (conv_id), ids whose conversation is now empty included.
    """
    convs = materialize(
        turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"base": base, "head": head}), "convs"
    )
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(sizes, "base", "left").withColumn(
        "taken", F.least("head", F.coalesce("there", F.lit(0))).cast("long")
    )
    # one row a chunk of turns: a conversation of any length is joined in even pieces
    chunks = convs.select("conv_id", "head", "taken", F.explode(F.sequence(F.lit(0), F.expr(f"n div {CHUNK}"))).alias("_chunk"))
    own = turns.withColumn("_chunk", F.expr(f"_pos div {CHUNK}")).join(chunks, ["conv_id", "_chunk"])
    own = own.where(F.col("_pos") >= F.col("head")).select(
        "conv_id", (F.col("_pos") - F.col("head") + F.col("taken")).alias("_pos"), "_tid"
    )
    first = turns.where(F.col("_pos") < most).withColumnRenamed("conv_id", "base")
    heads = convs.select("conv_id", "base", "taken").join(first, "base").where(F.col("_pos") < F.col("taken"))
    return own.union(heads.select("conv_id", "_pos", "_tid")), convs.select("conv_id")


def _fragments(batches):
    """Sorted (seq, conv_id) -> (seq, first, text): the ids comma-joined, in pieces."""
    seqs, firsts, texts = [], [], []
    seq, first, ids, size = None, None, [], 0

    def close():
        if ids:
            seqs.append(seq), firsts.append(first), texts.append(",".join(ids))

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(seqs, pa.int64()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())],
            names=["seq", "first", "text"],
        )
        seqs.clear(), firsts.clear(), texts.clear()
        return out

    for batch in batches:
        for s, c in zip(batch["seq"].to_pylist(), batch["conv_id"].to_pylist()):
            if s != seq or size > FRAGMENT:
                close()
                seq, first, ids, size = s, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if seqs:
            yield flush()
    close()
    if seqs:
        yield flush()


def _hashes(batches):
    """Sorted (seq, first, text) -> (seq, ends): SHA-256 of each sequence's pieces in order."""
    seq, state, seqs, ends = None, None, [], []

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(seqs, pa.int64()), pa.array(ends, pa.string())], names=["seq", "ends"])
        seqs.clear(), ends.clear()
        return out

    for batch in batches:
        for s, text in zip(batch["seq"].to_pylist(), batch["text"].to_pylist()):
            if s != seq:
                if state:
                    seqs.append(seq), ends.append(state.hexdigest())
                seq, state = s, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if seqs:
            yield flush()
    if state:
        seqs.append(seq), ends.append(state.hexdigest())
        yield flush()


def _ends(members: DataFrame) -> DataFrame:
    """(seq, ends): the digest of all ids that have the whole conversation ``seq``."""
    pieces = members.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(
        _fragments, "seq long, first long, text string"
    )
    return materialize(
        pieces.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(_hashes, "seq long, ends string"),
        "ends",
    )


def _string(items: str, value: str) -> Column:
    """Short hex digests of a bounded group, in the order of their numbers, as one digest."""
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(items, value))), lambda x: x[value]), ","), 256)


def _sequences(blocks: DataFrame, convs: DataFrame, cols: list[str]) -> DataFrame:
    """(conv_id, seq, len): ``seq`` the smallest id with the same whole conversation.  Digests of
    blocks are digested by chunks of blocks, then by conversation."""
    none = F.lit(bytearray(b""))
    rows = blocks.select("conv_id", "block", F.expr(f"block div {CHUNK}").alias("chunk"),
                         F.hex(_digest(*[F.coalesce(c, none) for c in cols])).alias("d"),
                         sum(F.col(c).isNotNull().cast("long") for c in cols).alias("size"))
    chunks = rows.groupBy("conv_id", "chunk").agg(_string("block", "d").alias("d"), F.sum("size").alias("size"))
    whole = chunks.groupBy("conv_id").agg(_string("chunk", "d").alias("name"), F.sum("size").alias("len"))
    named = materialize(
        convs.join(whole, "conv_id", "left").select(
            "conv_id", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("len", F.lit(0)).cast("long").alias("len")
        ),
        "named",
    )
    least = named.groupBy("name").agg(F.min("conv_id").alias("seq"), F.count(F.lit(1)).alias("n"))
    # a name may be shared by a third of all conversations
    return materialize(lookup(named, "name", least).drop("name"), "members")


def _rolled(rows: DataFrame, cols: list[str], aggregates: str) -> DataFrame:
    """``aggregates`` for every prefix of ``cols`` under each ``up``, with its length ``d``."""
    ends = " AND ".join(f"(grouping({c}) = 1 OR {c} IS NOT NULL)" for c in cols)
    names = ", ".join(cols)
    return rows.sparkSession.sql(
        f"SELECT up, {names}, CAST({len(cols)} - bit_count(grouping_id()) AS BIGINT) AS d, {aggregates} "
        f"FROM {{rows}} GROUP BY up, ROLLUP ({names}) HAVING {ends}",
        rows=rows,
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per distinct prefix of turns, the empty one (the root) included.

    ``turns`` (conv_id, _pos, _tid) are numbered from 0 without gaps, ``_tid`` as
    :func:`turns_of` makes it; ``convs`` (conv_id) holds every id once, those without turns
    too.  Columns: conv_id (the smallest member's id), depth, parent_conv_id (null at the
    root), n_convs (members), n_children, n_leaves (childless nodes of the subtree, itself
    included), saved_tokens (over the subtree, ``n_convs - 1`` times the bytes of a node's last text),
    ends_sha256 (SHA-256 of the ids that end here, ascending, comma-joined).  (depth, conv_id)
    is a key.  No conversations give no rows.
    """
    cols = [f"t{i}" for i in range(width)]
    none = F.lit(bytearray(b""))
    name_to = lambda d: F.when(d > 0, _digest(F.col("up"), *[
        F.when(F.lit(i) < d, F.col(c)).otherwise(none) for i, c in enumerate(cols)])).otherwise(F.col("up"))
    blocks = materialize(
        turns.groupBy("conv_id", F.expr(f"_pos div {width}").alias("block")).agg(*[
            F.max(F.when(F.col("_pos") % width == i, F.col("_tid"))).alias(c) for i, c in enumerate(cols)
        ]).repartitionByRange("block", "conv_id").sortWithinPartitions("block", "conv_id"),
        "blocks",
    )
    members = _sequences(blocks, convs, cols)
    ends = _ends(members.select("seq", "conv_id"))
    alive = members.where("conv_id = seq").select("seq", "n", "len", F.lit(bytearray(b"\0")).alias("up"))
    on_block = lambda b: blocks.where(F.col("block") == b).select(F.col("conv_id").alias("seq"), *cols)

    # down the blocks: nodes, and the paths that leave them
    levels, paths, block = [], [], 0
    while True:
        rows = materialize(alive.join(on_block(block), "seq", "left"), "rows")
        last = F.coalesce(*[F.when(F.col("d") == i + 1, F.col(c)) for i, c in enumerate(cols)])
        nodes = _rolled(
            rows, cols, "sum(n) AS n_convs, min(seq) AS conv_id, count(1) AS n_seqs, min(len) AS shortest, "
            "max(len) AS longest, min_by(seq, len) AS short_seq",
        ).where("d > 0" if block else "true").select(
            "*", (F.col("d") + block * width).alias("depth"), name_to(F.col("d")).alias("name"),
            F.when(F.col("d") > 0, name_to(F.col("d") - 1)).alias("parent_name"),
            F.coalesce(F.conv(F.hex(F.substring(last, 17, 4)), 16, 10).cast("long"), F.lit(0)).alias("bytes"),
        )
        nodes = materialize(nodes, "nodes")
        levels.append(nodes)
        full = nodes.where((F.col("d") == width) & (F.col("longest") > F.col("depth")))
        lone = full.where("n_seqs = 1").select(F.col("conv_id").alias("seq"))
        paths.append(full.where("n_seqs = 1").select(
            F.col("conv_id").alias("seq"), F.col("depth").alias("from"), F.col("longest").alias("len"),
            F.col("n_convs").alias("n")))
        if full.where("n_seqs > 1").isEmpty():
            break
        block += 1
        alive = rows.where(F.col("len") > block * width).select(
            "seq", "n", "len", name_to(F.lit(width)).alias("up")).join(lone, "seq", "left_anti")

    # the paths: one row a turn, joined to their blocks by chunks
    leaving = paths[0]
    for p in paths[1:]:
        leaving = leaving.union(p)
    leaving = leaving.withColumn("chunk", F.explode(F.expr(
        f"sequence(`from` div {width} div {CHUNK}, (len - 1) div {width} div {CHUNK})")))
    pieces = blocks.select(
        F.col("conv_id").alias("seq"), "block", F.expr(f"block div {CHUNK}").alias("chunk"), F.array(*cols).alias("ts")
    )
    path = (
        leaving.join(pieces, ["seq", "chunk"]).where(F.expr(f"block >= `from` div {width}"))
        .select("seq", "from", "len", "n", "chunk", "block", F.posexplode("ts").alias("i", "t")).where("t IS NOT NULL")
        .select("seq", "from", "len", "n", "chunk", (F.col("block") * width + F.col("i") + 1).alias("depth"),
                ((F.col("n") - 1) * F.conv(F.hex(F.substring("t", 17, 4)), 16, 10).cast("long")).alias("own"))
    )
    path = materialize(path, "paths")
    sums = path.groupBy("seq", "chunk").agg(F.sum("own").alias("all"))
    later = Window.partitionBy("seq").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    after = sums.withColumn("after", F.coalesce(F.sum("all").over(later), F.lit(0))).select("seq", "chunk", "after")
    within = Window.partitionBy("seq", "chunk").orderBy(F.desc("depth"))
    # without copies nothing is saved, and nothing needs summing
    copied = path.where("n > 1").withColumn("part", F.sum("own").over(within)).join(after, ["seq", "chunk"])
    path_rows = path.where("n = 1").withColumn("saved", F.lit(0).cast("long")).unionByName(
        copied.withColumn("saved", F.col("part") + F.col("after")).drop("part", "after")
    ).select(
        F.col("seq").alias("conv_id"), "depth", F.col("seq").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("depth") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.when(F.col("depth") == F.col("len"), F.col("seq")).alias("end_seq"),
    )
    below_path = path.groupBy(F.col("seq").alias("conv_id")).agg(F.sum("own").alias("path_saved"))

    # up the blocks: leaves and savings of subtrees
    totals, below = None, None
    for nodes in reversed(levels):
        own = nodes.select("up", *cols, "d", "depth", "conv_id", "name", (F.col("longest") == F.col("depth")).cast("long").alias("leaf"),
                           ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                           ((F.col("d") == width) & (F.col("n_seqs") == 1) & (F.col("longest") > F.col("depth"))).alias("leaves"))
        own = own.join(below_path.withColumn("leaves", F.lit(True)), ["conv_id", "leaves"], "left")
        leaf, saved = F.col("leaf") + F.col("leaves").cast("long"), F.col("saved") + F.coalesce("path_saved", F.lit(0))
        if below is not None:
            own = own.join(below, "name", "left")
            leaf = leaf + F.coalesce("below_leaf", F.lit(0))
            saved = saved + F.coalesce("below_saved", F.lit(0))
        rolled = materialize(_rolled(
            own.select("up", *cols, "depth", "conv_id", leaf.alias("leaf"), saved.alias("saved")), cols,
            "min(depth) AS depth, min_by(conv_id, depth) AS conv_id, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens",
        ), "totals")
        below = rolled.where("d = 0").select(
            F.col("up").alias("name"), F.col("n_leaves").alias("below_leaf"), F.col("saved_tokens").alias("below_saved")
        )
        found = rolled.where("d > 0" if nodes is not levels[0] else "true").select(
            "depth", "conv_id", "n_leaves", "saved_tokens")
        totals = found if totals is None else totals.union(found)

    every = None
    for nodes in levels:
        part = nodes.select("depth", "conv_id", "name", "parent_name", "n_convs",
                            ((F.col("d") == width) & (F.col("n_seqs") == 1) & (F.col("longest") > F.col("depth")))
                            .cast("long").alias("more"),
                            F.when(F.col("shortest") == F.col("depth"), F.col("short_seq")).alias("end_seq"))
        every = part if every is None else every.union(part)
    children = every.where("parent_name IS NOT NULL").groupBy(F.col("parent_name").alias("name")).agg(
        F.count(F.lit(1)).alias("n"))
    parents = every.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("parent_conv_id"))
    grown = lookup(every, "parent_name", parents).join(children, "name", "left").join(totals, ["depth", "conv_id"])
    grown = grown.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.coalesce("n", F.lit(0)) + F.col("more")).alias("n_children"),
        "n_leaves", "saved_tokens", "end_seq",
    )
    out = grown.union(path_rows.select(*grown.columns))
    return out.join(ends, out["end_seq"] == ends["seq"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(_EMPTY_HASH)).alias("ends_sha256"),
    )


def spliced_trie(rows: DataFrame, step: int = 5, most: int = 9, width: int = WIDTH, **names) -> DataFrame:
    """The trie of the conversations of ``rows`` rebuilt on others: conversation c begins with the
    first ``crc32(c as text) % most`` turns of conversation ``c - c % step`` (remainders as SQL
    takes them: with the sign of ``c``)."""
    conv = F.col("conv_id")
    turns, convs = splice(
        turns_of(rows, **names), conv - conv % step, F.crc32(conv.cast("string")) % most, most
    )
    return prefix_trie(turns, convs, width)
