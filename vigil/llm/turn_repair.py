"""Repair of a conversation's structure: the cheapest edits that make its roles alternate.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turns.  Its rows, in order, are kept
(cost 0), given the role user or assistant (3) or deleted (4, the only edit of blank and
repeated rows); empty turns may be inserted anywhere (3); a truncated row that stays
costs 3 more.  Among the cheapest edit sequences the one whose audit (initials of
its edits, K R D I) is least in ASCII order is taken.

A dynamic program runs along the rows over four states.  Its audits are not strings but
linked nodes that share their prefixes (:class:`Audits`): a node knows its parent, its
letter, a rolling hash of the audit that it ends, and ancestors at distances of powers of
two, so that two audits of equal cost are compared by a search for their longest common
prefix.  Equal hashes are verified letter by letter, and what was found equal is
remembered, so no part is verified twice.

Two audits that meet in a state at equal cost never are a proper prefix of each other
(both have one letter a row, and every further I costs 3), so comparing them by their
first different letter is right whatever follows.

Spark computes each row's faults and sorts, per conversation, first short rows of faults
and then the texts; a task sees a conversation's faults, decides, and hashes the texts as
they stream past: it never holds them.  It holds some hundred bytes per row of the one
conversation at hand.  The program and the digest of the repaired text are sequences, so a
conversation is one task's work.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: A Mersenne prime and a base of the rolling hash of audits.
_PRIME = (1 << 61) - 1
_BASE = 1_000_003

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn with this initial leads from a state.
_STEP = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: The only role that an inserted or relabelled turn can have after a state.
_WANTED = ("u", "u", "a", "u")

_ADJACENT = ("su", "ua", "au")
_WHITE = " \t\n\x0b\f\r"


class Audits:
    """A growing tree of audits; node 0 is the empty one.

    A node keeps its parent and one ancestor farther up, at a distance that follows from its
    depth alone (two equal leaps in a row are joined with a step into one): ancestors of any
    depth, and the first difference of two audits, are found in logarithmic time.
    """

    def __init__(self, prime: int = _PRIME):
        self.prime = prime
        self.depth, self.hash, self.letter = array("q", [0]), array("Q", [0]), bytearray(b"\0")
        self.ups = array("q")  # parent and far ancestor of the nodes 1, 2, ...
        self.same: dict[int, int] = {}  # nodes found to spell the same audit: the lesser of them

    def add(self, parent: int, letter: str) -> int:
        depth, code = self.depth[parent] + 1, ord(letter)
        self.depth.append(depth)
        self.hash.append((self.hash[parent] * _BASE + code) % self.prime)
        self.letter.append(code)
        far, leap = parent, self._far(parent)
        if leap and self.depth[parent] - self.depth[leap] == self.depth[leap] - self.depth[self._far(leap)]:
            far = self._far(leap)
        self.ups.append(parent)
        self.ups.append(far)
        return len(self.letter) - 1

    def _parent(self, node: int) -> int:
        return self.ups[2 * node - 2] if node else 0

    def _far(self, node: int) -> int:
        return self.ups[2 * node - 1] if node else 0

    def up(self, node: int, steps: int) -> int:
        """The ancestor ``steps`` above."""
        depth = self.depth[node] - steps
        while self.depth[node] > depth:
            far = self._far(node)
            node = far if self.depth[far] >= depth else self._parent(node)
        return node

    def _known(self, node: int) -> int:
        while node in self.same:
            node = self.same[node]
        return node

    def _verified(self, a: int, b: int) -> tuple[int, int] | None:
        """None if two nodes of equal hash and depth spell the same audit, else the highest
        pair of their ancestors whose letters differ."""
        seen, differ = [], None
        a, b = self._known(a), self._known(b)
        while a != b:
            seen.append((max(a, b), min(a, b)))
            if self.letter[a] != self.letter[b]:
                differ, seen = (a, b), []
            a, b = self._known(self._parent(a)), self._known(self._parent(b))
        if differ is None:
            self.same.update(seen)
        return differ

    def compare(self, a: int, b: int) -> int:
        """-1, 0 or 1 as the audit of ``a`` is less than, equal to or greater than that of ``b``."""
        longer = self.depth[a] - self.depth[b]
        x, y = self.up(a, max(longer, 0)), self.up(b, max(-longer, 0))
        if x == y or self.hash[x] == self.hash[y] and not (differ := self._verified(x, y)):
            return (longer > 0) - (longer < 0)
        if self.hash[x] == self.hash[y]:
            x, y = differ
        else:
            # climb while the ancestors differ: the last such pair has equal parents
            while True:
                p, q = self._far(x), self._far(y)
                if p == q or self.hash[p] == self.hash[q]:
                    p, q = self._parent(x), self._parent(y)
                    if p == q or self.hash[p] == self.hash[q]:
                        break
                x, y = p, q
            if p != q and (differ := self._verified(p, q)):
                x, y = differ
        return -1 if self.letter[x] < self.letter[y] else 1

    def text(self, node: int) -> str:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self._parent(node)
        return out[::-1].decode()


def repair(rows, audits: Audits | None = None) -> tuple[int, str]:
    """(cost, audit) for rows of (initial, must go, truncated), in order."""
    tree = audits or Audits()
    best: list = [(0, 0), None, None, None]  # a state's cost and audit

    def better(old, cost, parent, letter):
        """The cheaper of ``old`` and the audit of ``parent`` with ``letter``; ties by the audits."""
        if old is not None and old[0] < cost:
            return old
        new = (cost, tree.add(parent, letter))
        return old if old is not None and old[0] == cost and tree.compare(old[1], new[1]) <= 0 else new

    def insert():
        for state in (START, SYSTEM, ASSISTANT, USER):
            if best[state] is not None:
                to = ASSISTANT if state == USER else USER
                best[to] = better(best[to], best[state][0] + INSERT, best[state][1], "I")

    insert()
    for initial, gone, truncated in rows:
        stay = TRUNCATED if truncated else 0
        old, best[:] = best[:], [None] * 4
        for state, known in enumerate(old):
            if known is None:
                continue
            cost, node = known
            best[state] = better(best[state], cost + DELETE, node, "D")
            if gone:
                continue
            if (to := _STEP.get((state, initial))) is not None:
                best[to] = better(best[to], cost + stay, node, "K")
            to = ASSISTANT if state == USER else USER
            best[to] = better(best[to], cost + RELABEL + stay, node, "R")
        insert()
    ends = [x for x in (best[START], best[ASSISTANT]) if x is not None]
    cost, node = ends[0]
    for other in ends[1:]:
        if other[0] < cost or other[0] == cost and tree.compare(other[1], node) < 0:
            cost, node = other
    return cost, tree.text(node)


class _Repaired:
    """The digest of the repaired text, from the audit and the rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first = audit, 0, START, True
        self.sha = hashlib.sha256()

    def _put(self, initial: str, role: bytes, text: bytes) -> None:
        self.sha.update((b"" if self.first else b"\n") + role + b":")
        self.sha.update(text)
        self.first, self.state = False, _STEP[(self.state, initial)]

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            wanted = _WANTED[self.state]
            self._put(wanted, b"user" if wanted == "u" else b"assistant", b"")

    def row(self, role: bytes, text: bytes) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role[:1].decode(), role, text)
        elif edit == "R":
            wanted = _WANTED[self.state]
            self._put(wanted, b"user" if wanted == "u" else b"assistant", text)

    def digest(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


class _Conversation:
    """One conversation as its rows stream past: first the faults, then the texts."""

    def __init__(self, conv):
        self.conv = conv
        self.rows, self.seen = [], set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high, self.last, self.before = 0, None, None, None, None
        self.done = None

    def fault(self, turn, initial, blank, truncated, name):
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += self.last is None or turn != self.last
            self.last = self.high = turn
        if self.before is not None and self.before + initial not in _ADJACENT:
            self.illegal += 1
        self.before = initial
        repeated = not blank and name in self.seen
        self.seen.add(name)
        cut = truncated and not blank and not repeated
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + repeated, self.truncated + cut
        self.rows.append((initial, blank or repeated, cut))

    def decide(self):
        if self.done is None:
            self.cost, self.audit = repair(self.rows)
            self.done = _Repaired(self.audit)
            self.rows, self.seen = [], set()
        return self.done

    def result(self):
        digest = self.decide().digest()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, digest)


_OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _stream(schema: pa.Schema, many: int = 4096):
    """Rows sorted by conversation, phase and order -> one row per conversation."""

    def run(batches):
        now, out, started = None, [], False

        def flush():
            columns = zip(*out) if out else [[] for _ in schema]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
            )
            out.clear()
            return batch

        for batch in batches:
            bytes_of = lambda c: batch[c].cast(pa.large_binary()).to_pylist()
            convs, phases, turns = (batch[c].to_pylist() for c in ("conv", "phase", "turn"))
            blanks, cuts = batch["blank"].to_pylist(), batch["cut"].to_pylist()
            for conv, phase, turn, initial, blank, cut, name, role, text in zip(
                    convs, phases, turns, batch["initial"].to_pylist(), blanks, cuts, batch["name"].to_pylist(),
                    bytes_of("role"), bytes_of("text")):
                if not started or now.conv != conv:
                    if started:
                        out.append(now.result())
                    now, started = _Conversation(conv), True
                if phase == 1:
                    now.fault(turn, initial, blank, cut, name)
                elif phase == 2:
                    now.decide().row(role, text)
            if len(out) >= many:
                yield flush()
        if started:
            out.append(now.result())
            yield flush()

    return run


def repair_turns(rows: DataFrame, all_ids: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv id, gaps (turn numbers missing between the least and the greatest), blank,
    duplicate, truncated (rows by their first fault), illegal (neighbours whose initials are none of su, ua,
    au), cost, audit and repaired_sha256 (of the repaired ``role:text`` lines).

    ``all_ids`` (conv id) names conversations that must appear even without rows; they may repeat.
    Rows are ordered by turn, nulls first, equal turns by role, then by a digest of role and text.
    Null roles and texts are one space; rows of a null id are a conversation.  Blank: nothing but
    white space (U+0020, U+0009 to U+000D); duplicate: role and text were there earlier; truncated: the
    last character that is no white space is none of ``. ! ?``.  No rows: zeros, an empty audit, the hash of
    nothing.  Other columns are ignored.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    ends = F.rtrim(text, F.lit(_WHITE))
    null = lambda t: F.lit(None).cast(t)
    base = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("_role"), text.alias("_text"),
        F.unhex(F.substring(F.sha2(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256), 1, 32))
        .alias("name"), ends.alias("_ends"),
    )
    faults = base.select(
        "conv", F.lit(1).alias("phase"), "turn", "_role", "name", F.substring("_role", 1, 1).alias("initial"),
        (F.col("_ends") == "").alias("blank"), (~F.right("_ends", F.lit(1)).isin(".", "!", "?")).alias("cut"),
        null("string").alias("role"), null("string").alias("text"),
    )
    texts = base.select(
        "conv", F.lit(2).alias("phase"), "turn", "_role", "name", null("string").alias("initial"),
        null("boolean").alias("blank"), null("boolean").alias("cut"), F.col("_role").alias("role"), F.col("_text").alias("text"),
    )
    ids = all_ids.select(F.col(conv_col).alias("conv")).distinct().select(
        "conv", F.lit(0).alias("phase"), null("long").alias("turn"), null("string").alias("_role"), null("binary").alias("name"),
        null("string").alias("initial"), null("boolean").alias("blank"), null("boolean").alias("cut"),
        null("string").alias("role"), null("string").alias("text"),
    )
    order = ["conv", "phase", F.col("turn").asc_nulls_first(), "_role", "name"]
    ordered = ids.union(faults).union(texts).repartition("conv").sortWithinPartitions(*order).drop("_role")
    fields = T.StructType([T.StructField(conv_col, rows.schema[conv_col].dataType), *T.StructType.fromDDL(_OUT).fields])
    return ordered.mapInArrow(_stream(to_arrow_schema(fields)), fields)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", one_in: int = 20) -> DataFrame:
    """Rows of conversations damaged by ``crc32(conv:turn) % one_in``: 0 drops the row, 1 empties its text,
    2 removes the text's ``. ! ?``, 3 repeats it, 4 makes its role user.  Nulls count as one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col))) % one_in
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate(said(text_col), ".!?", ""))
    out = rows.select(conv_col, turn_col, role_col, text_col).withColumn("_fault", fault).where("_fault != 0")
    out = out.withColumns({
        text_col: text.otherwise(said(text_col)), role_col: F.when(F.col("_fault") == 4, "user").otherwise(said(role_col)),
    })
    twice = F.when(F.col("_fault") == 3, F.lit(2)).otherwise(F.lit(1))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), twice))).drop("_copy", "_fault")
