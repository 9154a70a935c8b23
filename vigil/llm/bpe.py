"""Byte-level BPE by a tokenization automaton.

A *tokenization automaton* reads token sequences and accepts exactly those that
the merge rules would produce.  It starts as one state with a loop for every
byte and is refined by one *merge gadget* per rule ``(u, v) -> w``, in rule
order:

* every state with an arc ``u`` (followed by an arc ``v``) gets an arc ``w`` to
  the target of ``v``;
* the target of ``u`` is split: the ``u`` arcs now lead to a copy of it that
  lacks the arc ``v``, so ``u v`` can no longer be read one after the other.

All arcs with one label lead to one state, so a gadget adds exactly one state,
the newest on the chain of copies that belongs to ``u``; below its oldest copy
the chain of ``u = x y`` goes on with the copies ``y`` had when ``u`` was made.
The transition table is therefore kept as its changes: per gadget ``(u, v)`` its
rule, and per label its rule and two parts.  Whether the state that ``u`` leads
to has an arc ``t`` is read off by going down the chain: a copy as old as ``t``
or older has ``t`` iff it has the left part of ``t``, and a copy lacks exactly
the one arc its gadget took away.

A word's bytes have exactly one accepted tokenization, and so has each of its
prefixes.  Encoding therefore runs forward over the bytes: for every position
the labels that end there (a byte trie) are tried, and the one whose arc exists
in the state of the position where it starts sets the state.  Time and memory
are linear in the word.  Decoding concatenates the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from array import array

import regex

# The byte <-> printable character table of byte-level BPE files
# (printable Latin-1 bytes stand for themselves, the rest follow from U+0100),
# and the white space of the pattern that splits a text into words before any
# merge.  The pattern's letters and numbers are written out as ranges, which the
# standard engine scans several times faster than properties.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Words kept with their ids per Python worker in each of its cache's two
#: generations.
CACHE_WORDS = 300_000
#: Arcs kept, found or known to be missing.
HELD_ARCS = 1_000_000

#: Characters of text that are split at once.
CHUNK_CHARS = 1_000_000


def _byte_table() -> dict[str, int]:
    table = {chr(b): b for b in _PRINTABLE}
    other = [b for b in range(256) if b not in set(_PRINTABLE)]
    table.update({chr(256 + i): b for i, b in enumerate(other)})
    return table


def _classes(category: str, limit: int) -> str:
    """The code points below ``limit`` of a general category (one letter) as ranges for ``re``."""
    hits = [m.start() for m in regex.finditer(rf"\p{{{category}}}", "".join(map(chr, range(limit))))]
    out, i = [], 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
            j += 1
        out.append(f"\\U{hits[i]:08x}-\\U{hits[j]:08x}")
        i = j + 1
    return "".join(out)


def _splitter(limit: int):
    letters, numbers = _classes("L", limit), _classes("N", limit)
    return re.compile(
        f" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{numbers}]+"
        f"| ?[^{_WHITE}{letters}{numbers}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
    ).findall


class TokenAutomaton:
    """The automaton of one tokenizer file: ``encode_all(texts)``, ``decode(ids)``."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        to_byte = _byte_table()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        raw = lambda s: bytes(to_byte[c] for c in s)
        self.label = {i: raw(s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.label.update({i: s.encode() for s, i in self.special.items()})
        size = max(self.label) + 1

        left, right = array("i", [-1]) * size, array("i", [-1]) * size  # label -> its rule's parts
        made = array("i", [-1]) * size  # label -> its rule, -1 for a byte
        gadget: dict[tuple[int, int], int] = {}  # (u, v) -> rule
        # labels by their bytes, last byte first; a node has its label, the states found to have
        # an arc of that label or to lack it (None without a label), and the next nodes
        trie: dict = {}
        for i, b in self.label.items():
            if i not in self.special.values():
                below = trie
                for x in b[:0:-1]:
                    below = below.setdefault(x, (-1, None, {}))[2]
                below[b[0]] = (i, {}, below[b[0]][2] if b[0] in below else {})
        for rule, pair in enumerate(merges):
            x, y = pair if isinstance(pair, list) else pair.split(" ")
            u, v, w = vocab[x], vocab[y], vocab[x + y]
            if made[w] != -1 or len(self.label[w]) < 2:
                raise ValueError(f"two rules make the label {x + y!r}")
            left[w], right[w], made[w] = u, v, rule
            gadget[u, v] = rule
        self._left, self._right, self._made, self._gadget = left, right, made, gadget
        self._trie, self._rules = trie, len(merges)
        self._arcs = 0  # held in the trie's nodes
        self._size = array("i", [0]) * size
        for i, b in self.label.items():
            self._size[i] = len(b)
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._basic, self._astral = _splitter(0x10000), re.compile("[^\\x00-\uffff]").search
        self._any = None
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def has_arc(self, u: int, t: int) -> bool:
        """Whether the state that label ``u`` leads to has an arc ``t``."""
        left, right, made, gadget = self._left, self._right, self._made, self._gadget
        below = self._rules  # copies made by this rule or a later one lie behind
        while True:
            oldest = made[u]
            while True:
                rule = gadget.get((u, t))
                if rule is not None and rule < below:
                    return False
                if made[t] <= oldest:
                    break
                below = min(below, made[t] + 1)
                t = left[t]
            if oldest < 0:
                return True  # down at the first state, which has every byte
            below = min(below, oldest)
            u = right[u]

    def ids_of(self, words):
        """Per word (``bytes``), in any order best sorted: its one accepted token
        sequence.  What two neighbours have in common at their start is read once."""
        trie, size, has_arc = self._trie, self._size, self.has_arc
        last, before = [-1], b""  # by position: the arc that ends there
        for word in words:
            n, i = len(word), 0
            if self._arcs > HELD_ARCS:
                self._forget(trie)
            for x, y in zip(word, before):
                if x != y:
                    break
                i += 1
            del last[i + 1:]
            while i < n:
                j, i, node = i, i + 1, trie
                while True:
                    t, arcs, node = node[word[j]]
                    if arcs is not None:
                        if not j:  # the first state has every arc
                            break
                        u = last[j]
                        ok = arcs.get(u)
                        if ok is None:
                            ok = arcs[u] = has_arc(u, t)
                            self._arcs += 1
                        if ok:
                            break
                    j -= 1
                last.append(t)
            before, out, i = word, [], n
            while i:
                out.append(last[i])
                i -= size[last[i]]
            yield out[::-1]

    def _forget(self, trie) -> None:
        """Drop the arcs found so far."""
        below = [trie]
        while below:
            for _, arcs, node in below.pop().values():
                if arcs:
                    arcs.clear()
                below.append(node)
        self._arcs = 0

    def split(self, text: str) -> list[str]:
        """The words of a text that holds no special string."""
        if self._astral(text) is None:
            return self._basic(text)
        if self._any is None:
            self._any = _splitter(0x110000)
        return self._any(text)

    def pieces(self, text: str) -> list[tuple[bool, str]]:
        """(is special, text) pieces; special strings are tokens of their own."""
        if self._cut is None:
            return [(False, text)]
        return [(k % 2 == 1, s) for k, s in enumerate(self._cut.split(text)) if s]

    def encode_all(self, texts):
        """The ids of every whole text as little-endian unsigned 32-bit integers."""
        chunk, chars = [], 0
        for text in texts:
            chunk.append(text)
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self._encode(chunk)
                chunk, chars = [], 0
        yield from self._encode(chunk)

    def _encode(self, texts: list[str]):
        if len(self._new) >= CACHE_WORDS:
            self._new, self._old = {}, self._new
        new, old = self._new, self._old
        known, fresh, found = new.get, set(), []
        for text in texts:
            ids, lost = [], []  # lost: the places and words of ids not known yet
            for special, piece in self.pieces(text):
                if special:
                    ids.append(array("I", [self.special[piece]]).tobytes())
                    continue
                words, begin = self.split(piece), len(ids)
                ids += map(known, words)
                k = begin - 1
                try:
                    while True:
                        k = ids.index(None, k + 1)
                        lost.append((k, words[k - begin]))
                except ValueError:
                    pass
            fresh.update([w for _, w in lost])
            found.append((ids, lost) if lost else (b"".join(ids), lost))
        raw = []
        for w in fresh:
            if w in old:
                new[w] = old[w]
            else:
                raw.append((w.encode("utf-8"), w))
        raw.sort()
        for (_, w), ids in zip(raw, self.ids_of(b for b, _ in raw)):
            new[w] = array("I", ids).tobytes()
        for ids, lost in found:
            for k, w in lost:
                ids[k] = new[w]
            yield b"".join(ids) if lost else ids
        for b, w in raw:  # very long words are not kept
            if len(b) > 64:
                del new[w]

    def encode(self, text: str) -> bytes:
        """The ids of one whole text, packed."""
        return next(self.encode_all([text]))

    def decode(self, packed: bytes) -> bytes:
        """The labels of the arcs, one after another."""
        return b"".join(map(self.label.__getitem__, array("I", packed)))


_automata: dict[str, TokenAutomaton] = {}


def automaton(path: str) -> TokenAutomaton:
    """The automaton of a file, compiled once per Python process."""
    if path not in _automata:
        _automata[path] = TokenAutomaton(path)
    return _automata[path]


def encode_decode(docs, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = True):
    """Encode and decode every whole text.

    Returns one row per input row: the id column, ``ids`` (array<long>, left
    out with ``with_ids=False``), ``decoded`` (string, likewise), ``n_tokens``,
    ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the decoded text in UTF-8).

    Null texts are empty texts: no ids, and the digests of nothing.  Repeated
    rows and repeated ids give one output row each; null ids stay null; other
    columns are ignored.  A text of any length is encoded whole.  No shuffle:
    each task works through its rows one at a time.
    """
    import hashlib

    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    fields = [T.StructField(id_col, slim.schema["_id"].dataType)]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())]
    fields += [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def run(batches):
        a = automaton(tokenizer)
        sha = hashlib.sha256
        for batch in batches:
            ids, counts, id_digests, text_digests, id_lists, texts = batch.column(0), [], [], [], [], []
            for packed in a.encode_all(value.as_py() or "" for value in batch.column(1)):
                text = a.decode(packed)
                counts.append(len(packed) // 4)
                id_digests.append(sha(packed).hexdigest())
                # bytes that are no UTF-8 decode to the replacement character
                whole = text.decode("utf-8", "replace")
                text_digests.append(sha(whole.encode("utf-8")).hexdigest())
                if with_ids:
                    id_lists.append(list(array("I", packed)))
                    texts.append(whole)
            columns = [ids]
            if with_ids:
                columns += [pa.array(id_lists, pa.list_(pa.int64())), pa.array(texts, pa.string())]
            columns += [pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                        pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return slim.mapInArrow(run, T.StructType(fields))
