"""Language-model scoring by online logistic context mixing.

A text is the sequence of its words, lower-cased (A-Z), joined by single spaces
and closed by an end symbol.  A symbol is coded as decisions on the way down a
Huffman tree of the training symbols, and every decision (bit) is predicted:

1. several *hashed-context predictors* - the last three symbols, the last five, and
   the word so far - each look up (context, tree node) in a table
   of how often the bit was 0 and 1 in training texts;
2. a *gated mixer* adds their log odds with weights chosen by the tree node and by
   which of the contexts have been met in training;
3. an *adaptive probability map* refines the mixed probability by what came of
   equally confident predictions at that node;
4. while a text is scored, the mixer adapts to it: a scale of its weights is
   corrected online along the gradient of the coding cost, at symbol 64, 128, ...

Tasks count their own documents by (context, tree node), hand the counts on when
they hold many, and these are added slice by slice.  Symbols are grouped by
occasion first (the same contexts and symbol): what happens again among some millions of
symbols is looked up, mixed and counted once.  The number of distinct keys
found sizes each context's table: at most one slot in SPARE is filled, so that the
tables, and the memory they take, grow with the training text.  The documents that are learned from are split:
most fill the tables, the rest teach the mixer and the map, as predictions of
texts already counted would look better than they are.  Both read all of their
documents.  The teaching documents are dealt to tasks by id and text and sorted there, so
many tasks as their number asks for, and every text is scored from the same start: scores
do not depend on how the input is partitioned (but for the rounding of sums over tasks).
"""

from __future__ import annotations

import heapq
import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize
from vigil.llm.lookup import document_sums, split_head, word_counts

END = 256  # the symbol after the last word
SYMBOLS = 257
ORDERS = (3, 5)  # lengths of the contexts of symbols; the word so far is one more
CONTEXTS = 3
#: Bits of the number of slots of a context's table: least and most (a bit of the hash is the decision's).
SLOT_BITS = 21
MOST_BITS = 31
#: Slots per distinct key, at least; a slot is one byte, log odds times SCALE.
SPARE = 4
SCALE = 16
#: Bits of the number of slices in which a context's keys are added up.
SLICE_BITS = 8
#: Steps of the map, symbols worked on at once, learning rates of mixer and text.
STEPS = 65
CHUNK_SYMBOLS = 400_000
#: Symbols whose like occasions (contexts and symbol) are told apart together, and symbols scored at once.
ALIKE_SYMBOLS = 3_200_000
BLOCK_SYMBOLS = 16_384
#: Symbols that are counted before a task looks at how many distinct (context, symbol) it holds, and most of a context.
COUNTED_AT_ONCE = 4_000_000
HELD_KEYS = 1_000_000
MIXER_RATE = 0.02
GATES = 8  # per node: which of the contexts are known
TEXT_RATE = 0.002
#: One in so many of the training documents teaches the mixer and the map.
TUNE_PART = 32
#: Documents from which one task teaches its mixer.
TUNE_DOCUMENTS = 2048
FIRST_CHECK = 64

# Odd multipliers of the hashes; contexts and tree nodes meet in 32 bits.
_NODE, _SLOT = np.uint32(0x85EBCA6B), np.uint32(0x9E3779B1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SIGN = np.uint32(1 << 31)


def words_of(text: str) -> list[str]:
    """The text's words, A-Z in lower case."""
    words = text.encode("utf-8").lower().split()
    return b" ".join(words).decode("utf-8").split(" ") if words else []


def symbols_of(text: str) -> np.ndarray:
    """The text's symbols: its words joined by spaces, and the end."""
    joined = b" ".join(text.encode("utf-8").lower().split())
    return np.append(np.frombuffer(joined, np.uint8).astype(np.int16), np.int16(END))


class Tree:
    """The Huffman tree of the symbol counts: per symbol and depth the node passed and the bit taken."""

    def __init__(self, counts):
        heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        up, made = {}, 0
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            node = SYMBOLS + made
            up[x], up[y] = (node, 0), (node, 1)
            heapq.heappush(heap, (a + b, node, node))
            made += 1
        paths = []
        for s in range(SYMBOLS):
            path, x = [], s
            while x in up:
                x, bit = up[x]
                path.append((x - SYMBOLS, bit))
            paths.append(path[::-1])
        self.depth = np.array([len(p) for p in paths], np.int16)
        longest = int(self.depth.max())
        self.node = np.zeros((longest, SYMBOLS), np.uint32)
        self.bit = np.zeros((longest, SYMBOLS), np.uint8)
        for s, path in enumerate(paths):
            for d, (node, bit) in enumerate(path):
                self.node[d, s], self.bit[d, s] = node, bit
        self.nodes = made
        self.mark = self.node * _NODE
        self.gate = self.node.astype(np.int64) * GATES
        self.cell = self.node.astype(np.int64) * STEPS
        # the paths end to end: of every decision the hashed node, its gates, the bit, and the map's cells for node and bit
        at = np.arange(longest) < self.depth[:, None]
        self.start = np.cumsum(self.depth, dtype=np.int64) - self.depth
        self.path_mark, self.path_gate, self.path_bit = (a.T[at] for a in (self.mark, self.gate, self.bit))
        self.path_cell = (self.node.T[at] * 2 + self.path_bit) * np.uint32(STEPS) | self.path_bit.astype(np.uint32) << np.uint32(31)

    def deepest_first(self, x):
        """The places of the symbols ``x``, those with the longest paths first."""
        return np.argsort(len(self.node) - self.depth.take(x), kind="stable")

    def layers(self, s):
        """(depth, n): of the symbols ``s``, deepest first, the first n have a node at that depth."""
        ends = np.bincount(self.depth.take(s), minlength=len(self.node) + 1)
        for d, n in enumerate(len(s) - np.cumsum(ends)):
            if not n:
                return
            yield d, n


#: Bits of a symbol in a history.
_BITS = np.uint64(9)


def _histories(symbols: list[np.ndarray]):
    """(all symbols, text number of each, place in the text, history, word so far).

    A history is the last five symbols plus one, 9 bits each, the last one lowest and 0
    before the text; the word so far is a context of 32 bits.
    """
    lengths = np.array([len(s) for s in symbols])
    x = np.concatenate(symbols)
    text = np.repeat(np.arange(len(symbols), dtype=np.int32), lengths)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(x), dtype=np.int64)
    place -= np.repeat(starts, lengths)
    value = x.astype(np.uint64) + np.uint64(1)
    history = np.zeros(len(x), np.uint64)
    for back in range(max(ORDERS), 0, -1):
        history <<= _BITS
        history[back:] |= value[:-back]
    for k in range(max(ORDERS)):  # nothing comes before a text
        history[starts[lengths > k] + k] &= (np.uint64(1) << np.uint64(k) * _BITS) - np.uint64(1)
    # a polynomial hash of the word since its first symbol, by differences of prefix sums
    begins = place == 0
    begins[1:] |= x[:-1] == 32
    offset = np.arange(len(x))
    first = np.maximum.accumulate(np.where(begins, offset, 0))
    offset -= first
    powers = np.cumprod(np.full(int(offset.max()) + 2, _C, np.uint64)).take(offset)
    value = value * _B ^ value
    value *= powers
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    word = sums[:-1] - sums.take(first)
    word *= _A
    word += powers
    word >>= np.uint64(32)
    return x, text, place, history, word.astype(np.uint32)


def _context(history: np.ndarray, order: int) -> np.ndarray:
    """The context (32 bits) of the last ``order`` symbols of the histories."""
    run = np.zeros(len(history), np.uint64)
    for back in range(order):
        run += history >> np.uint64(back) * _BITS & np.uint64(511)
        run *= _A
        run += _B
    return (run >> np.uint64(32)).astype(np.uint32)


def _contexts(symbols: list[np.ndarray]):
    """(all symbols, text number of each, place in the text, contexts [CONTEXTS, n] of 32 bits)."""
    x, text, place, history, word = _histories(symbols)
    return x, text, place, np.stack([*(_context(history, order) for order in ORDERS), word])


def _alike(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, kind of every place): a place of every distinct row of the ``keys`` and which of them each row is.

    Rows are sorted by hash and compared with their neighbours: a kind is never shared by
    different rows (where hashes are equal, equal rows may be several kinds).
    """
    n = len(keys[0])
    bits = np.uint64(n.bit_length())
    order = np.empty(n, np.uint64)
    for k in range(0, n, BLOCK_SYMBOLS):
        hashes = np.zeros(min(BLOCK_SYMBOLS, n - k), np.uint64)
        for key in keys:
            hashes += key[k:k + BLOCK_SYMBOLS]
            hashes *= _A
            hashes ^= hashes >> np.uint64(29)
        hashes *= _B
        hashes >>= bits
        hashes <<= bits
        hashes |= np.arange(k, k + len(hashes), dtype=np.uint64)
        order[k:k + BLOCK_SYMBOLS] = hashes
    order.sort()
    order &= (np.uint64(1) << bits) - np.uint64(1)
    order = order.view(np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for key in keys:
        row = key.take(order)
        new[1:] |= row[1:] != row[:-1]
    kind = np.empty(n, np.int32)
    kind[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], kind


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of the ranges [start, start + length), end to end."""
    ends = np.cumsum(lengths, dtype=np.int64)
    out = np.repeat(starts - (ends - lengths), lengths)
    out += np.arange(len(out))
    return out


def _groups(symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, histories with the symbol itself lowest, words so far) of all texts, made some texts at a time."""
    ends = np.cumsum([len(s) for s in symbols])
    every, histories, words = (np.empty(ends[-1], kind) for kind in (np.int16, np.uint64, np.uint32))
    begin = done = 0
    while begin < len(symbols):
        end = max(begin + 1, int(np.searchsorted(ends, done + BLOCK_SYMBOLS)))
        x, _, _, history, word = _histories(symbols[begin:end])
        here = slice(done, done + len(x))
        every[here], words[here] = x, word
        histories[here] = history << _BITS | x.astype(np.uint64)
        begin, done = end, here.stop
    return every, histories, words


def _keys(history: np.ndarray, word: np.ndarray, c: int) -> np.ndarray:
    """What tells apart (context ``c``, symbol), of histories with the symbol and words so far."""
    if c < len(ORDERS):
        return history & (np.uint64(1) << np.uint64(ORDERS[c] + 1) * _BITS) - np.uint64(1)
    return word.astype(np.uint64) << _BITS | history & np.uint64(511)


def _paths(keys: np.ndarray, c: int, tree: Tree):
    """Blocks of the ``_keys`` of context ``c``: (place of the first, depths, places in the tree's
    paths and hashes of their decisions, end to end)."""
    for k in range(0, len(keys), BLOCK_SYMBOLS):
        own = keys[k:k + BLOCK_SYMBOLS]
        symbol, before = (own & np.uint64(511)).astype(np.intp), own >> _BITS
        contexts = _context(before, ORDERS[c]) if c < len(ORDERS) else before.astype(np.uint32)
        depth = tree.depth.take(symbol)
        path = _ranges(tree.start.take(symbol), depth)
        yield k, depth, path, _hashes(np.repeat(contexts, depth), tree.path_mark.take(path))


class Occasions:
    """The distinct (contexts, symbol) of some texts.

    ``lengths`` are the texts' numbers of symbols, ``of`` is the occasion of each of all symbols and
    ``symbol`` each occasion's.  Per context ``seen`` has its distinct keys and which of them each
    occasion has.
    """

    def __init__(self, symbols: list[np.ndarray]):
        self.lengths = np.array([len(s) for s in symbols])
        x, history, word = _groups(symbols)
        places, self.of = _alike(history, word)
        history, word, self.symbol = history.take(places), word.take(places), x.take(places)
        self.seen = []
        for c in range(CONTEXTS):
            keys = _keys(history, word, c)
            some, which = _alike(keys)
            self.seen.append((keys.take(some), which))


def _hashes(contexts: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Hashes of contexts at tree nodes, ``mark`` the nodes' hashes; their first bits are the slot."""
    hashes = contexts + mark
    hashes *= _SLOT
    return hashes


def _chunks(batches, column: int, most: int):
    """(row numbers, symbols) of about ``most`` symbols, text after text."""
    rows, symbols, size = [], [], 0
    for k, text in enumerate(batches.column(column)):
        s = symbols_of(text.as_py() or "")
        rows.append(k)
        symbols.append(s)
        size += len(s)
        if size >= most:
            yield rows, symbols
            rows, symbols, size = [], [], 0
    if rows:
        yield rows, symbols


def symbol_counts(words: DataFrame, texts: int) -> np.ndarray:
    """Counts of all symbols in the training texts, from their (word, n)."""

    def run(batches):
        total = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            for w, n in zip(batch.column(0), batch.column(1)):
                np.add.at(total, np.frombuffer(w.as_py().encode("utf-8"), np.uint8), n.as_py())
                total[32] += n.as_py()
        yield pa.RecordBatch.from_arrays([pa.array(range(SYMBOLS)), pa.array(total)], ["s", "n"])

    rows = words.select("word", "n").mapInArrow(run, "s long, n long")
    counts = np.zeros(SYMBOLS, np.int64)
    for r in rows.groupBy("s").agg(F.sum("n").alias("n")).collect():
        counts[r["s"]] = r["n"]
    counts[32] = max(0, counts[32] - texts)  # spaces stand between words
    counts[END] = texts
    return counts


def _counted(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, with their counts added, of ``both``: key and count, 32 bits each."""
    both.sort()
    keys = both.view(np.uint32)[1::2]
    last = np.ones(len(both), bool)
    np.not_equal(keys[1:], keys[:-1], out=last[:-1])
    last = np.flatnonzero(last)
    keys = keys[last]
    both &= np.uint64(0xFFFFFFFF)
    np.cumsum(both, out=both)
    counts = both.take(last).view(np.int64)
    counts[1:] -= counts[:-1].copy()
    return keys, counts


def _times(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``keys`` in order, and how often each is there; sorts ``keys``."""
    keys.sort()
    last = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=last[:-1])
    last = np.flatnonzero(last)
    return keys.take(last), np.diff(last, prepend=-1)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]], ordered: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all (keys, counts) in order, with their counts added."""
    if len(parts) == 1 and ordered:
        return parts[0]
    if parts[0][0].itemsize == 4 and all(counts.max(initial=0) < 1 << 32 for _, counts in parts):
        both = np.concatenate([keys for keys, _ in parts], dtype=np.uint64)
        both <<= np.uint64(32)
        both |= np.concatenate([counts for _, counts in parts]).view(np.uint64)
        return _counted(both)
    keys, counts = (np.concatenate(a) for a in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys.take(order)
    first = np.flatnonzero(np.concatenate((np.ones(1, bool), keys[1:] != keys[:-1])))
    return keys.take(first), np.add.reduceat(counts.take(order), first)


def _packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """The steps between sorted keys, and the counts, as compressed planes of bytes."""
    steps = np.diff(keys, prepend=np.uint32(0))
    planes = (np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T) for a in (steps, counts))
    return tuple(pa.compress(a.tobytes(), "zstd", asbytes=True) for a in planes)


def _unpacked(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    def values(packed, kind):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(pa.decompress(packed, n * size, "zstd", asbytes=True), np.uint8)
        return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()

    return np.cumsum(values(keys, np.uint32), dtype=np.uint32), values(counts, np.int64)


def key_counts(texts: DataFrame, tree: Tree) -> DataFrame:
    """(slice, n_keys, n, keys, counts): how often each (context, node) was met with each bit.

    A key is 31 bits of the hash and the bit.  Slices are numbered context by context,
    in the order of the keys; ``n_keys`` are a slice's distinct hashes, ``n`` its keys.
    """
    borders = np.arange(1, 1 << SLICE_BITS, dtype=np.uint32) << np.uint32(32 - SLICE_BITS)

    def count(batches):
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(CONTEXTS)]
        size = 0

        def settle(most):
            for c in range(CONTEXTS):
                if sum(len(keys) for keys, _ in held[c]) <= most or not held[c]:
                    continue
                held[c][:] = [_summed(held[c])]
                if len(held[c][0][0]) <= most // 2:
                    continue
                met = []
                every, times = held[c].pop()
                for k, depth, path, keys in _paths(every, c, tree):
                    keys &= np.uint32(0xFFFFFFFE)
                    keys |= tree.path_bit.take(path)
                    met.append((keys, np.repeat(times[k:k + len(depth)], depth)))
                keys, counts = _summed(met, ordered=False)
                ends = [0, *np.searchsorted(keys, borders), len(keys)]
                some = [k for k in range(1 << SLICE_BITS) if ends[k] < ends[k + 1]]
                packed = [_packed(keys[ends[k]:ends[k + 1]], counts[ends[k]:ends[k + 1]]) for k in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array([(c << SLICE_BITS) + k for k in some], pa.int32()),
                    pa.array([ends[k + 1] - ends[k] for k in some], pa.int64()),
                    pa.array([a for a, _ in packed], pa.binary()), pa.array([b for _, b in packed], pa.binary()),
                ], ["slice", "n", "keys", "counts"])

        for batch in batches:
            for _, symbols in _chunks(batch, 0, ALIKE_SYMBOLS):
                x, history, word = _groups(symbols)
                for c in range(CONTEXTS):
                    held[c].append(_times(_keys(history, word, c)))
                size += len(x)
                if size >= COUNTED_AT_ONCE:
                    yield from settle(HELD_KEYS)
                    size = 0
        yield from settle(0)

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for k, *packed in zip(*batch.columns):
                parts = held.setdefault(k.as_py(), [])
                parts.append(_unpacked(*(v.as_py() for v in packed)))
                if len(parts) == 16:
                    parts[:] = [_summed(parts)]
        for k in sorted(held):
            keys, counts = _summed(held.pop(k))
            kinds = 1 + int(np.count_nonzero(np.diff(keys >> np.uint32(1))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([kinds], pa.int64()), pa.array([len(keys)], pa.int64()),
                 *(pa.array([b], pa.binary()) for b in _packed(keys, counts))], ["slice", "n_keys", "n", "keys", "counts"],
            )

    counted = texts.mapInArrow(count, "slice int, n long, keys binary, counts binary")
    return counted.repartition("slice").mapInArrow(add, "slice int, n_keys long, n long, keys binary, counts binary")


def slot_bits(keys: int) -> int:
    """The bits of a table's number of slots for so many distinct keys."""
    return min(max(SLOT_BITS, (SPARE * keys - 1).bit_length()), MOST_BITS)


def context_tables(texts: DataFrame, tree: Tree) -> list[tuple[int, dict[int, bytes]]]:
    """Per context the bits of its number of slots and the compressed slices of the trained
    table of log odds times SCALE (8-bit); 0 is a slot never met."""
    counted = materialize(key_counts(texts, tree), "keys")
    n_keys = [0] * CONTEXTS
    for r in counted.groupBy(F.shiftright("slice", SLICE_BITS).alias("c")).agg(F.sum("n_keys").alias("n")).collect():
        n_keys[r["c"]] = r["n"]
    bits = [slot_bits(n) for n in n_keys]

    def dense(batches):
        for batch in batches:
            for k, *packed in zip(*batch.columns):
                own = bits[k.as_py() >> SLICE_BITS]
                width = 1 << (own - SLICE_BITS)
                keys, counts = _unpacked(*(v.as_py() for v in packed))
                slots = ((keys >> np.uint32(32 - own)) & np.uint32(width - 1)).astype(np.int64)
                n = np.bincount(2 * slots + (keys & np.uint32(1)), counts, 2 * width)
                zero, one = n.reshape(width, 2).T
                odds = np.clip(np.rint(SCALE * np.log((one + 0.3) / (zero + 0.3))), -127, 127).astype(np.int8)
                odds[(odds == 0) & (zero + one > 0)] = 1
                yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], pa.int32()), pa.array([pa.compress(odds.tobytes(), "zstd", asbytes=True)], pa.binary())],
                                                 ["slice", "odds"])

    tables = [(b, {}) for b in bits]
    for r in counted.select("slice", "n", "keys", "counts").mapInArrow(dense, "slice int, odds binary").toLocalIterator():
        c, k = divmod(r["slice"], 1 << SLICE_BITS)
        tables[c][1][k] = bytes(r["odds"])
    return tables


def _slices(bits: int, slices: dict[int, bytes], drop: bool = False):
    """(number, dense odds) of a table's compressed slices, each dropped once it is read if asked."""
    for k in sorted(slices):
        packed = slices.pop(k) if drop else slices[k]
        yield k, np.frombuffer(pa.decompress(packed, 1 << (bits - SLICE_BITS), "zstd", asbytes=True), np.int8)


class Table:
    """A context's table as one bit a slot (met or not), the number of slots met before every 64, and
    the log odds of those met: under half the bytes of the dense table, as few slots are met."""

    def __init__(self, bits: int, slices):
        """``slices``: (number, dense odds) in order."""
        self.shift = np.uint32(32 - bits)  # hashes begin with the slot
        self.met = np.zeros(1 << (bits - 6), np.uint64)
        rows, odds = self.met.reshape(1 << SLICE_BITS, -1), [np.zeros(1, np.int8)]
        for k, dense in slices:
            rows[k] = np.packbits(dense != 0, bitorder="little").view(np.uint64)
            odds.append(dense[dense != 0])
        self.odds = np.concatenate(odds)
        self.before = np.zeros(len(self.met), np.uint32)
        np.cumsum(np.bitwise_count(self.met[:-1]), dtype=np.uint32, out=self.before[1:])

    def take(self, hashes: np.ndarray) -> np.ndarray:
        """Log odds times SCALE of the hashes' slots, 0 where never met."""
        slots = hashes >> self.shift
        place = slots >> np.uint32(6)
        up_to = self.met.take(place) << (~slots & np.uint32(63)).astype(np.uint64)  # the slot's own bit comes first
        odds = self.odds.take(self.before.take(place) + np.bitwise_count(up_to))
        odds *= (up_to >> np.uint64(63)).astype(np.int8)
        return odds


class Model:
    """Tables, mixer weights [CONTEXTS + 1, nodes * GATES] and map [nodes, STEPS] of log odds."""

    def __init__(self, tree: Tree, tables=None, packed=None, compact=None):
        self.tree, self.packed = tree, packed
        if tables is not None:
            self.tables = tables
        if compact is not None:
            self.compact = compact
        self.weights = np.full((CONTEXTS + 1, tree.nodes * GATES), 0.4 / SCALE, np.float32)
        self.weights[CONTEXTS] = 0
        self.map = np.tile(np.linspace(-8, 8, STEPS, dtype=np.float32), (tree.nodes, 1))

    @cached_property
    def tables(self):
        """The dense tables."""
        tables = [np.zeros(1 << b, np.int8) for b, _ in self.packed]
        for table, packed in zip(tables, self.packed):
            rows = table.reshape(1 << SLICE_BITS, -1)
            for k, odds in _slices(*packed):
                rows[k] = odds
        return tables

    @cached_property
    def compact(self) -> list[Table]:
        """The tables as they are read, laid out where they are first used: in the tasks, which then
        drop the packed ones."""
        if self.packed is None:
            return [Table(len(t).bit_length() - 1, enumerate(t.reshape(1 << SLICE_BITS, -1))) for t in self.tables]
        tables = [Table(b, _slices(b, slices, drop=True)) for b, slices in self.packed]
        self.packed = None
        return tables

    def bits(self, contexts, d, s):
        """Inputs (one array per context) and gates of the symbols ``s`` in their ``contexts``."""
        mark = self.tree.mark[d].take(s)
        gate = self.tree.gate[d].take(s)
        inputs = []
        for c, table in enumerate(self.compact):
            odds = table.take(_hashes(contexts[c, :len(s)], mark))
            gate += (odds != 0).view(np.int8) << c
            inputs.append(odds.astype(np.float32))
        return inputs, gate

    def mix(self, inputs, gate):
        """Log odds by the gates' weights; inputs are log odds times SCALE."""
        dot = self.weights[CONTEXTS].take(gate)
        for w, odds in zip(self.weights, inputs):
            dot += w.take(gate) * odds
        return dot

    def learn(self, x, contexts, count, seen):
        """One online pass of the mixer over a chunk; ``count`` [nodes, STEPS, 2] is what came
        of each step of the map, ``seen`` the bits of each gate."""
        block, gates = 4096, self.weights.shape[1]
        for begin in range(0, len(x), block):
            order = self.tree.deepest_first(x[begin:begin + block])
            every = x[begin:begin + block].take(order).astype(np.intp)
            here = contexts[:, begin:begin + block].take(order, axis=1)
            for d, n in self.tree.layers(every):
                s = every[:n]
                inputs, gate = self.bits(here, d, s)
                dot = np.clip(self.mix(inputs, gate), -30, 30)
                bit = self.tree.bit[d].take(s)
                error = bit - 1 / (1 + np.exp(-dot))
                times = np.bincount(gate, minlength=gates)
                seen += times
                rate = np.minimum(MIXER_RATE, 0.1 / np.maximum(times, 1))
                for c, odds in enumerate(inputs):
                    self.weights[c] += rate / SCALE**2 * np.bincount(gate, error * odds, gates)
                self.weights[CONTEXTS] += 0.1 * rate * np.bincount(gate, error, gates)
                np.add.at(count.reshape(-1), (self.tree.cell[d].take(s) + self.step(dot)) * 2 + bit, 1)

    def step(self, dot):
        """The step of the map nearest to log odds ``dot``, between -8 and 8."""
        scaled = dot * ((STEPS - 1) / 16) + STEPS / 2
        return np.clip(scaled, 0, STEPS - 1, out=scaled).astype(np.int64)

    def mixed(self, every: Occasions):
        """(starts, depths, decisions) of the occasions; a decision is its mixed log odds and its
        cell of the map for node and bit, the cell's highest bit set if the bit is."""
        tree = self.tree
        odds, begin = [], []
        for c, (table, (keys, which)) in enumerate(zip(self.compact, every.seen)):
            paths = [(depth, table.take(hashes)) for _, depth, _, hashes in _paths(keys, c, tree)]
            depth, found = (np.concatenate(a) for a in zip(*paths))
            odds.append(found)
            begin.append((np.cumsum(depth, dtype=np.int64) - depth, which))
        depths = tree.depth.take(every.symbol)
        starts = np.cumsum(depths, dtype=np.int64) - depths
        decisions = np.empty((int(depths.sum(dtype=np.int64)), 2), np.float32)
        for k in range(0, len(depths), BLOCK_SYMBOLS):
            own = slice(k, k + BLOCK_SYMBOLS)
            depth = depths[own]
            path = _ranges(tree.start.take(every.symbol[own]), depth)
            gate = tree.path_gate.take(path)
            inputs = []
            for c, (first, which) in enumerate(begin):
                value = odds[c].take(_ranges(first.take(which[own]), depth))
                gate += (value != 0).view(np.int8) << c
                inputs.append(value.astype(np.float32))
            here = decisions[starts[k]:starts[k] + len(gate)]
            here[:, 0] = self.mix(inputs, gate)
            here.view(np.uint32)[:, 1] = tree.path_cell.take(path)
        return starts, depths, decisions

    def score(self, symbols: list[np.ndarray]) -> np.ndarray:
        """The log10 probability of every text."""
        every = Occasions(symbols)
        starts, depths, decisions = self.mixed(every)
        decisions = decisions.view(np.int64).ravel()  # looked up in one
        spots = starts << 16 | depths
        lengths, n = every.lengths, len(symbols)
        begins = np.cumsum(lengths) - lengths
        cost, scale = np.zeros(n), np.ones(n, np.float32)
        refined = np.stack([self.map, -self.map], 1).ravel()  # of node and bit: against the bit, halved
        refined *= 0.5
        low, high, longest = 0, FIRST_CHECK, int(lengths.max())
        while low < longest:
            some = np.flatnonzero(lengths > low)
            many = np.minimum(lengths.take(some), high) - low
            part, text = _ranges(begins.take(some) + low, many), np.repeat(some, many)
            slope, bits = np.zeros(n), np.zeros(n, np.int64)
            for k in range(0, len(part), BLOCK_SYMBOLS):
                of, own = every.of.take(part[k:k + BLOCK_SYMBOLS]), text[k:k + BLOCK_SYMBOLS]
                spot = spots.take(of)
                depth = (spot & 0xFFFF).astype(np.int16)
                spot >>= 16
                symbol = np.repeat(np.arange(len(of)), depth)
                spot -= np.cumsum(depth, dtype=np.int64) - depth
                at = spot.take(symbol)
                at += np.arange(len(at))
                found = decisions.take(at)
                mixed, cell = found.view(np.float32)[::2], found.view(np.uint32)[1::2]
                bit = cell & _SIGN
                against = (mixed.view(np.uint32) ^ bit ^ _SIGN).view(np.float32)  # negative: for the bit
                odds = mixed * scale.take(own).take(symbol)
                cell = (cell ^ bit).astype(np.int64)
                cell += self.step(odds)
                odds.view(np.uint32)[:] ^= bit
                odds *= 0.5
                odds += refined.take(cell)
                # cost and slope of log(1 + exp(odds)), the odds now being against the bit
                e = np.exp(np.clip(odds, -30, 30, out=odds), out=odds)
                paid, pull = np.zeros(len(of), np.float32), np.zeros(len(of), np.float32)
                np.add.at(paid, symbol, np.log1p(e))
                e /= e + 1
                e *= against
                np.add.at(pull, symbol, e)
                first = np.flatnonzero(np.concatenate((np.ones(1, bool), own[1:] != own[:-1])))
                own = own.take(first)
                cost[own] -= np.add.reduceat(paid, first, dtype=np.float64)
                slope[own] += np.add.reduceat(pull, first, dtype=np.float64)
                bits[own] += np.add.reduceat(depth, first, dtype=np.int64)
            scale += np.minimum(TEXT_RATE, 0.25 / np.maximum(bits, 1)) * slope
            np.clip(scale, 0.5, 2, out=scale)
            low, high = high, 2 * high
        return cost / math.log(10)


def train_mixer(texts: DataFrame, model: Model) -> None:
    """Teach ``model`` its weights and map: every task goes online over its own texts,
    and the tasks' weights are averaged by the bits they saw."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    nodes = model.tree.nodes

    def run(batches):
        base = shared.value
        own = Model(base.tree, compact=base.compact)
        count, seen = np.zeros((nodes, STEPS, 2), np.int64), np.zeros(nodes * GATES)
        for batch in batches:
            for _, symbols in _chunks(batch, 0, CHUNK_SYMBOLS):
                x, _, _, contexts = _contexts(symbols)
                own.learn(x, contexts, count, seen)
        by_node = lambda a: pa.array(list(a.reshape(nodes, -1).astype(np.float64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(nodes), pa.int32()), by_node(seen), by_node((own.weights * seen).T), by_node(count)],
            ["node", "seen", "weights", "counts"],
        )

    rows = texts.mapInArrow(run, "node int, seen array<double>, weights array<double>, counts array<double>")
    width = {"seen": GATES, "weights": GATES * (CONTEXTS + 1), "counts": 2 * STEPS}
    sums = rows.groupBy("node").agg(
        *[F.array(*[F.sum(F.col(c)[i]) for i in range(w)]).alias(c) for c, w in width.items()],
    )
    p = 1 / (1 + np.exp(-np.linspace(-8, 8, STEPS)))
    rows = sums.collect()  # one row per tree node
    shared.destroy()
    for r in rows:
        seen = np.array(r["seen"])
        own = np.array(r["weights"]).reshape(GATES, -1)[seen > 0] / seen[seen > 0, None]
        model.weights[:, r["node"] * GATES + np.flatnonzero(seen > 0)] = own.T
        zero, one = np.array(r["counts"]).reshape(STEPS, 2).T
        model.map[r["node"]] = np.log((one + 20 * p) / (zero + 20 * (1 - p)))


def _dealt(texts: DataFrame) -> DataFrame:
    """``_text`` of the rows (_id, _text), in tasks and in an order that follow from the rows alone."""
    parts = max(1, -(-texts.count() // TUNE_DOCUMENTS))
    return texts.repartition(parts, "_id", "_text").sortWithinPartitions("_id", "_text").select("_text")


def train(docs: DataFrame, text_col: str, learn: str, tune: str, counts: np.ndarray, id_col: str | None = None) -> Model:
    """The model from the rows where the SQL predicate ``learn`` holds (tables), and ``tune`` (mixer, map)."""
    tree = Tree(counts)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    model = Model(tree, packed=context_tables(docs.where(learn).select(text), tree))
    own = F.col(id_col) if id_col else F.lit("")
    train_mixer(_dealt(docs.where(tune).select(own.alias("_id"), text)), model)
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
          held_out_fold: int = 1) -> DataFrame:
    """Per input row: id, ``held_out`` (crc32 of the id as text, modulo ``folds``, is
    ``held_out_fold``), ``n_tokens`` (words and one end), ``n_known`` (tokens met in
    training), ``train_tokens``, ``base_score`` (unigram, add one half), ``score`` (the
    model's log10 probability of the text) and ``bits_per_byte`` (of its symbols).

    Only rows that are not held out are learned from.  Null texts are empty texts: one
    token, the end.  Null ids count as the empty text for the fold; repeated rows and
    ids give a row each; whole texts are scored, however long; other columns are
    ignored.  An empty table gives an empty table.
    """
    fold = f"crc32(cast(coalesce(cast(`{id_col}` as string), '') as binary)) % {folds}"
    held = f"({fold} = {held_out_fold})"
    tune = f"(crc32(cast(concat('tune', coalesce(cast(`{id_col}` as string), '')) as binary)) % {TUNE_PART} = 0)"
    table = materialize(word_counts(docs.where(f"NOT {held}"), text_col, words_of), "words")
    texts = docs.where(f"NOT {held}").count()
    totals = table.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, kinds = (totals[0] or 0) + texts, totals[1] + (texts > 0)
    model = train(docs, text_col, f"NOT {held} AND NOT {tune}", f"NOT {held} AND {tune}",
                  symbol_counts(table, texts), id_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    values = table.select("word", "n", F.log10(F.col("n") + 0.5).alias("value"))
    head, rest = split_head(values, "value")
    end = math.log10(texts + 0.5)

    def extra(batch):
        scores = np.zeros(batch.num_rows)
        for rows, symbols in _chunks(batch, 2, ALIKE_SYMBOLS):
            scores[rows] = shared.value.score(symbols)
        return scores

    sums = document_sums(docs, id_col, text_col, words_of, head, rest, "value", unknown=math.log10(0.5),
                         per_batch=extra)
    every = F.col("n_words") + 1
    return sums.select(
        id_col, F.expr(held).alias("held_out"), every.alias("n_tokens"),
        (F.col("found") + (1 if texts else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("total") + F.lit(end) - every * math.log10(tokens + 0.5 * (kinds + 1))).alias("base_score"),
        F.col("per_row").alias("score"),
        (-F.col("per_row") * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
