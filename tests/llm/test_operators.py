"""The operators against plain Python, the installed libraries and DuckDB, on given
tables and on rows with nulls, empty and very long texts, ties and clashing names."""

import collections
import hashlib
import math
import re
import zlib
from array import array

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from tests import oracle
from tests.conftest import SF_MID, SF_SMALL
from vigil.llm import bpe, html_text, line_dedup, mixing, nearest, packing, quality, simhash, token_counts, warc
from vigil.llm.queries import BYTE_BPE

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD_TEXTS = [
    (1, "The cat sat.\nThe cat sat.\n" * 3), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (5, LONG), (None, "no id here"),
    (None, None), (7, "café 一二 <|endoftext|> 12's   x\x1cy"), (8, "a"), (9, "A  B\tC\nD e"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", None, "k", "w", 5) for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, key string, _row string, n_words int"
    ).repartition(3)


def _docs(sf):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()


def _empty(df):
    return df.where("false")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_BPE)


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


# -- SimHash ----------------------------------------------------------------------


def _slow_fingerprint(text, shingle=4):
    import xxhash

    words = [w.lower() for w in WORD.findall((text or "").encode())]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _slow_classes(values, most):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash_against_all_pairs(spark):
    docs = _docs(SF_SMALL)
    got = {r[0]: r for r in E.queries()["op1_simhash"](spark, SF_SMALL).collect()}
    values = [_slow_fingerprint(t) for _, t in docs]
    classes = _slow_classes(values, 4)
    least = {}
    for (i, _), c in zip(docs, classes):
        least[c] = min(least.get(c, i), i)
    assert len(got) == len(docs)
    for (i, _), v, c in zip(docs, values, classes):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{v:016x}", least[c])


@pytest.mark.parametrize("most", [1, 2, 3, 4, 5])
def test_ball_links_find_every_class(most):
    rng = np.random.default_rng(most)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, most + 2), replace=False)) for b in base]
    values = np.unique(np.array([*map(int, base), *near], np.uint64))
    root = simhash._bucket_links(values, 0, 0, most)
    assert root.tolist() == _slow_classes([int(x) for x in values], most)


def test_simhash_odd_rows(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD_TEXTS)
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and {r["component_id"] for r in zero} == {2}
    assert simhash.near_dedup(odd).columns == odd.columns
    assert sum(r["doc_id"] == 5 for r in simhash.near_dedup(odd).collect()) == 1
    assert simhash.near_duplicates(_empty(odd)).count() == 0


# -- quality ----------------------------------------------------------------------


@pytest.mark.parametrize("key", ["op2_quality", "op9_line_dedup"])
def test_against_sql(spark, key):
    ok, message = oracle.compare(spark, oracle.duck(SF_MID), SF_MID, key, E.queries()[key], E.oracle_sql()[key])
    assert ok, message


def test_binomial_bound(spark):
    for n, k, p in [(500, 0, 0.02), (500, 3, 0.02), (5000, 60, 0.0167), (200000, 3000, 0.0167)]:
        expr = quality._binomial_cdf(f"{k}L", f"{n}L", f"{p!r}D")
        got = spark.range(1).select(F.expr(expr)).first()[0]
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                 + (n - i) * math.log1p(-p) for i in range(k + 1)]
        assert got == pytest.approx(sum(map(math.exp, terms)), rel=1e-6)


def test_thresholds_bound_false_rejections(spark):
    rows = [("a", i % 10 > 0, 100, 400, 0 if i % 10 else 200, 5, 0, 0) for i in range(4000)]
    rows += [("b", True, 100, 400, 0, 5, 0, 0)] * 20 + [("b", False, 100, 400, 300, 5, 0, 0)] * 20  # too few to certify
    names = "_stratum string, _good boolean, n_words long, word_chars long, n_symbols long, n_lines long, " \
            "n_dup_lines long, n_repeat_words long"
    cuts = {r["_stratum"]: r["_cut_symbols"] for r in quality.thresholds(spark.createDataFrame(rows, names)).collect()}
    assert cuts == {"a": 0.4}


def test_quality_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.judge(odd, labels).collect()
    assert len(rows) == len(ODD_TEXTS)
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.judge(_empty(odd), _empty(labels)).count() == 0


# -- tokens -----------------------------------------------------------------------


def test_arcs_found_are_forgotten_and_found_again(tokenizer, monkeypatch):
    """Known words are joined at once, words met first are read with few arcs kept in the trie's nodes."""
    monkeypatch.setattr(bpe, "HELD_ARCS", 20)
    a = bpe.TokenAutomaton(BYTE_BPE)
    texts = ["the the<|endoftext|>the cat", "", "the cat", "a cat sat", *[t for _, t in _docs(SF_SMALL)[:30]]]
    for _ in range(2):  # the second time every word is known
        assert [list(array("I", x)) for x in a.encode_all(texts)] == [_ids(tokenizer, t) for t in texts]
    list(a.ids_of([b"x"]))
    assert a._arcs <= 20


def test_automaton_equals_library(tokenizer):
    a = bpe.automaton(BYTE_BPE)
    rng = np.random.default_rng(0)
    parts = ["a", " ", "  ", "\n", "é", "'s", "'t", "1", "²", "Ⅷ", "一", "\U0001f44d",
             "<|endoftext|>", "the", "\x1c", "​", "\xa0", "!", "...", "\x85", "́", "\x00"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(1500)]
    texts += ["a" * 3000, "ab" * 2000, " " * 500, LONG, *[t for _, t in _docs(SF_SMALL)]]
    for text, packed in zip(texts, a.encode_all(texts)):
        ids = _ids(tokenizer, text)
        assert list(array("I", packed)) == ids
        assert a.decode(packed).decode("utf-8", "replace") == tokenizer.decode(ids, skip_special_tokens=False)


def test_encode_and_count_odd_rows(odd, tokenizer):
    rows = bpe.encode_decode(odd, BYTE_BPE).collect()
    by_hash = collections.Counter((r["doc_id"], r["ids_sha256"], r["n_tokens"]) for r in rows)
    want = collections.Counter(
        (i, hashlib.sha256(np.array(_ids(tokenizer, t), "<u4").tobytes()).hexdigest(), len(_ids(tokenizer, t)))
        for i, t in ODD_TEXTS
    )
    assert by_hash == want
    counted = collections.Counter(tuple(r) for r in token_counts.token_counts(odd, BYTE_BPE).collect())
    assert counted == collections.Counter(
        (i, len((t or "").encode()), len(_ids(tokenizer, t)), len(_ids(tokenizer, t)) > 512) for i, t in ODD_TEXTS
    )
    assert bpe.encode_decode(_empty(odd), BYTE_BPE).count() == 0
    assert token_counts.token_counts(_empty(odd), BYTE_BPE).count() == 0


def test_counts_by_head_and_by_join(spark, tokenizer, monkeypatch):
    from vigil.llm import lookup

    monkeypatch.setattr(lookup.split_head, "__defaults__", (50,))  # a small head: most words are joined
    got = {r["doc_id"]: r["n_tokens"] for r in E.queries()["op4_token_counts"](spark, SF_SMALL).collect()}
    assert got == {i: len(_ids(tokenizer, t)) for i, t in _docs(SF_SMALL)}


# -- language model ---------------------------------------------------------------


def _check_scores(rows, docs):
    counts = collections.Counter()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [(i, [*WORD.findall((t or "").encode().lower()), None]) for i, t in docs]
    for i, t in tokens:
        if not held(i):
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter(
        (i, held(i), len(t), sum(counts[x] > 0 for x in t), n,
         round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 6)) for i, t in tokens
    )
    got = collections.Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in rows)
    assert got == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_scores(spark):
    rows = E.queries()["op5_lm_score"](spark, SF_SMALL).collect()
    _check_scores(rows, _docs(SF_SMALL))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 4  # far below 8, on texts not learned from


def test_scores_odd_rows(odd):
    _check_scores(mixing.score(odd).collect(), ODD_TEXTS)
    assert mixing.score(_empty(odd)).count() == 0


def test_tables_grow_with_the_keys(spark, monkeypatch):
    """More (context, node) keys than the least table has slots: met and unmet contexts stay apart."""
    monkeypatch.setattr(mixing, "HELD_KEYS", 300_000)  # tasks hand their counts on several times
    monkeypatch.setattr(mixing, "COUNTED_AT_ONCE", 500_000)
    rng = np.random.default_rng(11)
    texts = ["".join(map(chr, rng.integers(97, 123, 60_000))) for _ in range(12)]
    counts = np.bincount(np.concatenate([mixing.symbols_of(t) for t in texts]), minlength=mixing.SYMBOLS)
    tree = mixing.Tree(counts)
    model = mixing.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3),
                         "text", "true", "false", counts)
    x, _, _, contexts = mixing._contexts([mixing.symbols_of(t) for t in texts])
    five = collections.defaultdict(set)
    for d, node in enumerate(tree.node):
        at = np.flatnonzero(tree.depth[x] > d)
        for n in np.unique(node[x[at]]):
            five[int(n)].update(contexts[1, at[node[x[at]] == n]].tolist())
    n_keys = sum(map(len, five.values()))
    assert n_keys > 1 << mixing.SLOT_BITS
    met = np.count_nonzero(model.tables[1])
    assert 0.85 * n_keys < met <= n_keys and met < 0.25 * len(model.tables[1])


def test_like_occasions_are_told_apart_and_looked_up_once():
    """Texts that say the same over and over: every distinct (contexts, symbol) is mixed once, with the
    contexts of each place, and the scores are those of a decision-by-decision reckoning."""
    rng = np.random.default_rng(8)
    words = ["the", "then", "thé", "cat", "a", "catalogue", "x" * 70]
    texts = [mixing.symbols_of(" ".join(rng.choice(words, rng.integers(0, 60)))) for _ in range(300)]
    tree = mixing.Tree(np.bincount(np.concatenate(texts), minlength=mixing.SYMBOLS))
    model = mixing.Model(tree, [rng.integers(-90, 90, 1 << mixing.SLOT_BITS).astype(np.int8) * rng.integers(0, 2, 1 << mixing.SLOT_BITS, dtype=np.int8)
                                for _ in range(mixing.CONTEXTS)])
    model.map += rng.normal(0, 0.3, model.map.shape).astype(np.float32)
    looked_up = []
    take, model.compact = mixing.Table.take, list(model.compact)
    for table in model.compact:
        table.take = lambda hashes, own=table: looked_up.append(len(hashes)) or take(own, hashes)
    scores = model.score(texts)
    assert 10 * sum(looked_up) < mixing.CONTEXTS * sum(int(tree.depth.take(t).sum()) for t in texts)
    every = mixing.Occasions(texts)
    x, _, _, contexts = mixing._contexts(texts)
    assert len(every.of) == len(x) and (every.symbol.take(every.of) == x).all()
    assert len(every.symbol) == len(set(zip(x.tolist(), *contexts.tolist())))
    for text, got in list(zip(texts, scores))[::15]:
        x, _, _, contexts = mixing._contexts([text])
        cost, scale, slope, bits = 0.0, np.float32(1), 0.0, 0
        for k, s in enumerate(x):
            if k >= mixing.FIRST_CHECK and k & (k - 1) == 0:
                scale = np.float32(np.clip(scale + min(mixing.TEXT_RATE, 0.25 / bits) * slope, 0.5, 2))
                slope, bits = 0.0, 0
            for d in range(tree.depth[s]):
                inputs, gate = model.bits(contexts[:, k:k + 1], d, np.array([s]))
                mixed = model.mix(inputs, gate)
                odds = mixed * scale
                odds = odds + model.map[tree.node[d, s]].take(model.step(odds.copy()))
                sign = 2 * int(tree.bit[d, s]) - 1
                against = float(np.exp(np.clip(-sign * odds / 2, -30, 30))[0])
                cost -= math.log1p(against)
                slope += against / (1 + against) * sign * float(mixed[0])
                bits += 1
        assert got == pytest.approx(cost / math.log(10), rel=1e-4)


def test_counts_of_like_occasions_are_added():
    """Keys and counts handed on equal a count of every decision by itself."""
    keys = np.array([7, 3, 7, 2**32 - 1, 3, 3], np.uint32)
    counts = np.array([1, 2, 3, 4, 5, 2**33])
    for n in (5, 6):  # counts below and over 32 bits
        got = mixing._summed([(keys[:2], counts[:2]), (keys[2:n], counts[2:n])])
        want = collections.Counter()
        for k, c in zip(keys[:n].tolist(), counts[:n].tolist()):
            want[k] += c
        assert [a.tolist() for a in got] == [list(a) for a in zip(*sorted(want.items()))]


def test_decisions_are_a_probability():
    """Over all continuations of a prefix the model's probabilities sum to one."""
    texts = [mixing.symbols_of(t) for t in ("the cat", "the dog and the cat", "a cat")]
    tree = mixing.Tree(np.bincount(np.concatenate(texts), minlength=mixing.SYMBOLS))
    rng = np.random.default_rng(3)
    tables = rng.integers(-900, 900, (mixing.CONTEXTS, 1 << mixing.SLOT_BITS), dtype=np.int16)
    model = mixing.Model(tree, tables)
    prefix = np.frombuffer(b"the c", np.uint8).astype(np.int16)
    every = [np.append(prefix, np.int16(s)) for s in range(mixing.SYMBOLS)]
    total = sum(10 ** (a - b) for a, b in zip(model.score(every), np.repeat(model.score([prefix]), mixing.SYMBOLS)))
    assert total == pytest.approx(1, abs=1e-4)


# -- nearest neighbours -----------------------------------------------------------


def test_compact_tables_hold_what_the_dense_ones_do_in_half_the_bytes():
    rng = np.random.default_rng(3)
    bits = mixing.SLOT_BITS
    dense = np.where(rng.random(1 << bits) < 1 / mixing.SPARE, rng.integers(-127, 128, 1 << bits), 0).astype(np.int8)
    dense[[0, 63, 64, -1]] = 1, -2, 3, -4
    width = 1 << (bits - mixing.SLICE_BITS)
    slices = {k: mixing.pa.compress(dense[k * width:(k + 1) * width].tobytes(), "zstd", asbytes=True)
              for k in range(1 << mixing.SLICE_BITS)}
    del slices[5]  # a slice without a key
    dense[5 * width:6 * width] = 0
    model = mixing.Model(mixing.Tree([1] * mixing.SYMBOLS), packed=[(bits, slices)])
    assert (model.tables[0] == dense).all()
    table = model.compact[0]
    hashes = (np.arange(1 << bits, dtype=np.uint32) << table.shift) + np.uint32(7)
    assert table.take(hashes).dtype == np.int8 and (table.take(hashes) == dense).all()
    assert 2 * sum(a.nbytes for a in (table.met, table.before, table.odds)) <= dense.nbytes
    assert model.packed is None and not slices


def test_neighbours_recall(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = collections.defaultdict(list)
    for r in E.queries()["op6_neighbours"](spark, SF_SMALL).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q in ids[ids % 20 == 0]:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        best = np.lexsort((ids, -scores))[:20]
        hits += len({*ids[best].tolist()} & {i for i, _ in got[q]})
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True) and len(got[q]) == 20
    assert hits / (20 * len(got)) >= 0.9


def test_neighbours_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, [0.0, 0.0]),
            (6, [inf, 1.0]), (7, [nan, 1.0]), (8, [None, 1.0]), (40, [1.0, 2.0, 3.0]), (None, [3.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = [tuple(r) for r in nearest.nearest(df, "vec_id % 20 = 0", k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, None, 3.0), (0, 2, 3, 1.0), (0, 3, 3, 1.0), (20, 1, 3, 2.0), (20, 2, 3, 2.0), (20, 3, 0, 0.0)]
    assert nearest.nearest(_empty(df), "vec_id % 20 = 0").count() == 0


# -- WARC -------------------------------------------------------------------------


def test_archive(spark, tmp_path):
    same = "same " * 400
    rows = [(1, "http://a\r\nb", same), (2, None, same), (3, "u", same), (3, "u", same), (4, "v", "short"), (5, "w", None),
            (6, "x", ""), (None, "n", same), (7, "z", "é" * 800), (8, "z", LONG * 5)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, _id int").repartition(2)
    got = sorted(warc.archive(df).collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0))
    assert len(got) == len(rows)
    for r, (i, _, h) in zip(got, rows[:7] + rows[8:] + rows[7:8]):
        raw = (h or "").encode()
        assert (r["page_id"], r["payload_bytes"], r["payload_digest"]) == (i, len(raw), hashlib.sha1(raw).hexdigest())
        again = h == same and i != 3
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if again else ("response", None))
    index = warc.write_bundles(df, f"file://{tmp_path}/bundles")
    one = warc.read_records(index.where("record_id = 'urn:page:8'")).collect()
    assert [bytes(r["payload"]).decode() for r in one] == [LONG * 5]
    assert warc.archive(_empty(df)).count() == 0


def test_bundle_is_plain_zstandard(tmp_path):
    import zstandard

    writer = warc.BundleWriter(str(tmp_path), "p")
    records = [warc.record(f"urn:page:{i}", "u", bytes([65 + i]) * 400_000, None, "2024-01-01T00:00:00Z") for i in range(9)]
    for i, r in enumerate(records):
        writer.add(f"urn:page:{i}", r)
    writer.close()
    path = tmp_path / "p-00000.warc.zst"
    with path.open("rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(records)
    index = writer.taken()
    assert len({r[2] for r in index}) == 3 and [r[0] for r in index] == [f"urn:page:{i}" for i in range(9)]


# -- packing ----------------------------------------------------------------------


def _check_packing(rows, docs, tokenizer, capacity=1024):
    want = collections.Counter()
    for i, t in docs:
        ids = [*_ids(tokenizer, t), 2]
        first = len(ids) % capacity or capacity if len(ids) > capacity else len(ids)
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r["length"] for r in rows) // capacity)


def test_packing(spark, tokenizer):
    rows = E.queries()["op8_packing"](spark, SF_SMALL).collect()
    used, least = _check_packing(rows, _docs(SF_SMALL), tokenizer)
    assert used <= 1.02 * least + 1


def test_packing_odd_rows(odd, tokenizer):
    _check_packing(packing.pack(odd, BYTE_BPE).collect(), ODD_TEXTS, tokenizer)
    assert packing.pack(_empty(odd), BYTE_BPE).count() == 0


def test_evolution_beats_first_fit():
    rng = np.random.default_rng(5)
    sizes = rng.integers(200, 700, 400).tolist()
    packer = packing._Packer(sizes, 1024, 1)
    first = packer.best_fit(packer.decreasing(range(400)))
    best = packer.evolve([])
    assert sorted(i for b in best for i in b) == list(range(400)) and len(best) <= len(first)
    assert all(packer.fill(b) <= 1024 for b in best)


# -- line deduplication -----------------------------------------------------------


def test_line_runs(spark):
    run = "\n".join(" ".join(f"w{i}{j}" for j in range(20)) for i in range(3))  # three lines of 20 words
    short = " ".join(f"s{j}" for j in range(30))
    rows = [(1, f"start here\n{run}\nend"), (2, f"{run}\n\n  \nother"), (3, short), (4, short), (5, f"{run}\n{run}"),
            (6, run.split("\n")[0] + "\nalone"), (7, None), (8, ""), (None, run), (9, run.replace("\n", "\n\n"))]
    df = spark.createDataFrame([(*r, 0, "l") for r in rows], "doc_id long, text string, pos int, lines string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(df).select("_doc.*", "n_removed").collect()}
    assert got == {
        1: (f"start here\n{run}\nend", 0), 2: ("\n  \nother", 3), 3: (short, 0), 4: (short, 0), 5: ("", 6),
        6: (run.split("\n")[0] + "\nalone", 0), 7: (None, 0), 8: ("", 0), None: ("", 3), 9: ("\n", 3),
    }
    assert line_dedup.dedup_lines_of(df).columns == df.columns
    assert line_dedup.dedup_lines(_empty(df)).count() == 0


@pytest.mark.parametrize("n_lines", [12, 40])
def test_line_runs_of_copied_rows(spark, n_lines):
    lines = [" ".join(f"c{i}_{j}" for j in range(8)) for i in range(n_lines)]  # lines of 8 words
    whole, shared, early = "\n".join(lines), "\n".join(lines[3:10]), "\n".join(lines[5:12])
    rows = [(1, whole), (1, whole), (2, f"before\n{shared}\nafter"), (0, early), (3, "a b"), (3, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter(tuple(r) for r in line_dedup.dedup_lines(df).select("_doc.doc_id", "_doc.text", "n_removed").collect())
    left = "\n".join(lines[:5] + lines[12:])
    assert got == collections.Counter(
        {(0, early, 0): 1, (1, left, 7): 2, (2, "before\nafter", 7): 1, (3, "a b", 0): 2}
    )


def test_line_dedup_odd_rows(odd):
    assert line_dedup.dedup_lines_of(odd).count() == len(ODD_TEXTS)


def test_native_plans(spark):
    for key in ("op2_quality", "op9_line_dedup"):
        plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# -- HTML -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href=/>Site</a><nav><ul><li><a href=a>Menu</a></ul></nav></header><div class="cookie-notice">We use cookies, many.</div>
<div id="main-col"><article><header><h1>Title &amp; more</h1></header><p>First   paragraph, with a <a href=x>link</a> and
<b>bold</b>ness.<p>Second&nbsp;one, longer, with commas, and text enough to count for something.</p>
<form><input><label>Search</label></form><div class="ad">Buy, buy, buy now</div><ul><li>item one<li>item two</ul></article>
<aside class="sidebar"><p>Side, text, with, commas, many, of, them, all, here, so, long, as, can, be.</p></aside>
<section id="comments"><p>A reader says, at length, with commas, that this is wrong, and more, and more.</p></section></div>
<footer>&copy; 2024</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "Title & more First paragraph, with a link and boldness. Second one, longer, with commas, and text enough to "
        "count for something. item one item two"
    )
    plain = "<div class=menu><a>x</a></div><div><p>One, two, three.</p><p>Four.</p></div><div class=footer>f</div>"
    assert html_text.main_text(plain) == "One, two, three. Four."
    assert html_text.main_text("") == "" and html_text.main_text("<nav>only</nav>") == ""
    assert html_text.main_text("just text") == "just text"
    deep = "<div>" * 5000 + "<p>deep, down</p>"
    assert html_text.main_text(deep) == "deep, down"


def test_open_head_and_closed_svg():
    text, body = "One, two, three. Four.", "<p>One, two, three.</p><p>Four.</p>"
    for head in ("<head><title>T</title>", "<head><meta charset=utf-8><link rel=x>\n<script>a</script>",
                 "<head><basefont size=3><style>p{}</style>"):
        for start in ("<body>", "<div>", "\n<body><article>", "<main>"):
            assert html_text.main_text(f"<!DOCTYPE html><html>{head}{start}{body}") == text
        assert html_text.main_text(f"{head}Zero, text. {body}") == f"Zero, text. {text}"
        assert html_text.main_text(f"{head}</head><body>{body}") == text
    assert html_text.main_text(f"<head><noscript><link rel=x></noscript><body>{body}") == text
    for mark in ("<svg/>", '<svg class="icon" />', "<svg><path d='M0'/><g/></svg>", "<svg><title/><path/></svg>", "<math/>"):
        assert html_text.main_text(f"<body><article>{mark}{body}</article>") == text
        assert html_text.main_text(f"<body><article><p>One, {mark}two, three.</p><p>Four.</p></article>") == text
    assert html_text.main_text("<article><p>One, two, three.<p/>Four.</article>") == text  # no slash outside them


def test_lists_of_links_in_an_article():
    links = "<li><a href=a>Source one</a><li><a href=b>Source two</a><li><a href=c>Source three</a>"
    text = "<p>One, two, three, and text enough to count.</p>"
    for tag in ("article", "main"):
        page = f"<body><{tag}>{text}<ul>{links}</ul><ul class=menu>{links}</ul><ol role=navigation>{links}</ol></{tag}>"
        assert html_text.main_text(page) == "One, two, three, and text enough to count. Source one Source two Source three"
    assert html_text.main_text(f"<body><div>{text}<ul>{links}</ul></div>") == "One, two, three, and text enough to count."


def test_extract_odd_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", f"<article><p>{LONG}</p></article>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] == 3] == [LONG]
    assert html_text.extract(_empty(df)).count() == 0


# -- pipeline ---------------------------------------------------------------------


def test_pipeline_stages(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.collect()
        kept = corpus_pipeline.materialize(stage(spark, kept, SF_SMALL), name)
        assert kept.columns == columns and kept.count() <= len(before)
        if name == "simhash_near_dedup":
            values = [_slow_fingerprint(r["text"]) for r in before]
            classes = _slow_classes(values, 4)
            least = {}
            for r, c in zip(before, classes):
                least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
            assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    last = [(r["doc_id"], r["text"]) for r in kept.collect()]
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL).collect()
    _check_packing(rows, last, tokenizer)
    assert len(rows) == corpus_pipeline.run(spark, SF_SMALL).count()


def test_pipeline_empty(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        if docs.columns[:2] == ["doc_id", "text"]:
            docs = corpus_pipeline.materialize(docs, "empty")
    assert docs.count() == 0
