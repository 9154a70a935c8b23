"""Neighbour scores and ties on real dimensions; pages against another extractor; scores and
packings that must not depend on how the input lies."""

import bisect
import collections
import html
import re
import time

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_MID
from vigil.llm import html_text, mixing, nearest, packing, simhash, spread
from vigil.llm.queries import BYTE_BPE


def _expected(rows, k):
    """Per query the ``k`` best (id, score) by plain Python, every product summed in order."""
    out = {}
    for q, (qid, v) in enumerate(rows):
        if qid % 20 == 0:
            scores = []
            for i, (vid, w) in enumerate(rows):
                if i != q:
                    total = 0.0
                    for a, b in zip(w, v):
                        total += a * b
                    scores.append((-total, vid))
            out[qid] = [(vid, -s) for s, vid in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_equal_vectors_tie_by_id(spark, partitions):
    """Groups of equal vectors of 64 dimensions, however they are dealt and verified together."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((90, 64)).astype(np.float32)
    rows = [(i, vectors[i % 90 if i < 90 else int(rng.integers(0, 12))].tolist()) for i in range(130)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(130)], "vec_id long, embedding array<float>").repartition(partitions)
    got = collections.defaultdict(list)
    for r in nearest.nearest(df, "vec_id % 20 = 0", k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got == _expected(rows, 20)  # order and scores, to the last bit


def test_small_blocks_and_chunks_find_the_same(spark, monkeypatch):
    rows = [(i, np.random.default_rng(i).standard_normal(16).astype(np.float32).tolist()) for i in range(200)]
    monkeypatch.setattr(nearest, "BLOCK_VECTORS", 60)
    monkeypatch.setattr(nearest, "CHUNK_QUERIES", 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    hits, want = 0, _expected(rows, 10)
    for r in nearest.nearest(df, "vec_id % 20 = 0", k=10).collect():
        hits += (r["vec_id"], r["score"]) in want[r["query_id"]]
    assert hits >= 0.95 * 10 * len(want)


def test_recall_of_whole_tables(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_MID.replace('0.01', '0.1')}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = collections.defaultdict(set)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for r in nearest.nearest(df, "vec_id % 20 = 0", k=20).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(found[ids[q]] & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits / (20 * len(found)) >= 0.99


def _other_extractor(page):
    """The text of the one article of a page, by patterns: no tree, no scores."""
    body = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)
    text = re.sub(r"<!--.*?-->", "", body.group(1), flags=re.S)
    for tag in ("script", "style", "nav", "aside", "form", "footer", "noscript"):
        text = re.sub(rf"<{tag}\b.*?</{tag}>", " ", text, flags=re.S)
    text = re.sub(r'<(div|section|p)\b[^>]*class="(?:ad|ads|comments?|share|related|promo|cookie|sidebar|menu)[^"]*"[^>]*>.*?</\1>', " ", text, flags=re.S)
    text = re.sub(r"<(?!/?(?:a|b|i|em|strong|span|code|u|small|sub|sup|mark)\b)[^>]*>", " ", text)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


def test_pages_against_another_extractor(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF_MID}/pages.parquet'").fetchall()
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.read.parquet(f"{SF_MID}/pages.parquet")).collect()}
    checked = [(i, p) for i, p in pages if p and p.count("<article") == 1]
    assert len(checked) >= 0.9 * len(pages)
    different = [i for i, p in checked if got[i] != _other_extractor(p)]
    assert not different, (len(different), different[:5])


@pytest.mark.parametrize("markup", ["<div><b>", "<ul><li><a>x", "<article><header>", "<svg><g/>", "<table><tr><td>"])
def test_unclosed_markup_is_parsed_in_linear_time(markup):
    begin = time.process_time()
    html_text.main_text(markup * 100_000 + "some text, at the end")
    assert time.process_time() - begin < 15


# -- how the input lies ---------------------------------------------------------------


def test_model_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id < 300")
    one, other = ({r["doc_id"]: r["score"] for r in mixing.score(docs.repartition(n)).collect()} for n in (1, 5))
    assert one == pytest.approx(other, rel=1e-6) and len(one) == 300


def test_packing_is_no_worse_than_best_fit_decreasing(spark):
    rows = packing.pack(spark.read.parquet(f"{SF_MID}/documents.parquet"), BYTE_BPE).collect()
    rooms, used = [], 0
    for length in sorted((r["length"] for r in rows), reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else 1024
        used += room == 1024
        if room > length:
            bisect.insort(rooms, room - length)
    assert len({r["sequence_id"] for r in rows}) <= used


def test_blocks_come_to_an_end(spark, monkeypatch):
    """Blocks are dealt anew until one is left, whether bins fill up or hold one long document each."""
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 40)
    texts = ["word " * n for n in [3, 5, 9, 14] * 30 + [16] * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(df, BYTE_BPE, capacity=24).collect()
    fills = collections.Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills[r["sequence_id"]]
        fills[r["sequence_id"]] += r["length"]
    assert len(rows) == len(texts) and max(fills.values()) <= 24
    assert len(fills) <= 1.1 * sum(fills.values()) / 24 + 1


@pytest.mark.parametrize("most", [1 << 15, 1 << 26])
def test_rows_told_apart(spark, monkeypatch, most):
    """No row with a key is among those that have none, with few bits and with many."""
    monkeypatch.setattr(spread, "MOST_BITS", most)
    rows = spark.range(5000).selectExpr("struct(id IS NULL AS n, id) AS d", "id", "'x' AS _slot")
    keys = spark.range(0, 5000, 50).selectExpr("struct(id IS NULL AS n, id) AS d")
    maybe, none = spread.told_apart(rows, rows["d"], keys)
    assert maybe.columns == none.columns == ["d", "id", "_slot"]
    ids = {r["id"] for r in maybe.collect()}
    assert ids >= set(range(0, 5000, 50)) and len(ids) < 1000
    assert ids.isdisjoint(r["id"] for r in none.collect()) and none.count() == 5000 - len(ids)
    assert spread.told_apart(rows, rows["d"], keys.where("false"))[1].count() == 5000


def test_near_dedup_of_repeated_rows(spark):
    """Of rows equal in id and text one stays, of rows equal in text alone the least id."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text, "a"), (3, text, "a"), (1, text, "b"), (1, text, "b"), (None, text, "c"), (7, None, "d"), (7, None, "e"),
            (9, "other " + text[::-1], "f"), (9, "other " + text[::-1], "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(4)
    got = [r["doc_id"] for r in simhash.near_dedup(df).collect()]
    assert sorted(got) == [1, 7, 9]
    assert simhash.near_dedup(df).columns == df.columns
    assert simhash.near_dedup(df.where("false")).count() == 0
