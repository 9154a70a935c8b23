"""The compression classifier, the prefix trie and turn repair against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_MID, SF_SMALL
from vigil.llm import compress_quality, prefix_trie, turn_repair

CONVERSATION = "conv_id long, turn long, role string, text string"


# -- quality by compression ---------------------------------------------------------


def test_scores_of_held_out_documents(spark):
    rows = E.queries()["op11_compress_quality"](spark, SF_MID).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_MID}/labels.parquet'").fetchall())
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    ranked = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert ranked > 0.9, ranked  # a few dozen bad documents to learn from
    assert sum(s >= 0.3 for s in good) >= 0.98 * len(good)


def test_labels_of_held_out_documents_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    score = lambda x: sorted((r["doc_id"], r["score"]) for r in compress_quality.classify(docs, x).collect())
    assert score(labels) == score(flipped)


def test_scores_of_odd_rows(spark):
    texts = [(1, "so be it, all is well. " * 300), (2, None), (3, ""), (4, "| # |" * 50_000), (None, "no id"), (1, "again"), (1, "again")]
    docs = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in texts], "doc_id long, text string, _id string, n int, _text string")
    seen = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in seen] + [(None, 1), (seen[0], 1 - seen[0] % 2), (seen[1], None)],
                                   "doc_id long, quality int")
    for marks in (labels, labels.where("quality = 1"), labels.where("false")):
        rows = compress_quality.classify(docs, marks).collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in texts)
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert {r["n_bytes"] for r in rows if r["doc_id"] in (2, 3)} == {0}
        assert len({r["score"] for r in rows if r["n_bytes"] == 0}) == 1
    assert {r["score"] for r in rows} == {0.5}  # no labels
    assert compress_quality.classify(docs.where("false"), labels).count() == 0


def test_the_curve_rises_and_pools():
    knots = compress_quality.fit_curve([(1.0, False, 9), (2.0, True, 3), (2.0, False, 1), (3.0, False, 2), (4.0, True, 8)])
    assert [x for x, _ in knots] == sorted(x for x, _ in knots)
    assert [p for _, p in knots] == sorted(p for _, p in knots)
    assert knots[1][0] == pytest.approx((2 * 4 + 3 * 2) / 6)  # 2 and 3 are out of order, so one pool
    margin = 1 / 25
    assert knots[1][1] == pytest.approx(margin + (1 - 2 * margin) * 3 / 6)
    assert compress_quality.fit_curve([]) == [(0.0, 0.5)]


# -- prefix trie ----------------------------------------------------------------------


def _spliced(rows, step=5, most=9):
    """Every conversation's rebuilt turns, by the definition."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[conv].append((turn is not None, turn or 0, role, name + len(text.encode()).to_bytes(4, "big"), text))
    turns = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    cut = lambda c: zlib.crc32(str(c).encode()) % most
    return {c: tuple(turns.get(c - int(math.fmod(c, step)), [])[: cut(c)] + turns[c][cut(c):]) for c in turns}


def _trie(sequences):
    members, below = collections.defaultdict(list), collections.defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    for prefix in members:
        if prefix:
            below[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in below[p]) or 1
        saved[p] = sum(saved[k] for k in below[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(sequences[c]) == len(p))
    return {
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
         hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items()
    }


def _same_trie(df, width):
    got = [tuple(r) for r in prefix_trie.spliced_trie(df, width=width).collect()]
    want = _trie(_spliced([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]))
    assert len(got) == len(want) and set(got) == want


def test_the_trie_of_the_conversations(spark):
    df = E.queries()["op12_prefix_trie"](spark, SF_SMALL)
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    assert {tuple(r) for r in df.collect()} == _trie(_spliced(rows))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("width", [1, 3, 8])
def test_tries_in_blocks(spark, width):
    """Long shared prefixes, copies, ties, nulls and turnless conversations, in blocks of any width."""
    rng, rows = random.Random(width), []
    for conv in range(40):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, "éé"])) for _ in range(rng.choice([0, 1, 3, 12]))]
        if conv % 7 == 0:
            turns = [("user", "same")] * 14 + [("user", str(conv % 2))]
        rows += [(conv if conv < 30 else conv + 10**12, rng.choice([i, i, None, 3]), r, x) for i, (r, x) in enumerate(turns)]
    rows += [(None, 1, "user", "x"), (-3, 1, "user", "x")]
    df = spark.createDataFrame([(*r, "v", 1) for r in rows], CONVERSATION + ", _tid string, n int").repartition(5)
    _same_trie(df, width)


def test_no_conversations_no_nodes(spark):
    df = spark.createDataFrame([], CONVERSATION)
    assert prefix_trie.spliced_trie(df).count() == 0
    one = prefix_trie.spliced_trie(spark.createDataFrame([(5, None, None, None)], CONVERSATION)).collect()
    assert [r["depth"] for r in sorted(one)] == [0, 1]


def test_positions_of_one_large_group(spark):
    """A conversation of most rows is cut over tasks, and numbered without a gap."""
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 10 = 0 THEN id % 7 ELSE 99 END AS g", "(id * 7919) % 20000 AS o")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        placed = prefix_trie.positions(rows, "g", ["o"], "test").collect()
    finally:
        spark.conf.set(merge, "true")
    groups = collections.defaultdict(list)
    for r in placed:
        groups[r["g"]].append((r["o"], r["_pos"]))
    assert len(groups) == 8
    for pairs in groups.values():
        assert [p for _, p in sorted(pairs)] == list(range(len(pairs)))


def test_ends_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FRAGMENT", 64)
    members = spark.range(1000).selectExpr("id % 3 AS seq", "id AS conv_id").repartition(4)
    got = {r["seq"]: r["ends"] for r in prefix_trie._ends(members).collect()}
    assert got == {s: hashlib.sha256(",".join(map(str, range(s, 1000, 3))).encode()).hexdigest() for s in range(3)}


# -- turn repair ----------------------------------------------------------------------

SEEN = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def _cheapest(rows):
    """(cost, audit, repaired turns) for rows (role, text, fault), with audits as plain strings."""
    best = {"": (0, "", ())}

    def put(states, at, new):
        if at not in states or new[:2] < states[at][:2]:
            states[at] = new
            return True
        return False

    def insert(states):
        grew = True
        while grew:
            grew = False
            for at, (cost, audit, out) in list(states.items()):
                for role in ("user", "assistant"):
                    if (at, role[0]) in NEXT:
                        grew |= put(states, NEXT[at, role[0]], (cost + 3, audit + "I", (*out, (role, ""))))
        return states

    best = insert(best)
    for role, text, fault in rows:
        after = {}
        for at, (cost, audit, out) in best.items():
            put(after, at, (cost + 4, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            stay = 3 if fault == "truncated" else 0
            if (at, role[:1]) in NEXT:
                put(after, NEXT[at, role[:1]], (cost + stay, audit + "K", (*out, (role, text))))
            for given in ("user", "assistant"):
                if (at, given[0]) in NEXT:
                    put(after, NEXT[at, given[0]], (cost + stay + 3, audit + "R", (*out, (given, text))))
        best = insert(after)
    cost, audit, out = min((best[at] for at in ("", "a") if at in best), key=lambda x: x[:2])
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return cost, audit, out


def _repaired(rows):
    ids, groups = {r[0] for r in rows}, collections.defaultdict(list)
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else x
        fault = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = "user" if fault == 4 else said(role), said(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
        groups[conv] += [(turn is not None, turn or 0, role, name, text, turn)] * (0, 1, 1, 2, 1)[fault if fault < 5 else 4]
    out = set()
    for conv in ids:
        kept, seen, faults = sorted(groups[conv], key=lambda r: r[:4]), set(), []
        for _, _, role, _, text, _ in kept:
            shown = SEEN.findall(text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        turns = [r[5] for r in kept if r[5] is not None]
        initials = [r[2][:1] for r in kept]
        cost, audit, turns_out = _cheapest(faults)
        count = lambda f: sum(x[2] == f for x in faults)  # noqa: E731, B023
        out.add((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"),
            count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns_out).encode()).hexdigest(),
        ))
    return out


@pytest.mark.parametrize("prime", [turn_repair._PRIME, 7, 1])
def test_cheapest_edits(prime):
    """Also where hashes collide often, or always."""
    rng = random.Random(prime)
    for _ in range(1500):
        rows = [(rng.choice("suax"), rng.choice(["", "", "blank", "truncated"])) for _ in range(rng.choice([0, 1, 2, 5, 9, 17, 33]))]
        want = _cheapest([(r, "", f) for r, f in rows])[:2]
        assert turn_repair.repair([(r, f == "blank", f == "truncated") for r, f in rows], turn_repair.Audits(prime)) == want, rows


def test_long_conversations_share_their_audits():
    n = 30_000
    tree = turn_repair.Audits()
    cost, audit = turn_repair.repair([("u", False, False)] * n, tree)
    assert (cost, len(audit)) == (3 * n // 2, n) and set(audit) == {"K", "R"}
    assert len(tree.letter) < 15 * n and len(tree.ups) < 2 * len(tree.letter)
    assert turn_repair.repair([("x", True, False)] * n) == (4 * n, "D" * n)


def test_audits_compare_like_strings():
    rng = random.Random(2)
    for prime in (turn_repair._PRIME, 3):
        tree, texts = turn_repair.Audits(prime), [""]
        for _ in range(300):
            parent, letter = rng.randrange(len(texts)), rng.choice("DIKR")
            assert tree.add(parent, letter) == len(texts)
            texts.append(texts[parent] + letter)
        for _ in range(3000):
            a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
            assert tree.compare(a, b) == (texts[a] > texts[b]) - (texts[a] < texts[b]), (texts[a], texts[b])
            steps = rng.randint(0, len(texts[a]))
            assert tree.text(tree.up(a, steps)) == texts[a][: len(texts[a]) - steps]


def test_repairs_of_the_conversations(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_MID}/conversations.parquet'").fetchall()
    assert {tuple(r) for r in E.queries()["op13_turn_repair"](spark, SF_MID).collect()} == _repaired(rows)


def test_repairs_of_odd_rows(spark):
    rng = random.Random(9)
    rows = [(rng.choice([1, 2, None, 40, 5]), rng.choice([None, 1, 2, 7, 9, i]),
             rng.choice(["user", "assistant", "system", None, "", "tool", "unknown"]),
             rng.choice([None, "", "a.", "b", "c! \n", "é?", " \t", "long. " * 5000])) for i in range(200)]
    rows += [(c, c, "user", "x") for c in range(100, 160)]  # of some all rows are dropped
    df = spark.createDataFrame([(*r, "v", 1) for r in rows], CONVERSATION + ", phase string, name int").repartition(5)
    got = [tuple(r) for r in turn_repair.repair_turns(turn_repair.damage(df), df.select("conv_id")).collect()]
    assert len(got) == len({r[0] for r in rows}) and set(got) == _repaired(rows)
    empty = [r for r in got if r[7] == "" and r[6] == 0]
    assert empty and all(r[1:6] == (0,) * 5 and r[8] == hashlib.sha256(b"").hexdigest() for r in empty)
    assert turn_repair.repair_turns(df.where("false"), df.where("false")).count() == 0
