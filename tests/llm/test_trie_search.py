"""Prefix trie (12) and ranked search (13)."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import CLASH, documents, lower, same_as_twin, table

from arrivo.llm import queries, search, trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


# --- prefix trie ------------------------------------------------------------------------------------------

def plain_trie(convs):
    """convs: conversation -> list of (role, text). Rows as prefix_trie gives them, from every prefix of every one."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    name = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    def below(p):
        yield p
        for q in children[p]:
            yield from below(q)
    out = []
    for p, m in members.items():
        sub = list(below(p))
        ended = sorted((c for c, t in convs.items() if tuple(t) == p), key=lambda c: (c is not None, c))
        out.append((name[p], len(p), name[p[:-1]] if p else None, len(m), len(children[p]), sum(not children[q] for q in sub),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in sub if q),
                    hashlib.sha256(",".join("" if c is None else str(c) for c in ended).encode()).hexdigest()))
    return sorted(out, key=str)


def in_order(rows):
    convs = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs[r[0]].append((r[2] or "", r[3] or ""))
    return convs


@pytest.mark.parametrize("tail", [20_000, 60, 0])  # all levels in the tail's task, some, only the deepest conversation
def test_trie_against_every_prefix(spark, tmp_path, monkeypatch, tail):
    monkeypatch.setattr(trie, "TAIL", tail)
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é\n"])) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", "same") for c in range(100, 150) for t in range(3)]  # a hot conversation
    rows += [(c, t, "user", f"{t if t < 12 else c * t}") for c in (160, 161, 162) for t in range(25 + c % 3)]  # deep ones
    rows += [(200, None, None, "x"), (200, 1, "user", None), (200, 1, "user", None), (201, 0, "ab", "c"), (202, 0, "a", "bc"),
             (None, 0, "user", "alone"), (None, 1, "user", "a"), (203, 0, "user", "long " * 100_000)]
    rows.append((204, 0, rows[0][2], rows[0][3]))
    df = table(spark, tmp_path, [(*r, *["x"] * len(CLASH)) for r in rows], TURNS + "".join(f", `{c}` string" for c in CLASH))
    got = sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str)
    assert got == plain_trie(in_order(rows))


def test_trie_with_turnless_conversations_and_empty(spark, tmp_path):
    df = table(spark, tmp_path, [(1, 0, "u", "a")], TURNS)
    ids = spark.createDataFrame([(1,), (5,), (2,)], "conv_id bigint")
    got = sorted((tuple(r) for r in trie.prefix_trie(df, ids).collect()), key=str)
    assert got == plain_trie({1: [("u", "a")], 5: [], 2: []})
    none = trie.prefix_trie(df.where("conv_id > 1"))
    assert none.count() == 0 and none.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    only = trie.prefix_trie(df.where("conv_id > 1"), ids).collect()
    assert [tuple(r)[:7] for r in only] == [(1, 0, None, 3, 0, 1, 0)]


def test_long_lists_of_ends_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "JOINED", 16)
    ends = spark.range(-50, 3000).selectExpr("IF(id % 3 = 0, X'01', X'02') AS key", "id AS conv_id").repartition(7)
    got = {bytes(r.key): r.ends_sha256 for r in trie.joined_digests(ends).collect()}
    want = lambda k: hashlib.sha256(",".join(str(i) for i in range(-50, 3000) if (i % 3 == 0) == k).encode()).hexdigest()
    assert got == {b"\x01": want(True), b"\x02": want(False)}


def test_rebuilt_conversations_and_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, t, "user" if t % 2 else "assistant", f"t{rng.randint(0, 2)}") for c in (*range(0, 12), 17, 23, 24, 31) for t in range(rng.randint(1, 14))]
    rows += [(40, None, None, "n"), (40, 0, "user", None), (41, 0, "user", "z")]
    own = in_order(rows)
    want = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    table(spark, tmp_path, rows, TURNS, name="conversations")
    got = sorted((tuple(r) for r in queries.QUERIES["op12_prefix_trie"](spark, str(tmp_path)).collect()), key=str)
    assert got == plain_trie(want)


def test_trie_query(spark, sf):
    same_as_twin(queries.QUERIES["op12_prefix_trie"](spark, sf), queries.ORACLE["op12_prefix_trie"], sf)


# --- ranked search ----------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(docs, items, top):
    """docs: (doc_id, text); items: (item_id, text). Scores of all pairs, in Python integers."""
    terms = [TERM.findall(lower(t)) for _, t in docs]
    total, length = sum(map(bool, terms)), sum(map(len, terms))
    holding = Counter(t for own in terms for t in set(own))
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(TERM.findall(lower(t)))
    out = []
    for i, want in asked.items():
        found = []
        for (d, _), own in zip(docs, terms):
            tf, m = Counter(own), 100 - 75 + 75 * len(own) * total // max(length, 1)
            score = sum(n * math.floor(1000 * math.log((2 * total + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t, n in want.items() if tf[t])
            if score > 0:
                found.append((-score, d is None, d, score))
        out += [(i, rank, d, score) for rank, (_, _, d, score) in enumerate(sorted(found, key=lambda x: x[:2] + (x[2] or 0,))[:top], 1)]
    return sorted(out, key=str)


def small_corpus():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(40)] + ["Ünï", "ÉTÉ", "été", "x_y", "a-b", "9"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(300)] + ["w1 W2, w3"] * 400 + [None, "", "!?", "w5 " * 60_000]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(90)] + [(3, "w1 w1"), (None, "w7"), (95, None), (96, "nowhere"), (97, "")]
    return texts, items


def test_search_against_all_pairs(spark, tmp_path):
    texts, items = small_corpus()
    ids = [None if k == 7 else k // 2 if k < 20 else k for k in range(len(texts))]  # repeated and null identifiers
    docs = documents(spark, tmp_path, texts, ids=ids, extra=True)
    asked = table(spark, tmp_path, [(*r, "x", "y") for r in items], "item_id bigint, text string, score string, `rank` string", name="items")
    want = plain_search(list(zip(ids, texts)), items, 10)
    for block_bytes in (1 << 20, 500):  # one block, many blocks
        got = search.search(docs, asked, block_bytes=block_bytes)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_search_of_empty_tables(spark, tmp_path):
    docs, items = documents(spark, tmp_path, ["a b"]), table(spark, tmp_path, [(1, "a")], "item_id bigint, text string", name="items")
    assert [tuple(r)[:3] for r in search.search(docs, items).collect()] == [(1, 1, 0)]
    for d, i in ((docs.where("doc_id > 0"), items), (docs, items.where("item_id > 1")), (docs.selectExpr("doc_id", "'!' AS text"), items)):
        assert search.search(d, i).collect() == []


def test_slices_stay_exact():
    """Weights near and beyond the room of a slice: parts add up to the weights, and no row of a part can reach 2^53."""
    weights = np.array([[9e9, 5e9, 0, 2.5e10, 1], [1, 9e9, 9e9, 3, 0]])
    parts, total = list(search.slices(weights)), np.zeros_like(weights)
    for columns, own in parts:
        assert own.sum(1).max() * search.TOP_IMPACT < search.EXACT
        total[:, columns] += own
    assert (total == weights).all() and len(parts) > 3


def test_search_query(spark, sf):
    same_as_twin(queries.QUERIES["op13_search"](spark, sf), queries.ORACLE["op13_search"], sf)
