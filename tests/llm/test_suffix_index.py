"""Repeated passages by suffix arrays (11)."""

import hashlib
import random

import numpy as np
import pytest
from helpers import documents, table
from hypothesis import given, settings
from hypothesis import strategies as st

from arrivo.llm import queries, suffix_index


def plain(docs, length):
    """docs: (key, text) in order. Per document: bytes, removed bytes, runs, digest of the rest; by a set of all windows."""
    seen, out = set(), []
    for key, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            seen.add(w)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        runs = int(np.count_nonzero(gone[:-1] & ~np.append(False, gone[:-2]))) if len(data) else 0
        out.append((key, len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def got(df, *key):
    return sorted((tuple(r[c] for c in (*key, "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=str)


def corpus(seed, n=120):
    """Passages shared whole and in part, copies, runs of one character, texts at the limit of a window."""
    rng = random.Random(seed)
    words = ["the", "of", "ré", "passage", "x", "common", "word", "日本"]
    say = lambda k: " ".join(rng.choices(words, k=k))
    shared = [say(60) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [say(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts += [s[a:a + rng.randint(80, 250)], say(rng.randint(0, 30))]
        texts.append(rng.choice([" ", ""]).join(parts))
    texts += [texts[3]] * 5 + ["a" * 700, "b" * 99, "a" * 100, "ab" * 300, None, "", shared[0], "a" * 99 + "é" + "a" * 99]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_removed_bytes_against_all_windows(spark, tmp_path, monkeypatch, batches):
    if batches == 3:  # most seeds hot, several pieces and flushes
        monkeypatch.setattr(suffix_index, "HOT", 2)
        monkeypatch.setattr(suffix_index, "FLUSH_BYTES", 4000)
        monkeypatch.setattr(suffix_index, "PIECE", 1000)
    texts = corpus(batches)
    docs = documents(spark, tmp_path, texts, extra=True)
    out = suffix_index.remove_repeats(docs, length=100, batches=batches)
    assert got(out, "doc_id") == sorted(plain(list(enumerate(texts)), 100), key=str)
    kept = {r.doc_id: bytes(r.kept_text) for r in out.collect()}
    assert all(hashlib.sha256(kept[k]).hexdigest() == d for k, *_, d in plain(list(enumerate(texts)), 100))


def test_repeated_null_and_string_identifiers(spark, tmp_path):
    texts = corpus(9, 20)
    ids = [None if k < 3 else k // 2 for k in range(len(texts))]
    docs = documents(spark, tmp_path, texts, ids=ids)
    place = docs.select("doc_id", "text", "_metadata.file_path", "_metadata.row_index").collect()
    order = sorted(place, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.file_path, r.row_index))
    assert got(suffix_index.remove_repeats(docs, batches=2), "doc_id") == sorted(plain([(r.doc_id, r.text) for r in order], 100), key=str)
    named = documents(spark, tmp_path, texts, name="named").selectExpr("concat('k', lpad(doc_id, 4, '0')) AS name", "text AS body")
    want = plain([(f"k{k:04}", t) for k, t in enumerate(texts)], 100)
    assert got(suffix_index.remove_repeats(named, id_col="name", text_col="body"), "name") == sorted(want, key=str)


def test_long_text_hot_passage_and_empty(spark, tmp_path):
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefgh ", k=600_000))
    passage = "".join(rng.choices("pqrstuvw ", k=300))
    texts = [long, long[100_000:400_000] + "!" + long] + [f"{k} {rng.random()} {passage} {rng.random()}" for k in range(300)]
    docs = documents(spark, tmp_path, texts)
    assert got(suffix_index.remove_repeats(docs), "doc_id") == sorted(plain(list(enumerate(texts)), 100), key=str)
    none = suffix_index.remove_repeats(docs.where("doc_id < 0"))
    assert none.collect() == [] and none.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]


def test_levels_merge_as_in_binary_counting(spark, tmp_path):
    texts = corpus(4, 70)
    docs = documents(spark, tmp_path, texts).selectExpr("doc_id AS doc", "text")
    index = suffix_index.SuffixIndex(spark, str(tmp_path / "index"), buckets=4)
    sizes = []
    for k in range(7):
        index.add(docs.where(f"doc >= {k * 12} AND doc < {k * 12 + 12}"))
        sizes.append([n for _, n in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    with pytest.raises(ValueError):
        index.add(docs.where("doc = 3"))
    index.add(docs.where("doc < 0"))  # nothing to add
    for batch, _ in index.levels:
        for row in index._read(batch, "kept").collect():
            x = suffix_index.unpack(bytes(row.blob))
            assert list(zip(x["seed"], x["span"])) == sorted(set(zip(x["seed"], x["span"])))
    rows = docs.where("doc < 84").selectExpr("doc", "doc AS id", "text")
    assert got(suffix_index.cut_texts(rows, index.repeated(rows)), "id") == sorted(plain(list(enumerate(texts))[:84], 100), key=str)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=400), max_size=6), st.integers(40, 110))
def test_spans_cover_every_window_once(texts, length):
    texts = [bytes(b % 3 for b in t) for t in texts]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = ends - np.array([len(t) for t in texts], dtype=np.int64)
    x = suffix_index.spans(np.frombuffer(b"".join(texts), dtype=np.uint8), starts, ends, length)
    windows, span_text = [], {}
    for doc, pos, first, last, seed, span in zip(*(x[k].tolist() for k in ("doc", "pos", "first", "last", "seed", "span"))):
        windows += [(doc, p) for p in range(pos - first, pos - last + 1)]
        own = (texts[doc][pos - first:pos - last + length], first)
        assert span_text.setdefault((seed, span), own) == own
    assert sorted(windows) == [(d, p) for d, t in enumerate(texts) for p in range(len(t) - length + 1)]
    order = suffix_index.take(x, np.lexsort((x["span"], x["seed"])))
    back = suffix_index.unpack(suffix_index.pack(order))
    assert all((back[k] == order[k]).all() and back[k].dtype == order[k].dtype for k in order)


def test_repeats_query(spark, sf):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert got(queries.QUERIES["op11_repeats"](spark, sf), "doc_id") == sorted(plain(docs, 100), key=str)
