"""Language ID (1), mixing (9), sampled pieces (6) and the pipeline."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import WORDS, documents, lower, same_as_twin
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from arrivo.llm import language, mixing, pieces, queries

SF = "/root/testdata/sf0.01"


# --- language ---------------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.QUERIES["op1_language"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 5, 1])
    codes = rng.integers(0, 6, lengths.sum())
    scores = rng.normal(size=(6, 3))
    got = language.viterbi(scores, codes, lengths, 0.7)
    at = 0
    for n in lengths:
        own = codes[at:at + n]
        value = lambda p, own=own: (sum(scores[c, k] for c, k in zip(own, p, strict=True))
                                    - 0.7 * sum(a != b for a, b in itertools.pairwise(p)))
        best = max(itertools.product(range(3), repeat=n), key=value)
        assert math.isclose(value(best), value(tuple(got[at:at + n])))
        at += n


def test_language_spans_scripts_and_edges(spark, tmp_path):
    en, ru = "the cat sat on the mat and looked at the dog ", "кошка сидела на окне и смотрела на собаку "
    fr = "le chat est sur la table et regarde les oiseaux dans le jardin "
    train = documents(spark, tmp_path, [en * 5, fr * 5, ru * 5] * 8, langs=["en", "fr", "ru"] * 8, name="train")
    model = language.fit(train, F.col("lang"), F.col("text"), F.lit(True), F.col("doc_id"))
    assert model.langs == ["en", "fr", "ru"]
    t = [en * 3 + fr * 3, ru + en * 4, None, "", "12 !! 34", "字字字", en, en, "x" * 200_000]
    docs = documents(spark, tmp_path, t, extra=True)
    rows = {r.row.doc_id: r for r in language.identify(docs, model, penalty=4.0).collect()}
    assert [s.lang for s in rows[0].spans] == ["en", "fr"] and rows[0].spans[0].start == 0
    assert t[0][rows[0].spans[1].start:rows[0].spans[1].end] == (fr * 3).strip()
    assert [s.lang for s in rows[1].spans] == ["ru", "en"] and rows[1].lang_pred == "en"
    assert [(rows[k].lang_pred, rows[k].score, rows[k].spans) for k in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert rows[5].lang_pred in model.langs and rows[8].lang_pred in model.langs
    assert rows[6].lang_pred == rows[7].lang_pred == "en" and rows[6].score == rows[7].score
    assert rows[0].row.asDict().keys() == set(docs.columns)
    assert language.identify(docs.where("doc_id < 0"), model).count() == 0
    none = language.fit(train.where("doc_id < 0"), F.col("lang"), F.col("text"), F.lit(True), F.col("doc_id"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    kept = language.known_language(docs.withColumn("lang", F.lit("en")))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {0, 1, 5, 6, 7, 8}


def test_language_reads_only_the_text(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit_documents(docs)
    a = language.identify(docs, model, spans=False).select("row.doc_id", "lang_pred", "score")
    b = language.identify(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), model, spans=False)
    assert a.exceptAll(b.select("row.doc_id", "lang_pred", "score")).count() == 0


# --- mixing -----------------------------------------------------------------------------------------------

def test_mixing_twin(spark):
    same_as_twin(queries.QUERIES["op9_mixing"](spark, SF), queries.ORACLE["op9_mixing"], SF)


def plain_targets(sizes):
    """Targets by rounds of resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = sum(weight[s] for s in order if s not in capped)
        rate = (budget - sum(2 * sizes[s] for s in capped)) / left if left else 0
        new = {s for s in order if s not in capped and weight[s] * rate > 2 * sizes[s]}
        if not new:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * rate for s in order}
        capped |= new


def test_mixing_targets_and_taken(spark, tmp_path):
    import random
    rng = random.Random(5)
    sources = [rng.choice(["a", "a", "a", "b", "c", "é", None]) for _ in range(400)]
    t = ["w " * rng.randint(0, 30) for _ in sources]
    t[3], t[4] = None, "v " * 3000
    docs = documents(spark, tmp_path, t, sources, extra=True)
    sizes = Counter()
    for s, x in zip(sources, t, strict=True):
        sizes[s] += len(WORDS.findall(x or ""))
    want = plain_targets(sizes)
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == len(t)
    got = Counter()
    for r in rows:
        assert r.size == len(WORDS.findall(t[r.doc_id] or "")) and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source]) and r.taken in (0, r.size, 2 * r.size)
        got[r.source] += r.taken
    assert all(abs(got[s] - want[s]) <= 3100 if s == sources[4] else abs(got[s] - want[s]) <= 31 for s in want)
    assert sum(got.values()) <= 1.5 * sum(sizes.values())
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times[r.doc_id] * r.size == r.taken for r in rows)


def test_mixing_queue_is_in_finish_order_across_ranges(spark, tmp_path, monkeypatch):
    docs = documents(spark, tmp_path, ["w " * (k % 9) for k in range(300)], ["abc"[k % 3] if k % 2 else "a" for k in range(300)])
    whole = mixing.taken_words(docs).select("doc_id", "taken").collect()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)
    assert sorted(mixing.taken_words(docs).select("doc_id", "taken").collect()) == sorted(whole)
    queue = mixing.mix(docs)[1].orderBy("position", "finish").collect()
    assert all(a.finish <= b.finish and a.position + a.size == b.position for a, b in itertools.pairwise(queue) if a.size and b.size)


def test_mixing_edges(spark, tmp_path):
    docs = documents(spark, tmp_path, [None, "", " "], [None, "a", "b"])
    assert [(r.size, r.target, r.taken) for r in mixing.taken_words(docs).collect()] == [(0, 0.0, 0)] * 3
    assert mixing.taken_words(docs.where("doc_id < 0")).count() == 0
    same = documents(spark, tmp_path, ["a b"] * 4, ["s"] * 4, name="same", ids=[1, 1, None, None])
    assert sum(r.taken for r in mixing.taken_words(same).collect()) == 12


# --- pieces -----------------------------------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")
V = pieces.load(MODEL)


def cut(texts, keys=None, seed=0, v=V):
    keys = np.arange(len(texts)) if keys is None else keys
    ids, counts = pieces.sample(v, texts, keys, seed)
    return np.split(ids, np.cumsum(counts)[:-1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t▁ab字é<>s")), max_size=40), min_size=1, max_size=5))
def test_pieces_decode_to_the_text(texts):
    ids, counts = pieces.sample(V, texts, np.arange(len(texts)), 1)
    assert [x.decode() for x in pieces.Decoder(V).texts(ids, counts)] == texts
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for own, text in zip(np.split(ids, np.cumsum(counts)[:-1]), texts, strict=True):
        assert not any(sp.is_control(int(i)) or sp.is_unknown(int(i)) for i in own)
        if "\x00" not in text:
            assert sp.decode([int(i) for i in own]) == text


def test_pieces_follow_the_exact_distribution():
    """All segmentations of a short word, by their weights, against the shares of many draws."""
    text, n = "the", 20000
    names = {x.decode(): k for k, x in enumerate(V.data) if x and k not in set(V.byte_ids.tolist())}
    def ways(s):
        return [[]] if not s else [[names[s[:k]], *w] for k in range(1, len(s) + 1) if s[:k] in names for w in ways(s[k:])]
    weight = {tuple(w): math.exp(sum(V.weight[i] for i in w)) for w in ways(" " + text)}
    total = sum(weight.values())
    got = Counter(tuple(x.tolist()) for x in cut([text] * n))
    assert set(got) <= set(weight)
    for w, x in weight.items():
        p = x / total
        assert abs(got[w] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


def test_pieces_do_not_depend_on_batches():
    t = ["the quick brown fox", "jumps over", "", "the lazy dog 字 " * 50]
    whole = cut(t, np.array([5, 6, 7, 8]))
    for k, x in enumerate(t):
        assert cut([x], np.array([5 + k]))[0].tolist() == whole[k].tolist()
    assert cut(t, np.array([5, 6, 7, 8]), seed=1)[3].tolist() != whole[3].tolist()


def test_pieces_query_and_edges(spark, sf, tmp_path):
    rows = queries.QUERIES["op6_sampled_pieces"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(r.lossless for r in rows)
    t = [None, "", "a", "a", "long " * 40000, "x" * 50000, "▁ literal ▁"]
    docs = documents(spark, tmp_path, t, ids=[1, 2, 3, 3, 5, None, None], extra=True)
    out = pieces.encode(docs, V)
    back = {(r.row.row.doc_id, r.row.row.n_chars): r.text for r in pieces.decode(out, V).collect()}
    assert back == {(i, len(x or "")): x or "" for i, x in zip([1, 2, 3, 3, 5, None, None], t, strict=True)}
    assert all(r.lossless and r.n_pieces == len(r.pieces) for r in out.collect())
    assert out.where("row.doc_id = 3").select("pieces").distinct().count() == 1
    assert pieces.encode(docs.where("doc_id < 0"), V).count() == 0
    again = pieces.encode(docs.repartition(1), V)
    assert out.select("row.doc_id", "pieces").exceptAll(again.select("row.doc_id", "pieces")).count() == 0


# --- pipeline ---------------------------------------------------------------------------------------------

def plain_pipeline(rows):
    """Copies per doc_id that reach the last stage."""
    from test_duplicates import plain_components, plain_print

    rows = {r.doc_id: r for r in rows if any(c.isalpha() for c in r.text or "")}
    last = {}
    for i, r in rows.items():
        last[lower(r.text)] = max(i, last.get(lower(r.text), i))
    rows = {i: rows[i] for i in last.values()}
    label = plain_components({i: plain_print(r.text) for i, r in rows.items()}, 2)
    return {i: rows[i] for i in set(label.values())}


def test_pipeline_against_plain_version(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = documents(spark, tmp_path, [None, "", "12 34", "Hello world again", "hello World again"], name="extra", ids=[9001, 9002, 9003, 9004, 9005])
    both = docs.unionByName(extra)
    now = both
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf)
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        now = spark.read.parquet(path)
        if name == "simhash_dedup":
            want = plain_pipeline(both.collect())
            assert sorted(r.doc_id for r in now.select("doc_id").collect()) == sorted(want)
            taken = {r.doc_id: r.taken for r in mixing.taken_words(now).collect()}
            sizes = Counter()
            for r in want.values():
                sizes[r.source] += len(WORDS.findall(r.text))
            target = plain_targets(sizes)
    copies = Counter(r.doc_id for r in now.select("doc_id").collect())
    assert all(taken[i] == copies[i] * len(WORDS.findall(r.text)) for i, r in want.items())
    assert abs(sum(taken.values()) - sum(target.values())) <= 2000
    assert now.where("not lossless").count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and [s[0] for s in corpus_pipeline.STAGES][0] == "language_id"


def test_pipeline_run_is_the_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "n_pieces", "pieces", "decoded_sha256", "lossless"] and rows.count() > 0


@pytest.mark.parametrize("k", range(5))
def test_pipeline_stage_on_empty_table(spark, tmp_path, k):
    docs = documents(spark, tmp_path, ["a"]).where("doc_id < 0")
    assert corpus_pipeline.STAGES[k][1](spark, docs, "").count() == 0
