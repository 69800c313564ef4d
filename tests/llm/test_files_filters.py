"""Sharding (2), URL filter (3), token files (7), chat formatting (8), quality (10)."""

import hashlib
import os
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import CLASH, WORDS, documents, same_as_twin, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arrivo.llm import chat, quality, queries, sharding, tokens, urls

SF = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("byte_bpe_50k.json")


# --- sharding ---------------------------------------------------------------------------------------------

def check_shards(rows, texts, shards, slack):
    size = [0] * shards
    slots = {}
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert r.size == len(t) + 16 and r.text_crc32 == zlib.crc32(t)
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size) / shards
    assert max(abs(x - mean) for x in size) <= slack


def test_shards_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in docs}
    out = queries.QUERIES["op2_sharding"](spark, SF)
    assert dict(out.dtypes)["shard"] == dict(out.dtypes)["grown_shard"] == "int" and dict(out.dtypes)["slot"] == "bigint"
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and {r.law for r in rows} == {"bytes"}
    largest = max(len((t or "").encode()) for t in texts.values()) + 16
    total = sum(r.size for r in rows)
    check_shards(rows, texts, 40, largest + 0.1 * total / 40)
    assert sorted(rows) == sorted(queries.QUERIES["op2_sharding"](spark, SF).collect())


def test_counts_below_are_exact(spark, tmp_path):
    rng = random.Random(0)
    keys = [(rng.getrandbits(160) if k % 3 else 7 << 96).to_bytes(20, "big") for k in range(500)]
    df = table(spark, tmp_path, [(bytearray(k), n) for n, k in enumerate(keys)], "key binary, size bigint")
    probes = sorted({0, 1, 7 << 96, (7 << 96) + 1, 1 << 159, *(rng.getrandbits(160) for _ in range(20))})
    size, rows = sharding.count_below(df, probes)
    assert size.tolist() == [sum(n for n, k in enumerate(keys) if int.from_bytes(k, "big") < p) for p in probes]
    assert rows.tolist() == [sum(int.from_bytes(k, "big") < p for k in keys) for p in probes]


def test_shards_with_a_hot_group(spark, tmp_path):
    """A third of all rows is one text: its group is cut, smaller groups stay whole."""
    texts = ["copy " * 20] * 1000 + [f"text {k % 900} " * 10 for k in range(1800)] + [None, "", ""]
    docs = documents(spark, tmp_path, texts, extra=True)
    rows = sharding.shard(docs, shards=7, keep=[]).collect()
    check_shards(rows, dict(enumerate(texts)), 7, 0.12 * sum(r.size for r in rows) / 7)
    whole = [len({r.shard for r in rows if texts[r.doc_id] == t}) for t in {f"text {k} " * 10 for k in range(900)}]
    assert set(whole) == {1}
    fine = sharding.shard(docs, shards=7, keep=[], range_bytes=5000).collect()
    check_shards(fine, dict(enumerate(texts)), 7, 0.12 * sum(r.size for r in rows) / 7)


def test_shards_are_written_whole(spark, tmp_path):
    docs = documents(spark, tmp_path, [f"t{k}" for k in range(50)], extra=True)
    sharding.write_shards(docs.drop("slot"), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out"))[-4:] == [f"shard={k}" for k in range(4)]
    assert back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0 and back.count() == 50


def test_shards_edges(spark, tmp_path):
    docs = documents(spark, tmp_path, ["a"] * 30 + [None] * 3, ids=[1] * 30 + [None] * 3)
    rows = sharding.shard(docs, shards=3, keep=[]).collect()
    assert len(rows) == 33 and {r.shard for r in rows} <= {0, 1, 2}
    assert max(sum(r.shard == k for r in rows) for k in range(3)) <= 12  # repeated rows are parted by place
    assert sharding.shard(docs.where("doc_id < 0"), keep=[]).count() == 0
    one = sharding.shard(documents(spark, tmp_path, ["only"], name="one"), shards=40, keep=[]).collect()
    assert len(one) == 1 and one[0].slot == 0


# --- urls -------------------------------------------------------------------------------------------------

def test_urls_twin(spark):
    same_as_twin(queries.QUERIES["op3_urls"](spark, SF), queries.ORACLE["op3_urls"], SF)


def plain_reject(url, strict, soft, least):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    alone = lambda i, t: not (text[i - 1:i] and text[i - 1] in OWN) and not (text[i + len(t):i + len(t) + 1] and text[i + len(t)] in OWN)
    has = lambda t: any(text.startswith(t, i) and alone(i, t) for i in range(len(text)))
    return any(map(has, strict)) or sum(map(has, set(soft))) >= least


OWN = set("abcdefghijklmnopqrstuvwxyz0123456789")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB-/.:é1", max_size=25))
def test_url_terms_against_plain_search(url):
    strict, soft = ["bb", "a-b"], ["a", "b", "ab", "1", "é"]
    assert urls._rejected(urls._automaton(strict, soft), url, 2) == plain_reject(url, strict, soft, 2)


def test_urls_rules_and_edges(spark, tmp_path):
    rules = [urls.Rule(*r) for r in queries.URL_RULES]
    cases = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"), "http://net/": ("net", "/", "net/", "block"),
        "http://example.net/en/1": ("example.net", "/en/1", "example.net/en/", "allow"),
        "https://m.example.net/en": ("m.example.net", "/en", "net/", "block"),
        "http://xnet/": ("xnet", "/", None, "allow"), "http://a.net": ("a.net", "", None, "allow"),
        "http://w.org/fr/porn": ("w.org", "/fr/porn", "org/fr/", "allow"), "http://w.org/de/porn": ("w.org", "/de/porn", None, "block"),
        "http://sexton.org/win": ("sexton.org", "/win", None, "allow"), "http://w.org/free?sex#x": ("w.org", "/free", None, "block"),
        "http://w.org/free-free": ("w.org", "/free-free", None, "allow"), "no sign": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "": ("", "", None, "allow"), "a://b://c": ("b:", "//c", None, "allow"), "x://?q": ("", "", None, "allow"),
        "porn": ("", "", None, "block"), "http://w.org/" + "y" * 100_000: ("w.org", "/" + "y" * 100_000, None, "allow"),
    }
    pages = table(spark, tmp_path, [(k, u, "x", "y") for k, u in enumerate(cases)] * 2, "page_id bigint, url string, host string, rule string")
    got = {(r.row.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, rules).collect()}
    assert got == {(k, *v) for k, v in enumerate(cases.values())}
    assert urls.judge(pages.where("page_id < 0"), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, [], strict=[], soft=[]).collect()} == {"allow"}


# --- token files ------------------------------------------------------------------------------------------

@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_codes_round_trip_and_direct_access(ids):
    data = tokens.pack(np.array(ids, dtype=np.uint32))
    assert tokens.unpack(data).tolist() == ids
    assert [tokens.token_at(data, i) for i in range(len(ids))] == ids


def test_direct_access_reads_few_bytes():
    ids = np.random.default_rng(0).integers(0, 50257, 200_000).astype(np.uint32)
    data = tokens.pack(ids)
    read = set()

    class Watched(bytes):
        def __getitem__(self, k):
            read.update(range(*k.indices(len(self))) if isinstance(k, slice) else [k])
            return super().__getitem__(k)

    assert tokens.token_at(Watched(data), 123_456) == ids[123_456] and len(read) < 200


PLAIN = Tokenizer.from_file(FILE)
ENCODER = tokens.Encoder(FILE, cache=50)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" '\n\t\x1c\x85\xa0²½aé1 字")), max_size=60), min_size=1, max_size=4))
def test_encoder_equals_the_library(texts):
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    ids, counts = ENCODER.ids(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    ids, counts = ENCODER.ids(texts, end_id=7)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [[*x, 7] for x in want]


def test_encoder_on_special_strings():
    for t in ("a<|endoftext|>b", "don't we'll 'S 's''s", "x  y   z \n\n a", " " * 50, "ǅ ǈ ª º ² ¼"):
        assert ENCODER.ids([t])[0].tolist() == PLAIN.encode(t, add_special_tokens=False).ids
    assert ENCODER.by_words


def check_files(df, rows):
    """``rows``: (doc_id, text) in file order."""
    at, want = 0, []
    for i, t in rows:
        ids = [*PLAIN.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    key = lambda r: r[1]
    assert sorted(map(tuple, df.collect()), key=key) == want


def test_token_files_against_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    check_files(queries.QUERIES["op7_token_files"](spark, sf), [(r.doc_id, r.text) for r in docs])


def test_token_files_edges(spark, tmp_path):
    t, ids = ["b", None, "", "long word " * 9000, "字 é", "n1", "n0"], [4, 2, 9, 7, 7, None, None]
    docs = documents(spark, tmp_path, t, ids=ids, extra=True)
    order = sorted(zip(ids, t, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    for size in (1, 100, 1 << 20):
        check_files(tokens.token_files(docs, FILE, segment_tokens=size), order)
    assert tokens.token_files(docs.where("doc_id < 0"), FILE).count() == 0
    tokens.write_tokens(docs, str(tmp_path / "tok"), FILE)
    segments = spark.read.parquet(str(tmp_path / "tok")).orderBy("part", "seq").collect()
    ids = [i for s in segments for i in tokens.unpack(s.payload).tolist()]
    flat = [[*PLAIN.encode(x or "", add_special_tokens=False).ids, 0] for _, x in order]
    assert ids == [i for x in flat for i in x]
    many = str(tmp_path / "many")
    tokens.write_tokens(docs, many, FILE, segment_tokens=50)
    assert [tokens.token(spark, many, i) for i in (0, 1, 77, len(ids) - 1)] == [ids[i] for i in (0, 1, 77, len(ids) - 1)]
    for i in (-1, len(ids)):
        with pytest.raises(IndexError):
            tokens.token(spark, many, i)
    with pytest.raises(ValueError):
        tokens.token_files(docs.selectExpr("'d1' AS doc_id", "text"), FILE)


# --- chats ------------------------------------------------------------------------------------------------

CONTROLS = st.lists(st.sampled_from(["\\", "<s>", "</s>", "[INST]", "<|end|>", "<|turn|>", "\n", "a", "é", "<", "[", "|", "字"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.none() | st.sampled_from(["user", "assistant", "null", "odd role\n<|end|>"]) | CONTROLS, st.none() | CONTROLS), min_size=1, max_size=6))
def test_chat_round_trip(turns):
    import pyarrow as pa

    opens = np.zeros(len(turns), dtype=bool)
    opens[0] = True
    data, ends, starts, stops = chat.assemble([r for r, _ in turns], pa.array([t for _, t in turns], pa.string()), opens)
    assert ends[-1] == len(data)
    assert chat.parse(data.decode()) == [(r, t or "") for r, t in turns]
    assert [chat.unescape(data[a:b].decode()) for a, b in zip(starts, stops, strict=True)] == [t or "" for _, t in turns]
    for _, t in turns:
        assert chat.escape(t or "").count("\\") >= (t or "").count("\\") and chat.unescape(chat.escape(t or "")) == (t or "")


def plain_chats(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[conv] = (len(own), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                     3 + sum(8 + len(chat._role_out(r[2])) + 1 + len(chat.escape(r[3] or "")) + len(chat.TAIL) for r in own))
    return out


def found_chats(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in df.collect()}


def test_chats_against_plain_version(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    said = "</s>[INST] ok [/INST]"
    got = found_chats(queries.QUERIES["op8_chat"](spark, sf))
    assert got == plain_chats([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
    assert got[-1][2] == len(said)


def test_chats_twin(spark):
    same_as_twin(queries.QUERIES["op8_chat"](spark, SF), queries.ORACLE["op8_chat"], SF)


def test_chats_edges_and_long_conversation(spark, tmp_path):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} <s> " * 20) for k in range(25_000)]
    rows += [(2, None, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 0, "assistant", "y" * 100_000), (3, 1, "weird\nrole", "")]
    turns = table(spark, tmp_path, [r + ("c",) for r in rows], "conv_id bigint, turn bigint, role string, text string, piece string")
    assert found_chats(chat.chat_digests(turns)) == plain_chats(rows)
    pieces = chat.format_chats(turns).where("conv_id = 1").orderBy("piece").collect()
    assert [p.piece for p in pieces] == list(range(len(pieces))) and len(pieces) > 1
    assert chat.chat_digests(turns.where("conv_id = 99")).count() == 0


# --- quality ----------------------------------------------------------------------------------------------

def plain_rules(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1}
    repeated = {k + j for k, w in enumerate(windows) if w in again for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab \n\t\x0b|#é\xa0\x1c", max_size=60), min_size=1, max_size=6))
def test_rules_against_plain_version(texts):
    got = quality.rules(texts, quality.split(texts))
    assert [tuple(int(x[k]) for x in got) for k in range(len(texts))] == [plain_rules(t)[:5] for t in texts]


def test_scores_are_the_matrix_times_the_weights():
    texts = ["the cat sat on the mat", "", "ÄÖ b", "x", "a a a a"]
    w = quality.split(texts)
    weights = np.random.default_rng(0).normal(size=quality.BUCKETS)
    row, bucket, value = quality._matrix(w)
    assert np.allclose(quality.scores(weights, w), np.bincount(row, weights=value * weights[bucket], minlength=len(texts)))


def test_quality_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op10_quality"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in random.Random(0).sample(rows, 150):
        if len(docs[r.doc_id]) < 20000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(docs[r.doc_id])
    assert all(r.kept == (not r.base_failed and r.probability >= 0.5) for r in rows)
    assert sorted(rows) == sorted(queries.QUERIES["op10_quality"](spark, SF).collect())


def test_quality_on_unseen_labels(spark):
    """Fitted on one half of the labelled rows, judged on the other."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.judge(docs, model).select("row.doc_id", "probability").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = sum((r.probability >= 0.5) == (r.quality == 1) for r in rows)
    assert right >= 0.99 * len(rows)
    good = [r.probability for r in rows if r.quality == 1]
    assert sum(p >= 0.5 for p in good) >= 0.995 * len(good)


def test_quality_edges(spark, tmp_path):
    t = [None, "", "word " * 60, "a b c d e f g h i j " * 6, " ".join(f"w{k}" for k in range(80)), "z" * 300_000]
    docs = documents(spark, tmp_path, t, extra=True)
    labels = spark.createDataFrame([(0, 1, 0), (4, 0, 0), (4, 1, 0), (77, 1, 0), (3, None, None)], "doc_id bigint, quality int, toxic int")
    assert quality.fit(docs, labels.where("doc_id = 77")) is None and quality.fit(docs, labels.where("doc_id = 3")) is None
    model = quality.fit(docs, labels)
    for m in (None, model):
        rows = {r.row.doc_id: r for r in quality.judge(docs, m).collect()}
        assert [(rows[k].n_words, rows[k].base_failed) for k in range(6)] == [(0, True), (0, True), (60, True), (60, True), (80, False), (1, True)]
        assert all(0 <= r.probability <= 1 for r in rows.values())
        assert set(rows[0].row.asDict()) == set(docs.columns) >= set(CLASH)
    assert quality.judge(docs, None).where("kept").select("row.doc_id").collect()[0][0] == 4
    assert quality.judge(docs.where("doc_id < 0"), model).count() == 0
