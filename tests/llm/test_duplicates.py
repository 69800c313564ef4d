"""Exact duplicates (4) and SimHash near duplicates (5)."""

import hashlib
import random

import pytest
import xxhash
from helpers import CLASH, WORDS, documents, lower, same_as_twin
from pyspark.sql import functions as F

from arrivo.llm import exact_dedup, queries, simhash
from arrivo.llm.components import stars


def texts(n=120, seed=1):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(["alpha", "Beta", "ÄÖ", "x", "#"]) for _ in range(rng.randint(0, 4))) for _ in range(n)]
    return base + [None, "", "", "ABC", "abc", "aBc", "ÄBC", "äbc", "a\n" * 5000, "A\n" * 5000, "abc "]


def plain_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g}


def found(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_exact_twin(spark, sf):
    same_as_twin(queries.QUERIES["op4_exact_dedup"](spark, sf), queries.ORACLE["op4_exact_dedup"], sf)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_against_plain_version(spark, tmp_path, weak):
    """A weak digest makes hits of different texts: the byte check must part them."""
    t = texts()
    docs = documents(spark, tmp_path, t, extra=True)
    digest = F.substring(F.sha2(F.lower(F.coalesce("text", F.lit(""))), 256), 1, 1) if weak else None
    out = exact_dedup.exact_dedup(docs, digest=digest)
    assert found(out) == plain_groups(enumerate(t))
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns and set(CLASH) < set(kept.columns)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, g in plain_groups(enumerate(t)).items() if g[2])


def test_exact_goes_on_from_its_state(spark, tmp_path):
    t = texts(40)
    first = documents(spark, tmp_path, t, name="a")
    later = documents(spark, tmp_path, t[:20] + ["new"], name="b", ids=list(range(1000, 1021)))
    state = str(tmp_path / "state")
    exact_dedup.exact_dedup(first, state_dir=state).count()
    both = spark.read.parquet(str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet"))
    out = exact_dedup.exact_dedup(later, state_dir=state, contents=both)
    plain = plain_groups([*enumerate(t), *zip(range(1000, 1021), t[:20] + ["new"], strict=True)])
    assert found(out) == {i: plain[i] for i in range(1000, 1021)}


def test_exact_batch_passed_again_counts_once(spark, tmp_path, monkeypatch):
    docs, state = documents(spark, tmp_path, ["A", "a", "b"]), str(tmp_path / "state")
    run = exact_dedup._run_stream

    def fails(*args):
        run(*args)
        raise RuntimeError("lost after the stream")

    monkeypatch.setattr(exact_dedup, "_run_stream", fails)
    with pytest.raises(RuntimeError):
        exact_dedup.exact_dedup(docs, state_dir=state)
    monkeypatch.setattr(exact_dedup, "_run_stream", run)
    want = plain_groups(enumerate(["A", "a", "b"]))
    assert found(exact_dedup.exact_dedup(docs, state_dir=state)) == want
    assert found(exact_dedup.exact_dedup(docs, state_dir=state, contents=docs)) == want


def test_exact_bytes_are_compared_over_runs(spark, tmp_path):
    """Under a digest of one value for all texts, a later text is parted from the earlier one that stays."""
    first, later = documents(spark, tmp_path, ["A", "zzz"], name="a"), documents(spark, tmp_path, ["y", "a"], name="b", ids=[-2, -1])
    state, weak = str(tmp_path / "state"), F.lit("same")
    assert found(exact_dedup.exact_dedup(first, digest=weak, state_dir=state)) == plain_groups(enumerate(["A", "zzz"]))
    with pytest.raises(ValueError, match="pass all rows as contents"):
        exact_dedup.exact_dedup(later, digest=weak, state_dir=state)
    with pytest.raises(ValueError, match="rows of all runs"):
        exact_dedup.exact_dedup(later, digest=weak, state_dir=state, contents=later)
    with pytest.raises(ValueError, match="read from Parquet"):
        exact_dedup.exact_dedup(spark.createDataFrame(later.collect(), later.schema), state_dir=state, contents=later)
    both = spark.read.parquet(str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet"))
    got = found(exact_dedup.exact_dedup(later, digest=weak, state_dir=state, contents=both))
    plain = plain_groups([(0, "A"), (1, "zzz"), (-2, "y"), (-1, "a")])
    assert got == {i: plain[i] for i in (-2, -1)} and got[-1][:3] == (0, 2, False)


def test_exact_repeated_rows_and_null_ids(spark, tmp_path):
    docs = documents(spark, tmp_path, ["a", "a", "a", "b", "b"], ids=[7, 7, None, None, None])
    rows = exact_dedup.exact_dedup(docs).collect()
    assert sorted((str(r.keep_id), r.group_size) for r in rows) == [("7", 3)] * 3 + [("None", 2)] * 2
    assert sum(r.kept for r in rows) == 2


def test_exact_empty_and_unstored(spark, tmp_path):
    docs = documents(spark, tmp_path, ["a", "A"])
    assert exact_dedup.exact_dedup(docs.where("doc_id < 0")).count() == 0
    assert exact_dedup.exact_dedup(docs.limit(0)).columns[0] == "row"
    assert found(exact_dedup.exact_dedup(docs.union(docs.withColumn("doc_id", F.col("doc_id") + 10)))).keys() == {0, 1, 10, 11}


def plain_print(text):
    words = WORDS.findall(lower(text))
    runs = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(prints, bits):
    """Component label by smallest id, by comparing all pairs of distinct fingerprints."""
    own = sorted(set(prints.values()))
    parent = {p: p for p in own}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = {}
    for i, p in prints.items():
        least[root(p)] = min(least.get(root(p), i), i)
    return {i: least[root(p)] for i, p in prints.items()}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_near_pairs_finds_every_pair(spark, bits):
    rng = random.Random(bits)
    own = {0, 2**64 - 1}
    for _ in range(40):
        center = rng.getrandbits(64)
        for _ in range(8):
            x = center
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            own.add(x)
    # many values that share one segment
    own |= {0xABCDEF0100000000 | rng.getrandbits(32) for _ in range(60)} | {0x12345678 | rng.getrandbits(32) << 32 for _ in range(60)}
    signed = [x - (x >> 63 << 64) for x in own]
    pairs = simhash.near_pairs(spark.createDataFrame([(x,) for x in signed], "fp bigint"), bits)
    got = {frozenset((r.x & 2**64 - 1, r.y & 2**64 - 1)) for r in pairs.collect()}
    own = sorted(own)
    assert got == {frozenset((a, b)) for i, a in enumerate(own) for b in own[:i] if (a ^ b).bit_count() <= bits}


def test_more_bits_are_refused():
    with pytest.raises(ValueError):
        simhash._radii(4)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200 + k, 200 + (k + 1) % 30) for k in range(30)] + [(5, 5)]
    label = {r.hi: r.lo for r in stars(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    want = {k: 0 for k in range(1, 61)} | {k: 100 for k in range(101, 160)} | {k: 200 for k in range(201, 230)}
    assert label == want


def test_simhash_against_plain_version(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    extra = [None, "", " \t\n", "one", "One", "one two", "one two three", "ONE TWO THREE", "a b c d" * 3, "Ü ü É", "w " * 30000]
    t = [r.text for r in docs] + extra
    table = documents(spark, tmp_path, t, extra=True)
    prints = {k: plain_print(x) for k, x in enumerate(t)}
    rows = simhash.simhash_groups(table).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {k: f"{p:016x}" for k, p in prints.items()}
    want = plain_components(prints, 2)
    assert {r.doc_id: r.component_id for r in rows} == want
    kept = simhash.kept_rows(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_simhash_hot_group_of_near_copies(spark, tmp_path):
    rng = random.Random(3)
    body = [f"w{rng.randint(0, 500)}" for _ in range(400)]
    t = []
    for k in range(300):
        own = list(body)
        own[rng.randrange(400)] = f"n{k % 60}"
        t.append(" ".join(own))
    table = documents(spark, tmp_path, t)
    want = plain_components({k: plain_print(x) for k, x in enumerate(t)}, 2)
    assert {r.doc_id: r.component_id for r in simhash.simhash_groups(table).collect()} == want


def test_simhash_empty_nulls_and_repeats(spark, tmp_path):
    docs = documents(spark, tmp_path, ["a b c", "a b c", "x y z q", None], ids=[4, 4, None, None])
    assert simhash.simhash_groups(docs.where("doc_id < 0")).count() == 0
    rows = simhash.simhash_groups(docs).collect()
    assert sorted(str(r.component_id) for r in rows) == ["4", "4", "None", "None"] and sum(r.kept for r in rows) == 3
