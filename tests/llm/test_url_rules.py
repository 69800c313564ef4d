"""Rules by hash against every rule tried in turn; vocabulary files; long runs of letters."""

import random

import pytest

from arrivo.llm import language, urls
from arrivo.llm.urls import Rule, RuleIndex


def slow(rules, host, path):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fit, key=lambda r: (-len(r.name), r.name), default=None)


def test_index_equals_all_rules():
    rng = random.Random(5)
    labels, parts = ["a", "b", "net", "", "example"], ["", "/", "/a", "/a/", "/a/b", "/b"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(0, 4)))
    rules = [Rule(host(), rng.choice(parts), rng.random() < 0.5) for _ in range(300)]
    index = RuleIndex(rules)
    for _ in range(5000):
        h, p = host(), rng.choice(parts) + rng.choice(["", "c", "/b/c"])
        want, got = slow(rules, h, p), index.find(h, p)
        assert (want and (want.name, want.allow)) == (got and (got.name, got.allow))
    assert RuleIndex([]).find("a.net", "/") is None


def test_many_rules_one_url():
    index = RuleIndex([Rule(f"h{i}.example", f"/p{i}/", False) for i in range(200_000)] + [Rule("example", "/", True)])
    assert index.find("www.h77.example", "/p77/x").name == "h77.example/p77/"
    assert index.find("www.h77.example", "/p78/x").name == "example/"


def test_vocabulary_file(spark, tmp_path):
    (tmp_path / "terms.txt").write_text("# general\nstrict CASINO\nsoft gratis\n\nsoft  apuestas \nsoft gratis\n")
    strict, soft = urls.read_vocabulary(spark, str(tmp_path / "terms.txt"))
    assert (strict, soft) == (["casino"], ["apuestas", "gratis"])
    pages = spark.createDataFrame([(1, "http://h/casino"), (2, "http://h/gratis/apuestas"), (3, "http://h/gratis"), (4, "http://h/" + "x" * 200_000),
                                   (5, "http://h/" + "x" * 200_000 + "/casino")], "page_id long, url string")
    got = {r.row.page_id: r.verdict for r in urls.judge(pages, [], strict=strict, soft=soft).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block"}
    (tmp_path / "bad.txt").write_text("weak term\n")
    with pytest.raises(ValueError):
        urls.read_vocabulary(spark, str(tmp_path / "bad.txt"))


def test_long_runs_are_cut_into_words():
    text = "ab" * 5000 + " c"
    words = language.words_of(text)
    assert "".join(words) == "ab" * 5000 + "c" and max(map(len, words)) == language.WORD_LETTERS
