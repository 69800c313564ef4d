"""URL filter with a weighted vocabulary (operator 3).

An Aho-Corasick automaton over strict and soft terms reads each url (A-Z lower-cased) once; an occurrence counts
if no letter a-z or digit stands right before or after it. One strict term or ``least_soft`` distinct soft
terms reject the url. Rules (host, path, verdict) come first: a rule fits its host and all subdomains if the
url's path starts with the rule's path; the longest rule decides. Rules are found by hash, so block lists may hold
millions: one lookup for each suffix of the host, then one for each length of path that this suffix has rules for.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``,
``#`` or the end.

Edge cases: a null url, or one without ``://``, has an empty host and path (its text is still searched); an
empty vocabulary rejects nothing; repeated rows get equal verdicts; extra columns pass through in ``row``;
an empty table gives an empty result; a very long url is searched whole, in one pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField

from arrivo.llm.common import LOWER, UPPER, col, map_texts, whole_row

# A small general vocabulary; callers may pass their own. A term that also names a harmless topic is soft.
STRICT = ["casino", "casinos", "cialis", "hentai", "porn", "porno", "viagra", "warez", "xxx"]
SOFT = ["ad", "ads", "adult", "adults", "babes", "bet", "bets", "betting", "bonus", "cam", "cams", "cheap", "click", "clicks", "crack",
        "cracked", "dating", "discount", "erotic", "escort", "escorts", "farm", "fetish", "free", "gambling", "hookup", "hot", "jackpot",
        "keygen", "loan", "loans", "malware", "naked", "nsfw", "nude", "nudes", "payday", "pharmacy", "phishing", "pills", "poker",
        "popup", "promo", "replica", "roulette", "sex", "sexy", "slots", "spam", "stripper", "strippers", "torrent", "torrents", "track",
        "tracker", "tracking", "webcam", "webcams", "win", "winner"]

DOWN = str.maketrans(UPPER, LOWER)
REST = re.compile(r"([^/?#]*)([^?#]*)")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


class RuleIndex:
    """Rules by host, each host's by path. Of rules with the same host and path the first given counts."""

    def __init__(self, rules: list[Rule]):
        self.hosts: dict[str, tuple[dict[str, Rule], list[int]]] = {}
        for r in rules:
            self.hosts.setdefault(r.host, ({}, []))[0].setdefault(r.path, r)
        for by_path, lengths in self.hosts.values():
            lengths.extend(sorted({len(p) for p in by_path}, reverse=True))

    def find(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits, ties by name."""
        found, at = [], 0
        while True:
            by_path, lengths = self.hosts.get(host[at:], ({}, []))
            if (n := next((n for n in lengths if path[:n] in by_path), None)) is not None:
                found.append(by_path[path[:n]])
            if (dot := host.find(".", at)) < 0:
                return min(found, key=lambda r: (-len(r.name), r.name), default=None)
            at = dot + 1


def read_vocabulary(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Strict and soft terms from a text file with a line ``strict TERM`` or ``soft TERM`` each, for ``judge``.

    Terms are lower-cased (A-Z); empty lines and lines that begin with ``#`` are passed over, any other line is an error.
    The vocabulary is configuration, shipped to every task, and bounded by the file that the caller writes.
    """
    terms: dict[str, list[str]] = {"strict": [], "soft": []}
    for (line,) in spark.read.text(path).collect():
        kind, _, term = line.strip().translate(DOWN).partition(" ")
        if not kind or kind.startswith("#"):
            continue
        if kind not in terms or not term.strip():
            raise ValueError(f"no vocabulary line: {line!r}")
        terms[kind].append(term.strip())
    return sorted(set(terms["strict"])), sorted(set(terms["soft"]))


def host_and_path(url: str | None) -> tuple[str, str]:
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    host, path = REST.match(rest).groups()
    return host.translate(DOWN), path


def _automaton(strict: list[str], soft: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, terms in ((1, soft), (0, strict)):  # a term of both lists is strict
        for term in terms:
            found.add_word(term, (kind, term))
    if len(found):
        found.make_automaton()
    return found


def _inside(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def _rejected(automaton, url: str | None, least_soft: int) -> bool:
    if not url or not len(automaton):
        return False
    text = url.translate(DOWN)
    soft = set()
    for end, (kind, term) in automaton.iter(text):
        start = end + 1 - len(term)
        if (start and _inside(text[start - 1])) or (end + 1 < len(text) and _inside(text[end + 1])):
            continue
        if kind == 0:
            return True
        soft.add(term)
    return len(soft) >= least_soft


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", strict: list[str] = STRICT, soft: list[str] = SOFT,
          least_soft: int = 2, keep: list[Column] | None = None) -> DataFrame:
    """``keep`` (default: row, all columns of ``pages``), host, path, rule, verdict (allow or block)."""
    def start():
        automaton, index = _automaton(strict, soft), RuleIndex(rules)

        def run(urls: pa.Array) -> list[pa.Array]:
            out = []
            for url in urls.to_pylist():
                host, path = host_and_path(url)
                rule = index.find(host, path)
                allow = rule.allow if rule else not _rejected(automaton, url, least_soft)
                out.append((host, path, rule.name if rule else None, "allow" if allow else "block"))
            return [pa.array([x[k] for x in out], pa.string()) for k in range(4)]

        return run

    keep = [whole_row(pages).alias("row")] if keep is None else keep
    fields = [StructField(x, StringType()) for x in ("host", "path", "rule", "verdict")]
    return map_texts(pages, keep, col(url_col), start, fields)
