"""The page scanner and reference resolution against Python's parser and urljoin."""

from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from arrivo.sources import pages


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.open = [], False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            own = dict(attrs)  # the last of equal names
            self.open = "href" in own and own["href"] is not None
            if self.open:
                self.found.append([own["href"], ""])

    def handle_endtag(self, tag):
        if tag == "a":
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.found[-1][1] += data


def parsed(html):
    p = Anchors()
    p.feed(html)
    p.close()
    return [(h, t.strip()) for h, t in p.found]


PAGES = [
    '<!-- <a href="/no.csv">x</a> --><a href="/yes.csv">y</a>',
    "<!-- never closed <a href='/no.csv'>x</a>",
    '<script>var t = "<a href=\'/no.csv\'>";</script><a href=/yes.csv>y</a>',
    '<script type="a>b">if (a < b) { "<!--"; }</script ><a href="/yes.csv">z</a>',
    '<style>a{content:"<a href=/no>"}</style><title><a href="/no"></title><a href=/1>1</a>',
    '<script><!-- <a href="/no"> </script><a href="/after">b</a>',
    '<a title="a>b" href="/t.csv">quoted</a>',
    "<a title='x \"> y' HREF = '/u.csv' class=z>one <b>bold</b> two</a> out <a href=\"/v\">v",
    '<a data-href="/no" href="/w?a=1&amp;b=2">&lt;w&gt;</a><a name="n">no link</a>text<a href="/first" href="/last">twice</a>',
    "<a\nhref=\n'/nl.csv'\n>new\nlines</a><abbr href='/no'>a</abbr><a/href='/slash'>s</a>",
    "1 < 2 <a href=/lt.csv>3 < 4</a> <br/> <p>5 > 4</p>", "<a href=/plain", "", "no tags at all", "<a href='it''s'>q</a>",
    "<div " + "x='y' " * 3000 + "><a href='/far'>far</a></div>" + "<p>" * 5000 + "word " * 20000 + "<a href='/end'>e</a>",
    "<!DOCTYPE html><?xml version='1'?><A HREF='/up'>U</A><textarea><a href='/no'></textarea>",
]


def test_scanner_against_a_parser(spark):
    df = spark.createDataFrame([(k, "http://h.org/", p) for k, p in enumerate(PAGES)] + [(99, None, None)], "page_id int, url string, html string")
    got = {k: [] for k in range(len(PAGES))}
    for r in pages.links(df).orderBy("page_id", "pos").collect():
        assert r.pos == len(got[r.page_id])
        got[r.page_id].append((r.href, r.text))
    for k, p in enumerate(PAGES):
        want = parsed(p)
        if "<textarea>" in p or "<title>" in p:  # older parsers look into these
            want = [x for x in want if x[0] != "/no"]
        if p.startswith("<!-- never"):  # an open comment hides the rest
            want = []
        assert got[k] == want, p[:80]


BASES = ["http://h.com/x/y", "https://h.com", "http://h.com/", "http://h.com:8080/a/b/c?q=1#f", "HTTP://h.com/a//b/./c/../d/", "http://u@h.com/a;p/b?x=/../y"]
REFS = ["../a/b.csv", "./a", ".", "..", "../", "./", "../../../../g", "a/../b", "a//b", "a/b/..", "a/b/.", "/a/../b", "/", "?p=1", "#f", "?p#f", "?", "#", "",
        "//o.org/x/../y", "//o.org", "mailto:a@b", "http:g", "https://z.org/a/../b", "ftp://z.org/x", "g;x=1/../y", "...", "..g", "g.", "g?y/../x", "g#s/./x",
        " /lead", "a\tb\nc", "data.csv", "javascript:void(0)", "a:b", "1:2", "é/ü?ö#ß"]


def test_references_as_urljoin(spark):
    rows = [(b, r, urljoin(b, r)) for b in BASES for r in REFS]
    df = spark.createDataFrame(rows, "base string, ref string, want string").withColumn("got", pages.url_join(F.col("base"), F.col("ref")))
    bad = [(r.base, r.ref, r.want, r.got) for r in df.collect() if r.want != r.got]
    assert not bad, bad[:10]


@pytest.mark.parametrize("href,want", [("httpdocs/a.csv", "httpdocs/a.csv"), ("../a.csv", "http://h.com/a.csv"), ("http://z/../x", "http://z/../x")])
def test_links_that_start_with_http_are_kept(spark, href, want):
    df = spark.createDataFrame([(href, "http://h.com/x/y")], "h string, u string")
    assert df.select(pages.resolve(df.h, df.u)).first()[0] == want
