"""Named entities of the whole table."""

import html
from html.entities import html5

from arrivo.sources import pages


def texts(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    return [r.v for r in df.select("k", pages.unescape(df.v).alias("v")).orderBy("k").collect()]


def test_every_named_entity_is_decoded(spark):
    names = [n for n in html5 if n.endswith(";")]
    assert texts(spark, [f"a&{n}b" for n in names]) == [f"a{html5[n]}b" for n in names]


def test_entities_are_decoded_once(spark):
    t = ["&amp;lt;", "&#38;amp;", "&&num;39;", "&Acirc;&acirc; &rsquo;&Ouml;&#243;&#xF1;&#8364;", "&nosuch; & &", "no sign", "", "&amp;amp;"]
    assert texts(spark, t) == [html.unescape(x) for x in t]
    assert texts(spark, [None]) == [None]


def test_links_spelled_with_any_entity(spark):
    page = "<a href='/a&ccedil;&atilde;o.csv'>&Agrave; la c&ocirc;te d&rsquo;&icirc;le</a>"
    df = spark.createDataFrame([(1, "https://h.org/", page)], "page_id int, url string, html string")
    assert [(r.href, r.text) for r in pages.links(df).collect()] == [("/ação.csv", "À la côte d’île")]
    assert {r.target: r.link for r in pages.target_links(df, ["côte", "ação"]).collect()} == dict.fromkeys(
        ["côte", "ação"], "https://h.org/ação.csv")
