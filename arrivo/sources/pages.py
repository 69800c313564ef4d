"""Link discovery over a table of web pages.

The reference looks for data-file links on catalogue pages.  Here a page is a
row ``(page_id, url, html)``; a scanner cuts it into tokens (comments, raw text
elements, tags with quoted values, text), the anchors' links are exploded with
their position, matched against target names and keyword sets, resolved against
the page URL, and reduced per (page, target).  Everything is column expressions
plus one grouped aggregate keyed by page: no per-page Python.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivo.functions import strip_ws

# Tokens of a page, tried in this order at each place. Loops are possessive: a page is scanned once, without going back.
# What follows a tag's name: quotes only count after an equals sign, and a quoted value may hold ">".
REST = r"""(?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
COMMENT = r"<!--.*?(?:-->|\z)|<[!?][^>]*+>"
RAW = rf"<(script|style|textarea|title)(?=[\s/>]){REST}.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
TAG = rf"</?+[a-z][^\s/>]*+{REST}"
TOKEN = f"(?is){COMMENT}|{RAW}|{TAG}|[^<]++|<"
ATTRIBUTE = r"""(?is)[^\s/=>][^\s/=>]*+(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?"""
# Marks in the joined pieces of a page: an anchor, the end of its link, the end of its text.
ANCHOR, LINK_END, TEXT_END = "\x01", "\x02", "\x03"

# The named HTML entities with their semicolon, as in Python's table. The usual ones come first, as Spark
# looks a key up from the start of the map.
USUAL = ["amp", "lt", "gt", "quot", "apos", "nbsp", *name2codepoint]
ENTITIES = {f"&{name};": html5[f"{name};"] for name in [*USUAL, *(x[:-1] for x in html5 if x.endswith(";"))]}
ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# The reference's discovery parameters.
TARGET_FILES = ["turistas_no_residentes_por_residencia_aeropuerto_mendoza",
                "turistas_no_residentes_por_residencia_cristo_redentor"]
KEYWORD_SETS = [
    ["turistas", "no_residentes", "mendoza", "aeropuerto"],
    ["turistas", "no_residentes", "cristo", "redentor"],
    ["mendoza", "aeropuerto", "trimestral"],
    ["cristo_redentor", "trimestral"],
]
DATA_SUFFIX = ".csv"


def unescape(c: Column) -> Column:
    """HTML entities as a parser would decode them, once: the named ones of ``ENTITIES``, decimal and hexadecimal ones."""
    named = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))

    def char(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def decoded(e: Column) -> Column:
        return (F.when(e.rlike("^&#[xX]"), char(F.conv(F.regexp_extract(e, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10).cast("long")))
                .when(e.startswith("&#"), char(F.regexp_extract(e, "^&#([0-9]+)", 1).try_cast("long")))
                .otherwise(F.coalesce(F.try_element_at(named, e), e)))

    between, found = F.split(c, ENTITY, -1), F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0))
    whole = F.array_join(F.zip_with(between, found, lambda t, e: F.concat(t, F.coalesce(decoded(e), F.lit("")))), "")
    return F.when(c.contains("&"), whole).otherwise(c)


def _href(tag: Column) -> Column:
    """The link of an opening anchor tag as written (the last one, if it is given twice); NULL without one."""
    found = F.filter(F.regexp_extract_all(F.substr(tag, F.lit(3)), F.lit(ATTRIBUTE), F.lit(0)), lambda x: x.rlike(r"(?i)^href\s*="))
    value = F.regexp_replace(F.get(found, F.size(found) - 1), r"(?is)^href\s*=\s*", "")
    quoted = (value.startswith('"') & value.endswith('"') | value.startswith("'") & value.endswith("'")) & (F.length(value) > 1)
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _piece(token: Column) -> Column:
    """What a token adds to the joined text of a page: marks for anchors, text as it is, nothing for all else."""
    opens = token.rlike(r"(?i)^<a[\s/>]")
    return (F.when(~token.startswith("<"), F.translate(token, ANCHOR + LINK_END + TEXT_END, ""))
            .when(token == "<", token)
            .when(opens, F.coalesce(F.concat(F.lit(ANCHOR), _href(token), F.lit(LINK_END)), F.lit(TEXT_END)))
            .when(token.rlike(r"(?i)^</a[\s/>]"), F.lit(TEXT_END))
            .otherwise(F.lit("")))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """All anchors of every page: ``page_id, url, pos, href, text`` (text without tags, stripped). One pass over a page.

    Nothing is found in comments and in script, style, textarea and title
    elements, which go on to the end of the page if they are not closed. An
    anchor's text ends at its closing tag, the next anchor or the end of the page.
    """
    tokens = F.regexp_extract_all(F.col(html), F.lit(TOKEN), F.lit(0))
    joined = F.array_join(F.transform(tokens, _piece), "")
    # what is ahead of the first anchor is dropped
    z = pages.select("page_id", "url", F.posexplode(F.split(joined, ANCHOR)).alias("pos", "a")).where("pos > 0").withColumn("pos", F.col("pos") - 1)
    return z.select(
        "page_id", "url", "pos",
        unescape(F.substring_index("a", LINK_END, 1)).alias("href"),
        strip_ws(unescape(F.substring_index(F.element_at(F.split("a", LINK_END), 2), TEXT_END, 1))).alias("text"),
    )


REFERENCE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _parts(ref: Column) -> tuple[Column, ...]:
    """Scheme (lower case), authority (NULL if there is none), path, query, fragment."""
    scheme, authority, path, query, fragment = (F.regexp_extract(ref, REFERENCE, k) for k in range(1, 6))
    has = ref.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]")
    return F.lower(scheme), F.when(has, authority), path, query, fragment


def join_path(base: Column, path: Column) -> Column:
    """A relative path on a base path: a stack of segments, on which ``..`` takes one off and ``.`` stands for nothing."""
    folder = F.regexp_replace(base, "[^/]*$", "")
    whole = F.split(F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)), "/")
    # empty segments inside go; the last one says whether the result names a folder
    inner = F.filter(F.slice(whole, F.lit(2), F.size(whole) - 1), lambda x, i: (x != "") | (i == F.size(whole) - 2))
    none = F.expr("CAST(array() AS array<string>)")
    stack = F.aggregate(inner, none, lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                        .when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    last = F.element_at(whole, -1)
    closed = F.when(last.isin(".", ".."), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


def url_join(base: Column, href: Column) -> Column:
    """A reference resolved against a base URL (RFC 3986, as Python's ``urljoin`` for web addresses)."""
    href = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme, authority, path, query, fragment = _parts(href)
    b_scheme, b_authority, b_path, b_query, _ = _parts(base)
    same = (path == "") & authority.isNull()
    own = F.when(authority.isNotNull(), path).when(same, b_path).otherwise(join_path(b_path, path))
    asked = F.when(same & (query == ""), b_query).otherwise(query)
    tail = lambda mark, x: F.when(x == "", F.lit("")).otherwise(F.concat(F.lit(mark), x))
    joined = F.concat(b_scheme, F.lit("://"), F.coalesce(authority, b_authority, F.lit("")), own, tail("?", asked), tail("#", fragment))
    return F.when(href == "", base).when((scheme != "") & (scheme != b_scheme), href).otherwise(joined)


def resolve(href: Column, base: Column) -> Column:
    """Absolute link from ``href`` and the page URL; what starts with ``http`` is kept, as the reference does."""
    return F.when(href.startswith("http"), href).otherwise(url_join(base, href))


def target_links(pages: DataFrame, targets=TARGET_FILES, suffix: str = DATA_SUFFIX) -> DataFrame:
    """Per (page, target) the link whose href or text holds the target and whose href ends with ``suffix``.

    Only absolute (``http``) and root-relative (``/``) links count; when several
    match, the later one on the page wins (``max_by`` on the position).
    """
    ln = links(pages)
    kept = F.col("href").startswith("http") | F.col("href").startswith("/")
    low_h, low_t = F.lower("href"), F.lower("text")
    hits = F.filter(F.array(*[F.lit(x) for x in targets]), lambda t: low_h.contains(t) | low_t.contains(t))
    m = ln.filter(F.col("href").endswith(suffix) & kept).select("*", F.explode(hits).alias("target"))
    return m.groupBy("page_id", "target").agg(
        F.max_by(resolve(F.col("href"), F.col("url")), F.col("pos")).alias("link"),
        F.max("pos").alias("pos"),
    )


def keyword_links(pages: DataFrame, keyword_sets=KEYWORD_SETS, suffix: str = DATA_SUFFIX,
                  exclude: DataFrame | None = None) -> DataFrame:
    """Links where every keyword of a set appears in the href or the text; key ``<n>`` is the set number.

    Runs only on pages without an S8 hit when ``exclude`` (the S8 result) is
    given: a left-anti join on ``page_id``.  Later matches win.
    """
    if exclude is not None:
        pages = pages.join(exclude.select("page_id").distinct(), "page_id", "left_anti")
    ln = links(pages)
    low_h, low_t = F.lower("href"), F.lower("text")
    hits = F.array_compact(F.array(*[
        F.when(F.forall(F.array(*[F.lit(k) for k in ks]), lambda k: low_h.contains(k) | low_t.contains(k)), F.lit(i + 1))
        for i, ks in enumerate(keyword_sets)]))
    m = ln.filter(F.col("href").endswith(suffix)).select("*", F.explode(hits).alias("set_no"))
    return m.groupBy("page_id", "set_no").agg(
        F.max_by(resolve(F.col("href"), F.col("url")), F.col("pos")).alias("link"),
        F.max("pos").alias("pos"),
    )


def newest_link(pages: DataFrame, pattern: str) -> DataFrame:
    """Per page, the lexicographically last resolved link whose href matches ``pattern``; else the page URL."""
    ln = links(pages).filter(F.col("href").rlike(pattern))
    best = ln.groupBy("page_id").agg(F.max(resolve(F.col("href"), F.col("url"))).alias("found"),
                                     F.count(F.lit(1)).alias("matches"))
    return pages.select("page_id", "url").join(best, "page_id", "left").select(
        "page_id", F.coalesce("found", "url").alias("resolved_url"), F.coalesce("matches", F.lit(0)).alias("matches"),
        F.col("found").isNotNull().alias("found"))


def canonical_name(key: Column, prefix: str = "eti_mendoza") -> Column:
    """File name for a discovered key (fixed names for the two known entry points)."""
    low = F.lower(key)
    return (
        F.when(low.contains("aeropuerto"), F.lit(f"{prefix}_aeropuerto_turistas_no_residentes.csv"))
        .when(low.contains("cristo") | low.contains("redentor"), F.lit(f"{prefix}_cristo_redentor_turistas_no_residentes.csv"))
        .otherwise(F.concat(F.lit(f"{prefix}_"), key, F.lit(".csv")))
    )
