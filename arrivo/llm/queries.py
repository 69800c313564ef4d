"""Driver queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm import chat, exact_dedup, language, mixing, pieces, quality, search, sharding, simhash, suffix_index, tokens, trie, urls

QUERIES: dict = {}
ORACLE: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary_file(name: str) -> str:
    """Place of a public tokenizer file; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all documents, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit_documents(docs), spans=False)
    doc_id = F.col("row.doc_id")
    return found.select(doc_id.alias("doc_id"), language.held_out(doc_id).alias("held_out"), "lang_pred", "score")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents, 40 shards."""
    rows = sharding.shard(_table(spark, sf_dir, "documents"), shards=40, keep=[])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


# Fixed values of the query: (host, path, allowed).
URL_RULES = [("net", "/", False), ("example.net", "/en/", True), ("example.com", "/de/", False), ("org", "/fr/", True)]


@query
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all pages, with the four rules of the query."""
    return urls.judge(_table(spark, sf_dir, "pages"), [urls.Rule(*r) for r in URL_RULES], keep=[F.col("page_id")])


def _urls_twin() -> str:
    alone = lambda terms: f"(^|[^a-z0-9])({'|'.join(terms)})($|[^a-z0-9])"
    rules = ", ".join(f"('{h}', '{p}', '{'allow' if a else 'block'}')" for h, p, a in URL_RULES)
    soft = " + ".join(f"CAST(regexp_matches(url, '{alone([t])}') AS INT)" for t in urls.SOFT)
    down = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    return f"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
u AS (SELECT page_id, {down.format("coalesce(url, '')")} AS url, {rest.replace("url", "coalesce(url, '')")} AS rest FROM pages),
p AS (SELECT page_id, url, {down.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
      FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN regexp_matches(url, '{alone(urls.STRICT)}') OR {soft} >= 2
       THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f USING (page_id)
"""


ORACLE["op3_urls"] = _urls_twin()


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).drop("row")


_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op4_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256({_NORM}) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY {_NORM})
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), width=3, max_bits=2).select("doc_id", "fingerprint", "component_id")


@query
def op6_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents: sampled pieces, and whether they decode to the text."""
    vocabulary = pieces.load(_vocabulary_file("piece_bpe_32k.model"))
    return pieces.encode(_table(spark, sf_dir, "documents"), vocabulary, keep=[F.col("doc_id")])


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents: digests read back from the written files."""
    return tokens.token_files(_table(spark, sf_dir, "documents"), _vocabulary_file("byte_bpe_50k.json"))


#: Fixed value of the query: what both turns of the made conversation say.
SAID = "</s>[INST] ok [/INST]"


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all conversations and one made conversation, read back from the formatted table."""
    made = spark.createDataFrame([(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)], "conv_id bigint, turn bigint, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(made)
    return chat.chat_digests(rows)


# The twin counts the formatted text by its parts: the opening, and per turn the mark, the role, two line breaks around
# the text, a backslash per control string, and the end. Roles are plain names in this table.
_IN_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text"
ORACLE["op8_chat"] = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{SAID}'), (-1, 1, 'assistant', '{SAID}')) made(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' {_IN_ORDER})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' {_IN_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST({len(chat.BEGIN)} + sum({len(chat.TURN) + 1 + len(chat.TAIL)} + length(role) + length(text)
            + len(regexp_extract_all(text, '{chat.ANY_RE2}'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents: sources weigh 5, 2, 1, repeating, and share 150% of all words."""
    return mixing.taken_words(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all documents, fitted on a sample of the labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, keep=[F.col("doc_id")])


ORACLE["op9_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
filled AS (
  SELECT *, 2 * source_size AS cap,
         sum(2 * source_size) OVER o - 2 * source_size AS cap_before, sum(w) OVER () - (sum(w) OVER o - w) AS w_left
  FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
budget AS (SELECT 1.5::DOUBLE * sum(size) AS b FROM d),
level AS (
  SELECT max((b - cap_before) / w_left) AS rate FROM filled, budget),
t AS (
  SELECT source, source_size, CASE WHEN w * rate > cap THEN CAST(cap AS DOUBLE) ELSE w * rate END AS target FROM filled, level),
q AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS done
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
queued AS (
  SELECT *, (done + copy * source_size) / target AS finish FROM q, (SELECT unnest([0, 1]) AS copy) WHERE target > 0),
taken AS (
  SELECT doc_id, sum(size) AS taken
  FROM (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, h, doc_id, copy ROWS UNBOUNDED PRECEDING) AS until
        FROM queued), (SELECT sum(target) AS all_targets FROM t)
  WHERE until <= all_targets GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(taken.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN taken USING (doc_id)
"""


@query
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over all documents: bytes of repeated passages of 100 bytes go, the first of each stays."""
    return suffix_index.remove_repeats(_table(spark, sf_dir, "documents"), length=100, texts=False)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations of operator 12's query and their identifiers: the first h turns of conversation c - c % 5, then
    c's own turns after its first h."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), *[F.coalesce(c, F.lit("")) for c in ("role", "text")])
    placed = turns.select("conv_id", F.row_number().over(order).alias("pos"), "role", "text")
    h = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % 9
    ids = turns.select("conv_id").distinct()
    own = placed.where(F.col("pos") > h).select("conv_id", F.lit(1).alias("part"), "pos", "role", "text")
    source = ids.select(F.col("conv_id").alias("to"), (F.col("conv_id") - F.col("conv_id") % 5).alias("conv_id"), h.alias("h"))
    first = (placed.where("pos <= 8").join(source, "conv_id").where("pos <= h")
             .select(F.col("to").alias("conv_id"), F.lit(0).alias("part"), "pos", "role", "text"))
    return first.unionByName(own), ids


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all conversations, rebuilt on shared first turns."""
    turns, ids = rebuilt(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return trie.prefix_trie(turns, ids, order=("part", "pos")).withColumnRenamed("saved", "saved_tokens")


# The twin lists every prefix of every conversation. CRC-32 is taken bit by bit (its polynomial is a fixed value).
ORACLE["op12_prefix_trie"] = """
WITH RECURSIVE crc AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, s, i + 1, xor(x >> 1, 3988292384 * (x & 1))
  FROM (SELECT conv_id, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, CAST(i // 8 + 1 AS BIGINT), 1)) AS BIGINT)) ELSE v END AS x
        FROM crc WHERE i < 8 * length(s))),
ids AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = 8 * length(s)),
placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations),
turns AS (
  SELECT ids.conv_id, 0 AS part, pos, role, text FROM ids JOIN placed ON placed.conv_id = ids.conv_id - ids.conv_id % 5 WHERE pos <= h
  UNION ALL
  SELECT conv_id, 1, pos, role, text FROM placed JOIN ids USING (conv_id) WHERE pos > h),
prefixes AS (
  SELECT conv_id, strlen(text) AS bytes, row_number() OVER w AS depth,
         md5(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '') OVER w) AS key
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
rows AS (
  SELECT conv_id, depth, key, bytes, lag(key, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         lead(key) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ended FROM prefixes
  UNION ALL
  SELECT ids.conv_id, 0, '', 0, NULL, max(depth) IS NULL FROM ids LEFT JOIN prefixes USING (conv_id) GROUP BY ids.conv_id),
nodes AS (
  SELECT key, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM rows GROUP BY key, depth),
children AS (SELECT parent AS key, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.key, count(*) FILTER (children.n IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.bytes) AS saved
  FROM nodes d LEFT JOIN children USING (key) JOIN rows a ON a.conv_id = d.conv_id AND a.depth <= d.depth GROUP BY a.key)
SELECT nodes.conv_id, nodes.depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes LEFT JOIN nodes up ON nodes.parent = up.key LEFT JOIN children ON nodes.key = children.key JOIN below ON nodes.key = below.key
"""


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: the ten best of all documents for each benchmark item."""
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(_NORM)
ORACLE["op13_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
sizes AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0),
tf AS (SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, sizes GROUP BY term, docs),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term), sizes GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
