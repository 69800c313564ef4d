"""Small tables for the corpus operators' tests, and plain versions to compare with."""

import re

import duckdb

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside, as extra columns of the input.
CLASH = ("row", "file", "at", "digest", "keep", "fp", "h", "size", "key", "score", "kept", "__text", "taken", "slot")


def table(spark, tmp_path, rows, schema, name="t", parts=3):
    path = str(tmp_path / f"{name}.parquet")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def documents(spark, tmp_path, texts, sources=None, langs=None, name="docs", ids=None, extra=False):
    rows = [(k if ids is None else ids[k], t, langs[k] if langs else "en", sources[k] if sources else "s", len(t or ""))
            + (("x",) * len(CLASH) if extra else ()) for k, t in enumerate(texts)]
    schema = DOCS + "".join(f", `{c}` string" for c in CLASH if extra)
    return table(spark, tmp_path, rows, schema, name)


def twin(sql, sf, tables="documents pages conversations labels benchmark"):
    con = duckdb.connect()
    for t in tables.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), sorted(tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())


def same_as_twin(df, sql, sf):
    names, rows = twin(sql, sf)
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    assert sorted(df.columns) == names and got == sorted(rows, key=key)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
