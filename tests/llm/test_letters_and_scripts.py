"""Words are letters only, and the pipeline's language stage knows scripts."""

import sys
import zlib

from helpers import documents
from pyspark.sql import functions as F

from arrivo.llm import language

EN = "the cat sat on the mat and looked at the dog "
FR = "le chat est sur la table et regarde les oiseaux dans le jardin "


def test_words_hold_letters_only():
    every = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum())
    assert "".join(language.words_of(every)) == "".join(c for c in every if c.isalpha())
    text = "abc² ½ ①Ⅳ été⁵x 12 \u4e00"
    assert language.words_of(text) == ["abc", "été", "x", "\u4e00"]
    assert [(m.group(), text[m.start():m.end()]) for m in language.word_matches(text)] == [(w, w) for w in language.words_of(text)]


def test_number_signs_are_no_language(spark, tmp_path):
    train = documents(spark, tmp_path, [EN * 5, FR * 5] * 8, langs=["en", "fr"] * 8, name="train")
    model = language.fit(train, F.col("lang"), F.col("text"), F.lit(True), F.col("doc_id"))
    t = ["² ½ ① Ⅳ", "12 ²³!", EN + "²" * 500 + " " + "½ " * 500, EN]
    rows = {r.row.doc_id: r for r in language.identify(documents(spark, tmp_path, t), model).collect()}
    assert [(rows[k].lang_pred, rows[k].score, rows[k].spans) for k in (0, 1)] == [("und", 0.0, [])] * 2
    assert (rows[2].lang_pred, rows[2].score) == (rows[3].lang_pred, rows[3].score) == ("en", 1.0)
    short = language.identify(documents(spark, tmp_path, t, name="short"), model, spans=False).collect()
    assert {r.row.doc_id: (r.lang_pred, r.score) for r in short} == {k: (r.lang_pred, r.score) for k, r in rows.items()}
    docs = documents(spark, tmp_path, [EN * 5, FR * 5] * 8 + t[:2], langs=["en", "fr"] * 8 + ["en"] * 2, name="stage")
    assert sorted(r.doc_id for r in language.known_language(docs).collect()) == list(range(16))


def test_stage_rejects_texts_in_unlearned_scripts(spark, tmp_path):
    han, kana, greek = "猫は" * 40, "ねこ " * 40, "γάτα " * 40
    t = [EN * 5, FR * 5] * 200 + [han, kana, greek, EN + "字" * 5, han + "cat", "字 cat"]
    docs = documents(spark, tmp_path, t, langs=["en", "fr"] * 200 + ["zh", "ja", "el", "en", "zh", "en"], name="scripts",
                     ids=[*range(400), *(i for i in range(400, 1000) if zlib.crc32(str(i).encode()) % 4 == 2)][:406])
    held = sorted(r.doc_id for r in docs.collect())[400:]  # not learned from, so zh, ja and el are no learned languages
    assert language.fit_documents(docs).langs == ["en", "fr"]
    kept = language.known_language(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(400), held[3], held[5]]


def test_scripts_of_words_are_those_of_the_grams():
    words = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    assert (language._scripts(words) == language._grams(words)[2]).all()
