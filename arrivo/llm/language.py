"""Language of whole texts and of spans inside them (operator 1).

A word is a run of letters; a longer run is cut after every ``WORD_LETTERS`` letters and each piece is a word, so that
scripts without blanks can change language inside a run and no word's scores outweigh all others; every letter
belongs to one word. The script of its first letter narrows the candidate languages; each candidate
gets a log-likelihood from hashed character bigrams and trigrams (word ends included); Viterbi over a
document's words, with a penalty for each switch, labels spans of one language. The document's language
is the label with most letters, its score the share of letters under that label.

Fit: ``fit_docs`` labelled documents per language (expected number, chosen by a hash) are counted into
tables of fixed size; nothing but text and label is learned from.

Edge cases: null text or text without a letter gives ``und`` and score 0, no spans; a text whose scripts no
learned language uses is judged over all learned languages; ties go to the language first by code point;
no labelled rows at all give ``und`` everywhere. A null identifier counts as not held out. Repeated rows
get equal results; extra columns pass through in ``row``; an empty table gives an empty result. Very long texts
are judged whole, in time and memory linear in their words.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from arrivo.llm.common import col, map_texts, mix64, stored, whole_row

WORD_LETTERS = 24  # longer runs of letters are cut into words of this length
LETTERS = re.compile(rf"[^\W\d_]{{1,{WORD_LETTERS}}}")  # also takes number signs that are no letters (½, ①, Ⅳ); see words_of
BUCKETS = 1 << 16

# First code points of Unicode script blocks, each up to the next entry.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"),
    (0x2E80, "han"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
]
SCRIPT_STARTS = np.array([a for a, _ in SCRIPTS], dtype=np.int64)
SCRIPT_NAMES = sorted({b for _, b in SCRIPTS})
SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(b) for _, b in SCRIPTS])


@dataclass
class Model:
    """``langs`` in code point order; ``grams`` log-probabilities [bucket, language]; ``allowed`` [script, language]."""

    langs: list[str]
    grams: np.ndarray
    allowed: np.ndarray


def _blanked(text: str, words: list[str]) -> str | None:
    """``text`` with blanks for the number signs in its ``words``, or None if these are all letters (category L)."""
    joined = "".join(words)
    if not joined or joined.isalpha():
        return None
    return text.translate({ord(c): " " for c in set(joined) if not c.isalpha()})


def words_of(text: str) -> list[str]:
    """The words of ``text``: runs of letters."""
    found = LETTERS.findall(text)
    clean = _blanked(text, found)
    return found if clean is None else LETTERS.findall(clean)


def word_matches(text: str) -> list[re.Match]:
    """``words_of`` with their places."""
    found = list(LETTERS.finditer(text))
    clean = _blanked(text, [m.group() for m in found])
    return found if clean is None else list(LETTERS.finditer(clean))


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all bigrams and trigrams of the lower-cased words, the word of each, the script of each word."""
    text = "\n" + "\n".join(words).lower() + "\n"
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    gap = cp == 10
    word = np.cumsum(gap) - 1
    script = SCRIPT_OF_RANGE[np.searchsorted(SCRIPT_STARTS, cp[1:][gap[:-1]].astype(np.int64), side="right") - 1]
    two = mix64(cp[:-1] * np.uint64(0x110000) + cp[1:])
    three = mix64((cp[:-2] * np.uint64(0x110000) + cp[1:-1]) * np.uint64(0x110000) + cp[2:] + np.uint64(1))
    inner = ~gap[1:-1]
    buckets = np.concatenate([two, three[inner]]) & np.uint64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate([word[:-1], word[1:-1][inner]]), script


def _scripts(words: list[str]) -> np.ndarray:
    """The script of each word, as ``_grams`` gives it."""
    first = np.array([ord(w[0].lower()[0]) for w in words], dtype=np.int64)
    return SCRIPT_OF_RANGE[np.searchsorted(SCRIPT_STARTS, first, side="right") - 1]


def fit(docs: DataFrame, lang: Column, text: Column, usable: Column, key: Column, fit_docs: int = 4000,
        least_share: float = 0.002) -> Model:
    """Count grams and scripts per language over about ``fit_docs`` usable rows of each.

    ``key`` only chooses the sample. A language is a candidate for a script that holds at least
    ``least_share`` of its sampled letters.
    """
    rows = docs.where(usable & lang.isNotNull() & text.isNotNull()).select(
        lang.alias("lang"), text.alias("text"), F.pmod(F.xxhash64(key, F.lit("fit")), F.lit(1 << 20)).alias("h"))
    n = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")  # small, so no text is shuffled to meet it
    sample = rows.join(n, "lang").where(F.col("h") * F.col("n") < F.lit(fit_docs << 20))

    def count(batches):
        grams, scripts = {}, {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {}
                for w in words_of(text):
                    found[w] = found.get(w, 0) + 1
                if not found:
                    continue
                times = np.fromiter(found.values(), dtype=np.float64)
                words = list(found)
                buckets, word, script = _grams(words)
                total = grams.setdefault(name, np.zeros(BUCKETS))
                total += np.bincount(buckets, weights=times[word], minlength=BUCKETS)
                letters = np.array([len(w) for w in words]) * times
                seen = scripts.setdefault(name, np.zeros(len(SCRIPT_NAMES)))
                seen += np.bincount(script, weights=letters, minlength=len(SCRIPT_NAMES))
        for kind, by in ((0, grams), (1, scripts)):
            for name, values in by.items():
                at = np.flatnonzero(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)),
                     pa.array(at.astype(np.int32)), pa.array(values[at])], names=["lang", "kind", "at", "n"])

    counts = (sample.select("lang", "text").mapInArrow(count, "lang string, kind int, at int, n double")
              .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n"))).toPandas()  # at most languages x table size
    langs = sorted(counts["lang"].unique())
    grams = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(langs)))
    lang_at = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
    for kind, table in ((0, grams), (1, scripts)):
        own = (counts["kind"] == kind).to_numpy()
        table[counts["at"].to_numpy()[own], lang_at[own]] = counts["n"].to_numpy()[own]
    logs = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS)) if langs else grams
    allowed = scripts >= np.maximum(scripts.sum(0) * least_share, 1e-9) if langs else scripts > 0
    return Model(langs, (logs / 2).astype(np.float32), allowed)


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """Log-likelihoods [word, language]; languages that do not use the word's script are far below."""
    buckets, word, script = _grams(words)
    scores = np.empty((len(words), len(model.langs)))
    for k in range(len(model.langs)):
        scores[:, k] = np.bincount(word, weights=model.grams[buckets, k], minlength=len(words))
    allowed = model.allowed[script]
    allowed |= ~allowed.any(1, keepdims=True)
    return np.where(allowed, scores, scores - 1000.0)


def viterbi(scores: np.ndarray, codes: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word. ``codes``: rows of ``scores``, documents one after the other with ``lengths`` words.

    All documents step together: step t handles the t-th word of every document that has one.
    """
    rank = np.argsort(-lengths, kind="stable")
    by_length = lengths[rank]
    steps = int(by_length[0]) if len(by_length) else 0
    active = np.searchsorted(-by_length, -np.arange(steps), side="left")  # documents with more than t words
    starts = np.concatenate([[0], np.cumsum(active)])
    place = np.empty(len(lengths), dtype=np.int64)
    place[rank] = np.arange(len(lengths))
    first = np.cumsum(lengths) - lengths
    at = np.arange(len(codes)) - np.repeat(first, lengths)
    index = starts[at] + np.repeat(place, lengths)
    code_at = np.empty(len(codes), dtype=np.int64)
    code_at[index] = codes
    jump = np.zeros((len(codes), scores.shape[1]), dtype=bool)
    best = np.zeros(len(codes), dtype=np.int16)
    label = np.empty(len(codes), dtype=np.int16)
    last = np.empty((len(lengths), scores.shape[1]))
    v = None
    for t in range(steps):
        a, n = starts[t], active[t]
        s = scores[code_at[a:a + n]]
        if t:
            p = v[:n]
            top = p.max(1)[:, None] - penalty
            jump[a:a + n] = p < top
            best[a:a + n] = p.argmax(1)
            s += np.maximum(p, top)
        v = s
        ends = active[t + 1] if t + 1 < steps else 0
        last[ends:n] = v[ends:]
    now = last[:active[0] if steps else 0].argmax(1).astype(np.int16)
    rows = np.arange(len(now))
    for t in range(steps - 1, -1, -1):
        a, n = starts[t], active[t]
        label[a:a + n] = now[:n]
        if t:
            now[:n] = np.where(jump[a + rows[:n], now[:n]], best[a:a + n], now[:n])
    return label[index]


def _labeller(model: Model, penalty: float, spans: bool, known: bool = False):
    langs = model.langs
    count = max(1, len(langs))

    def run(texts: pa.Array) -> list[pa.Array]:
        codes_of, codes, lengths, begins = defaultdict(itertools.count().__next__), [], [], []
        for text in texts.to_pylist():
            if spans:
                found = word_matches(text or "") if langs else []
                begins.extend(m.start() for m in found)
                found = [m.group() for m in found]
            else:
                found = words_of(text) if text and langs else []
            lengths.append(len(found))
            codes.extend(map(codes_of.__getitem__, found))
        lengths = np.array(lengths, dtype=np.int64)
        codes = np.array(codes, dtype=np.int64)
        words = list(codes_of)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        label = viterbi(word_scores(model, words), codes, lengths, penalty) if words else np.zeros(0, np.int16)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        letters = np.bincount(doc * count + label, weights=sizes[codes] if words else None,
                              minlength=len(lengths) * count).reshape(len(lengths), count)
        top, total = letters.argmax(1), letters.sum(1)
        names = [langs[k] if n else "und" for k, n in zip(top, total, strict=True)]
        score = np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)
        out = [pa.array(names, pa.string()), pa.array(score)]
        if spans:
            begin = np.array(begins, dtype=np.int64)
            end = begin + sizes[codes] if words else begin
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(doc))[:len(head)] - 1
            counts = np.bincount(doc[head], minlength=len(lengths))
            items = pa.StructArray.from_arrays(
                [pa.array(begin[head].astype(np.int32)), pa.array(end[tail].astype(np.int32)),
                 pa.array([langs[k] for k in label[head]], pa.string())], names=["start", "end", "lang"])
            out.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), items))
        if known:
            own = np.bincount(doc, weights=(sizes * model.allowed[_scripts(words)].any(1))[codes] if words else None,
                              minlength=len(lengths))
            out.append(pa.array(np.where(total > 0, own / np.maximum(total, 1), 0.0)))
        return out

    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 8.0,
             spans: bool = True, known: bool = False) -> DataFrame:
    """row (all columns of ``docs``), lang_pred, score and, if asked for, spans (start, end in code points, lang) and
    known (the share of letters in words whose script a learned language uses)."""
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if spans:
        item = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("lang", StringType())])
        fields.append(StructField("spans", ArrayType(item)))
    if known:
        fields.append(StructField("known", DoubleType()))
    return map_texts(docs, [whole_row(docs).alias("row")], col(text_col), lambda: _labeller(model, penalty, spans, known),
                     fields, limit=3 << 20)


def held_out(id_col: Column) -> Column:
    """True where crc32 of the identifier as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_documents(docs: DataFrame, fit_docs: int = 4000) -> Model:
    """Fit on the rows of a documents table that are not held out."""
    return fit(docs, F.col("lang"), F.col("text"), ~held_out(F.col("doc_id")), F.col("doc_id"), fit_docs)


def known_language(docs: DataFrame, fit_docs: int = 4000, least_score: float = 0.0) -> DataFrame:
    """The rows with a language (not ``und``) of at least ``least_score``, with the columns of ``docs``.

    A text with most of its letters in scripts that no learned language uses has no known language.
    """
    found = identify(docs, fit_documents(docs, fit_docs), spans=False, known=True)
    return found.where((F.col("lang_pred") != "und") & (F.col("known") >= 0.5) & (F.col("score") >= least_score)).select("row.*")
