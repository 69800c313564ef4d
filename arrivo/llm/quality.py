"""Quality rules and a calibrated n-gram classifier (operator 10).

Rules per whole text: words ``[^\\x20\\x09-\\x0D]+``, their code points, symbols, repeated lines, and words inside
3-word windows that occur twice or more. A text fails if it has fewer than ``MIN_WORDS`` words or more than
``MAX_REPEAT`` percent of repeated words.

Classifier: logistic regression on hashed word unigrams, word bigrams and character bigrams and trigrams (each
kind as shares of its occurrences), fitted on a bounded sample of labelled rows (``fit_docs`` expected per
label) in one task, calibrated by Platt's method on scores from fits that did not see the row. A text that passes the
rules is kept if its probability of good quality is at least ``threshold``.

Edge cases: null or empty text has no words and fails the rules; without labels of both kinds the probability is 1, so
the rules alone decide; conflicting or repeated labels are separate training rows; repeated rows get equal
results; extra columns are not read by name and pass through in ``row``; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from arrivo.llm.common import BLANKS, col, map_texts, mix64, stored, whole_row

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT, WINDOW = 50, 50, 3
BUCKETS = 1 << 18
SCALE = 50.0  # shares are small numbers; this only sets the step of the fit


@dataclass
class Words:
    """The words of a slice of texts: distinct words, code of each occurrence, its text, number per text."""

    known: list[bytes]
    codes: np.ndarray
    doc: np.ndarray
    counts: np.ndarray


def split(texts: list[str | None]) -> Words:
    known, codes, counts = defaultdict(itertools.count().__next__), [], []
    for text in texts:
        words = text.encode().split() if text else []  # bytes split at exactly the six blanks
        counts.append(len(words))
        codes.extend(map(known.__getitem__, words))
    counts = np.array(counts, dtype=np.int64)
    return Words(list(known), np.array(codes, dtype=np.int64), np.repeat(np.arange(len(counts)), counts), counts)


def repeated_words(w: Words) -> np.ndarray:
    """Per text, words inside windows of three words that occur twice or more in it."""
    n = len(w.codes)
    at = np.flatnonzero(w.doc[:-2] == w.doc[2:]) if n > 2 else np.zeros(0, np.int64)
    if not len(at):
        return np.zeros(len(w.counts), dtype=np.int64)
    if len(w.known) < 1 << 21:
        key = w.codes[at] << 42 | w.codes[at + 1] << 21 | w.codes[at + 2]
    else:
        pair = np.unique(w.codes[at] << 32 | w.codes[at + 1], return_inverse=True)[1]
        key = pair << 32 | w.codes[at + 2]
    window = np.unique(key, return_inverse=True)[1]
    own = w.doc[at] << 32 | window
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(WINDOW):
        covered[at[twice] + k] = True
    return np.bincount(w.doc[covered], minlength=len(w.counts))


def repeated_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def rules(texts: list[str | None], w: Words) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    chars = [len(t) - sum(t.count(c) for c in BLANKS) if t else 0 for t in texts]
    symbols = [sum(t.count(c) for c in SYMBOLS) if t else 0 for t in texts]
    lines = [repeated_lines(t) for t in texts]
    return [w.counts, *(np.array(x, dtype=np.int64) for x in (chars, symbols, lines)), repeated_words(w)]


def _grams(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each distinct word; bucket and word of each of their character bigrams and trigrams."""
    from xxhash import xxh64_intdigest

    hashes = np.fromiter((xxh64_intdigest(x) for x in w.known), dtype=np.uint64, count=len(w.known))
    cp = np.frombuffer((b"\n" + b"\n".join(w.known) + b"\n").decode().encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    gap = cp == 10
    word = np.cumsum(gap) - 1
    two = mix64(cp[:-1] * np.uint64(0x110000) + cp[1:] + np.uint64(2))
    three = mix64((cp[:-2] * np.uint64(0x110000) + cp[1:-1]) * np.uint64(0x110000) + cp[2:] + np.uint64(3))
    inner = ~gap[1:-1]
    buckets = np.concatenate([two, three[inner]]) & np.uint64(BUCKETS - 1)
    return hashes, buckets.astype(np.int64), np.concatenate([word[:-1], word[1:-1][inner]])


def _pairs(w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each word bigram; a word after itself is one feature, whatever the word."""
    at = np.flatnonzero(w.doc[:-1] == w.doc[1:]) if len(w.doc) > 1 else np.zeros(0, np.int64)
    own = hashes[w.codes]
    bucket = (mix64(own[at] * np.uint64(3) + own[at + 1]) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.where(w.codes[at] == w.codes[at + 1], 0, bucket), w.doc[at]


def _per(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    return SCALE * total / np.maximum(count, 1)


def scores(weights: np.ndarray, w: Words) -> np.ndarray:
    """Linear score of each text: the sums of the weights of its n-grams, as means by kind."""
    n = len(w.counts)
    if not len(w.codes):
        return np.zeros(n)
    hashes, buckets, word = _grams(w)
    one = weights[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)]
    chars = np.bincount(word, weights=weights[buckets], minlength=len(one))
    per_word = np.bincount(word, minlength=len(one))
    pair, pair_doc = _pairs(w, hashes)
    total = lambda x: np.bincount(w.doc, weights=x[w.codes], minlength=n)
    return (_per(total(one), w.counts) + _per(total(chars), total(per_word))
            + _per(np.bincount(pair_doc, weights=weights[pair], minlength=n), np.bincount(pair_doc, minlength=n)))


def _matrix(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same features as a sparse matrix: text, bucket, value."""
    hashes, buckets, word = _grams(w)
    order = np.argsort(word, kind="stable")
    buckets, size = buckets[order], np.bincount(word, minlength=len(w.known))
    first = np.cumsum(size) - size
    times = size[w.codes]
    total = np.cumsum(times)
    flat = np.arange(int(total[-1])) + np.repeat(first[w.codes] - (total - times), times)
    pair, pair_doc = _pairs(w, hashes)
    n = len(w.counts)
    out = []
    for doc, at in ((w.doc, (hashes[w.codes] & np.uint64(BUCKETS - 1)).astype(np.int64)), (pair_doc, pair),
                    (np.repeat(w.doc, times), buckets[flat])):
        key, count = np.unique(doc * BUCKETS + at, return_counts=True)
        row = key // BUCKETS
        out.append((row, key % BUCKETS, SCALE * count / np.maximum(np.bincount(doc, minlength=n), 1)[row]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _descend(matrix, good: np.ndarray, seen: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Scores of all rows and, at the end, weights and bias, by full-batch gradient steps (Adam) on the seen rows."""
    row, bucket, value = matrix
    n = len(good)
    balance = np.where(good, 0.5 / max(1, (good & seen).sum()), 0.5 / max(1, (~good & seen).sum())) * seen
    weights = np.zeros(BUCKETS + 1)  # the last is the bias
    slow, fast = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=value * weights[bucket], minlength=n) + weights[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good) * balance
        grad = np.append(np.bincount(bucket, weights=value * miss[row], minlength=BUCKETS) + 1e-4 * weights[:-1], miss.sum())
        slow, fast = 0.9 * slow + 0.1 * grad, 0.99 * fast + 0.01 * grad * grad
        weights -= rate * (slow / (1 - 0.9**t)) / (np.sqrt(fast / (1 - 0.99**t)) + 1e-6)
    return np.bincount(row, weights=value * weights[bucket], minlength=n) + weights[-1], weights


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the probability of y, by Newton steps; targets drawn in by the class sizes."""
    goal = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    a, b = 1.0 / max(1.0, float(np.abs(x).max())), 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        h = p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 1e-6, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, [((p - goal) * x).sum(), (p - goal).sum()])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -5, 5)
    return a, b


def _fit(texts: list[str], good: np.ndarray, folds: int = 3, steps: int = 60, rate: float = 0.1) -> tuple[np.ndarray, float, float]:
    """Weights fitted on all rows; calibration on the scores that each row gets from a fit without its fold."""
    parts, base = [], 0
    for at in range(0, len(texts), 64):
        chunk = split(texts[at:at + 64])
        if len(chunk.codes):
            row, bucket, value = _matrix(chunk)
            parts.append((row + base, bucket, value.astype(np.float32)))
        base += len(chunk.counts)
    matrix = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    fold = np.arange(len(texts)) % folds
    unseen = np.zeros(len(texts))
    for k in range(folds):
        unseen[fold == k] = _descend(matrix, good, fold != k, steps, rate)[0][fold == k]
    slope, shift = _platt(unseen, good)
    weights = _descend(matrix, good, np.ones(len(texts), dtype=bool), steps, rate)[1]
    return weights[:-1], slope, slope * weights[-1] + shift


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = 1500) -> tuple[np.ndarray, float, float] | None:
    """(weights, slope, intercept) from about ``fit_docs`` labelled rows of each quality, or None without both kinds."""
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)))
    n = known.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    chosen = known.join(n, "quality").where(F.col("h") * F.col("n") < F.lit(fit_docs << 20)).select("doc_id", "quality", "h")
    chosen = stored(chosen, "labelled-sample")  # a bounded table of known size, so no text is shuffled to meet it
    rows = docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id").select("h", "doc_id", "quality", "text")

    def train(batches):
        found = sorted(x for batch in batches for x in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
        good = np.array([x[2] == 1 for x in found], dtype=bool)
        texts = [x[3] for x in found]
        if good.any() and not good.all() and any(t.split() for t in texts):
            weights, slope, shift = _fit(texts, good)
            yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()]), pa.array([slope]), pa.array([shift])],
                                             names=["weights", "slope", "shift"])

    got = rows.repartition(1).mapInArrow(train, "weights binary, slope double, shift double").collect()  # one row, 1 MB
    return (np.frombuffer(got[0][0], dtype="<f4").astype(np.float64), got[0][1], got[0][2]) if got else None


def judge(docs: DataFrame, model: tuple[np.ndarray, float, float] | None, text_col: str = "text", threshold: float = 0.5,
          keep: list[Column] | None = None) -> DataFrame:
    """``keep`` (default: row), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability."""

    def run(texts: pa.Array) -> list[pa.Array]:
        texts = texts.to_pylist()
        w = split(texts)
        counts = rules(texts, w)
        failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEAT * counts[0])
        if model is None:
            p = np.ones(len(texts))
        else:
            weights, slope, shift = model
            p = 1 / (1 + np.exp(-np.clip(slope * scores(weights, w) + shift, -500, 500)))
        return [*(pa.array(x.astype(np.int64)) for x in counts), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)]

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [*(StructField(x, LongType()) for x in names), StructField("base_failed", BooleanType()),
              StructField("kept", BooleanType()), StructField("probability", DoubleType())]
    keep = [whole_row(docs).alias("row")] if keep is None else keep
    return map_texts(docs, keep, col(text_col), lambda: run, fields)
