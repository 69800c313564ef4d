"""Ranked lexical search by dense blocked matrix products (operator 13).

The items are taken in blocks of bounded size. For a block, every document is read once and reduced to the
counts of the block's terms (a thin table in the shared folder), and document counts and lengths are summed
over all documents. Then tiles of items, each with its compact vocabulary, are multiplied with tiles of
documents: weights (items x terms) times impacts (terms x documents), in float64 by BLAS. A tile's terms are
cut into slices whose sums stay below 2^53 for any document, so every product is an exact integer, whatever
the order of additions; slices are added as 64-bit integers. Each task keeps the best rows of every item over
its tiles by (score, doc_id), so ties at the last rank are settled right, and two rounds of ranking join the tasks.

The block's weights are sent to the tasks: at most ``block_bytes`` of item text, whatever the tables' sizes
(a longer item comes alone, and its distinct terms are what is sent).

Edge cases: null texts have no terms. Rows that repeat an item_id are one item with the terms of all of them;
a null item_id is an item too. Every row of the documents is a document: rows that repeat a doc_id are ranked
each; a null doc_id comes last among equal scores. A document's length does not matter: texts are split whole, a
very long one in its own Arrow slice. Without a document (or an item) with terms the result is empty. Extra
columns are not read. Identifiers are cast to long; other values raise Spark's cast error.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField

from arrivo.llm.common import col, map_texts, stored

#: Fixed value: bytes of a term (digits, letters, all of code points above 127) as themselves, A-Z as a-z, others blank.
TERM_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
EXACT = float(1 << 53)
#: The largest impact of a term: (10^9 * tf) div (1000 * tf + 8 * m) with m of 0 at least.
TOP_IMPACT = 1_000_000
TILE_ITEMS, TILE_DOCS, TILE_TERMS = 64, 1024, 4096
NO_ID = np.iinfo(np.int64).max
FOUND = "item bigint, doc_id bigint, score bigint"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode().translate(TERM_BYTES).split()


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items with their term counts, in blocks; the driver holds one block and one partition of item rows."""
    rows = items.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).orderBy("id")
    block, size, last = [], 0, ...
    for row in rows.toLocalIterator():
        counts = Counter(terms(row.text))
        if row.id == last and block:
            block[-1][1].update(counts)
        else:
            if size >= block_bytes:
                yield block
                block, size = [], 0
            block.append((row.id, counts))
        last = row.id
        size += len(row.text or "") + 8
    if block:
        yield block


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Thin rows of all documents: id, n (terms with repeats), terms and tfs (of the vocabulary, by number)."""
    def start():
        known = vocabulary.get

        def run(texts: pa.Array) -> list:
            n, ends, found, times = [], [0], [], []
            for text in texts.to_pylist():
                own = terms(text)
                n.append(len(own))
                counts = Counter(map(known, own))
                counts.pop(None, None)
                found.extend(counts)
                times.extend(counts.values())
                ends.append(len(found))
            ends = pa.array(ends, pa.int32())
            return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))]

        return run

    return map_texts(docs, [col(id_col).cast("long").alias("id")], col(text_col), start,
                     [StructField("n", LongType()), StructField("terms", ArrayType(IntegerType())), StructField("tfs", ArrayType(LongType()))])


def weight(total: int, holding: int) -> int:
    """A term's weight, from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


def slices(weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut items x terms into (columns, weights) so that no row of a slice can sum to 2^53 with the largest impacts.

    Columns are taken in order while every row has room; a weight that exceeds a whole slice goes on in the next one.
    """
    left, room = weights.astype(np.float64), math.floor(EXACT / TOP_IMPACT) - 1.0
    while (used := np.flatnonzero(left.any(0))).size:
        part = left[:, used][:, :TILE_TERMS]
        fits = np.flatnonzero((part.cumsum(1) <= room).all(0))
        take = max(1, len(fits))  # cumulative sums only grow: a prefix of the columns fits
        own = np.minimum(part[:, :take], room)
        yield used[:take], own
        left[:, used[:take]] -= own


class Tile:
    """Up to 64 items: their compact vocabulary, their weights in slices, and their best documents so far."""

    def __init__(self, first: int, rows: list[dict[int, int]], vocabulary: int, top: int):
        self.first, self.top = first, top
        own = sorted(set().union(*rows))
        self.place = np.full(vocabulary, -1, dtype=np.int32)
        self.place[own] = np.arange(len(own))
        weights = np.zeros((len(rows), len(own)))
        for r, row in enumerate(rows):
            for term, w in row.items():
                weights[r, self.place[term]] = w
        self.terms, self.parts = len(own), list(slices(weights))
        self.score = np.zeros((len(rows), 0), dtype=np.int64)
        self.id = np.zeros((len(rows), 0), dtype=np.int64)

    def add(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, ids: np.ndarray) -> None:
        """A tile of documents: entries (document's place, term, impact) and the documents' identifiers."""
        at = self.place[term]
        mine = at >= 0
        if not mine.any():
            return
        dense = np.zeros((self.terms, len(ids)))
        dense[at[mine], doc[mine]] = impact[mine]
        sums = np.zeros((len(self.score), len(ids)), dtype=np.int64)
        for columns, weights in self.parts:
            sums += (weights @ dense[columns]).astype(np.int64)
        score = np.concatenate([self.score, sums], axis=1)
        every = np.concatenate([self.id, np.broadcast_to(ids, sums.shape)], axis=1)
        if score.shape[1] > self.top:
            least = -np.partition(-score, self.top - 1, axis=1)[:, self.top - 1:self.top]  # the last rank's score, ties beside it
            keep = [self._best(s, i, bound) for s, i, bound in zip(score, every, least[:, 0], strict=True)]
            score, every = (np.stack([x[k] for x, k in zip(m, keep, strict=True)]) for m in (score, every))
        self.score, self.id = score, every

    def _best(self, score: np.ndarray, ids: np.ndarray, bound: int) -> np.ndarray:
        at = np.flatnonzero(score > bound)
        ties = np.flatnonzero(score == bound)
        if len(at) + len(ties) > self.top:
            ties = ties[np.argsort(ids[ties], kind="stable")[:self.top - len(at)]]
        return np.concatenate([at, ties])

    def found(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.score > 0)
        ids = self.id[row, place]
        return pa.RecordBatch.from_arrays([pa.array(self.first + row), pa.array(ids, mask=ids == NO_ID), pa.array(self.score[row, place])],
                                          names=["item", "doc_id", "score"])


def _impacts(n: np.ndarray, tf: np.ndarray, total: int, length: int) -> np.ndarray:
    """Of terms that occur ``tf`` times in documents of ``n`` terms; integers, divisions round down."""
    m = 100 - 75 + (75 * n * total) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _block(docs: DataFrame, block: list[tuple[int | None, Counter]], id_col: str, text_col: str, top: int) -> DataFrame | None:
    names = sorted(set().union(*(c for _, c in block)))
    vocabulary = {t: k for k, t in enumerate(names)}
    if not names:
        return None
    thin = stored(term_counts(docs, vocabulary, id_col, text_col), "term-counts")
    total, length = thin.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not total:
        return None
    holding = dict(thin.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # the block's terms at most
    weights = [weight(total, holding.get(k, 0)) for k in range(len(names))]
    rows = [{vocabulary[t]: times * weights[vocabulary[t]] for t, times in counts.items()} for _, counts in block]

    def run(batches):
        tiles = [Tile(k, rows[k:k + TILE_ITEMS], len(names), top) for k in range(0, len(rows), TILE_ITEMS)]
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                ids = part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                own = part.column(2)
                sizes = np.diff(own.offsets.to_numpy())
                doc = np.repeat(np.arange(len(ids)), sizes)
                n = part.column(1).to_numpy()[doc]
                impact = _impacts(n, part.column(3).flatten().to_numpy(), total, length).astype(np.float64)
                term = own.flatten().to_numpy()
                for tile in tiles:
                    tile.add(doc, term, impact, ids)
        for tile in tiles:
            yield tile.found()

    found = thin.where("n > 0").mapInArrow(run, FOUND)
    # the tasks' best rows meet in groups first, so that the last ranking reads a bounded number from each group
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    groups = found.withColumn("group", F.spark_partition_id() % 256)
    near = groups.withColumn("r", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))).where(F.col("r") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    ids = docs.sparkSession.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "item bigint, item_id bigint")
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # a block's items: bounded


def search(docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``top`` documents with a score above 0.

    Every block of items makes one pass over all documents; with more than one block the blocks' results are
    written to the shared folder.
    """
    results = []
    for block in item_blocks(items, item_id, item_text, block_bytes):
        if (found := _block(docs, block, doc_id, doc_text, top)) is not None:
            results.append(found)
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = results[0] if len(results) == 1 else stored(results[0], "search")
    for more in results[1:]:
        out = out.unionByName(stored(more, "search"))
    return out
