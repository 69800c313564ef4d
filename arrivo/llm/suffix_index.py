"""Repeated passages by a logarithmic family of suffix arrays (operator 11).

A byte is removed if a string of ``length`` bytes around it also starts earlier: in a document with a smaller
identifier, or further ahead in the same one. Texts come in batches of ascending identifiers. A batch gets its
suffix array; it is merge-scanned against the arrays of the levels kept so far, and then merged with the levels of
its own size, as in binary counting: n batches leave at most log2(n) + 1 levels.

The arrays are sparse. Each window of ``length`` bytes is governed by one of the seeds of 32 bytes in it, the one of
least hash (leftmost among equals), so equal windows are governed by equal seeds at equal places. Only the suffixes that
start at a governing seed are in the array, about one in 31 bytes. They are ordered by the hash of their seed (it
deals evenly over tasks, and equal beginnings are neighbours as in any suffix order) and then by the hash of their
span, which is the text of all windows that the seed governs. An array is cut into buckets by range of the order, one row
each. What a scan finds:

* equal spans: all but the earliest are repeated whole;
* one seed in different spans, of which some windows may still be equal: the earliest of each span is a candidate. The
  texts of the candidates' spans are fetched, and their windows are compared one by one.

Seeds and spans are matched by 64 bits each (together, and for windows again, 128 bits).

Hot groups: a task sends each distinct span once, and at most 64 distinct spans of one seed to the seed's bucket. From 64
on a seed is hot: its candidates' windows are dealt by their own hashes, each window once per task, instead of
meeting by seed. So no seed, passage or copied document gathers in one task, and nothing is dropped.

Edge cases: null text is empty. Identifiers that are unique long values are used as they are; with repeated, null or other
identifiers the rows are numbered in the order of (identifier, null first; place in the files). Texts shorter than
``length`` have no window. Very long texts are cut into pieces of 256 kB for the hashing only, windows across the
cuts included. Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import col, located, mix64, shared_path, stored

SEED = 32
#: Distinct spans of one seed from which the seed is hot.
HOT = 64
#: Text that a task turns into one piece of an array, text per bucket, and positions that are hashed at a time.
FLUSH_BYTES, BUCKET_BYTES, PIECE = 16 << 20, 32 << 20, 1 << 18
#: Least number of buckets.
BUCKETS = 64
BASE = 0x9E3779B97F4A7C15
MASK = np.uint64((1 << 20) - 1)  # places in a piece
#: An array: seed and span hashes, document, place of the seed, and how far before it the first and last window begin.
COLUMNS = (("seed", "u8"), ("span", "u8"), ("doc", "i8"), ("pos", "u4"), ("first", "u1"), ("last", "u1"))
ROW = "side string, bucket int, blob binary, seed bigint, doc bigint, a int, b int, hot boolean"
ARROW = pa.schema([("side", pa.string()), ("bucket", pa.int32()), ("blob", pa.binary()), ("seed", pa.int64()), ("doc", pa.int64()),
                   ("a", pa.int32()), ("b", pa.int32()), ("hot", pa.bool_())])
#: Random values of the 256 bytes.
BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))

Array = dict[str, np.ndarray]


def grams(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Polynomial hashes (modulo 2^64) of all substrings of each length, by doubling."""
    now, size = BYTE[data], 1
    out: list = [None] * len(lengths)
    have = [0] * len(lengths)
    times = lambda n: np.uint64(pow(BASE, n, 1 << 64))
    while True:
        for k, n in enumerate(lengths):
            if n & size:
                total = have[k] + size
                count = max(len(data) - total + 1, 0)
                out[k] = now[:count] if out[k] is None else out[k][:count] * times(size) + now[have[k]:have[k] + count]
                have[k] = total
        if size * 2 > max(lengths):
            return out
        count = max(len(data) - 2 * size + 1, 0)
        now = now[:count] * times(size) + now[size:size + count]
        size *= 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    count, size = len(x) - width + 1, 1
    while size * 2 <= width:
        x = np.minimum(x[:len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[:count], x[width - size:width - size + count])


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> Array:
    """The governing seeds of texts that lie one after the other in ``data``; ``doc`` is the text's number."""
    outside = np.maximum(starts, ends - length + 1)  # from here to the text's end no window begins
    found: list[list[np.ndarray]] = [[] for _ in range(5)]
    for at in range(0, len(data), PIECE):
        part = data[at:at + PIECE + length - 1]
        n = len(part) - length + 1
        if n <= 0:
            break
        near = slice(np.searchsorted(ends, at, side="right"), np.searchsorted(starts, at + n))
        step = np.zeros(n + 1, dtype=np.int32)
        np.add.at(step, np.clip(outside[near] - at, 0, n), 1)
        np.add.at(step, np.clip(ends[near] - at, 0, n), -1)
        ok = np.cumsum(step[:-1], dtype=np.int32) == 0  # where a window begins that ends inside its text
        if not ok.any():
            continue
        by_seed, by_window = grams(part, SEED, length)
        by_seed = mix64(by_seed)
        order = (by_seed & ~MASK) | np.arange(len(by_seed), dtype=np.uint64)
        seed = (sliding_min(order, length - SEED + 1) & MASK).astype(np.int64)
        cut = (seed[1:] != seed[:-1]) | ~ok[1:] | ~ok[:-1]
        first = np.flatnonzero(ok & np.append(True, cut))
        last = np.flatnonzero(ok & np.append(cut, True))
        own = seed[first]
        # the first and the last window overlap: with their distance they determine the span
        shape = ((last - first) * 1009 + (own - first)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        # the least hashes were chosen: mixed anew, they deal evenly over the buckets
        for k, x in enumerate((mix64(by_seed[own] ^ np.uint64(BASE)), mix64(by_window[first] * np.uint64(0xA0761D6478BD642F) + mix64(by_window[last] + shape)),
                               own + at, own - first, own - last)):
            found[k].append(x)
    seed, span, place, first, last = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    doc = np.searchsorted(starts, place, side="right") - 1
    return {"seed": seed.astype("u8"), "span": span.astype("u8"), "doc": doc, "pos": (place - starts[doc]).astype("u4"),
            "first": first.astype("u1"), "last": last.astype("u1")}


def take(x: Array, at: np.ndarray) -> Array:
    return {k: v[at] for k, v in x.items()}


def joined(parts: list[Array]) -> Array:
    return {k: np.concatenate([np.zeros(0, t), *(p[k] for p in parts)]).astype(t, copy=False) for k, t in COLUMNS}


def pack(x: Array) -> bytes:
    """A sorted array as compressed byte planes; seeds as differences."""
    body = b""
    for k, t in COLUMNS:
        v = np.diff(x[k], prepend=x[k].dtype.type(0)) if k == "seed" else x[k]
        body += np.ascontiguousarray(v.astype(f"<{t}").view(np.uint8).reshape(len(v), int(t[1])).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> Array:
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, at, out = len(body) // sum(int(t[1]) for _, t in COLUMNS), 0, {}
    for k, t in COLUMNS:
        size = int(t[1])
        out[k] = np.ascontiguousarray(body[at:at + n * size].reshape(size, n).T).view(f"<{t}").reshape(n)
        at += n * size
    out["seed"] = np.cumsum(out["seed"], dtype=np.uint64)
    return out


def heads(*keys: np.ndarray) -> np.ndarray:
    """Of sorted rows: which differ from the row before in any key."""
    out = np.zeros(len(keys[0]), dtype=bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _rows(side: str, n: int, **columns) -> pa.RecordBatch:
    put = lambda f: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
    return pa.RecordBatch.from_arrays([pa.array([side] * n) if f.name == "side" else put(f) for f in ARROW], schema=ARROW)


def _repeated(x: Array, length: int, buckets: int) -> pa.RecordBatch:
    """Spans as intervals of bytes; those that go on in each other become one."""
    a, b = x["pos"].astype(np.int64) - x["first"], x["pos"].astype(np.int64) - x["last"] + length
    doc, a, b = merged(x["doc"], a, b)
    return _rows("repeated", len(a), bucket=doc % buckets, doc=doc, a=a, b=b)


def merged(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals [a, b) of documents in order, overlapping and touching ones as one."""
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    if not len(doc):
        return doc, a, b
    new = heads(doc)
    group = np.cumsum(new) - 1
    far = int(b.max()) + 1
    top = np.maximum.accumulate(b + group * far) - group * far  # furthest end in the document so far
    start = new.copy()
    start[1:] |= a[1:] > top[:-1]
    at = np.flatnonzero(start)
    return doc[at], a[at], top[np.append(at[1:], len(a)) - 1]


def _candidates(x: Array, hot: np.ndarray, buckets: int) -> pa.RecordBatch:
    pos = x["pos"].astype(np.int64)
    return _rows("candidate", len(pos), bucket=x["doc"] % buckets, seed=x["seed"].view(np.int64), doc=x["doc"], a=pos - x["first"], b=pos - x["last"], hot=hot)


def array_of(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Suffix arrays of the tasks' texts in pieces per bucket, with what is settled inside a task."""
    def flush(ids: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(np.array(ids), kind="stable")
        sizes = np.array([len(texts[k]) for k in order])
        data = np.frombuffer(b"".join([texts[k] for k in order]), dtype=np.uint8)
        texts.clear()
        x = spans(data, np.cumsum(sizes) - sizes, np.cumsum(sizes), length)
        x["doc"] = np.array(ids, dtype=np.int64)[order][x["doc"]]
        x = take(x, np.lexsort((x["span"], x["seed"])))  # stable: the earliest of equal spans comes first
        new = heads(x["seed"], x["span"])
        yield _repeated(take(x, ~new), length, buckets)
        x = take(x, new)
        seeds = np.flatnonzero(heads(x["seed"]))
        rank = np.arange(len(new[new])) - np.repeat(seeds, np.diff(np.append(seeds, len(x["seed"]))))
        over = rank >= HOT
        yield _candidates(take(x, over), np.ones(over.sum(), dtype=bool), buckets)
        x = take(x, ~over)
        bucket = ((x["seed"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            yield _rows("new", 1, bucket=[b], blob=[pack(take(x, slice(cuts[b], cuts[b + 1])))])

    def run(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = t.as_buffer().to_pybytes() if t.is_valid else b""
                if len(t) < length:
                    continue
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= FLUSH_BYTES:
                    yield from flush(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from flush(ids, texts)

    return docs.select("doc", "text").mapInArrow(run, ROW)


def scan(length: int, buckets: int, merge: list[int], keep: bool):
    """The work on one bucket: merge-scan of the new array against the levels, and the merged array if it is kept."""
    def run(table: pa.Table) -> pa.Table:
        passed = table.filter(pc.is_null(table.column("blob"))).to_batches()  # settled by the tasks
        blobs = table.filter(pc.is_valid(table.column("blob")))
        arrays: dict[str, list[Array]] = {}
        for s, blob in zip(blobs.column("side").to_pylist(), blobs.column("blob"), strict=True):
            arrays.setdefault(s, []).append(unpack(blob.as_buffer()))
        new = joined(arrays.pop("new", []))
        old = joined([a for parts in arrays.values() for a in parts])
        x = {k: np.concatenate([old[k], new[k]]) for k in new}
        x["old"] = np.arange(len(x["seed"])) < len(old["seed"])
        x = take(x, np.lexsort((x["pos"], x["doc"], x["span"], x["seed"])))  # identifiers ascend from batch to batch
        first = heads(x["seed"], x["span"])
        repeated = take(x, ~first & ~x["old"])
        x = take(x, first)
        # per seed: distinct spans, and how many of them were known
        starts = np.flatnonzero(heads(x["seed"]))
        if len(starts):
            sizes = np.diff(np.append(starts, len(x["seed"])))
            every, known = np.repeat(sizes, sizes), np.repeat(np.add.reduceat(x["old"].astype(np.int64), starts), sizes)
        else:
            every = known = np.zeros(0, dtype=np.int64)
        turned = (known == 1) | (known < HOT) & (every >= HOT)  # known spans that now are candidates, or now hot ones
        chosen = (every > known) & (every > 1) & (~x["old"] | turned)
        out = [*passed, _repeated(repeated, length, buckets), _candidates(take(x, chosen), (every >= HOT)[chosen], buckets)]
        if keep:
            mine = joined([new, *(a for m in merge for a in arrays.get(f"level{m}", []))])
            mine = take(mine, np.lexsort((mine["pos"], mine["doc"], mine["span"], mine["seed"])))
            mine = take(mine, heads(mine["seed"], mine["span"]))
            if len(mine["seed"]):
                out.append(_rows("kept", 1, bucket=[table.column("bucket")[0].as_py()], blob=[pack(mine)]))
        return pa.Table.from_batches(out, schema=ARROW)

    return run


class SuffixIndex:
    """The family of arrays in a shared folder. Batches are added in ascending order of their identifiers."""

    def __init__(self, spark: SparkSession, home: str, buckets: int = BUCKETS, length: int = 100):
        if not SEED < length < SEED + 256:
            raise ValueError("length must be 33 to 287 bytes")
        self.spark, self.home, self.buckets, self.length = spark, home, buckets, length
        self.levels: list[tuple[int, int]] = []  # (number of the batch that wrote it, batches in it), largest first
        self.batches, self.top = 0, None

    def add(self, docs: DataFrame, last: bool = False) -> None:
        """Scan a batch (columns doc, text) against the levels and keep its array; with ``last`` it is not kept."""
        least, most = docs.agg(F.min("doc"), F.max("doc")).first()
        if least is None:
            return
        if self.top is not None and least <= self.top:
            raise ValueError("a batch must have larger identifiers than those before it")
        self.top = most
        merge, size = [], 1
        while len(merge) < len(self.levels) and self.levels[-1 - len(merge)][1] == size:
            merge.append(self.levels[-1 - len(merge)][0])
            size *= 2
        rows = array_of(docs, self.length, self.buckets)
        for batch, _ in self.levels:
            rows = rows.unionByName(self._read(batch, "kept").withColumn("side", F.lit(f"level{batch}")))
        at = self.batches
        (rows.groupBy("bucket").applyInArrow(scan(self.length, self.buckets, merge, not last), ROW)
         .write.partitionBy("side").parquet(f"{self.home}/batch={at}"))
        self.batches += 1
        if not last:
            self.levels = [*self.levels[:len(self.levels) - len(merge)], (at, size)]
            for batch in merge:  # their rows are in the new level
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.home}/batch={batch}/side=kept")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _read(self, batch: int, side: str) -> DataFrame:
        return self.spark.read.schema(ROW).parquet(f"{self.home}/batch={batch}").where(F.col("side") == side)

    def _found(self, side: str, *columns: str) -> DataFrame:
        found = self.spark.createDataFrame([], ROW)
        for batch in range(self.batches):
            found = found.unionByName(self._read(batch, side))
        return found.select(*columns)

    def repeated(self, docs: DataFrame) -> DataFrame:
        """doc, a, b: intervals of bytes of the texts added so far that are repeated. ``docs`` has these texts (doc, text)."""
        windows = stored(candidate_windows(docs, self._found("candidate", "seed", "doc", "a", "b", "hot").distinct(), self.length), "windows")
        cold = windows.where("text IS NOT NULL").select("seed", "doc", "a", "text")
        hot = windows.where("hash IS NOT NULL").select("seed", "hash", "doc", "a")
        settled = windows.where("b IS NOT NULL").select("doc", "a", "b")
        cold = cold.repartition("seed").sortWithinPartitions("seed").mapInArrow(compare_texts(self.length), INTERVAL)
        hot = hot.repartition("seed", "hash").sortWithinPartitions("seed", "hash", "doc", "a").mapInArrow(compare_hashes(self.length), INTERVAL)
        return self._found("repeated", "doc", "a", "b").unionByName(settled).unionByName(cold).unionByName(hot)


INTERVAL = "doc bigint, a int, b int"
WINDOWS = "seed bigint, doc bigint, a int, b int, text binary, hash bigint"
W_ARROW = pa.schema([("seed", pa.int64()), ("doc", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("text", pa.binary()), ("hash", pa.int64())])


def _intervals(doc: np.ndarray, a: np.ndarray, length: int) -> pa.RecordBatch:
    doc, a, b = merged(doc, a, a + length)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["doc", "a", "b"])


def _later(seed: np.ndarray, window: np.ndarray, doc: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows, and which of them (in that order) are not the earliest of their kind."""
    order = np.lexsort((a, doc, window, seed))
    return order, ~heads(seed[order], window[order])


def candidate_windows(docs: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """Of each candidate its span's text, or if its seed is hot the hashes of its windows, each once per batch of rows
    (rows with b: intervals that are already known as repeated)."""
    of_doc = candidates.groupBy("doc").agg(F.collect_list(F.struct("seed", "a", "b", "hot")).alias("own"))
    rows = docs.select("doc", "text").join(of_doc, "doc")

    def put(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in W_ARROW], schema=W_ARROW)

    def run(batches):
        for batch in batches:
            own = batch.column(2)
            sizes = np.diff(own.offsets.to_numpy())
            seed, a, b, hot = (x.to_numpy(zero_copy_only=False) for x in own.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            doc = batch.column(0).to_numpy()[row]
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            cold = np.flatnonzero(~hot)
            for k in range(0, len(cold), 4096):
                at = cold[k:k + 4096]
                cut = [texts[r][x:y + length] for r, x, y in zip(row[at].tolist(), a[at].tolist(), b[at].tolist(), strict=True)]
                yield put(len(at), seed=seed[at], doc=doc[at], a=a[at], text=cut)
            if hot.any():
                at = np.flatnonzero(hot)
                x = windows_of([texts[r][x:y + length] for r, x, y in zip(row[at].tolist(), a[at].tolist(), b[at].tolist(), strict=True)],
                               seed[at], doc[at], a[at], length)
                order, later = _later(*x)
                s, h, d, p = (v[order] for v in x)
                yield put(int((~later).sum()), seed=s[~later], doc=d[~later], a=p[~later], hash=h[~later])
                d, p, e = merged(d[later], p[later], p[later] + length)
                yield put(len(d), doc=d, a=p, b=e)

    return rows.mapInArrow(run, WINDOWS)


def windows_of(texts: list[bytes], seed: np.ndarray, doc: np.ndarray, a: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """seed, hash, doc, place of every window of the spans."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = sizes - length + 1
    (hashes,) = grams(np.frombuffer(b"".join(texts), dtype=np.uint8), length)
    row = np.repeat(np.arange(len(texts)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(sizes) - sizes)[row] + inside
    return seed[row], mix64(hashes)[at].view(np.int64), doc[row], a.astype(np.int64)[row] + inside


def compare_texts(length: int):
    """Over rows sorted by seed: the windows that an earlier span of the same seed has."""
    def run(batches):
        left = None
        for batch in batches:
            if left is not None:
                batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
            seeds = batch.column(0).to_numpy()
            whole = int(np.searchsorted(seeds, seeds[-1])) if len(seeds) else 0  # the last seed may go on
            left = batch.slice(whole)
            if whole:
                yield judge(batch.slice(0, whole))
        if left is not None and left.num_rows:
            yield judge(left)

    def judge(batch):
        texts = [t.as_buffer().to_pybytes() for t in batch.column(3)]
        x = windows_of(texts, *(batch.column(k).to_numpy() for k in range(3)), length)
        order, later = _later(*x)
        return _intervals(x[2][order][later], x[3][order][later], length)

    return run


def compare_hashes(length: int):
    """Over rows sorted by window, document and place: all rows of a window but its first."""
    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            seed, window, doc, a = (batch.column(k).to_numpy() for k in range(4))
            new = heads(seed, window)
            new[0] = last != (seed[0], window[0])
            last = (seed[-1], window[-1])
            yield _intervals(doc[~new], a[~new].astype(np.int64), length)

    return run


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """doc (ascending, unique), id, text of all rows, and the bytes of all texts."""
    own = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    n, ids, bytes_ = (rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
                      .agg(F.sum("n"), F.count("id"), F.sum("bytes")).first())
    if own in ("bigint", "int", "smallint", "tinyint") and n == ids:
        return rows.select(F.col("id").cast("long").alias("doc"), "id", "text"), bytes_ or 0
    place, file, row = located(docs)
    order = [F.col("id").asc_nulls_first(), "file", "row"]
    rows = place.select(col(id_col).alias("id"), col(text_col).alias("text"), file.alias("file"), row.alias("row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.select(F.monotonically_increasing_id().alias("doc"), "id", "text"), "numbered"), bytes_ or 0


def cut_texts(docs: DataFrame, intervals: DataFrame, texts: bool = True) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and with ``texts`` kept_text (binary) of every row of ``docs`` (doc, id, text)."""
    of_doc = intervals.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("own"))
    rows = docs.join(of_doc, "doc", "left").select("id", F.coalesce("text", F.lit("")).alias("text"), "own")
    fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("kept_text", pa.binary())] * texts

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out: list[list] = [[] for _ in fields]
                own = part.column(2)
                for k, t in enumerate(part.column(1)):
                    text, cuts = t.as_buffer().to_pybytes(), []
                    if own[k].is_valid:
                        a, b = (x.to_numpy().astype(np.int64) for x in own[k].values.flatten())
                        _, a, b = merged(np.zeros(len(a), np.int64), a, b)
                        cuts = list(zip(a.tolist(), b.tolist(), strict=True))
                    kept = b"".join(text[x:y] for x, y in zip([0, *(y for _, y in cuts)], [*(x for x, _ in cuts), len(text)], strict=True))
                    for x, v in zip(out, (len(text), len(text) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest(), kept)):
                        x.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, (_, t) in zip(out, fields, strict=True))],
                                                 names=["id", *(n for n, _ in fields)])

    made = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text binary" * texts
    return rows.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, {made}")


def remove_repeats(docs: DataFrame, length: int = 100, batches: int = 4, id_col: str = "doc_id", text_col: str = "text",
                   texts: bool = True) -> DataFrame:
    """``id_col``, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and with ``texts`` kept_text (binary) of every row."""
    spark = docs.sparkSession
    rows, size = numbered(docs, id_col, text_col)
    index = SuffixIndex(spark, shared_path(spark, "suffixes"), max(BUCKETS, -(-size // BUCKET_BYTES)), length)
    shares = [k / batches for k in range(1, batches)]
    bounds = rows.agg(F.percentile_approx("doc", shares, 1000)).first()[0] if shares else []
    bounds = [None, *sorted(set(bounds or [])), None]
    for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = rows if low is None else rows.where(F.col("doc") > low)
        index.add(part if high is None else part.where(F.col("doc") <= high), last=k == len(bounds) - 2)
    return cut_texts(rows, index.repeated(rows), texts).withColumnRenamed("id", id_col)
