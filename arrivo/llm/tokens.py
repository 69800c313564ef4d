"""Token ids in files of directly addressable codes (operator 7).

Texts are put in identifier order (range exchange, then a sort inside each task), encoded, and written in
segments: an id is cut into chunks of eight bits; level k holds the k-th chunk of all ids that have one, a
continuation bitmap says which go on in the next level, and a rank directory (ones before each block of 512
bits) gives an id's place there. So any token is found from a few bytes of each level (:func:`token_at`)
without decoding a block. A segment is one row of a Parquet table in a folder that Spark writes and commits:
part, seq (ascending in identifier order), doc_ids, counts, tokens, payload. The column is not compressed, and
:func:`token` finds any token of the corpus by its number: it sums the segments' counts, reads the one segment that
holds it, and addresses the id there. (A Parquet value has no address of its own, so a segment is read whole.)

Encoding goes through the tokenizers library. If its file is plain byte-level BPE, texts in Latin characters
are split as the file's splitter does and each distinct word is encoded by the library once per cache; all
other texts are given to the library whole.

Edge cases: null text is empty and has the end id only; a null identifier comes first; rows that repeat an
identifier all stay, ordered by text; identifiers must be integers (a ValueError is raised for other types); a very
long text makes one long segment; extra columns are not read; an empty table writes no segments.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import col, in_bytes, shared_path, stored

MAGIC = b"DAC1"
BLOCK = 512  # bits per entry of a rank directory
SEGMENT = "part int, seq int, doc_ids array<bigint>, counts array<bigint>, tokens bigint, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """Ids (unsigned, 32 bits) as directly addressable codes."""
    levels = []
    rest = ids.astype(np.uint32)
    while len(rest) or not levels:
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
        ones = np.bitwise_count(bits.reshape(-1, BLOCK // 8)).sum(1, dtype=np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), ranks.astype("<u4").tobytes()))
        rest = rest[on] >> np.uint32(8)
        if not on.any():
            break
    head = MAGIC + struct.pack("<I", len(levels))
    body = b""
    for n, chunks, bits, ranks in levels:
        head += struct.pack("<QQQ", n, len(bits), len(ranks))
        body += chunks + bits + ranks
    return head + body


def _levels(payload) -> list[tuple[int, int, int, int]]:
    """Of each level: number of chunks, and where chunks, bitmap and directory begin."""
    if bytes(payload[:4]) != MAGIC:
        raise ValueError("not a file of directly addressable codes")
    (count,) = struct.unpack_from("<I", payload, 4)
    at, out = 8 + 24 * count, []
    for k in range(count):
        n, bits, ranks = struct.unpack_from("<QQQ", payload, 8 + 24 * k)
        out.append((n, at, at + n, at + n + bits))
        at += n + bits + ranks
    return out


def token_at(payload, i: int) -> int:
    """The i-th id, from one chunk, one bit and one directory entry of each level."""
    value = 0
    for k, (n, chunks, bits, ranks) in enumerate(_levels(payload)):
        if not 0 <= i < n:
            raise IndexError(i)
        value |= payload[chunks + i] << 8 * k
        if not payload[bits + i // 8] >> i % 8 & 1:
            break
        block = i // BLOCK
        (before,) = struct.unpack_from("<I", payload, ranks + 4 * block)
        own = int.from_bytes(payload[bits + block * BLOCK // 8:bits + i // 8 + 1], "little")
        i = before + (own & ((1 << i % BLOCK) - 1)).bit_count()
    return value


def unpack(payload) -> np.ndarray:
    """All ids."""
    data = np.frombuffer(payload, dtype=np.uint8)
    ids, where = None, None
    for k, (n, chunks, bits, _) in enumerate(_levels(payload)):
        part = data[chunks:chunks + n].astype(np.uint32)
        on = np.flatnonzero(np.unpackbits(data[bits:bits + (n + 7) // 8], count=n, bitorder="little"))
        if k == 0:
            ids, where = part, on
        else:
            ids[where] |= part << np.uint32(8 * k)
            where = where[on]
    return ids


def _splitter():
    """The byte-level splitter for characters below U+0250, with letters and numbers by Unicode category."""
    chars = [chr(c) for c in range(0x250)]
    letters = "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == "L")
    numbers = "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == "N")
    space = "\\t-\\r \\x85\\xa0"
    return re.compile(f" ?[{letters}]+|'(?:s|t|re|ve|m|ll|d)| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


class Encoder:
    """Ids of texts by the tokenizers library; ``cache`` bounds the words remembered."""

    JOINED = 50  # words encoded in one call

    def __init__(self, path: str, cache: int = 1_300_000):
        from tokenizers import Tokenizer

        # the tasks are what runs in parallel; the library's own threads would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.by_words = (before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
                         and not spec.get("normalizer") and not spec.get("truncation") and model.get("type") == "BPE"
                         and not model.get("dropout") and not model.get("ignore_merges"))
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.split = _splitter().findall
        self.other = re.compile("[^\\x00-\\u024f]").search
        self.cache, self.known = cache, {}
        # bytes of each id: a byte-level vocabulary has one character per byte
        self.size = np.zeros(max(model["vocab"].values()) + 1, dtype=np.int64) if self.by_words else None
        if self.by_words:
            for piece, i in model["vocab"].items():
                self.size[i] = len(piece)

    def ids(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text; ``end_id`` ends every text."""
        index, flat, words_of = defaultdict(itertools.count().__next__), [], []
        for text in texts:
            by_words = self.by_words and (text.isascii() or not self.other(text)) and not any(s in text for s in self.special)
            words = self.split(text) if by_words else [(text,)]  # a tuple: encoded whole
            if end_id is not None:
                words.append(None)
            flat.extend(map(index.__getitem__, words))
            words_of.append(len(words))
        used = {w for w in index if isinstance(w, str)}
        if len(self.known) + len(used) > self.cache:  # go on with the words of these texts only
            self.known = {w: self.known[w] for w in used if w in self.known}
        self._learn(used.difference(self.known))
        end = b"" if end_id is None else struct.pack("<I", end_id)
        data = [self.known[w] if isinstance(w, str) else end if w is None else self._whole(w[0]) for w in index]

        # each distinct word's ids once, then all occurrences by their places in them
        table = np.frombuffer(b"".join(data), dtype="<u4")
        sizes = np.array([len(x) // 4 for x in data], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        codes = np.array(flat, dtype=np.int64)
        sizes_at = sizes[codes]
        until = np.cumsum(sizes_at)
        n = int(until[-1]) if len(until) else 0
        ids = table[np.arange(n) + np.repeat(starts[codes] - (until - sizes_at), sizes_at)]
        ends = np.concatenate([[0], until])[np.cumsum(words_of)] if texts else np.zeros(0, np.int64)
        return ids, np.diff(ends, prepend=0)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, new: set[str]) -> None:
        """Encode new words, many at a time: a line break after each keeps them apart, and the ids' byte
        lengths tell where each word ends. Words of blanks only are encoded alone."""
        alone = [w for w in new if w.isspace()]
        self.known.update((w, self._whole(w)) for w in alone)
        new = list(new.difference(alone))
        groups = [new[k:k + self.JOINED] for k in range(0, len(new), self.JOINED)]
        for k in range(0, len(groups), 32):
            texts = ["\n".join(g) + "\n" for g in groups[k:k + 32]]
            for group, text, e in zip(groups[k:k + 32], texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, dtype="<u4")
                ends = np.cumsum([len(w) + 1 for w in (group if text.isascii() else [w.encode() for w in group])])
                at = np.searchsorted(np.cumsum(self.size[ids]), ends)  # the line break after each word
                data, begin = ids.tobytes(), 0
                for w, to in zip(group, (4 * at).tolist(), strict=True):
                    self.known[w] = data[begin:to]
                    begin = to + 4


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker: its words are kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, segment_tokens: int = 1 << 20) -> None:
    """Encode all texts, append ``end_id`` to each, and write segments of about ``segment_tokens`` to ``out``.

    A segment ends with a document, so a longer document makes a longer segment.
    """
    if docs.schema[id_col].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"{id_col} must be an integer column")
    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))

    def run(batches):
        encode = encoder(tokenizer).ids
        part, seq = TaskContext.get().partitionId(), 0
        docs, counts, data, size = [], [], [], 0

        def segment():
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "doc_ids": docs, "counts": counts, "tokens": size, "payload": pack(np.concatenate(data))}],
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                                  ("counts", pa.list_(pa.int64())), ("tokens", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            for piece in in_bytes(batch, 1, 4 << 20):
                ids, own = encode(piece.column(1).to_pylist(), end_id)
                at = 0
                for doc, n in zip(piece.column(0).to_pylist(), own.tolist(), strict=True):
                    docs.append(doc)
                    counts.append(n)
                    data.append(ids[at:at + n])
                    at += n
                    size += n
                    if size >= segment_tokens:
                        yield segment()
                        docs, counts, data, size, seq = [], [], [], 0, seq + 1
        if docs:
            yield segment()

    (rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
     .mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(out))


def segment_starts(files: DataFrame) -> DataFrame:
    """part, seq, start (ids of all segments before it); only the tokens per part (one row per written task) are summed in one task."""
    before = lambda order, by: F.sum("tokens").over(Window.partitionBy(*by).orderBy(order)) - F.col("tokens")
    parts = (files.groupBy("part").agg(F.sum("tokens").alias("tokens"))
             .select("part", before("part", []).alias("part_start")))
    starts = files.select("part", "seq", before("seq", ["part"]).alias("seq_start")).join(parts, "part")
    return starts.select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("start"))


def token(spark: SparkSession, path: str, i: int) -> int:
    """The i-th id of all files at ``path``: the payload of its segment alone is read."""
    files = spark.read.schema(SEGMENT).parquet(path)
    own = segment_starts(files).where(F.col("start") <= i).orderBy(F.col("start").desc(), F.col("part").desc(), F.col("seq").desc()).first()
    if own is None or i < 0:
        raise IndexError(i)
    return token_at(files.where((F.col("part") == own.part) & (F.col("seq") == own.seq)).first().payload, i - own.start)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the files."""
    files = spark.read.schema(SEGMENT).parquet(path)
    index = stored(segment_starts(files), "token-index")
    placed = files.join(index, ["part", "seq"]).select("start", "doc_ids", "counts", "payload")

    def run(batches):
        for batch in batches:
            for start, docs, counts, payload in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                data = unpack(payload).astype("<u4").tobytes()
                ends = np.cumsum(counts)
                begins = ends - counts
                crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + begins), pa.array(counts, pa.int64()),
                                                  pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the files to a new shared folder and read the documents' digests back from them."""
    out = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, out, tokenizer, **options)
    return read_tokens(docs.sparkSession, out)
