"""Sampled segmentation into SentencePiece pieces and lossless decoding (operator 6).

The text (with one blank before it, as the vocabulary expects) falls into chunks that no piece crosses: a run
of blanks and what follows up to the next blank. Over the lattice of all pieces of a chunk, forward filtering
sums the weights of all segmentations up to each position; backward sampling then draws one segmentation with
its exact probability. The draws come from a counter-based generator on (seed, row key, chunk, step), so a
row's sample depends neither on batches nor on partitions. A distinct chunk's lattice is built once per slice
of texts; all its occurrences are sampled together.

Weights: the pieces' scores order them; the piece of rank r weighs ``1 / (r + 10)`` to the power ``alpha``. A
character without a piece of its own is written as byte pieces (also U+2581, which would decode to a blank).

Edge cases: null or empty text gives no pieces and decodes to the empty text; control and unknown pieces
are never produced; rows with equal keys and texts get equal samples, null keys count as one key; extra
columns pass through in ``row``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from arrivo.llm.common import col, in_bytes, mix64, whole_row

BLANK = 0x2581  # the vocabulary's sign for a blank
OUTSIDE, END = 0x110001, 0x110002  # no piece has these


@dataclass
class Vocabulary:
    """Trie of pieces; ``weight`` and ``data`` by piece id.

    ``first`` leads from a character to a node; further steps are looked up by (node, character) in a hash
    table with linear probing (``keys``, ``child``; -1: empty). ``piece`` is the piece that ends in a node, or -1.
    """

    first: np.ndarray
    keys: np.ndarray
    child: np.ndarray
    piece: np.ndarray
    weight: np.ndarray
    byte_ids: np.ndarray
    data: list[bytes]
    chunks: str


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)


def load(path: str, alpha: float = 1.0) -> Vocabulary:
    """Read a SentencePiece model file with byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(size)]
    byte_ids = np.full(256, -1, dtype=np.int64)
    data = [b""] * size
    plain = []
    for i, name in enumerate(names):
        if sp.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            data[i] = bytes([int(name[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            plain.append(i)
            data[i] = name.replace(chr(BLANK), " ").encode()
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no byte pieces")
    if any(re.search(f"[^{chr(BLANK)}]{chr(BLANK)}", names[i]) for i in plain):
        raise ValueError("pieces that go on after a blank are not supported")
    rank = np.full(size, size)
    rank[sorted(plain, key=lambda i: (-sp.get_score(i), i))] = np.arange(len(plain))
    weight = -alpha * np.log(rank + 10.0)

    edges, piece = {}, [-1]
    for i in plain:
        node = 0
        for c in names[i]:
            key = node << 21 | ord(c)
            if key not in edges:
                edges[key] = len(piece)
                piece.append(-1)
            node = edges[key]
        piece[node] = i
    first = np.full(END + 1, -1, dtype=np.int32)
    size = 1 << (8 * len(edges)).bit_length()
    keys, child = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
    for key, node in edges.items():
        if key >> 21 == 0:
            first[key] = node
            continue
        at = int(_slot(np.array([key]), size)[0])
        while keys[at] >= 0:
            at = (at + 1) % size
        keys[at], child[at] = key, node
    used = {c for i in plain for c in names[i]}
    alone = "".join(c for c in "\n\t\r" if c not in used)
    chunks = (f"[{alone}]|" if alone else "") + f" *[^ {alone}]+| +"
    return Vocabulary(first, keys, child, np.array(piece, dtype=np.int32), weight, byte_ids, data, chunks)


def _step(v: Vocabulary, node: np.ndarray, char: np.ndarray) -> np.ndarray:
    """The nodes after one more character, -1 where the trie has none."""
    key = node.astype(np.int64) << 21 | char
    at = _slot(key, len(v.keys))
    out = np.full(len(key), -1, dtype=np.int32)
    open_ = np.arange(len(key))
    while len(open_):
        there = v.keys[at]
        hit = there == key
        out[open_[hit]] = v.child[at[hit]]
        on = ~hit & (there >= 0)  # another key sits here: look at the next place
        open_, key, at = open_[on], key[on], (at[on] + 1) & (len(v.keys) - 1)
    return out


def _edges(v: Vocabulary, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All pieces in the characters, ordered by the node they lead to, then by length.

    (edges into each node, where a node's edges start, from, piece id; -1 where a character falls back to bytes).
    """
    inner = np.flatnonzero(cp != END)
    at, node = inner, v.first[cp[inner]]
    found = []
    length = 1
    while True:
        at, node = at[node >= 0], node[node >= 0]
        if not len(at):
            break
        piece = v.piece[node]
        own = piece >= 0
        found.append((at[own], length, piece[own]))
        node = _step(v, node, cp[at + length])
        length += 1
    alone = np.zeros(len(cp), dtype=bool)
    if found:
        alone[found[0][0]] = True
    rest = inner[~alone[inner]]
    found.insert(0, (rest, 1, np.full(len(rest), -1, dtype=np.int32)))
    degree = np.zeros(len(cp), dtype=np.int32)
    ranks = []
    for begin, length, _ in found:  # a node has at most one edge of each length and kind
        ranks.append(degree[begin + length])
        degree[begin + length] += 1
    head = np.cumsum(degree) - degree
    start = np.empty(int(degree.sum()), dtype=np.int32)
    ids = np.empty(len(start), dtype=np.int32)
    for (begin, length, piece), rank in zip(found, ranks, strict=True):
        to = head[begin + length] + rank
        start[to], ids[to] = begin, piece
    return degree, head, start, ids


def _byte_lengths(cp: np.ndarray) -> np.ndarray:
    return 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)


def sample(v: Vocabulary, texts: list[str], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, one after the other, and the number of each text."""
    cut = re.compile(v.chunks).findall
    known, codes, counts = defaultdict(itertools.count().__next__), [], []
    for text in texts:
        found = cut(" " + text) if text else []
        counts.append(len(found))
        codes.extend(map(known.__getitem__, found))
    if not codes:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    codes, counts = np.array(codes, dtype=np.int64), np.array(counts, dtype=np.int64)

    # The lattice: node i stands before character i; each chunk ends in a node of its own.
    sizes = np.array([len(c) for c in known], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    raw = np.frombuffer("\n".join([*known, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    cp = np.where(raw == BLANK, OUTSIDE, np.where(raw == 0x20, BLANK, raw))
    cp[ends] = END
    degree, head, begin, piece = _edges(v, cp)
    weight = np.where(piece >= 0, v.weight[piece], 0.0)
    back = np.flatnonzero(piece < 0)
    weight[back] = v.weight.min() * _byte_lengths(raw[begin[back]])
    offset = np.arange(len(cp)) - np.repeat(starts, sizes + 1)

    # Forward: log of the summed weights up to each node, all chunks step by step together.
    forward = np.full(len(cp), -np.inf)
    forward[starts] = 0.0
    most = int(sizes.max())
    nodes = np.argsort(offset.astype(np.int16) if most < 1 << 15 else offset, kind="stable")
    bounds = np.searchsorted(offset[nodes], np.arange(1, most + 2))
    for x, y in zip(bounds[:-1], bounds[1:], strict=True):
        to = nodes[x:y]
        many = degree[to]
        first = np.cumsum(many) - many
        at = np.arange(int(many.sum())) + np.repeat(head[to] - first, many)
        value = forward[begin[at]] + weight[at]
        top = np.maximum.reduceat(value, first)
        forward[to] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, many)), first))

    # Distribution over the edges into each node, as integers so that no batch changes a comparison.
    into = np.repeat(np.arange(len(cp)), degree)
    share = np.exp(forward[begin] + weight - forward[into])
    last = head + degree - 1
    k = 1
    own = head[degree > k]
    while len(own):
        share[own + k] += share[own + k - 1]
        k += 1
        own = head[degree > k]
    limit = np.minimum((share * 2.0**32).astype(np.int64), 0xFFFFFFFF)
    limit[last[degree > 0]] = 0xFFFFFFFF
    table = into << 32 | limit
    del into, share, limit, weight, forward, nodes

    # Backward: all occurrences draw their last piece, then the one before it, until their chunk's start.
    doc = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
    stream = mix64(mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(seed))[doc] + nth.astype(np.uint64))
    live = np.argsort(codes, kind="stable")  # equal chunks side by side: near lookups, the draws stay the same
    node, first = ends[codes[live]], starts[codes[live]]
    drawn = np.zeros(len(codes), dtype=np.int64)
    steps, k = [], 0
    while len(live):
        u = (mix64(stream[live] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(32)).astype(np.int64)
        e = np.searchsorted(table, node << 32 | u).astype(np.int32)
        steps.append((live, e))
        drawn[live] += 1
        node = begin[e].astype(np.int64)
        more = node > first
        live, node, first = live[more], node[more], first[more]
        k += 1
    del table, stream
    until = np.cumsum(drawn)
    edge = np.empty(int(until[-1]), dtype=np.int32)
    for k, (at, e) in enumerate(steps):
        edge[until[at] - 1 - k] = e
    del steps
    ids = piece[edge]
    per_chunk = drawn
    if (ids < 0).any():  # bytes instead of a piece
        char = raw[begin[edge]]
        times = np.where(ids < 0, _byte_lengths(char), 1)
        wide = np.repeat(ids, times)
        lost = np.flatnonzero(ids < 0)
        where = np.cumsum(times) - times
        spelled = {c: v.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in np.unique(char[lost]).tolist()}
        for c, own in spelled.items():
            at = where[lost[char[lost] == c]]
            for j, x in enumerate(own):
                wide[at + j] = x
        ids = wide
        per_chunk = np.add.reduceat(times, until - drawn)
    return ids, np.bincount(doc, weights=per_chunk, minlength=len(texts)).astype(np.int64)


class Decoder:
    """Bytes of pieces in one table, so that many ids are joined at once."""

    def __init__(self, v: Vocabulary):
        self.sizes = np.array([len(x) for x in v.data], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(v.data), dtype=np.uint8)

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each run of ids, as UTF-8, without the blank put before it."""
        sizes = self.sizes[ids]
        total = np.cumsum(sizes)
        n = int(total[-1]) if len(total) else 0
        flat = self.data[np.arange(n) + np.repeat(self.starts[ids] - (total - sizes), sizes)].tobytes()
        edge = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[x + 1:y] if y > x else b"" for x, y in zip(edge[:-1], edge[1:], strict=True)]


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
           keep: list[Column] | None = None) -> DataFrame:
    """``keep`` (default: row, all columns of ``docs``), n_pieces, pieces, and of the decoded pieces
    decoded_sha256 (hex) and lossless (equal to the text, byte for byte)."""
    keep = [whole_row(docs).alias("row")] if keep is None else keep
    rows = docs.select(*keep, F.xxhash64(col(id_col)).alias("__key"), F.coalesce(col(text_col), F.lit("")).alias("__text"))
    n = len(keep)
    schema = StructType([*rows.schema.fields[:n], StructField("n_pieces", LongType()), StructField("pieces", ArrayType(IntegerType())),
                         StructField("decoded_sha256", StringType()), StructField("lossless", BooleanType())])

    def run(batches):
        decoder = Decoder(vocabulary)
        for batch in batches:
            for part in in_bytes(batch, n + 1, 3 << 19):
                texts = part.column(n + 1).to_pylist()
                ids, counts = sample(vocabulary, texts, part.column(n).to_numpy(), seed)
                back = decoder.texts(ids, counts)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(counts), lists, pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                     pa.array([x == t.encode() for x, t in zip(back, texts, strict=True)])], names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, pieces_col: str = "pieces") -> DataFrame:
    """row (all columns of ``rows``) and text, joined from the pieces (null: empty)."""
    out = rows.select(whole_row(rows).alias("row"), col(pieces_col).alias("__pieces"))
    schema = StructType([out.schema.fields[0], StructField("text", StringType())])

    def run(batches):
        decoder = Decoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(1)
                counts = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], dtype=np.int64)
                texts = decoder.texts(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.decode() for x in texts], pa.string())], names=schema.names)

    return out.mapInArrow(run, schema)
