"""Chat formatting by columnar byte assembly (operator 8).

Template: a conversation starts with ``<s>``; a turn is ``<|turn|>`` role newline text newline ``<|end|>`` newline. In
texts every control string gets a backslash before it, which is taken off again when reading: a raw control
string is never preceded by a backslash, as a newline or a control string stands there. A role that is not a
plain name is written as a JSON string (null as ``null``).

A batch of turns is assembled at once: lengths of headers, contents and tails give cumulative offsets; scatter
indices copy header bytes and content bytes into one preallocated buffer, which becomes the Arrow column. The
loss mask are the byte spans of the contents of the roles in ``learned``.

Turns are dealt out by conversation and sorted by turn (ties by role, then text). A conversation that is longer
than a batch is written as several pieces (0, 1, ...) and read back in that order, so no task holds a whole
conversation.

Edge cases: null text is empty; null conv_id is a conversation of its own; a null turn comes first; repeated
rows are turns of their own; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.llm.common import col, in_bytes, stored

# Strings that mark turns here or in common chat templates; texts never hold one unescaped.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>", "<|im_start|>", "<|im_end|>"]
ANY = "(" + "|".join(re.escape(c) for c in CONTROL) + ")"
ANY_RE2 = "(" + "|".join(re.sub(r"([\[\]|])", r"\\\1", c) for c in CONTROL) + ")"
ESCAPED = re.compile(r"\\" + ANY)
BEGIN, TURN, TAIL = "<s>", "<|turn|>", "\n<|end|>\n"
PLAIN_ROLE = re.compile(r"[A-Za-z][A-Za-z0-9_-]*")
PIECES = ("conv_id {id}, piece bigint, formatted string, loss_start array<bigint>, loss_end array<bigint>")


def escape(text: str) -> str:
    return re.sub(ANY, r"\\\1", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _role_out(role: str | None) -> str:
    if role is not None and PLAIN_ROLE.fullmatch(role) and role != "null":
        return role
    return json.dumps(role).replace("<", "\\u003c").replace("[", "\\u005b")


def _role_in(role: str) -> str | None:
    return json.loads(role) if role == "null" or role.startswith('"') else role


def assemble(roles: list[str | None], texts: pa.Array, opens: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns: (bytes, end of each turn, start and end of each content).

    ``opens``: turns that start a conversation.
    """
    texts = pc.replace_substring_regex(pc.fill_null(texts, ""), ANY_RE2, "\\\\\\1").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    heads = {}
    kind = np.array([heads.setdefault((r, bool(o)), len(heads)) for r, o in zip(roles, opens, strict=True)], dtype=np.int64)
    head_bytes = [((BEGIN if o else "") + TURN + _role_out(r) + "\n").encode() for r, o in heads]
    head_sizes = np.array([len(h) for h in head_bytes], dtype=np.int64)
    head_starts = np.cumsum(head_sizes) - head_sizes
    head_table = np.frombuffer(b"".join(head_bytes), dtype=np.uint8)
    tail = np.frombuffer(TAIL.encode(), dtype=np.uint8)
    n = len(texts)
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * texts.offset)
    sizes = np.diff(edges)
    own = head_sizes[kind]
    ends = np.cumsum(own + sizes + len(tail))
    starts = ends - len(tail) - sizes  # of the contents
    out = np.empty(int(ends[-1]) if n else 0, dtype=np.uint8)

    def scatter(to: np.ndarray, lengths: np.ndarray, source: np.ndarray, origin: np.ndarray) -> None:
        total = np.cumsum(lengths)
        within = np.arange(int(total[-1])) - np.repeat(total - lengths, lengths)
        out[np.repeat(to, lengths) + within] = source[np.repeat(origin, lengths) + within]

    if n:
        scatter(starts - own, own, head_table, head_starts[kind])
        data = texts.buffers()[2]
        scatter(starts, sizes, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), edges[:-1])
        out[(ends - len(tail))[:, None] + np.arange(len(tail))] = tail
    return out.tobytes(), ends, starts, starts + sizes


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, piece, formatted, and the loss mask as byte spans loss_start, loss_end (per piece)."""
    rows = turns.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), col(role_col).cast("string").alias("role"),
                        col(text_col).cast("string").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = PIECES.format(id=rows.schema["conv_id"].dataType.simpleString())

    def run(batches):
        last, piece = (), 0
        for batch in batches:
            for part in in_bytes(batch, 2, 4 << 20):
                convs, roles = part.column(0).to_pylist(), part.column(1).to_pylist()
                new = np.array([k == 0 or c != convs[k - 1] for k, c in enumerate(convs)], dtype=bool)
                opens = new.copy()
                opens[0] = last != (convs[0],)
                data, ends, starts, stops = assemble(roles, part.column(2), opens)
                heads = np.flatnonzero(new)
                bounds = np.append(heads[1:], len(convs))
                cut = np.concatenate([[0], ends[bounds - 1]])
                masked = np.array([r in learned for r in roles], dtype=bool)
                base = np.repeat(cut[:-1], np.diff(np.append(heads, len(convs))))
                edges = np.concatenate([[0], np.cumsum(np.add.reduceat(masked, heads, dtype=np.int64))]).astype(np.int32)
                spans = [pa.ListArray.from_arrays(edges, pa.array((x - base)[masked])) for x in (starts, stops)]
                text = pa.StringArray.from_buffers(len(heads), pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(data))
                pieces = np.zeros(len(heads), dtype=np.int64)
                if not opens[0]:
                    pieces[0] = piece + 1
                last, piece = (convs[-1],), int(pieces[-1])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(heads)), pa.array(pieces), text, *spans],
                                                 names=["conv_id", "piece", "formatted", "loss_start", "loss_end"])

    return rows.mapInArrow(run, schema)


def parse(formatted: str) -> list[tuple[str | None, str]]:
    """The turns of a piece: (role, text)."""
    found = []
    for turn in formatted.removeprefix(BEGIN).split(TAIL)[:-1]:
        head, _, text = turn.removeprefix(TURN).partition("\n")
        found.append((_role_in(head), unescape(text)))
    return found


def read_chats(formatted: DataFrame) -> DataFrame:
    """From formatted pieces, per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Pieces of a conversation are read one after the other with running digests.
    """
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece").select(
        "conv_id", "formatted", "loss_start", "loss_end")
    ident = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        now, state = None, None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def done(found, kind):
            cols = [pa.array([x[0] for x in found], kind)]
            for k, t in ((1, pa.int64()), (2, pa.string()), (3, pa.int64()), (4, pa.string()), (5, pa.int64())):
                cols.append(pa.array([x[k].hexdigest() if t == pa.string() else x[k] for x in found], t))
            return pa.RecordBatch.from_arrays(cols, names=names)

        kind = None
        for batch in batches:
            kind, found = batch.column(0).type, []
            for conv, text, starts, ends in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if now != (conv,):
                    if state:
                        found.append(state)
                    now, state = (conv,), [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[1] += 1
                    state[2].update(f"{role or ''}\n{said}\n".encode())
                data = text.encode()
                for a, b in zip(starts, ends, strict=True):
                    said = unescape(data[a:b].decode())
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            if found:
                yield done(found, kind)
        if state:
            yield done([state], kind)

    return rows.mapInArrow(run, f"conv_id {ident}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def chat_digests(turns: DataFrame, **columns) -> DataFrame:
    """Format all turns into a table in the shared folder and read the digests back from it."""
    return read_chats(stored(format_chats(turns, **columns), "chats"))
