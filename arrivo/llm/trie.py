"""Prefix trie of conversations by truncation peeling (operator 12).

Every conversation becomes a thin row: the chained digests of its first 1, 2, ... turns (SHA-256 over the digest
before and the turn's role and text) and each turn's size. The rows are peeled from the deepest level up: at depth d
the conversations that end there join the nodes left over from depth d + 1, whose last turn is stripped; rows that
agree in the last digest left are one node. One grouped aggregation per level finds the nodes and at once sums members,
children, leaves and savings, each of which a node hands on to its parent. Levels are written to the shared
folder, so a lost executor repeats one level at most. A node that a third of all conversations share is a hot
key of an aggregation with partial sums only; nothing gathers a node's members.

The deepest conversations are few: what of them is deeper than all others is peeled in one task in the same way, as long
as they have at most 20,000 turns in all or are one conversation. So there are as many rounds as the depth that more
of them reach. The digests of one conversation (about 50 bytes a turn) are one row.

Edge cases: null role or text counts as empty. Turns are ordered by the columns of ``order`` (null first), turns
at one place by their digests; repeated rows are turns each. A null conversation is a conversation, a member like any other, that names a
node only if it is alone there. A conversation without turns (see ``conversations``) is a member of the root alone. Texts of
any length are only hashed. An empty table has no node. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from arrivo.llm.common import col, shared_path

#: Characters of a list of identifiers that are joined in one row.
JOINED = 4096
#: Turns (about 50 bytes each) of the deepest conversations that one task peels alone, instead of a round for every level.
TAIL = 20_000


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _root() -> Column:
    """Key of the root: the digest before the first turn."""
    return F.unhex(F.sha2(F.lit(""), 256))


def chains(turns: DataFrame, conv: str = "conv_id", order: tuple[str, ...] = ("turn",), role: str = "role", text: str = "text",
           conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, depth, chain: per conversation the (key, size) of its first 1, 2, ... turns.

    ``conversations`` (a table with the column ``conv``) adds conversations that may have no turns.
    """
    who, said = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    size = F.octet_length(said).cast("long")
    # the sizes ahead keep (role, text) pairs apart
    own = _digest(F.encode(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), "UTF-8"))
    one = F.struct(*[col(c).alias(f"o{n}") for n, c in enumerate(order)], own.alias("own"), size.alias("size"))
    rows = turns.select(col(conv).alias("conv_id"), one.alias("one"))
    if conversations is not None:
        rows = rows.unionByName(conversations.select(col(conv).alias("conv_id")), allowMissingColumns=True)
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    step = lambda acc, x: F.struct(
        _digest(acc["key"], x["own"]).alias("key"),
        F.concat(acc["chain"], F.array(F.struct(_digest(acc["key"], x["own"]).alias("key"), x["size"].alias("size")))).alias("chain"))
    start = F.struct(_root().alias("key"), F.expr("CAST(array() AS array<struct<key: binary, size: bigint>>)").alias("chain"))
    chain = F.aggregate("turns", start, step)["chain"]
    return listed.select("conv_id", F.size("turns").alias("depth"), chain.alias("chain"))


def _tail(convs: DataFrame) -> int:
    """The depth below which one task may peel: what is deeper has at most ``TAIL`` turns in all, or is one conversation."""
    cut = n = turns = 0
    for depth, count in sorted(convs.groupBy("depth").count().collect(), reverse=True):  # one row per depth that occurs
        cut, n, turns = depth, n + count, turns + depth * count
        if n > 1 and turns > TAIL:
            return cut
    return 0


def peel_tail(cut: int):
    """In one task: the nodes deeper than ``cut``, level by level; those at ``cut + 1`` with their chains."""
    def run(batches):
        names, chain_of, ended = [], [], {}
        for batch in batches:
            for conv, depth, chain in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ended.setdefault(depth, []).append(len(names))
                names.append(conv)
                chain_of.append(chain)
        alive: dict[bytes, list] = {}
        rows = []
        for depth in range(max(ended, default=cut), cut, -1):
            level: dict[bytes, list] = {}  # key: smallest member, members, children, leaves, saved, a conversation's chain
            below = [([names[r], 1, 0, 0, 0], r) for r in ended.get(depth, [])]
            below += [([conv, n, 1, leaves, saved], r) for conv, n, _, leaves, saved, r in alive.values()]
            for own, r in below:
                node = level.setdefault(chain_of[r][depth - 1]["key"], [None, 0, 0, 0, 0, r])
                node[0] = own[0] if node[0] is None or own[0] is not None and own[0] < node[0] else node[0]
                for k in range(1, 5):
                    node[k] += own[k]
            for key, node in level.items():
                chain = chain_of[node[5]]
                node[3] = node[3] if node[2] else 1
                node[4] += (node[1] - 1) * chain[depth - 1]["size"]
                rows.append({"key": key, "parent_key": chain[depth - 2]["key"] if depth > 1 else None, "conv_id": node[0], "n_convs": node[1],
                             "n_children": node[2], "n_leaves": node[3], "saved": node[4], "depth": depth,
                             "chain": chain[:depth] if depth == cut + 1 else None})
            alive = level
            if len(rows) >= 10_000:
                yield rows
                rows = []
        yield rows

    return run


def peel(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the rows of :func:`chains`: nodes and ends.

    nodes: key, parent_key, depth, conv_id (smallest member), n_convs, n_children, n_leaves, saved. ends: key of
    the node where a conversation ends, and its conv_id.
    """
    spark = convs.sparkSession
    home = shared_path(spark, "trie")
    convs.write.parquet(f"{home}/chains")
    convs = spark.read.schema(convs.schema).parquet(f"{home}/chains")
    kind = convs.schema["conv_id"].dataType.simpleString()
    schema = (f"key binary, parent_key binary, conv_id {kind}, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, depth int, "
              "chain array<struct<key: binary, size: bigint>>")
    # by the chain's own length, not the level's number: all levels then share one generated code
    turn = lambda back: F.get("chain", F.size("chain") - back)
    key = F.coalesce(turn(1)["key"], _root())
    ends = convs.select(key.alias("key"), "conv_id")
    zero = F.lit(0).cast("long")
    cut = _tail(convs)
    tail, arrow = peel_tail(cut), None

    def run(batches):
        for rows in tail(batches):
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema([("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", to_arrow_type(convs.schema["conv_id"].dataType)),
                       *[(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved")], ("depth", pa.int32()),
                       ("chain", pa.list_(pa.struct([("key", pa.binary()), ("size", pa.int64())])))])
    root = F.when(F.col("depth") == 1, _root()).otherwise(F.col("parent_key"))
    (convs.where(F.col("depth") > cut).select("conv_id", "depth", "chain").repartition(1).mapInArrow(run, schema)
     .withColumn("parent_key", root).write.parquet(f"{home}/nodes/level={cut + 1}"))
    for depth in range(cut, -1, -1):
        rows = convs.where(F.col("depth") == depth).select(
            "chain", "conv_id", F.lit(1).cast("long").alias("n"), zero.alias("child"), zero.alias("leaves"), zero.alias("saved"))
        # and the nodes of the level below, their last turn stripped
        below = spark.read.schema(schema).parquet(f"{home}/nodes/level={depth + 1}").where("chain IS NOT NULL")
        rows = rows.unionByName(below.select(
            F.slice("chain", F.lit(1), F.size("chain") - 1).alias("chain"), "conv_id", F.col("n_convs").alias("n"),
            F.lit(1).cast("long").alias("child"), F.col("n_leaves").alias("leaves"), "saved"))
        # equal keys have equal chains; the root has no last turn
        found = rows.groupBy(key.alias("key"), F.coalesce(turn(1)["size"], zero).alias("size")).agg(
            F.first("chain").alias("chain"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
            F.sum("child").alias("n_children"), F.sum("leaves").alias("inner"), F.sum("saved").alias("below"))
        parent = F.when(F.size("chain") > 0, F.coalesce(turn(2)["key"], _root()))
        found.select(
            "key", parent.alias("parent_key"), "conv_id", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("inner")).alias("n_leaves"),
            (F.col("below") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"), F.size("chain").alias("depth"), "chain",
        ).write.parquet(f"{home}/nodes/level={depth}")
    nodes = spark.read.schema(schema).parquet(*[f"{home}/nodes/level={depth}" for depth in range(cut + 1, -1, -1)])
    return nodes.drop("chain"), ends


def with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id, the parent's conv_id (null for the root). A hot parent is one row of its side of the join."""
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, "parent_key", "left")


def joined_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: the digest of a node's ended conversations in ascending order, joined by commas.

    Range-sorted tasks join some thousand characters to a row, wherever a node's list is cut; then each node's
    rows are hashed in order, as a stream.
    """
    by_id = ["key", F.col("conv_id").asc_nulls_first()]

    def join(batches):
        key, first, text = None, None, []
        size = 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(text)])],
                                              names=["key", "first", "ids"])

        for batch in batches:
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text and (k != key or size >= JOINED):
                    yield row()
                    text, size = [], 0
                if not text:
                    key, first = k, i
                text.append("" if i is None else str(i))
                size += len(text[-1]) + 1
        if text:
            yield row()

    def hashed(batches):
        key, digest = None, None
        done_keys, done = [], []
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k != key:
                    if digest is not None:
                        done_keys.append(key)
                        done.append(digest.hexdigest())
                    key, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_keys, pa.binary()), pa.array(done, pa.string())], names=["key", "ends_sha256"])
            done_keys, done = [], []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    lists = (ends.select("key", F.col("conv_id").cast("long").alias("conv_id")).repartitionByRange(*by_id).sortWithinPartitions(*by_id)
             .mapInArrow(join, "key binary, first bigint, ids string"))
    return (lists.repartition("key").sortWithinPartitions("key", F.col("first").asc_nulls_first())
            .mapInArrow(hashed, "key binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, **columns) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends_sha256 of every node; see :func:`chains`."""
    nodes, ends = peel(chains(turns, conversations=conversations, **columns))
    out = with_parents(nodes).join(joined_digests(ends), "key", "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
