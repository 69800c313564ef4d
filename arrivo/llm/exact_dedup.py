"""Exact duplicates by a stateful stream (operator 4).

Every row gives a thin record: SHA-256 of the normalised text, identifier, content locator (file and row).
A stream keeps one state entry per digest, on disk (RocksDB) and without expiry: the record that stays
(largest identifier) and the number of rows. Later runs on the same ``state_dir`` go on from that state.
Where a digest was hit more than once, the texts are fetched and their full bytes compared with those of
the record that stays; texts that differ under one digest are grouped by their whole text instead.
Only DataFrame and SQL functions are used.

Edge cases: a null text counts as empty. A null identifier is smaller than any other. Rows that repeat an
identifier and text form one group in which the last row by locator stays. Extra columns are never read
by name and pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import col, located, lower_ascii, shared_path, stored, whole_row

STATE = "spark.sql.streaming.stateStore"
#: State on disk; native memory bounded for all partitions of an executor together, whatever their number; no
#: space is reserved ahead for the logs of partitions with little state.
STATE_CONF = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true", f"{STATE}.rocksdb.maxMemoryUsageMB": "192",
    f"{STATE}.rocksdb.writeBufferSizeMB": "2", f"{STATE}.maintenanceInterval": "10s",
    f"{STATE}.rocksdb.allowFAllocate": "false",
}


def _run_stream(spark: SparkSession, intake: str, schema, state: str) -> DataFrame:
    """Feed all new intake files to the keyed state and return the state: one row per digest."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        (spark.readStream.schema(schema).parquet(intake)
         .groupBy("digest")
         .agg(F.max(F.struct("id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
         .writeStream.format("noop").outputMode("update")
         .option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination())
        entries = spark.read.format("statestore").load(state)
        keep, n = (f"value.`{x}`" for x in entries.schema["value"].dataType.names)
        return stored(entries.select(F.col("key.digest").alias("digest"), F.col(keep).alias("keep"),
                                     F.col(n).alias("n")), "dedup-state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Words of 64 bits in the sieve of hit digests: a table of at most 2 MB at any size of the input.
SIEVE = 1 << 17


def _sieve(digest: Column) -> tuple[Column, Column]:
    """Word and bit of a digest in the sieve."""
    h = F.xxhash64(digest)
    return F.pmod(h, F.lit(SIEVE)), F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(63)).cast("int")


def _sifted(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows whose digest may be among the hits: texts of all others need not be moved to find that out.

    A bit per hit digest, gathered into a table of fixed size; the exact join follows.
    """
    word, bit = _sieve(F.col("digest"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    sieve = hits.select(word.alias("word"), one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits"))
    return (rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(sieve), "word")
            .where(F.getbit("bits", F.col("bit")) == 1).drop("word", "bit", "bits"))


def _intake(thin: DataFrame, home: str) -> tuple[str, bool]:
    """Path of the thin records under ``home``, and whether other batches were passed before.

    Named by the rows' locators: a batch that is passed again after a failed run finds its records there. They are not
    written again, so that the stream, which knows its files by name, never takes a row twice.
    """
    spark = thin.sparkSession
    h = F.xxhash64("file", "row")
    n, mixed, total = thin.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first()
    name = f"run={n}-{(mixed or 0) & (2**64 - 1):016x}-{total or 0}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/intake")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    others = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{home}/intake/{name}/_SUCCESS")):
        thin.write.mode("overwrite").parquet(f"{home}/intake/{name}")
    return f"{home}/intake/{name}", any(o != name for o in others)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Column | None = None,
                state_dir: str | None = None, contents: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: row (all its columns), doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` replaces SHA-256 of the normalised text (any deterministic expression is right, a weak one
    only costs more byte checks). ``state_dir`` keeps intake and state between runs over growing data:
    pass only new rows each time, and as ``contents`` the table of all rows passed so far, these included; the result covers the new rows, with the state of all runs. Both must be read from Parquet
    files, whose rows can be found again. A batch that is passed again, after a failed run or a full one, counts once.
    Where ``contents`` lacks a row of a group that the new rows join, the run fails: full bytes are always compared.
    The state keeps the number of partitions (``spark.sql.shuffle.partitions``) of its first run.
    """
    spark = docs.sparkSession
    given = docs
    docs, file, row = located(docs)
    if state_dir and docs is not given:
        raise ValueError("with state_dir the rows must be read from Parquet files")
    norm = lower_ascii(col(text_col))
    sha = F.unhex(F.sha2(norm, 256))
    key = sha if digest is None else digest
    thin = docs.select(key.alias("digest"), col(id_col).alias("id"), file.alias("file"), row.alias("row"))
    home = state_dir or shared_path(spark, "dedup")
    if state_dir:
        path, earlier = _intake(thin, home)
        if earlier and contents is None:
            raise ValueError("the state holds earlier rows: pass all rows as contents")
    else:
        path = f"{home}/intake/run=1"
        thin.write.parquet(path)
    intake = spark.read.schema(thin.schema).parquet(path)
    out = docs.select(whole_row(docs).alias("row"), key.alias("digest"), file.alias("file"), row.alias("at"),
                      col(id_col).alias("doc_id"), F.hex(sha).alias("sha"))
    if intake.isEmpty():
        return out.select("row", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                          F.lit(True).alias("kept"), F.lower("sha").alias("text_sha256"))
    state = _run_stream(spark, f"{home}/intake/*", thin.schema, f"{home}/state")

    # Full bytes of the hits: each text that shares a digest, of all runs, against the text that stays.
    hits = state.where("n > 1")
    source, s_file, s_row = docs, file, row
    if contents is not None:
        hits = hits.join(intake.select("digest"), "digest", "left_semi")
        source, s_file, s_row = located(contents)
        if source is not contents:
            raise ValueError("contents must be read from Parquet files")
    located_texts = source.select(key.alias("digest"), norm.alias("norm"), col(id_col).alias("id"), s_file.alias("file"), s_row.alias("row"))
    texts = stored(_sifted(located_texts, hits).join(hits, "digest"), "dedup-hits")
    if contents is not None:
        found = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("found"))
        if not hits.join(found, "digest", "left").where("coalesce(found, 0) != n").isEmpty():
            raise ValueError("contents must hold the rows of all runs, once each")
    stays = texts.where("keep.file = file and keep.row = row").select("digest", F.col("norm").alias("kept_norm"))
    other = stored(texts.join(stays, "digest").where("norm != kept_norm")
                   .select("digest", "norm", "id", "file", "row"), "dedup-other")
    regrouped = other.groupBy("digest", "norm").agg(F.max(F.struct("id", "file", "row")).alias("own_keep"),
                                                    F.count(F.lit(1)).alias("own_n"))
    moved = (other.join(regrouped, ["digest", "norm"])
             .select(F.col("file").alias("m_file"), F.col("row").alias("m_row"), "own_keep", "own_n"))
    lost = other.groupBy("digest").agg(F.count(F.lit(1)).alias("lost_n"))

    judged = (out.join(state, "digest").join(lost, "digest", "left")
              .join(moved, (F.col("file") == F.col("m_file")) & (F.col("at") == F.col("m_row")), "left"))
    keep = F.coalesce("own_keep", "keep")
    return judged.select(
        "row", "doc_id", keep["id"].alias("keep_id"),
        F.coalesce("own_n", F.col("n") - F.coalesce("lost_n", F.lit(0))).alias("group_size"),
        ((keep["file"] == F.col("file")) & (keep["row"] == F.col("at"))).alias("kept"),
        F.lower("sha").alias("text_sha256"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return exact_dedup(docs, id_col, text_col).where("kept").select("row.*")
