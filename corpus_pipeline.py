"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, source mixing, sampled SentencePiece pieces.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``. SQL cannot express language ID, fingerprints and sampling, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm import exact_dedup, language, mixing, pieces, simhash
from arrivo.llm.common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (language ``und``) or mostly in scripts of no learned language go."""
    return language.known_language(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 2 or fewer bits (shingles of 3 words) the smallest doc_id stays."""
    return simhash.kept_rows(docs, width=3, max_bits=2)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: sources weigh 5, 2, 1, repeating, and share 150% of all words."""
    return mixing.mixed_rows(docs)


def sampled_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces, decoded_sha256, lossless."""
    import public_tokenizers

    return pieces.encode(docs, pieces.load(public_tokenizers.path("piece_bpe_32k.model")), keep=[F.col("doc_id")])


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_dedup", near_duplicates),
    ("source_mix", source_mix),
    ("sampled_pieces", sampled_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
