"""The corpus pipeline: documents -> packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import exact_dedup, jaccard_join, lang_id, mixing, packing
from rowtide.llm.common import land, prepare


# A text of so many letters is in a learned language if its cosine with the nearest prototype reaches the floor. The
# cosine of a text in its own language grows with its length: from 200 letters on the least of 9,589 labelled rows is 0.19
# (one word repeated), a thousandth lies below 0.29; letters in random order stay below 0.07.
FLOOR, FLOOR_LETTERS = 0.12, 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from all labelled rows; rows in no language go.

    These are null texts, texts without a letter, and texts of ``FLOOR_LETTERS`` letters or more
    whose score is below ``FLOOR``. Shorter texts say too little to be rejected by score.
    """
    prepare(spark)
    model = lang_id.train(docs)
    if not model.languages:  # nothing to learn from: no score to go by
        return docs.where(F.col("text").rlike("\\p{IsAlphabetic}"))
    told = lang_id.language(docs, model)
    letters = F.length(F.regexp_replace("text", "\\P{IsAlphabetic}", ""))
    return docs.where((told["lang"] != lang_id.UNKNOWN) & ((told["score"] >= FLOOR) | (letters < FLOOR_LETTERS)))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the greatest id stays."""
    prepare(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    prepare(spark)
    return jaccard_join.keep_one_of_each(docs, words=5, part=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    prepare(spark)
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece, with its sequence and its place there."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

# Language profiles and token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is landed before the next reads it.

    Null columns, empty texts, repeated rows, an empty table and other columns are
    handled as each operator states.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
