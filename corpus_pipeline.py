"""A training-data pipeline of five of the operators in ``footmark.llm``.

Language ID (documents without a recognisable language go), near duplicates (one document of each
group stays), secrets (masked in the texts), mixing (the words that the mix takes of each document)
and packing. Each stage reads the documents that the stage before it kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footmark.llm import language_id, minhash_dedup, mixing, packing, secret_scan
from footmark.llm.common import Scope, columns_of, cut, held_out_col, numbered, remove, unused


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents that have a language (one id in four held out) and keeps those for
    which a language is recognised. Null and empty texts and texts without a letter go; so do texts
    whose rank-order distance to every learned language is beyond ``language_id.farthest``, a bound
    that is fitted out of fold. Long texts are read whole; repeated rows share a decision; ties go to
    the first language, which stays a language; columns of any name are kept; an empty table stays
    empty, and without any labelled text every document goes."""
    labelled = docs.filter(~held_out_col())
    profiles, bound = language_id.learn_profiles(labelled), language_id.farthest(labelled)
    seen = unused("seen", docs.columns)
    return docs.withColumn(seen, language_id.nearest(F.col("text"), profiles)) \
        .filter((F.col(f"{seen}.lang_pred") != language_id.UNKNOWN) & (F.col(f"{seen}.distance") <= bound)).select(*columns_of(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group (five-word shingles, similarity 0.8), the one with the smallest id.

    Groups are of rows: of an id with several texts only those rows go that are like one that stays,
    directly or by others, and copies without an id go too (a null id is the largest; of repeated rows
    the first stays). Null and empty texts have no shingle and stay. Long texts count with all their
    shingles; columns of any name are kept; an empty table stays empty."""
    rows, key = numbered(docs)
    gone = cut(minhash_dedup.repeated_rows(rows, key), "duplicates")
    return rows.join(gone, key, "left_anti").select(*columns_of(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret found; documents stay, with ``n_chars`` of the masked text (null text: 0).

    Edge cases are those of ``secret_scan.mask``."""
    out = secret_scan.mask(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*columns_of(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each pass over a document the words taken of it. Edge cases are those of
    ``mixing.mix_documents``."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids. Edge cases are those of ``packing.pack``."""
    return packing.pack(docs)


def _staged(number: int, stage):
    """A stage that first removes the tables which the stages before it wrote for themselves.

    Each stage's result is written before the next stage is called, so these tables have had their
    last reader; those that ``docs`` itself reads are kept."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for scope in _SCOPES[:number]:
            scope.clear(keep=docs)
        with _SCOPES[number]:
            return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [("language ID", language), ("MinHash near-dedup", near_duplicates), ("secret scan", secrets), ("source mixing", mix), ("packing", pack)]
_SCOPES = [Scope() for _ in STAGES]
STAGES = [(name, _staged(i, stage)) for i, (name, stage) in enumerate(STAGES)]

#: The stages train, tokenise and draw; SQL can't express them. tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's result is removed when the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir), name.split()[0].lower())
        remove(before)
    out = STAGES[-1][1](spark, docs, sf_dir)
    remove(docs)  # the last stage has written their tokens
    return out
