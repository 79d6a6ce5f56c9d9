"""The corpus pipeline: five stages, each one operator of ``curata.llm`` on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curata.llm import language, line_dedup, mixing, pieces, simhash
from curata.llm.contracts import piece_model_path
from curata.llm.texts import free_name
from curata.session import settle
from curata.sources.tables import read_table

#: A document is rejected if no language is likelier than all others together.
LEAST_SURE = 0.5
#: Stages that SQL cannot express: piece vocabularies, winnowing, fingerprints. They are tested against brute force.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a clear language go; a missing label is filled in.

    Null and empty texts have no letters. If no row is labelled, no language can be told and only texts without letters go.
    """
    model = language.learned(docs, piece_model_path())
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    pred, score = free_name("lang_pred", docs), free_name("lang_score", docs)
    rows = language.predicted(docs, model, pred=pred, score=score)
    kept = rows.where((F.col(pred) != language.UNKNOWN) & (F.col(score) >= LEAST_SURE))
    return kept.withColumn("lang", F.coalesce("lang", pred)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out; a document that has no word left of what it had goes."""
    rows = line_dedup.deduplicated(docs)
    kept = rows.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest key (a null key last); of rows equal in key and text one.

    Null and empty texts have no shingle and so one fingerprint, and are copies of each other. An empty table stays empty.
    """
    return simhash.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate takes them; a null source is a source.

    Null and empty texts add no words, but are taken at their source's rate like any others; a source without words is left out. Rows
    that repeat a key are drawn alike, very long texts as often as short ones. An empty table stays empty.
    """
    return mixing.mixed(docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, with its digests; decoding gives the text back.

    A null or empty text has no ids. Rows are taken as they come, repeated ones and very long texts too; an empty table stays empty.
    """
    rows = pieces.encoded(docs, piece_model_path(), keep=["doc_id", "lang", "source"])
    digests = [c.alias(n) for n, c in pieces.digests(rows).items()]
    return rows.select("doc_id", "lang", "source", "ids", *digests)


STAGES = [
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("pieces", piece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every one is written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
