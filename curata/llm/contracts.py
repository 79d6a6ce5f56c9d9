"""The registered queries of this package, each over its whole table, and their expected results as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from curata.llm import byte_pairs, itq, language, line_dedup, mixing, phrases, pieces, pseudolikelihood, resampling, simhash, token_cache, warc, winnow
from curata.session import own_folder
from curata.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_ranks() -> tuple[str, str]:
    """Path of a rank file and the pattern that splits texts before it is used."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query(warc.WARC_SQL)
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = own_folder(spark, "archives")
    warc.write_archives(read_table(spark, folder, "pages"), archives)
    records = warc.read_archives(spark, archives)
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


@query()
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    rows = pieces.encoded(docs, piece_model_path())
    return rows.select("doc_id", *[c.alias(n) for n, c in pieces.digests(rows).items()])


@query()
def op3_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.edited_likeness(read_table(spark, folder, "documents"))


@query()
def op4_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudolikelihood.pseudo_likelihood(read_table(spark, folder, "documents"))


@query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    cache = own_folder(spark, "token-counts")  # a new one, so that a run never lives on another run's counts
    return token_cache.token_counts(docs, token_cache.Tokenizer(piece_model_path()), cache)


@query()
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs).select("doc_id", "n_lines", "n_removed", "removed", "text")


@query()
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = language.learned(docs, piece_model_path())
    rows = language.predicted(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query()
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@query()
def op9_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return itq.near_duplicates(read_table(spark, folder, "embeddings"))


@query(mixing.MIXING_SQL.format(documents="documents"))
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return mixing.mixture(docs).select("doc_id", "size", "source_size", "target", "taken")


@query(resampling.RESAMPLING_SQL)
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return resampling.resampled(docs, read_table(spark, folder, "benchmark"))


@query()
def op12_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = byte_pairs.encoded(read_table(spark, folder, "documents"), *byte_ranks())
    return rows.select("doc_id", *[c.alias(n) for n, c in byte_pairs.digests(rows).items()])


@query(phrases.PHRASE_SQL)
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read_table(spark, folder, "documents"))
