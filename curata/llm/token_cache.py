"""Token counts through a cache of digests.

A text is known by the digest of its normalised content, a tokenizer by the digest of its file and kind. Counts are
stored under both. A run joins its digests to the stored counts, encodes one text for each distinct digest that is not there,
appends those counts to the cache and joins again. The cache is an append-only Parquet table in a folder that all executors share,
one partition per tokenizer version; an append is committed whole or not at all, and a count stored twice is read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curata.llm import piece_model
from curata.llm.pieces import portions
from curata.llm.texts import need, whole_text
from curata.session import settle

LIMIT = 4096
HELD = 1 << 20
SENT = 10_000
CACHE_SCHEMA = "content binary, n_tokens long, tokenizer string"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file that every executor can read; its kind is told by its ending."""

    path: str

    @property
    def kind(self) -> str:
        kind = {"json": "tokenizers", "model": "sentencepiece"}.get(self.path.rpartition(".")[2])
        if not kind:
            raise ValueError(f"neither .json nor .model: {self.path}")
        return kind

    @property
    def version(self) -> str:
        """Digest of the file and the library that reads it."""
        with open(self.path, "rb") as file:
            return hashlib.sha256(self.kind.encode() + b"\0" + file.read()).hexdigest()

    def normalised(self, text: Column) -> Column:
        """What two texts of equal counts may differ in is levelled: behind an idle normaliser, a space and its mark."""
        if self.kind == "sentencepiece" and (model := piece_model.load(self.path)).idle and model.escape:
            return F.replace(text, F.lit(" "), F.lit(piece_model.SPACE.decode()))
        return text


@lru_cache(maxsize=4)
def _counter(path: str, kind: str):
    """A function from texts to counts, made once per Python worker."""
    if kind == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import tokenizers

    model = tokenizers.Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``content, n_tokens`` of one tokenizer version; empty if the cache is not there yet."""
    rows = spark.createDataFrame([], CACHE_SCHEMA)
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    mine = rows.where(F.col("tokenizer") == version)
    return mine.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def encode_misses(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``content, n_tokens`` of rows ``content, text``."""
    path, kind = tokenizer.path, tokenizer.kind

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, kind)
        for batch in batches:
            digests, column = batch.column(0), batch.column(1)
            for start, end in portions(pa.compute.binary_length(column).to_pylist(), HELD):
                counts = count(column.slice(start, end - start).to_pylist())
                columns = [digests.slice(start, end - start), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["content", "n_tokens"])

    return texts.mapInArrow(work, "content binary, n_tokens long")


def token_counts(
    docs: DataFrame, tokenizer: Tokenizer, cache: str, *, text: str = "text", key: str = "doc_id", limit: int = LIMIT
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row; fills the cache at ``cache``.

    Runs jobs while it is built. A null text counts as the empty one (0 bytes, 0 tokens), texts are never cut, rows with
    equal texts are encoded once, rows that repeat a key or have none come out as often as they are there, an empty table
    gives an empty result; other columns are not looked at. The distinct misses are written first: up to ``SENT`` digests
    are sent to the texts, more meet them in a join.
    """
    need(docs, text, key)
    spark, version = docs.sparkSession, tokenizer.version
    content = F.unhex(F.sha2(tokenizer.normalised(whole_text(text)).cast("binary"), 256))
    known = settle(docs.select(F.col(key).alias("key"), content.alias("content"), F.octet_length(whole_text(text)).cast("long").alias("n_bytes")))
    misses = settle(known.select("content").distinct().join(stored(spark, cache, version), "content", "left_anti"))
    texts = docs.select(content.alias("content"), whole_text(text).alias("text"))
    if misses.limit(SENT + 1).count() <= SENT:  # few: texts that are not needed stay where they are
        needed = texts.join(F.broadcast(misses), "content", "left_semi").dropDuplicates(["content"])
    else:  # copies are combined before they move, then meet the misses without moving again
        needed = texts.dropDuplicates(["content"]).join(misses, "content", "left_semi")
    new = encode_misses(needed, tokenizer).withColumn("tokenizer", F.lit(version))
    new.write.mode("append").partitionBy("tokenizer").parquet(cache)
    counts = settle(stored(spark, cache, version))  # written, so that the join can split a content with very many copies
    counted = known.join(counts, "content")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
