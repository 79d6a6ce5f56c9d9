"""Offset-preserving piece encoding and decoding.

Every text is normalised here, by longest prefixes through the model's compiled character map, with the source offset
of every normalised byte kept; the encoder works behind an idle normaliser, and each piece's extent in the normalised
text is taken back through the offsets to a byte span of the original. Spans follow each other without gap or overlap.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from curata.llm import piece_model
from curata.llm.texts import need, whole_text

#: Bytes of text whose pieces are held at a time (a longer text is held alone).
HELD = 1 << 18

PIECES = (
    StructField("ids", ArrayType(IntegerType(), False)),
    StructField("begins", ArrayType(IntegerType(), False)),
    StructField("ends", ArrayType(IntegerType(), False)),
    StructField("decoded", StringType()),
)


def portions(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes stay below ``limit`` together, or single ones."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encoded(docs: DataFrame, model: str, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``ids, begins, ends`` (arrays, one entry per piece) and ``decoded``.

    ``model`` is the path of a model file that every executor can read. Texts are taken whole: a null or empty text has
    empty arrays and decodes to the empty text. Rows are independent: nothing is shuffled, repeated rows come out
    repeated, an empty table stays empty; columns outside ``keep`` do not matter, whatever their names. Within a
    task, the pieces of about ``HELD`` bytes of text are held at a time.
    """
    need(docs, text, *keep)
    fields = [docs.schema[c] for c in keep]
    names = [f.name for f in fields]
    clash = set(names) & {f.name for f in PIECES}
    if clash:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model.load(model)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = pa.compute.binary_length(column).to_pylist()
            for start, end in portions(sizes, HELD):
                part = batch.slice(start, end - start)
                out = [pieces.encode(t) for t in column.slice(start, end - start).to_pylist()]
                ends_at = np.cumsum([0, *(len(x[0]) for x in out)]).astype(np.int32)
                columns = [pa.ListArray.from_arrays(ends_at, np.concatenate([x[i] for x in out]).astype(np.int32)) for i in (1, 2, 3)]
                columns.append(pa.array([pieces.decoder.decode(x[0]) for x in out], pa.string()))
                kept = [part.column(i) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(kept + columns, names=[*names, *(f.name for f in PIECES)])

    rows = docs.select(*[docs[c] for c in keep], whole_text(text).alias("__text"))
    return rows.mapInArrow(work, StructType([*fields, *PIECES]))


def decoded(rows: DataFrame, model: str, *, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``decoded``: the text of the ids; null ids give the empty text."""
    need(rows, ids, *keep)
    fields = [rows.schema[c] for c in keep]
    names = [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model.load(model)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for start, end in portions(pa.compute.list_value_length(column).to_pylist(), HELD):
                texts = [pieces.decoder.decode(x) for x in column.slice(start, end - start).to_pylist()]
                kept = [batch.column(i).slice(start, end - start) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*names, "decoded"])

    empty = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>"))
    given = rows.select(*[rows[c] for c in keep], empty.alias("__ids"))
    return given.mapInArrow(work, StructType([*fields, StructField("decoded", StringType())]))


def digests(rows: DataFrame) -> dict:
    """Columns that sum up the arrays: counts, and SHA-256 of the ids joined by commas and of the decoded text."""
    return {
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256),
        "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
        "span_bytes": F.when(F.size("ends") > 0, F.element_at("ends", -1)).otherwise(0).cast("long"),
    }
