"""Writing pages as WARC archives, and reading archives back with their record boundaries verified.

The magic that opens a record can also stand inside a payload. So tasks cut a file at every magic, wherever Spark splits it,
and emit light candidates: the offset of the magic and the offset where the record it would open ends. Pointer jumping
from the start of each file then marks the candidates that the chain reaches, in rounds that double the distance. All
others are payload. A record whose payload holds magic was cut; its parts are found by offset, fetched in a second
pass and put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from curata.llm.texts import hex_sha256, need
from curata.session import settle

#: The format's fixed strings.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

LEAST_REVISITED = 100
RECORDS_PER_FILE = 5_000
STRIDE = 1 << 20

PIECE_SCHEMA = (
    "file string, block long, local long, size long, span long, whole boolean, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_bytes long, payload_digest string"
)
RECORD_COLUMNS = ["record_type", "record_id", "target_uri", "refers_to", "payload_bytes", "payload_digest"]


def revisits(pages: DataFrame, *, key: str = "page_id", html: str = "html", least: int = LEAST_REVISITED) -> DataFrame:
    """``key, digest, refers_to`` of pages whose payload, of ``least`` bytes or more, a page of smaller key has too."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    known = settle(pages.select(F.col(key).alias("key"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes")))
    groups = known.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("key").alias("refers_to"), F.max("key").alias("last"))
    groups = groups.where("refers_to < last").drop("last")
    later = known.join(groups, "digest").where("key > refers_to")
    return later.select(F.col("key").alias(key), "digest", "refers_to").distinct()


def _line(name: str, value: Column) -> Column:
    clean = F.regexp_replace(value, r"[\x00-\x20\x7F]", "%20")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise("")


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least: int = LEAST_REVISITED,
    compression: str = "gzip",
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """One record per row: an HTTP response with the html in UTF-8, or a revisit that names the page it repeats.

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest key is the response. A null
    html is an empty payload; a null url or key leaves its header out, and a page without key is never a revisit. Rows that repeat the
    key of a response are responses too. White space in urls is written as %20. Other columns are not looked at; an empty
    table gives empty archives. Payloads do not move unless there are too many revisits to send them to the pages.
    """
    need(pages, key, url, html)
    later = settle(revisits(pages, key=key, html=html, least=least).select(F.col(key).alias("k"), "digest", "refers_to"))
    body = F.coalesce(F.col(html), F.lit(""))
    given = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body"))
    given = given.withColumns({"digest": F.sha2(F.col("body").cast("binary"), 256), "bytes": F.octet_length("body").cast("string")})
    rows = given.join(later, (F.col("key") == F.col("k")) & (given["digest"] == later["digest"]), "left").drop(later["digest"])
    again = F.col("refers_to").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    block = F.when(again, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("bytes"), F.lit(END), F.col("body")))
    record = F.concat(
        F.lit(MAGIC),
        F.when(again, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        _line("WARC-Record-ID", urn("key")),
        _line("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {date}\r\n"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\n")),
        F.concat(F.lit("X-Payload-Bytes: "), F.col("bytes"), F.lit("\r\n")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn("refers_to"), F.lit(f"\r\nWARC-Profile: {SAME_PAYLOAD}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
        F.col("block"),
    )
    out = rows.withColumn("block", block).select(record.alias("value"))
    writer = out.write.option("lineSep", END).option("compression", compression)
    writer.option("maxRecordsPerFile", records_per_file).text(path)


HEADER = re.compile(rb"([^\r\n:]+):[ \t]*([^\r\n]*)\r\n")


def parse(piece: bytes) -> tuple[int, bytes, dict[str, str]] | None:
    """Header size, payload and fields of what follows a magic; None if it is no record's beginning.

    The payload is cut at the piece's end if the record goes on beyond it.
    """
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.decode("latin-1").strip().lower(): v.decode("utf-8", "replace").strip() for k, v in HEADER.findall(piece[: end + 2])}
    if not fields.get("content-length", "").isdecimal():
        return None
    block = piece[end + 4 : end + 4 + int(fields["content-length"])]
    if fields.get("content-type", "").startswith("application/http"):
        head, mark, body = block.partition(b"\r\n\r\n")
        block = body if mark else b""
    return end + 4, block, fields


def described(payload: bytes, fields: dict[str, str]) -> list:
    """The columns of a whole record. A revisit has no payload of its own: its header tells size and digest."""
    kind = fields.get("warc-type")
    if kind == "revisit":
        size = fields.get("x-payload-bytes", "")
        digest = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
        size = int(size) if size.isdecimal() else None
    else:
        size, digest = len(payload), hex_sha256(payload)
    return [kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), size, digest]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", MAGIC).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, offset within the block's pieces, piece): a task reads the pieces of a block in their order."""
    last, local = None, 0
    for batch in batches:
        for file, block, piece in zip(*(batch.column(i) for i in range(3))):
            file, block, piece = file.as_py(), block.as_py(), piece.as_py()
            if (file, block) != last:
                last, local = (file, block), 0
            yield file, block, local, piece
            local += len(piece) + len(MAGIC)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
    out = []
    for file, block, local, piece in _placed(batches):
        found = parse(piece)
        row = [file, block, local, len(piece), None, False, *[None] * 6]
        if found:
            head, payload, fields = found
            row[4] = len(MAGIC) + head + int(fields["content-length"]) + len(END)
            row[5] = row[4] == len(MAGIC) + len(piece) and piece.endswith(END.encode())
            if row[5]:
                row[6:] = described(payload, fields)
        out.append(row)
        if len(out) == 2_000:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], PIECE_ARROW)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], PIECE_ARROW)


PIECE_ARROW = pa.schema(
    [
        pa.field(name, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[kind])
        for name, kind in (c.split() for c in PIECE_SCHEMA.split(", "))
    ]
)


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _placed(batches):
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["file", "block", "local", "piece"])


def _bases(sizes: DataFrame) -> DataFrame:
    """``file, block, base, file_end``: where the pieces of each block begin, from the sizes of all pieces before them."""
    blocks = sizes.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("length"))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file_end = F.sum("length").over(Window.partitionBy("file")) - len(MAGIC)
    return blocks.select("file", "block", F.coalesce(F.sum("length").over(along), F.lit(0)).alias("base"), file_end.alias("file_end"))


def reachable(links: DataFrame) -> DataFrame:
    """``file, at`` of the offsets that the chain from offset 0 passes in each file.

    ``links``: ``file, at, to``, one row per candidate, ``to`` null where no candidate follows. Each round marks what
    the marked ones point to and lets every pointer jump over the one it points to, so that n records take about
    log2(n) rounds. The rounds are written, so a lost executor costs no more than the running one.
    """
    state = settle(links.select("file", "at", "to", (F.col("at") == 0).alias("reached"), F.lit(True).alias("opens")))
    while state.where("reached and to is not null").limit(1).count():
        marks = state.where("reached and to is not null").select("file", F.col("to").alias("at"), F.lit(None).cast("long").alias("to"), F.lit(True).alias("reached"), F.lit(False).alias("opens"))
        ahead = state.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("to").alias("next"))
        jumped = state.join(ahead, (F.col("file") == F.col("f")) & (F.col("to") == F.col("a")), "left")
        jumped = jumped.select("file", "at", F.col("next").alias("to"), "reached", "opens")
        state = settle(jumped.union(marks).groupBy("file", "at").agg(*[F.max(c).alias(c) for c in ("to", "reached", "opens")]))
    return state.where("reached and opens").select("file", "at")


def read_archives(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """``file, at, record_type, record_id, target_uri, refers_to, payload_bytes, payload_digest`` of every record.

    Runs jobs while it is built. Uncompressed archives are read in splits, gzipped ones a file per task. ``payloads`` adds the payload
    itself. A file whose chain breaks (cut off, or no record where one should follow) gives the records before the break;
    a file that does not begin with a record gives none, an empty file or folder neither. Size and digest of a revisit are those its
    header states, of other records those of the payload read. One record must fit a task's memory.
    """
    pieces = settle(_pieces(spark, path).mapInArrow(_candidates, PIECE_SCHEMA))
    placed = pieces.join(_bases(pieces.select("file", "block", "size")), ["file", "block"])
    placed = placed.withColumn("at", F.col("base") + F.col("local") - len(MAGIC))
    placed = settle(placed.withColumn("to", F.col("at") + F.col("span")).drop("block", "local", "base", "span"))

    opens = placed.where("at >= 0 and to is not null")
    starts = opens.select(F.col("file").alias("f"), F.col("at").alias("a"))
    links = opens.select("file", "at", "to", "file_end").join(starts, (F.col("file") == F.col("f")) & (F.col("to") == F.col("a")), "left")
    links = settle(links.where("a is not null or to = file_end").select("file", "at", F.col("a").alias("to")))
    found = placed.join(reachable(links), ["file", "at"])
    columns = ["file", "at", *RECORD_COLUMNS]
    cut = settle(found.where("true" if payloads else "not whole").select("file", "at", "to"))
    if not cut.limit(1).count():
        return found.select(*columns)
    joined = _joined(spark, path, placed, cut).select(*columns, *["payload"] * payloads)
    return joined if payloads else found.where("whole").select(*columns).union(joined)


def _joined(spark: SparkSession, path: str, placed: DataFrame, cut: DataFrame) -> DataFrame:
    """The records ``file, at, to`` put together from all pieces within their spans.

    The archives are read again and their pieces placed anew, since Spark may split files differently this time.
    """
    strides = F.sequence(F.floor(F.col("at") / STRIDE), F.floor((F.col("to") - 1) / STRIDE))
    spans = cut.select(F.col("file").alias("f"), F.col("at").alias("record"), "to", F.explode(strides).alias("stride"))
    parts = placed.select("file", "at", F.floor(F.col("at") / STRIDE).alias("s"))
    inside = (F.col("file") == F.col("f")) & (F.col("s") == F.col("stride")) & (F.col("at") >= F.col("record")) & (F.col("at") < F.col("to"))
    wanted = settle(parts.join(spans, inside).select("file", "at", "record", "to"))
    texts = _pieces(spark, path).mapInArrow(_located, "file string, block long, local long, piece binary")
    bases = _bases(_pieces(spark, path).select("file", "block", F.octet_length("piece").alias("size")))
    texts = texts.join(bases, ["file", "block"]).withColumn("at", F.col("base") + F.col("local") - len(MAGIC))
    whole = texts.select("file", "at", "piece").join(wanted, ["file", "at"]).groupBy("file", "record", "to").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["piece"].cast("string")), MAGIC).cast("binary")
    span = F.col("to") - F.col("record") - len(MAGIC)
    schema = "file string, at long, record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for file, at, piece, size in zip(*(batch.column(i) for i in range(4))):
                found = parse(piece.as_py())
                # the next record's magic was cut off with the last piece, its end was not
                if found is None or len(piece.as_py()) != size.as_py():
                    raise ValueError(f"{file.as_py()} changed between two readings")
                row = dict(zip(names, [file.as_py(), at.as_py(), *described(found[1], found[2]), found[1]]))
                yield pa.RecordBatch.from_pylist([row], pa.schema([*RECORD_ARROW, pa.field("payload", pa.binary())]))

    return whole.select("file", F.col("record").alias("at"), joined.alias("piece"), span.alias("size")).mapInArrow(work, schema)


RECORD_ARROW = [pa.field("file", pa.string()), pa.field("at", pa.int64()), *[PIECE_ARROW.field(c) for c in RECORD_COLUMNS]]


def page_of(urn: Column) -> Column:
    """The page id of a record id written here."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


WARC_SQL = f"""
with known as (
  select page_id, sha256(coalesce(html, '')) as digest, strlen(coalesce(html, '')) as bytes from pages
), firsts as (
  select digest, min(page_id) as first from known where bytes >= {LEAST_REVISITED} group by digest
)
select page_id, bytes::bigint as payload_bytes, k.digest as payload_digest,
  case when page_id > first then 'revisit' else 'response' end as record_type,
  case when page_id > first then first end as refers_to
from known k left join firsts f on k.digest = f.digest
"""
