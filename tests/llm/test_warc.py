"""Archives written and read back: payloads with magic inside, splits anywhere, broken files."""

import gzip
import hashlib

import pytest
from harness import duck, duck_result, spark_result
from pyspark.sql import functions as F

from curata.llm import contracts, warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
LONG = "<p>" + "long text é " * 40
PAGES = [
    (1, "http://a/1", "<html>" + "x" * 120),
    (2, "http://a/2", "<html>" + "x" * 120),
    (3, "http://a/\r\nX: y", "small"),
    (4, None, "small"),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "WARC/1.0\r\n" * 5 + "tail"),
    (8, "u", FAKE * 3),
    (9, "u", "a" + FAKE + "WARC/1.0\r\nContent-Length: 9999999\r\n\r\nzz\r\n\r\n" + LONG),
    (10, "u", LONG),
    (11, "u", LONG),
    (12, "u", "WARC/1.0\r\nWARC/1.0\r\n\r\n\r\n\r\n\r\nWARC/1.0"),
    (13, "u", "日本 🙂" * 3000),
]


def expected(rows):
    first = {}
    for i, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", i)
    out = {}
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and first[html] != i
        out[i] = (len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None)
    return out


@pytest.mark.parametrize("compression, width, n", [("gzip", "128m", 13), ("none", "97", 12), ("none", "4k", 13)])
def test_round_trip(spark, tmp_path, compression, width, n):
    given = PAGES[:n]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("body", F.lit("?"))
    warc.write_archives(pages.repartition(2), f"{tmp_path}/a", compression=compression)
    spark.conf.set("spark.sql.files.maxPartitionBytes", width)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = warc.read_archives(spark, f"{tmp_path}/a").select(
            warc.page_of(F.col("record_id")).alias("i"), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")).alias("r")
        ).collect()
        whole = warc.read_archives(spark, f"{tmp_path}/a", payloads=True).select(warc.page_of(F.col("record_id")).alias("i"), "payload", "record_type").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == len(given) == len(whole)
    assert {r.i: tuple(r)[1:] for r in rows} == expected(given)
    text = {i: html for i, _, html in given}
    assert all(r.record_type == "revisit" or r.payload.decode() == (text[r.i] or "") for r in whole)


def test_uncompressed_archive_is_one_stream_of_records(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, f"{tmp_path}/a", compression="none")
    data = next((tmp_path / "a").glob("part-*")).read_bytes()
    assert data.startswith(b"WARC/1.0\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    assert b"\r\nX: y" not in data


def record(body, length=None, kind="resource"):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(body) if length is None else length}\r\n\r\n{body}\r\n\r\n".encode()


@pytest.mark.parametrize(
    "data, bodies",
    [
        (record("one") + record("two"), [b"one", b"two"]),
        (record("one") + record("two")[:-3], [b"one"]),  # the last is cut off
        (record("one") + record("two") + b"junk", [b"one"]),
        (b"junk" + record("one"), []),
        (record("one", 2) + record("two"), []),
        (b"", []),
        (record(""), [b""]),
        (record("x" + record("in").decode() + "y") + record("z"), [b"x" + record("in") + b"y", b"z"]),
    ],
)
def test_foreign_and_broken_files(spark, tmp_path, data, bodies):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes(data)
    half = len(data) // 2  # two members, as archives with a member per record have
    (tmp_path / "f" / "b.warc.gz").write_bytes(gzip.compress(data[:half]) + gzip.compress(data[half:]))
    rows = warc.read_archives(spark, f"{tmp_path}/f", payloads=True)
    rows = rows.collect() if bodies else rows.select("file", "at").collect()
    got = sorted((r.file, r.at, bytes(r.payload)) for r in rows) if bodies else rows
    assert [b for _, _, b in got] == bodies * 2 if bodies else not got


def test_empty_table_and_odd_keys(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0
    odd = spark.createDataFrame([(None, "u", LONG), (5, "u", LONG), (5, "u", LONG), (6, "u", LONG), (6, "u", LONG)], "page_id long, url string, html string")
    warc.write_archives(odd, f"{tmp_path}/o")
    rows = warc.read_archives(spark, f"{tmp_path}/o").select(warc.page_of(F.col("record_id")).alias("i"), "record_type").collect()
    assert sorted((r.i or 0, r.record_type) for r in rows) == [(0, "response"), (5, "response"), (5, "response"), (6, "revisit"), (6, "revisit")]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert spark_result(contracts.QUERIES["op1_warc"](spark, folder)) == duck_result(duck(folder), contracts.SQL["op1_warc"])
