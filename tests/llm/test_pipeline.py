"""Each stage against a brute-force version on its own input."""

import hashlib

import corpus_pipeline
import duckdb
import sentencepiece
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint

import __spark_entry__ as entry
from curata.llm import contracts, line_dedup, mixing, simhash
from curata.session import settle

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_stages(spark):
    first = docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, settle(stage(spark, docs, SF))
        after[name] = docs
        if name != "pieces":
            assert docs.columns == first.columns and docs.dtypes == first.dtypes
        if name == "language":
            assert before.count() - docs.count() <= 3 and docs.join(before, ["doc_id", "text"]).count() == docs.count()
            gone = before.join(docs, "doc_id", "left_anti").collect()
            assert not [r for r in gone if len((r.text or "").split()) > 20 and sum(map(str.isalpha, r.text)) > 50]
        if name == "line_dedup":
            given = [(r.doc_id, r.text) for r in before.collect()]
            want = brute_lines(given, line_dedup.LEAST)
            texts = dict(given)
            assert {r.doc_id: r.text for r in docs.collect()} == {i: t for i, t in want.items() if t.split() or t == texts[i]}
            assert docs.where("n_chars != char_length(text)").count() == 0
        if name == "near_dedup":
            marks = [(r.doc_id, brute_fingerprint(r.text)) for r in before.collect()]
            roots = brute_components(marks, lambda x, y: (x ^ y).bit_count() <= 3)
            assert rows_of(docs) == rows_of(before.where(F.col("doc_id").isin([i for i, r in roots.items() if i == r])))
        if name == "mixing":
            con = duckdb.connect()
            documents = before.toPandas()
            con.register("documents", documents)
            taken = con.execute(mixing.MIXING_SQL.format(documents="documents")).fetchall()
            want = {i: round(t / s) for i, s, _, _, t in taken if t}
            assert {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want
            assert docs.distinct().subtract(before).count() == 0
    library = sentencepiece.SentencePieceProcessor(model_file=contracts.piece_model_path())
    texts = {r.doc_id: r.text for r in after["mixing"].collect()}
    out = docs.collect()
    assert len(out) == after["mixing"].count()
    for r in out:
        ids = library.encode(texts[r.doc_id])
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert rows_of(corpus_pipeline.run(spark, SF)) == rows_of(docs)


def test_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [
        (1, None, None, None, 0), (2, "", "en", "a", 0), (None, "the dog and the cat", "en", "a", 19), (3, "le chien et le chat", "fr", None, 19),
        (3, "le chien et le chat", "fr", None, 19), (4, "12 34", "en", "b", 5), (5, "the " * 30_000, "en", "b", 120_000), (7, "the cat", None, "b", 7),
    ]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/a")
    assert {r.doc_id for r in out.collect()} <= {None, 3, 5, 7} and out.count()
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_representatives_of_repeated_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "x y z w"), (None, "x y z w"), (None, "q"), (None, "q"), (0, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(1)).withColumn("key", F.lit(2))
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in simhash.representatives(docs).collect())
    assert got == [(-1, "q"), (0, ""), (1, "a b c d"), (1, "x y z w")]
