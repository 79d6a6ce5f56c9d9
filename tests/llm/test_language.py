"""The forward algorithm against all segmentations, expected counts, and accuracy on documents not learned from."""

import numpy as np
import public_tokenizers
import pytest
import zlib
from pyspark.sql import functions as F

from curata.llm import contracts, language

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        piece = pieces.ids.get(word[:n], -1)
        rows = [piece] if piece >= 0 else list(pieces.bytes[list(word[:1].encode())]) if n == 1 else None
        if rows:
            for rest in segmentations(word[n:], pieces):
                yield rows + rest


@pytest.fixture(scope="module")
def logs():
    rng = np.random.default_rng(1)
    raw = rng.random((language.vocabulary(PATH).size, 3)) + 0.01
    return np.log(raw / raw.sum(0))


def test_forward_sums_all_segmentations(logs):
    pieces = language.vocabulary(PATH)
    words = ["▁the", "▁thing", "▁", "▁é", "▁日𓀀x", "▁information", "𓀀"]
    got = language.word_scores(words, pieces, logs)
    for word, row in zip(words, got):
        want = np.log(sum(np.exp(logs[s].sum(0)) for s in segmentations(word, pieces)))
        assert np.allclose(row, want)


def test_long_words_are_scored_whole(logs):
    pieces = language.vocabulary(PATH)
    word = "▁inthetionénd𓀀" * 2
    assert np.allclose(language._long_score(word, pieces, logs), language.word_scores([word], pieces, logs)[0])
    longer = language._long_score(word * 300, pieces, logs)
    assert np.isfinite(longer).all() and (longer < -5000).all()


def test_expected_counts(logs):
    pieces = language.vocabulary(PATH)
    p = np.exp(logs[:, 0])
    want = np.zeros(pieces.size)
    for word, n in (("▁thing", 3.0), ("▁𓀀a", 2.0)):
        ways = list(segmentations(word, pieces))
        mass = np.array([p[s].prod() for s in ways])
        for s, m in zip(ways, mass / mass.sum()):
            np.add.at(want, s, n * m)
    got = language.expected_counts(["▁thing", "▁𓀀a"], np.array([3.0, 2.0]), pieces, p)
    assert np.allclose(got, want)


def test_characters_without_a_piece(spark, logs):
    pieces = language.vocabulary(PATH)
    low = logs - 12
    for word in ("▁" + "𓀀" * 30, "▁information" + "\u1201" * 20, "▁" + "𓀀" * 31, "▁information" + "𓀀" * 60):
        spelled = [sum(low[pieces.bytes[b]] for b in c.encode()) for c in word if c in "𓀀\u1201"]
        plain = word.rstrip("𓀀\u1201")
        want = np.log(sum(np.exp(low[s].sum(0)) for s in segmentations(plain, pieces))) + sum(spelled)
        assert np.allclose(language.word_scores([word], pieces, low)[0], want), word
    p = np.exp(low[:, 0])
    n = np.array([2.0, 3.0])
    got = language.expected_counts(["▁" + "𓀀" * 30, "▁thing"], n, pieces, p)
    want = language.expected_counts(["▁", "▁thing"], n, pieces, p)
    np.add.at(want, pieces.bytes[list("𓀀".encode() * 30)], 2.0)
    assert np.allclose(got, want)
    rows = [(1, "the cat and the dog", "en"), (3, "le chat " + "𓀀" * 30, "fr"), (4, "the dog", "en"), (5, "le chien", "fr"), (7, "le chat", "fr"), (8, "a cat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learned(docs, PATH)
    assert "fr" in model.languages and np.isfinite(model.logs).all()
    odd = docs.select("doc_id", "text").union(spark.createDataFrame([(9, "the cat " + "ሁ" * 30)], "doc_id long, text string"))
    found = {r.doc_id: r for r in language.predicted(odd, model).collect()}
    assert all(0 < r.score <= 1 for r in found.values())
    assert found[1].lang_pred == found[9].lang_pred == "en" and found[7].lang_pred == "fr"


def test_accuracy_and_labels_are_not_looked_at(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learned(docs, PATH, per_language=100)
    rows = language.predicted(docs.withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit("s")), model).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum(r.lang == r.lang_pred for r in held) / len(held)
    print("held-out accuracy", right, len(held))
    assert right > 0.97 and all(0 <= r.score <= 1 for r in rows)
    blind = language.predicted(docs.select("text", F.lit("xx").alias("lang"), F.lit(0).alias("doc_id")), model)
    assert sorted((r.text, r.lang_pred) for r in blind.collect()) == sorted((r.text, r.lang_pred) for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en"), (3, "le chat et le chien", "fr"), (None, "the", "zz"), (4, None, "de"), (5, "un", None)], "doc_id long, text string, lang string"
    )
    model = language.learned(docs, PATH)
    assert set(model.languages) <= {"en", "fr"} and model.languages
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 -- 7"), (4, "the " * 9), (4, "the " * 9), (None, "x" * 3000)], "doc_id long, text string")
    rows = language.predicted(odd, model).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and all(r.score == 0 for r in rows[:3])
    assert rows[3] == rows[4] and rows[5].lang_pred in model.languages
    none = language.learned(docs.where("lang = 'zz'"), PATH)
    assert {r.lang_pred for r in language.predicted(odd, none).collect()} == {"und"}
    assert language.predicted(odd.limit(0), model).count() == 0


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = contracts.QUERIES["op7_language"](spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in rows) > 0.97 * len(rows)
