"""N-gram buckets against zlib, selection against a sort, the draw against its definition, and the query against its SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from harness import duck, duck_result, spark_result
from pyspark.sql import functions as F

from curata.llm import contracts, hashed_ngrams, resampling

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def brute_buckets(text, buckets, longest=3):
    words = WORD.findall(text.encode().lower())
    grams = [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(g) % buckets for g in grams)


def noise(n, seed=3):
    rng = random.Random(seed)
    alphabet = "abZ09 é日🙂\n\t.,_-\0"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]
    return [*texts, "", " ", "a", "x" * 500 + " y " + "é" * 400, ("Long " * 3000 + "ß" * 300 + "\n") * 3, "w" * 9000, "a b"]


@pytest.mark.parametrize("held", [1 << 20, 700, 64, 1])
def test_buckets_equal_those_of_joined_words(held):
    texts = noise(200)
    column = pa.array(["skipped", *texts])[1:]
    words, found = np.zeros(len(texts), int), [Counter() for _ in texts]
    for first, rows, row, bucket, per_row in hashed_ngrams.of_texts(column, 997, 3, held):
        words[first : first + rows] += per_row
        for r, b in zip(row.tolist(), bucket.tolist()):
            found[first + r][b] += 1
    for i, text in enumerate(texts):
        assert (words[i], found[i]) == brute_buckets(text, 997), (i, text[:50])


def brute(rows, target, buckets=50, least=3, percent=20, seed=42):
    def total(texts):
        return sum((brute_buckets(t or "", buckets)[1] for t in texts), Counter())

    s, t = total(x for _, x in rows), total(target)
    n_s, n_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * n_s / (float(s[b] + 1) * n_t))) for b in range(buckets)]
    out = []
    for key, text in rows:
        n, found = brute_buckets(text or "", buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * c for b, c in found.items())
        out.append([key, n, sum(found.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    draw = percent * len(able) // 100
    rank = {id(r): i + 1 for i, r in enumerate(able[:draw])}
    return sorted([(r[0], *r[2:], rank.get(id(r))) for r in out], key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "RANK": F.lit(1), "key": F.lit(0)})


@pytest.mark.parametrize("few", [0, 4, 4096])
def test_draw(spark, monkeypatch, few):
    monkeypatch.setattr(resampling, "FEW", few)
    monkeypatch.setattr(resampling, "PORTION", 16)
    rng = random.Random(11)
    vocabulary = ["aa", "Bb", "cé", "d1", "ee", "日本"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(12)))) for i in range(400)]
    rows += [(7, "aa bb cé")] * 5 + [(None, "aa aa aa aa")] * 3 + [(500, None), (501, ""), (None, None)]
    target = ["aa bb aa bb", None, "日本 ee"]
    docs = frame(spark, rows).repartition(5)
    out = resampling.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), buckets=50, least=3, percent=20)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, target)


def test_cutoff_is_exact_for_every_draw(spark, monkeypatch):
    monkeypatch.setattr(resampling, "FEW", 0)
    monkeypatch.setattr(resampling, "PORTION", 4)
    rng = random.Random(2)
    rows = [(rng.randrange(6), rng.choice([None, 1, 2, 3]), rng.randrange(2)) for _ in range(60)]
    places = resampling.settle(resampling.placed(spark.createDataFrame(rows, "score long, key long, n_features long").repartition(3)))
    want = sorted((-s, k is None, k, n) for s, k, n in ((s, k, n) for s, k, n in rows) if k is not None)
    want += sorted((-s, True, 0, n) for s, k, n in rows if k is None)
    want = sorted(want, key=lambda r: (r[0], r[1], r[2], r[3]))
    for draw in (1, 2, 17, 31, 59, 60):
        got = resampling.cutoff(places, draw)
        assert (got.down, got.unkeyed, got.key or 0, got.n_features) == want[draw - 1]
    assert resampling.cutoff(places, 61) is None and resampling.cutoff(places, 0) is None


def test_nothing(spark):
    nothing = frame(spark, [(1, "a")]).where("doc_id > 1")
    assert resampling.resampled(nothing, nothing).count() == 0
    some = resampling.resampled(frame(spark, [(1, "a b c d")]), nothing, least=1, percent=100).collect()
    assert [r.rank for r in some] == [1]


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y"), (None, "y")], "doc_id string, text string")
    out = resampling.resampled(docs, docs, least=1, percent=100).collect()
    assert sorted(r["rank"] for r in out) == [1, 2, 3]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert spark_result(contracts.QUERIES["op11_resampling"](spark, folder)) == duck_result(duck(folder), contracts.SQL["op11_resampling"])
