"""Winnowing against a direct version in Python, its match guarantee, and neighbours in the order of keys."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from curata.llm import contracts, winnow

MASK = (1 << 64) - 1
TOKEN = re.compile(winnow.TOKEN.replace(r"\x{20000}-\x{3FFFF}", "\U00020000-\U0003ffff"))


def brute(text, k=winnow.K, w=winnow.W):
    """(position, hash) of the kept grams, straight from the definition."""
    tokens = [xxhash.xxh64_intdigest(t.encode(), seed=42) for t in TOKEN.findall(text or "")]
    if not tokens:
        return []
    turned = lambda x, n: (x << n | x >> 64 - n) & MASK
    grams = []
    for i in range(max(len(tokens) - k, 0) + 1):
        mixed = 0
        for j in range(k):
            mixed ^= turned(tokens[i + j], k - 1 - j) if i + j < len(tokens) else 0
        grams.append(mixed >> 33)
    kept = []
    for i in range(max(len(grams) - w, 0) + 1):
        window = grams[i : i + w]
        at = max(j for j, g in enumerate(window, i) if g == min(window))
        if not kept or kept[-1] != (at, grams[at]):
            kept.append((at, grams[at]))
    return kept


def shown(kept):
    return "".join(f"{h:08x}" for _, h in kept)


def near(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    order = sorted((i, t or "") for i, t in rows)
    out = {}
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b = brute(text), brute(edited)
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b), near(a, b), near(a, brute(following)), [p for p, _ in a])
    return out


def check(rows, got):
    want = expected(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r[0]], r[0]


def texts(n):
    rng = random.Random(3)
    some = ["a", "b", "cé", "the", "x" * 30, "日本語", "🙂", "of"]
    return ["".join(rng.choice(some) + rng.choice(" \n\t") for _ in range(rng.choice([0, 1, 3, 5, 40, 300]))) for _ in range(n)]


def test_against_brute_force(spark):
    rows = list(zip([7, -3, 10**12, 0, *range(20, 140)], [None, "", "  \n", "one", *texts(120)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(0)).withColumn("key", F.lit("k"))
    check(rows, winnow.edited_likeness(docs.repartition(5)).collect())
    alone = {r.doc_id: r for r in winnow.fingerprints(docs).collect()}
    assert all(alone[i].fingerprint == shown(brute(t)) and alone[i].n_chars == len(t or "") for i, t in rows)


def test_match_guarantee(spark):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(50)}" for _ in range(n)]
    rows = []
    for _ in range(60):
        shared = words(winnow.K + winnow.W - 1)
        rows.append((" ".join(words(rng.randrange(60)) + shared + words(60)), " ".join(words(rng.randrange(9)) + shared)))
    pairs = spark.createDataFrame(rows, "a string, b string")
    a, b = (winnow.kept_hashes(winnow.winnowed(F.col(c))) for c in "ab")
    assert pairs.where(F.size(F.array_intersect(a, b)) == 0).count() == 0


def test_odd_tables(spark):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    assert winnow.edited_likeness(docs([])).count() == 0
    check([(5, "a b c d e f")], winnow.edited_likeness(docs([(5, "a b c d e f")])).collect())
    twice = winnow.edited_likeness(docs([(1, "p q r s"), (1, "p q r s"), (2, "z y"), (2, "a b c d"), (None, "k l")])).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in twice) == [(0, 3), (1, 7), (1, 7), (2, 3), (2, 7)]
    for r in twice:
        text = {1: "p q r s" [:4] + "a b", 0: None}.get(r.doc_id or 0, "")
        if r.doc_id is None:
            assert r.edited_sha256 is None and r.near_next is None and r.fingerprint
        if r.doc_id == 1:
            assert r.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_main_path_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = winnow.edited_likeness(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(rows, contracts.QUERIES["op3_winnowing"](spark, folder).collect())
