"""The code's properties, fingerprints against their definition, links and components against brute force."""

import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from curata import session
from curata.llm import components, contracts, simhash

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(rows, linked):
    """Smallest id reachable for each (id, thing)."""
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, x) in enumerate(rows):
        for j, y in rows[:n]:
            if linked(x, y):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in parent}


def test_the_code_is_perfect():
    rng = np.random.default_rng(0)
    low, high, errors = simhash._decoder()
    assert len(np.unique(errors)) == 2048 and np.bitwise_count(errors).max() == 3
    words = rng.integers(0, 1 << 23, 2_000)
    nearest = words ^ errors[low[words & 4095] ^ high[words >> 12]]
    assert (low[nearest & 4095] == high[nearest >> 12]).all()  # each is a codeword
    for bit in range(23):  # up to three errors do not change a codeword's index
        assert (simhash.codeword(nearest ^ (1 << bit) ^ (1 << (bit + 5) % 23)) == nearest >> 11).all()


def test_keys_guarantee_three_bits():
    rng = random.Random(1)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        own = set(simhash.own_keys(np.array([a], np.uint64))[1])
        near = set(simhash.near_keys(np.array([b], np.uint64))[1])
        assert own & near and len(near) <= 108


def test_near_keys_are_all_neighbours():
    bits = np.random.default_rng(2).integers(0, 1 << 63, 50).astype(np.uint64)
    rows, keys = simhash.near_keys(bits)
    for i, x in enumerate(bits):
        s = simhash.segments(np.array([x]))
        near = [{int(simhash.codeword(w ^ f)[0]) for f in [0, *(1 << b for b in range(n))]} for w, n in zip(s, simhash.SEGMENTS)]
        want = {n << 24 | p << 12 | q for n, (a, b) in enumerate(simhash.PAIRS) for p in near[a] for q in near[b]}
        assert sorted(keys[rows == i]) == sorted(want)


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    rng = random.Random(3)
    bits = {0}
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for bit in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << bit
            bits.add(x)
    signed = [(b - (1 << 64) if b >> 63 else b, b) for b in bits]
    want = brute_components(signed, lambda x, y: (x ^ y).bit_count() <= 3)
    codes = spark.createDataFrame([(s,) for s, _ in signed], "bits long")
    for common, block in ((simhash.COMMON, simhash.BLOCK), (1, 8), (10**6, 8)):
        monkeypatch.setattr(simhash, "COMMON", common)
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r.node: r.root for r in components.components(simhash.links(codes)).collect()}
        assert {i: got.get(i, i) for i, _ in signed} == want, common


def test_components_of_odd_graphs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(5, 5), (300, 301), (301, 300), (None, 7), (-4, 300)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {200 + i: 100 for i in range(50)} | {300: -4, 301: -4}
    assert got == want
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_odd_rows(spark):
    texts = [None, "", " \n", "One two", "one TWO", "a b c d e f", "a b c d e f", "É x", "é x"]
    rows = [(i * 3 % 10, t) for i, t in enumerate(texts)] + [(None, "one two"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bits", F.lit(0)).withColumn("first", F.lit(0))
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    marks = {(r.doc_id, r.fingerprint) for r in out}
    assert marks == {(i, f"{brute_fingerprint(t):016x}") for i, t in rows}
    zero = [r for r in out if r.fingerprint == "0" * 16]
    assert len(zero) == 4 and {r.component_id for r in zero} == {0}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_components(docs, lambda x, y: (x ^ y).bit_count() <= 3)
    rows = contracts.QUERIES["op8_simhash"](spark, SF).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{b:016x}" for i, b in docs}
    assert {r.doc_id: r.component_id for r in rows} == want


def test_keys_of_fingerprints_are_never_broadcast(spark, monkeypatch):
    """Spark takes the some eighty keys of a fingerprint for one row, so a table it thinks small would fill the driver."""
    plans = []

    def settled(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return session.settle(df, *args)

    monkeypatch.setattr(simhash, "settle", settled)
    docs = spark.createDataFrame([(i, f"a b c {i % 5}") for i in range(30)], "doc_id long, text string")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for made in (simhash.near_duplicates, simhash.representatives):
        plans.clear()
        made(docs)
        keyed = [lines for lines in plans if sum("MapInArrow" in x for x in lines) > 1]
        assert keyed and all(any("SortMergeJoin" in x for x in lines) for lines in keyed)
        for lines in keyed:
            for i in (i for i, x in enumerate(lines) if "BroadcastExchange" in x):
                below = list(itertools.takewhile(lambda x: depth(x) > depth(lines[i]), lines[i + 1 :]))
                assert not any("MapInArrow" in x for x in below)
