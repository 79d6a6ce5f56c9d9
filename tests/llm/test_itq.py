"""Links, components and recall against all pairs."""

import math
import random

import numpy as np
from pyspark.sql import functions as F
from test_simhash import brute_components

from curata.llm import contracts, itq


def brute(rows, cosine=itq.COSINE):
    """{id: (links, component, kept)} from the cosines of all pairs with equal labels."""

    def able(v, label):
        return v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, (np.array(v, np.float32).astype(float), label)) for i, v, label in rows if able(v, label)]
    good = [(i, (v / np.sqrt(v @ v), label)) for i, (v, label) in good]
    linked = lambda x, y: x[1] == y[1] and len(x[0]) == len(y[0]) and x[0] @ y[0] >= cosine
    n = {i: sum(linked(x, y) for j, y in good if j != i) for i, x in good}
    roots = brute_components(good, linked)
    return {i: (n.get(i, 0), roots.get(i, i), roots.get(i, i) == i) for i, _, _ in rows}


def rows_of(frame):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in frame.collect()}


def groups(seed, dim, sizes, spread):
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        out += [centre + spread * rng.standard_normal(dim) / np.sqrt(dim) for _ in range(size)]
    return [[float(x) for x in np.float32(v)] for v in out]


def test_groups_blocks_and_tables(spark, monkeypatch):
    vectors = groups(1, 64, [1] * 60 + [2] * 20 + [30, 60], 0.06)
    rows = [(i * 7 % 997, v, i % 2 if i < 90 else 1) for i, v in enumerate(vectors)]
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute(rows)
    assert max(n for n, _, _ in want.values()) > 20
    for block in (itq.BLOCK, 7):
        monkeypatch.setattr(itq.links, "__kwdefaults__", {"cosine": itq.COSINE, "block": block})
        assert rows_of(itq.near_duplicates(frame)) == want


def test_recall_at_the_threshold():
    """Pairs at a cosine of just 0.98, the hardest there are: how many meet in a table within one bit."""
    rng = np.random.default_rng(5)
    a = itq.unit(rng.standard_normal((4_000, 64)))
    other = rng.standard_normal(a.shape)
    other = itq.unit(other - (other * a).sum(1, keepdims=True) * a)
    b = 0.9801 * a + math.sqrt(1 - 0.9801**2) * other
    codes = itq.fit(a)
    x = codes(a).view(np.uint64) ^ codes(b).view(np.uint64)
    bits = np.stack([np.bitwise_count(x >> np.uint64(itq.WIDTH * t) & np.uint64((1 << itq.WIDTH) - 1)) for t in range(itq.TABLES)])
    met = ((bits <= 1).any(0) & (np.bitwise_count(x) <= itq.REACH)).mean()
    print("recall at 0.98", met)
    assert met > 0.98
    balance = np.unpackbits(codes(a).view(np.uint8).reshape(-1, 8), axis=1).mean(0)
    assert np.abs(balance - 0.5).max() < 0.1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], None), (4, None, 0), (5, [], 0),
        (6, [0.0, 0.0, 0.0], 0), (7, [0.0, -0.0, 0.0], 0), (8, [1.0, None, 0.0], 0), (9, [nan, 1.0, 0.0], 0), (10, [inf, 1.0, 0.0], 0),
        (11, [1.0, 0.0], 0), (12, [1.0, 0.01], 0), (13, [1e-30, 0.0, 0.0], 0), (14, [1e30, 1e28, 0.0], 0), (15, [1.0, 0.0, 0.0], 1),
        (-1, [-1.0, 0.0, 0.0], 0),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(0)).withColumn("able", F.lit("x"))
    want = brute(rows)
    assert want[2][0] == 3
    assert rows_of(itq.near_duplicates(frame)) == want
    more = spark.createDataFrame([(None, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (4, [1.0, 2.0], 0), (4, [1.0, 2.0], 0)], "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in itq.near_duplicates(more).fillna(-9).collect())
    assert got == [(-9, 0, -9, False)] * 2 + [(4, 1, 4, True)] * 2
    assert itq.near_duplicates(frame.limit(0)).count() == 0


def test_one_key_on_unlike_vectors(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(5, a, 0), (5, b, 0), (100, [1.0, 0.01, 0.0, 0.0], 0), (101, [0.01, 1.0, 0.0, 0.0], 0), (7, [0.0, 0.0, 1.0, 0.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in itq.near_duplicates(frame).collect())
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (7, 0, 7, True), (100, 1, 5, False), (101, 1, 5, False)]


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows)
    got = rows_of(contracts.QUERIES["op9_embeddings"](spark, folder))
    assert got.keys() == want.keys()
    found, there = sum(n for n, _, _ in got.values()), sum(n for n, _, _ in want.values())
    print("recall", found, there)
    assert all(got[i][0] <= want[i][0] for i in got) and found >= 0.98 * there
