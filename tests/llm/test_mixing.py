"""Targets against the stepwise definition, repetition rates, and the query against its SQL."""

import random
from fractions import Fraction

import pytest
from harness import duck, duck_result, spark_result
from pyspark.sql import functions as F

from curata.llm import contracts, mixing


def brute_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MOST):
    """Share by weight, stop those above their limit, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, stopped = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[n] for n in stopped)
        free = [n for n in names if n not in stopped]
        target = {n: Fraction(most * sizes[n]) if n in stopped else Fraction(rest * weight[n], sum(weight[m] for m in free)) for n in names}
        above = {n for n in free if target[n] > most * sizes[n]}
        if not above:
            return target
        stopped |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{rng.randrange(1000)}é{i}": rng.choice([0, 1, 10, 1000, 10**6, 10**12]) for i in range(rng.randrange(1, 30))}
    if seed % 2:
        sizes[None] = 77
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert {r.source for r in rows} == set(sizes)
    for r in rows:
        assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert 0 <= r.rate <= mixing.MOST


def docs_of(spark, n=4_000):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randrange(1, 60), "hot" if i % 3 == 0 else rng.choice(["b", "c", "d", None])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_come_near_their_targets(spark):
    docs = docs_of(spark)
    out = mixing.mixture(docs)
    for r in out.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.1)
    assert out.where("taken > 3 * size or taken < 0").count() == 0
    again = mixing.mixture(docs.repartition(7))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_the_mixture_has_the_copies(spark):
    docs = docs_of(spark, 500).withColumn("rate", F.lit("x")).withColumn("copies", F.lit(1))
    n = {r.doc_id: r.copies for r in mixing.mixture(docs).collect() if r.copies}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == n
    assert mixed.distinct().subtract(docs).count() == 0


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, "x y", None), (None, "x y", None), (3, " é z", "b")], "doc_id long, text string, source string")
    rows = {(r.doc_id, r.size, r.source_size) for r in mixing.mixture(docs).collect()}
    assert rows == {(1, 0, 0), (2, 0, 4), (None, 2, 4), (3, 2, 2)}
    nothing = docs.where("size(split(text, ' ')) < 0")
    assert mixing.mixture(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    wordless = mixing.mixture(docs.where("doc_id in (1, 2)")).collect()
    assert all(r.taken == 0 and r.target == 0 for r in wordless)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    assert spark_result(contracts.QUERIES["op10_mixing"](spark, folder)) == duck_result(duck(folder), contracts.SQL["op10_mixing"])
