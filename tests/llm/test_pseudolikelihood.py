"""The network against a direct version, its gradient against differences, and what the scores tell apart."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curata.llm import contracts, pseudolikelihood as P

SF = "/root/testdata/sf0.001"


def model(seed=0, n=3000):
    rng = np.random.default_rng(seed)
    classes, inside = P.classed(rng.integers(0, 50, n) ** 3)
    return P.Model(classes, inside, P.initial() + 0.1 * rng.standard_normal(P.SIZE).astype(np.float32))


def brute(ids, m):
    """Word by word, straight from the definition."""
    w = {k: v.astype(float) for k, v in P.views(m.weights).items()}
    total = 0.0
    for i, word in enumerate(ids):
        around = [m.classes[ids[i + o]] if 0 <= i + o < len(ids) else P.CLASSES for o in (-2, -1, 1, 2)]
        hidden = np.tanh(np.concatenate([w["embedding"][c] for c in around]) @ w["inner"] + w["inner_bias"])
        logits = hidden @ w["outer"] + w["outer_bias"]
        total += logits[m.classes[word]] - np.log(np.exp(logits).sum()) + m.inside[word]
    return total


def test_scores_equal_the_definition(monkeypatch):
    m, rng = model(), np.random.default_rng(2)
    lists = [rng.integers(0, 3000, n).astype("<u2") for n in (0, 1, 2, 3, 50, 0, 200)]
    monkeypatch.setattr(P, "AT_ONCE", 64)
    got = P.conditional_sums(lists, m, m.tables())
    assert np.allclose(got, [brute(x, m) for x in lists], rtol=1e-4)


@pytest.mark.parametrize("size", [0.1, 20.0])
def test_exponentials_need_a_shift_only_for_large_weights(size):
    """Both ways give the same step and scores, and weights whose exponentials leave a float are still shifted."""
    rng = np.random.default_rng(4)
    weights = P.initial() + (size * rng.standard_normal(P.SIZE)).astype(np.float32)
    parts = P.views(weights)
    assert P.mild(parts) == (size < 1)
    logits = (np.tanh(rng.standard_normal((50, P.HIDDEN))) @ parts["outer"] + parts["outer_bias"]).astype(np.float32)
    target = rng.integers(0, P.CLASSES, 50)
    want = P.log_softmax(logits.astype(float))[np.arange(50), target]
    assert np.allclose(P.log_softmax_at(logits.copy(), target, not P.mild(parts)), want, rtol=1e-4, atol=1e-4)
    trainer = P.Trainer(weights)
    trainer.step(rng.integers(0, P.CLASSES + 1, (50, 4)).astype(np.int16), target.astype(np.int16))
    assert np.isfinite(trainer.weights).all() and not (trainer.weights == weights).all()


def test_probabilities_sum_to_one():
    for n in (3000, 40, 2, 1):
        m = model(1, n)
        mass = np.bincount(m.classes, np.exp(m.inside.astype(float)), P.CLASSES)
        assert np.allclose(mass[np.unique(m.classes)], 1, atol=1e-3)
        assert m.classes[-1] == P.SPELLED and (m.classes[:-1] != P.SPELLED).all()


def test_gradient():
    rng = np.random.default_rng(3)
    context, target = rng.integers(0, P.CLASSES + 1, (40, 4)), rng.integers(0, P.CLASSES, 40)

    def loss(weights):
        w = P.views(weights)
        x = w["embedding"][context].reshape(40, -1)
        logits = np.tanh(x @ w["inner"] + w["inner_bias"]) @ w["outer"] + w["outer_bias"]
        return -P.log_softmax(logits)[np.arange(40), target].mean()

    trainer = P.Trainer(P.initial())
    before = trainer.weights.copy()
    trainer.step(context, target)
    gradient = np.sqrt(trainer.squares - 1e-6) * np.sign(before - trainer.weights)
    wide = before.astype(float)
    for i in rng.choice(np.flatnonzero(np.abs(gradient) > 1e-3), 40):
        step = np.zeros(P.SIZE)
        step[i] = 1e-5
        assert np.isclose((loss(wide + step) - loss(wide - step)) / 2e-5, gradient[i], rtol=0.05, atol=2e-4)


def test_every_position_is_learned_from_once(monkeypatch):
    rng = np.random.default_rng(5)
    lists = [rng.integers(0, P.CLASSES, n) for n in (0, 1, 2, 3, 15, 50, 0, 700)]
    taken = []
    monkeypatch.setattr(P.Trainer, "step", lambda self, context, target: taken.extend(map(tuple, np.column_stack([context, target]).tolist())))
    for rounds in (1, 2, 3):
        taken.clear()
        for turn in range(rounds):
            P.Trainer(P.initial()).learn(lists, turn, rounds)
        line, places, _ = P.laid_out(lists)
        assert sorted(taken) == sorted(map(tuple, np.column_stack([line[places[:, None] + P.OFFSETS], line[places]]).tolist()))


def spelled_by_hand(word, counts):
    """Log-probability of a word's bytes and its end, each after the one before, from {(byte, byte): n}."""
    marks = [P.EDGE, *word, P.EDGE]
    total = 0.0
    for x, y in zip(marks, marks[1:]):
        total += math.log((counts[x, y] + 1) / (sum(n for (a, _), n in counts.items() if a == x) + P.EDGE + 1))
    return total


def test_words_are_counted_one_by_one(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(80)], k=60) + rng.sample([f"r{i}é" for i in range(3000)], 5)) for _ in range(300)]
    number = Counter(w.encode() for t in texts for w in t.split())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(P, "COUNTED", 50)
    words = P.vocabulary(docs, "text", own=100)
    least = sorted(number.values())[-101]
    first = sorted((-n, w) for w, n in number.items() if n > least)
    assert 80 <= len(first) <= 100 and words.words == [w for _, w in first] and words.counts.tolist() == [*(-n for n, _ in first), sum(number.values()) + sum(n for n, _ in first)]
    pairs = Counter()
    for w in number.keys() - set(words.words):
        marks = [P.EDGE, *w, P.EDGE]
        for pair in zip(marks, marks[1:]):
            pairs[pair] += number[w]
    some = [*list(number)[::400], b"unseen", b"x"]
    assert words.log_spelled(some) == pytest.approx([spelled_by_hand(w, pairs) for w in some])
    for row in P.in_units(docs, words, "text", "doc_id").collect():
        split = texts[row.key].encode().split()
        ids = np.frombuffer(row.ids, "<u2")
        assert [words.words[i] if i < len(first) else None for i in ids] == [w if w in words.words else None for w in split]
        assert row.spelled == pytest.approx(sum(spelled_by_hand(w, pairs) for w in split if w not in words.words))
    few = P.vocabulary(docs, "text")
    assert len(few.words) == len(number) and few.counts[-1] == 0


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_pairs_of_bytes_are_read_from_any_array(kind):
    """Also from parts of one, whose bytes begin elsewhere, from filtered ones and empty words."""
    rng = random.Random(9)
    whole = pa.array([rng.randbytes(rng.randrange(0, 9)) for _ in range(300)], kind)
    part = whole.slice(50, 100)
    for words in (whole, part, part.filter(pa.array([i % 3 == 0 for i in range(100)])), whole.slice(7, 0), pa.array([], kind)):
        marked = [(i, [P.EDGE, *w, P.EDGE]) for i, w in enumerate(words.to_pylist())]
        want = [(a * (P.EDGE + 1) + b, i) for i, marks in marked for a, b in zip(marks, marks[1:])]
        pairs, owner = P.byte_pairs_of(words)
        assert list(zip(pairs.tolist(), owner.tolist())) == want


def test_words_of_equal_counts_are_all_in_or_all_out(spark):
    """At either side of any place, and the table of words is read few times to find that out."""
    number = {"a": 9, "b": 7, "c": 7, "d": 7, "e": 2, "f": 1, "g": 1}
    docs = spark.createDataFrame([(" ".join(w for w, n in number.items() for _ in range(n)),), (None,), ("",)], "text string")
    for own, first in enumerate(["", "a", "a", "a", "abcd", "abcde", "abcde", "abcdefg", "abcdefg"]):
        words = P.vocabulary(docs, "text", own)
        assert b"".join(words.words).decode() == first, own
        assert words.counts.tolist() == [*(number[w] for w in first), sum(n for w, n in number.items() if w not in first)]
    assert P.vocabulary(docs.limit(0), "text").counts.tolist() == [0]
    context = spark.sparkContext
    context.setJobGroup("vocabulary", "")
    try:
        P.vocabulary(docs, "text", 3)
        assert len(context.statusTracker().getJobIdsForGroup("vocabulary")) <= 9
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_words_of_many_texts_at_once_are_those_of_split():
    odd = ["", " a", "b ", "a  b\t\n c\x0b\x0cd\r", "\x1c a\x1f\x85 b c\xa0d\x00e", " ", "é ü", "\u2003x y"]
    for some, texts in ((pa.array(odd), odd), (pa.array(odd).slice(2, 4), odd[2:6]), (pa.array([], pa.string()), [])):
        words, sizes = P.words_in(some)
        split = [t.encode().split() for t in texts]
        assert words.to_pylist() == [w for x in split for w in x] and sizes.tolist() == [len(x) for x in split]


def test_every_word_has_its_place_in_a_class():
    """Neither classes nor the words in them end at a number: counts tell any two words of a class apart, and nothing is left out."""
    counts = np.arange(1, P.OWN + 2)[::-1] ** 2
    classes, inside = P.classed(counts)
    assert len(classes) == len(inside) == P.OWN + 1 and set(classes.tolist()) == set(range(P.CLASSES))
    totals = np.bincount(classes, counts + 1.0, P.CLASSES)
    assert np.allclose(np.exp(inside.astype(float)), (counts + 1) / totals[classes], rtol=1e-5)


def test_the_query_gives_the_likelihood(spark):
    """Trained by the operator, scored by the definition."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(200)], k=rng.randrange(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    m = P.trained(docs)
    unit = {w: i for i, w in enumerate(m.words.words)}
    want = {i: brute([unit[w.encode()] for w in t.split()], m) for i, t in enumerate(texts)}
    got = {r.doc_id: r for r in P.pseudo_likelihood(docs).collect()}
    for i, t in enumerate(texts):
        n = len(t.split())
        assert got[i].n_tokens == n and got[i].log_likelihood == pytest.approx(want[i], rel=1e-4, abs=1e-4)
        assert (got[i].per_token is None) == (n == 0)
        if n:
            assert got[i].per_token == pytest.approx(want[i] / n, rel=1e-4) and got[i].perplexity == pytest.approx(math.exp(-want[i] / n), rel=1e-3)


def test_order_matters_to_the_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").select("doc_id", "text")
    rng = random.Random(4)
    pattern = [" ".join(rng.choice(["the", "a"]) + f" {x} of {x}s ." for x in rng.choices("bcdfgh", k=40)) for _ in range(200)]
    known = spark.createDataFrame(list(enumerate(pattern, 10**6)), "doc_id long, text string").union(docs).coalesce(2)
    m = P.trained(known, rounds=3)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in pattern]
    both = spark.createDataFrame([(0, t) for t in pattern] + [(1, t) for t in mixed], "doc_id long, text string")
    means = {r.key: r.m for r in P.scored(both, m).groupBy("key").agg(F.avg(F.col("log_likelihood") / F.col("n_tokens")).alias("m")).collect()}
    assert means[0] > means[1] + 0.3, means


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (None, "one"), (5, "x" * 9000), (6, "w " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("?")).withColumn("ids", F.lit(0))
    out = P.pseudo_likelihood(docs).collect()
    assert [r.n_tokens for r in sorted(out, key=lambda r: r.doc_id or 0)] == [1, 0, 0, 0, 1, 1, 1, 30_000]
    assert all(r.log_likelihood == 0 and r.perplexity is None for r in out if r.n_tokens == 0)
    assert len({r.log_likelihood for r in out if r.doc_id in (4, None)}) == 1
    assert all(r.perplexity > 1 for r in out if r.n_tokens)
    assert P.pseudo_likelihood(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = contracts.QUERIES["op4_pseudo_likelihood"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(t.encode().split()) for i, t in texts.items()}
