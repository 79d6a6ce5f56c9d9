"""Phrases against counting all n-grams, vertical partitioning at any group size, exact scores, and the query against its SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from harness import duck, duck_result, spark_result
from pyspark.sql import functions as F

from curata.llm import contracts, phrases


def brute_nodes(rows, longest):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, least, longest=5, share=100, top=2000):
    f, n = brute_nodes(rows, longest)
    nodes = {p: c for p, c in f.items() if c >= least}
    out = []
    for (lang, *words), a in nodes.items():
        if len(words) < 2:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        held = any(
            100 * c >= share * a and any(p[i : i + len(words)] == tuple(words) for i in range(1, len(p) - len(words) + 1))
            for p, c in nodes.items()
            if p[0] == lang and len(p) - 1 > len(words)
        )
        if not held:
            out.append((lang, -score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang]))
    result, place = [], Counter()
    for lang, score, a, phrase, l, r, total in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            result.append((lang, place[lang], phrase.decode(), -a, l, r, total, -score))
    return result


def made(n, seed=1):
    rng = random.Random(seed)
    words = ["a", "B", "of", "the", "é", "日本", "x\0", "x\x01y", "ÀB", "of"]
    marks = [" ", "  ", "\t", ", ", ". ", "\n", " "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(25)))
        rows.append((rng.choice(["en", "en", "de", None]), text + rng.choice(["", "the end of it all now", "The End. of it"])))
    return rows + [("en", None), (None, ""), ("xx", "lonely words"), ("en", "a " * 500), ("en", " ,;.")]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    return docs.withColumns({"phrase": F.lit(1), "n": F.lit("x"), "GROUP": F.lit(0), "leaf": F.lit(0)})


@pytest.mark.parametrize("group,slots", [(1, 1 << 22), (7, 64), (1 << 18, 1 << 10)])
def test_collocations(spark, group, slots):
    rows = made(120)
    docs = frame(spark, rows).repartition(3)
    got = phrases.collocations(docs, least=5, group=group, slots=slots, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, top=40)


def test_share_and_length(spark):
    rows = made(60, 9)
    got = phrases.collocations(frame(spark, rows), least=4, longest=3, share=60, top=None)
    assert sorted((r.lang, r.phrase, r.a, r.score) for r in got.collect()) == sorted((r[0], r[2], r[3], r[7]) for r in brute(rows, 4, 3, 60, 10**9))


def test_all_nodes(spark):
    rows = made(50, 4)
    nodes, sizes = phrases.frequent(frame(spark, rows), least=3, group=5, slots=256)
    f, n = brute_nodes(rows, 5)
    want = {(p[0], " ".join(p[1:])): c for p, c in f.items() if c >= 3}
    got = nodes.collect()
    assert len(got) == len(want) and {(r.lang, r.phrase): r.n for r in got} == want
    assert all(r.words == len(r.phrase.split(" ")) for r in got)
    assert {r.lang: r.n for r in sizes.collect()} == {k: v for k, v in n.items() if v}


def test_words_may_be_forgotten_and_leaves_sent_early(spark, monkeypatch):
    monkeypatch.setattr(phrases, "REMEMBERED", 3)
    monkeypatch.setattr(phrases, "HELD", 200)
    monkeypatch.setattr(phrases, "HELD_LEAVES", 20)
    rows = made(80, 12)
    docs = frame(spark, rows)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    everything = phrases.Filter(np.ones(64, bool), np.ones(8, bool))
    leaves = phrases.suffixes(texts, everything, 3, 4).collect()
    f, n = brute_nodes(rows, 3)
    assert len({(r.lang, r.leaf) for r in leaves}) == len(leaves)
    for lang in n:
        assert sum(r.n for r in leaves if r.lang == lang) == n[lang]
    for (lang, *words), count in list(f.items())[:200]:
        assert sum(r.n for r in leaves if r.lang == lang and r.leaf.split(" ")[: len(words)] == words) == count


def test_groups_hold_twice_their_size_at_most(spark):
    rows = made(150, 6)
    texts = spark.createDataFrame([(x or "und", t or "") for x, t in rows], "lang string, text string")
    leaves = phrases.settle(phrases.suffixes(texts, phrases.Filter(np.ones(64, bool), np.ones(8, bool)), 5, 3))
    grouped, above = phrases.partitioned(leaves, 5, 20)
    sizes = [r["count"] for r in grouped.groupBy("group").count().collect()]
    assert max(sizes) <= 40 and sum(sizes) == leaves.count()
    assert above.count() > 0


def test_scores_are_exact_beyond_64_bits(spark):
    nodes = spark.createDataFrame(
        [("l", "a b", 2, 10**12), ("l", "a", 1, 10**12 + 7), ("l", "b", 1, 10**12 + 9)], "lang string, phrase string, words int, n long"
    )
    sizes = spark.createDataFrame([("l", 10**15 + 3)], "lang string, n long")
    assert [r.score for r in phrases.scored(nodes, sizes).collect()] == [1000 * 10**12 * (10**15 + 3) // ((10**12 + 7) * (10**12 + 9))]


def test_nothing(spark):
    docs = frame(spark, [("en", "a b")])
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(docs.where("lang = 'x'")).count() == 0
    assert phrases.collocations(frame(spark, [("en", None), (None, " . ")])).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    assert spark_result(contracts.QUERIES["op13_collocations"](spark, folder)) == duck_result(duck(folder), contracts.SQL["op13_collocations"])
