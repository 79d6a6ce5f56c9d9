"""Line dedup against a direct search for all repeated runs."""

import random

from pyspark.sql import functions as F

from curata.llm import contracts, line_dedup


def brute(rows, least):
    """Lines left of each document: every run with enough words is compared with every earlier one."""
    docs = {i: [x.strip() for x in t.split("\n")] for i, t in rows if t is not None}
    first, later = {}, []
    for i in sorted(docs):
        lines = docs[i]
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b].split())
                if words >= least:
                    run = tuple(lines[a : b + 1])
                    if run in first:
                        later.append((i, a, b, *first[run]))
                    else:
                        first[run] = i, b
    gone = {i: set() for i in docs}
    for i, a, b, source, end in later:
        gone[i] |= set(range(max(a, end + 1) if source == i else a, b + 1))
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]) for i, t in rows if t is not None}


def noise(seed, docs, kinds, least):
    rng = random.Random(seed)
    lines = ["", "  ", *(" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, least + 3))) for _ in range(kinds))]
    return [(i * 7 % 101 - 50, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 14)))) for i in range(docs)]


def left(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_against_all_runs(spark):
    for seed, kinds, least in ((1, 4, 6), (2, 12, 9), (3, 2, 5), (4, 60, 12)):
        rows = noise(seed, 60, kinds, least)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert left(line_dedup.deduplicated(docs, least=least)) == brute(rows, least), seed


def test_picks_are_rightmost_minima():
    for _, text in noise(5, 80, 5, 6):
        digests, words = line_dedup.sketch(text)
        hashes = [digests[i * 16 : i * 16 + 8] for i in range(len(words))]
        want = []
        for a, b in line_dedup.windows_from(words, 6):
            assert sum(words[a : b + 1]) >= 6 > sum(words[a:b])
            at = max(i for i in range(a, b + 1) if hashes[i] == min(hashes[a : b + 1]))
            want += [at] if at not in want else []
        assert line_dedup.picks(digests, words, 6) == want


def test_a_frequent_passage_and_copies(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own {i} line\n{passage}\nend {i}") for i in range(300)] + [(1000 + i, "\n".join(["short"] * 5)) for i in range(50)]
    rows += [(2000 + i, f"{passage} x\nsame") for i in range(3)]
    out = left(line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[0] == rows[0][1] and all(out[i] == f"own {i} line\nend {i}" for i in range(1, 300))
    assert all(out[1000 + i] == "\n".join(["short"] * 5) for i in range(50))
    assert out[2000] == rows[350][1] and out[2001] == out[2002] == ""


def test_odd_rows(spark):
    long = "a b c d e f\ng h"
    rows = [(None, long), (3, long), (3, long), (4, None), (5, ""), (6, long + "\n\n"), (7, "\n".join(["x y"] * 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("old")).withColumn("k", F.lit(1)).withColumn("__k", F.lit(2))
    out = line_dedup.deduplicated(docs, least=6)
    assert out.columns == ["doc_id", "text", "k", "__k", "n_lines", "n_removed", "removed"]
    got = sorted(((r.doc_id or 99), r.text, r.n_lines, r.n_removed) for r in out.collect() if r.text is not None)
    assert got == [(3, long, 2, 0), (3, long, 2, 0), (5, "", 1, 0), (6, "\n", 4, 2), (7, "x y\nx y\nx y", 9, 6), (99, "", 2, 2)]
    assert [(r.doc_id, r.n_lines) for r in out.where("text is null").collect()] == [(4, 0)]
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0


def test_text_keys_and_clashing_names(spark):
    long = "a b c d e f\ng h"
    docs = spark.createDataFrame([("b2", long), ("a1", long + "\nmore"), (None, long), ("", "x")], "doc_id string, text string")
    docs = docs.withColumns({"__runs": F.lit(1), "Removed": F.lit("old"), "__d": F.lit(2)})
    out = line_dedup.deduplicated(docs, least=6)
    assert out.columns == ["doc_id", "text", "__runs", "__d", "n_lines", "n_removed", "removed"]
    assert {(r.doc_id, r.text) for r in out.collect()} == {("a1", long + "\nmore"), ("b2", ""), (None, ""), ("", "x")}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert left(contracts.QUERIES["op6_line_dedup"](spark, folder)) == brute(rows, line_dedup.LEAST)
