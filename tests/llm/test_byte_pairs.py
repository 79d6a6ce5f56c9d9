"""Ids and round trips against the library, matrices against the heap, and the query over its table."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from curata.llm import byte_pairs, contracts

PATH, PATTERN = contracts.byte_ranks()
TEXTS = [
    "", " ", "a", "Hello  world", "don't we'll I'm you've", " lead and trail ", "x\ty\nz\r\n\n", "日本語のテキスト", "é ﬁ ½ Å", "12 345 678",
    "🙂 and 👩‍👩‍👧", "nul\0in", "<|endoftext|>", "a" * 5000, "ab" * 3000, " " * 700 + "x", "​﻿zero", "!?" * 400, "é" * 300,
]


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def path(request):
    return public_tokenizers.path(request.param)


def library(path):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(n, seed=5):
    rng = random.Random(seed)
    alphabet = "abcdeht  é日ﬁ\n\t①'s9!🙂"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_ids_equal_the_library(path):
    vocabulary, own = byte_pairs.load(path, PATTERN), library(path)
    memory = byte_pairs.Memory(vocabulary)
    texts = TEXTS + noise(400)
    for part in (texts[:7], texts[7:30], texts[30:]):
        flat, ends = memory.encode(part)
        for i, text in enumerate(part):
            assert flat[ends[i] : ends[i + 1]].tolist() == own.encode_ordinary(text), text[:40]
        assert [b.as_py() for b in vocabulary.decode(flat, ends)] == [t.encode() for t in part]


def test_matrices_and_heap_merge_alike(path):
    vocabulary, own = byte_pairs.load(path, PATTERN), library(path)
    rng = random.Random(1)
    pieces = [bytes(rng.choice(b"aehinrst \xc3\xa9") for _ in range(rng.randrange(1, 256))) for _ in range(300)]
    ids, counts = vocabulary.encode_pieces(pieces)
    ends = np.cumsum(counts)
    for piece, end, n in zip(pieces, ends, counts):
        got = ids[end - n : end].tolist()
        assert got == own._core_bpe.encode_single_piece(piece)
        if piece not in vocabulary.ranks:
            assert got == vocabulary.merged_alone(piece)


def test_a_piece_of_any_length():
    vocabulary = byte_pairs.load(PATH, PATTERN)
    rng = random.Random(3)
    piece = "".join(rng.choice("etaoinshr") for _ in range(200_000))
    assert byte_pairs.Memory(vocabulary).encode([piece])[0].tolist() == library(PATH).encode_ordinary(piece)


def test_memory_may_forget(monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3)
    memory, own = byte_pairs.Memory(byte_pairs.load(PATH, PATTERN)), library(PATH)
    for text in noise(40, 8):
        assert memory.encode([text])[0].tolist() == own.encode_ordinary(text)


def test_pair_table():
    rng = np.random.default_rng(4)
    pairs = np.unique(rng.integers(0, 300, (5000, 2)), axis=0)
    table = byte_pairs.PairTable(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int32))
    assert (table(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    known = set(map(tuple, pairs.tolist()))
    others = [(a, b) for a in range(-1, 300, 7) for b in range(-1, 310, 3) if (a, b) not in known]
    a, b = np.array(others).T
    assert (table(a, b) == byte_pairs.NONE).all()


def test_rows(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate([*TEXTS, None])), "doc_id long, text string").withColumns({"IDS": F.lit(1), "__text": F.lit("x"), "decoded": F.lit(0)})
    rows = byte_pairs.encoded(docs.union(docs), PATH, PATTERN)
    own, out = library(PATH), rows.collect()
    assert len(out) == 2 * len(TEXTS) + 2
    for r in out:
        text = [*TEXTS, ""][r.doc_id]
        assert r.ids == own.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    back = byte_pairs.decoded(rows, PATH, PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {i: t.encode() for i, t in enumerate([*TEXTS, ""])}
    odd = spark.createDataFrame([(1, None), (2, [0, 1])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, bytes(r.decoded)) for r in byte_pairs.decoded(odd, PATH, PATTERN).collect()) == [(1, b""), (2, b'!"')]
    assert byte_pairs.encoded(docs.limit(0), PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        byte_pairs.encoded(docs, PATH, PATTERN, keep=["doc_id", "decoded"])


def test_query(spark):
    folder, own = "/root/testdata/sf0.001", library(PATH)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in contracts.QUERIES["op12_byte_pairs"](spark, folder).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = own.encode_ordinary(text)
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
