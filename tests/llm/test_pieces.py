"""Normalising, encoding and spans against the library; counts through the cache against direct counts."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from curata.llm import contracts, piece_model, pieces, token_cache

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "a", "Hello  world", " lead and trail ", "x\ty\nz\r\n", "▁ mark ▁▁ in", "日本語のテキスト", "é ﬁ ½ Å",
    "🙂 and 👩‍👩‍👧", "nul\0in", "<s>special</s> <unk> <0x41>", "ﷺ①⑳ｱﾊﾟ", "a" * 5000, "​﻿zero", "tab　wide  ", "  ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def noise(n):
    rng = random.Random(5)
    alphabet = "abc deé ▁日ﬁ\n\t①½́A　🙂"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_and_round_trip_equal_the_library(library):
    model = piece_model.load(PATH)
    for text in TEXTS + noise(300):
        ids, at, begins, ends = model.encode(text)
        assert ids == library.encode(text) == at.tolist()
        assert model.decoder.decode(ids) == library.decode(ids)


def test_spans_tile_the_text_and_hold_their_pieces():
    model = piece_model.load(PATH)
    for text in TEXTS + noise(300):
        data = text.encode()
        ids, at, begins, ends = model.encode(text)
        if not data:
            assert not ids
            continue
        assert begins[0] == 0 and ends[-1] == len(data)
        assert (begins[1:] == ends[:-1]).all()
        for n, (i, b, e) in enumerate(zip(ids, begins, ends)):
            shown = data[b:e].replace(b" ", piece_model.SPACE)
            if model.texts[i].startswith(b"<0x"):
                assert shown == bytes([int(model.texts[i][3:5], 16)])
            else:
                whole = piece_model.SPACE + shown if n == 0 else shown
                assert model.texts[i] == whole


def test_compiled_map_equals_the_library():
    """The map, stripping and offsets, with a rule set compiled into the library."""
    for rule in ("nmt_nfkc", "nfkc_cf", "identity"):
        own = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
        spec = own.serialized_model_proto()
        model = piece_model.PieceModel.__new__(piece_model.PieceModel)
        fields = {n: v for n, v, _ in piece_model.message(next(v for n, v, _ in piece_model.message(spec) if n == 3))}
        model.map = piece_model.CharacterMap(fields.get(2, b""))
        model.own, model.prefix, model.strip, model.escape = None, True, True, True
        if rule != "identity":
            assert model.map.units
        for text in TEXTS + noise(400):
            normal, origin = model.normalise(text.encode())
            want, offsets = own.normalize(text, with_offsets=True)
            assert normal.decode() == want, (rule, text)
            data = text.encode()
            # offsets of the library are of characters; ours are of bytes
            at = 0
            for ch, there in zip(want, offsets):
                assert len(data[: origin[at]].decode(errors="ignore")) == there, (rule, text)
                at += len(ch.encode())


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")


def test_rows(spark, library):
    docs = frame(spark, TEXTS).withColumn("ids", F.lit(1)).withColumn("__text", F.lit("x"))
    rows = pieces.encoded(docs, PATH)
    out = rows.select("doc_id", "ids", "decoded", *[c.alias(n) for n, c in pieces.digests(rows).items()]).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        text = [*TEXTS, ""][r.doc_id]
        ids = library.encode(text)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r.span_bytes == len(text.encode())
    back = pieces.decoded(rows, PATH).collect()
    assert {r.doc_id: r.decoded for r in back} == {r.doc_id: r.decoded for r in out}
    assert pieces.encoded(docs.limit(0), PATH).count() == 0


def test_portions_cover_all():
    sizes = [3, 9, 1, 1, 20, 0, 0, 4]
    parts = list(pieces.portions(sizes, 10))
    assert [i for a, b in parts for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a == 1 or sum(sizes[a:b]) <= 10 for a, b in parts)
    assert list(pieces.portions([], 10)) == []


def test_counts_through_the_cache(spark, tmp_path, monkeypatch):
    texts = TEXTS + ["same"] * 20 + ["two spaces", "two▁spaces"]
    docs = frame(spark, texts).withColumn("content", F.lit(0)).withColumn("n_tokens", F.lit(0))
    for name in ("piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"):
        tokenizer, cache = token_cache.Tokenizer(public_tokenizers.path(name)), f"{tmp_path}/cache"
        count = token_cache._counter(tokenizer.path, tokenizer.kind)
        want = {i: (len(t.encode()), n) for i, (t, n) in enumerate(zip([*texts, ""], count([*texts, ""])))}
        for _ in range(2):
            rows = token_cache.token_counts(docs.union(docs), tokenizer, cache, limit=10).collect()
            assert len(rows) == 2 * len(want)
            assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want
            assert all(r.over_limit == (r.n_tokens > 10) for r in rows)
        stored = spark.read.parquet(cache).where(F.col("tokenizer") == tokenizer.version)
        distinct = {t.replace(" ", "▁") if name.endswith(".model") else t for t in [*texts, ""]}
        assert stored.count() == len(distinct)  # nothing twice, nothing in the second run
    more = frame(spark, ["a new text"])
    assert token_cache.token_counts(more, tokenizer, cache).count() == 2
    assert spark.read.parquet(cache).where(F.col("tokenizer") == tokenizer.version).count() == len(distinct) + 1
    assert token_cache.token_counts(docs.limit(0), tokenizer, cache).count() == 0


def test_rows_without_a_key(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None), (1, "a b")], "doc_id long, text string")
    rows = token_cache.token_counts(docs, token_cache.Tokenizer(PATH), f"{tmp_path}/c").collect()
    assert sorted(r.n_tokens for r in rows) == [0, 2, 2, 2]


@pytest.mark.parametrize("name", ["op2_sentencepiece", "op5_token_counts"])
def test_queries(spark, library, name):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in contracts.QUERIES[name](spark, folder).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text)
        assert rows[doc_id].n_tokens == len(ids)
        if name.startswith("op2"):
            assert rows[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert rows[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        else:
            assert rows[doc_id].n_bytes == len(text.encode()) and rows[doc_id].over_limit == (len(ids) > 4096)
