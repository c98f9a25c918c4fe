import hashlib
import random

import numpy as np
import pytest

from mise.llm import pieces as X

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=X.default_model())


@pytest.fixture(scope="module")
def own():
    return X.Pieces(X.default_model())


def texts():
    rng = random.Random(1)
    signs = " abcdefgh  \n\t=-_日本éßñ▁\x00😀"
    out = ["", " ", "   ", "a ", " a", "▁▁ x", "<s> </s> <0x0A> <unk>", "=" * 3000, "a" * 1001, "ab" * 2000, " " * 500 + "x", "﻿", "é"]
    out += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 150))) for _ in range(800)]
    out += ["".join(rng.choice("etaoinshr") for _ in range(1500)) for _ in range(10)]
    out += ["The quick brown fox jumps over the lazy dog. " * 30, "".join(rng.choice("abcdefgABCDEFG0123456789+/") for _ in range(20_000))]
    return out


def test_encodes_as_the_library(own, library):
    got = [ids.tolist() for ids in own.encode(texts())]
    assert got == library.encode(texts(), add_bos=True, add_eos=True)


def test_decodes_as_the_library(own, library):
    rng = random.Random(2)
    for text, ids in zip(texts(), library.encode(texts(), add_bos=True, add_eos=True), strict=True):
        assert own.decode(np.array(ids)).decode() == library.decode(ids), text
    for _ in range(800):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(261), rng.randrange(130, 258)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_blocks_and_a_full_cache_change_nothing(library, monkeypatch):
    want = library.encode(texts(), add_bos=True, add_eos=True)
    monkeypatch.setattr(X, "BLOCK_CHARS", 40)
    monkeypatch.setattr(X, "CACHE_WORDS", 5)
    assert [ids.tolist() for ids in X.Pieces(X.default_model()).encode(texts())] == want


def test_frames(spark, frame, empty, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, ""), (3, "long wörds " * 20_000)]
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in X.digests(frame(rows)).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = X.decoded(X.encoded(frame(rows)))
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert X.digests(empty).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert X.decoded(none).first()["text"] is None


def test_columns_with_any_name_are_carried(frame):
    from pyspark.sql import functions as F
    docs = frame([(1, "a b"), (2, None)]).select("*", F.lit("x").alias("whole"), F.lit("y").alias("__text"))
    got = X.digests(docs, carry=("doc_id", "whole", "__text")).collect()
    want = {r["doc_id"]: r["ids_sha256"] for r in X.digests(docs).collect()}
    assert {r["doc_id"]: r["ids_sha256"] for r in got} == want and {(r["whole"], r["__text"]) for r in got} == {("x", "y")}
