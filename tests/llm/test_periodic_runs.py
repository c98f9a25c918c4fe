"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mise.llm import queries
from mise.llm.periodic_runs import periodic_runs, pieces_of, runs_of


def plain_runs(words, least):
    """Every stretch of equal words at distance q, kept if no shorter period holds on it."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                own = words[i: j + q]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(draw, most=70):
    n, kinds = draw.randint(0, most), draw.choice([1, 2, 3, 5, 40])
    words = [draw.randrange(kinds) for _ in range(n)]
    if n and draw.random() < 0.6:
        a, p = draw.randrange(n), draw.randint(1, 15)
        words = [words[i] if i < a or a + (i - a) % p >= n else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_match_plain_search(least):
    draw = random.Random(least)
    for _ in range(600):
        words = random_words(draw)
        assert runs_of(words, least) == plain_runs(words, least)


@pytest.mark.parametrize("least", [4, 12])
def test_pieces_keep_every_run(least):
    draw = random.Random(least)
    for _ in range(300):
        texts = [random_words(draw) or [0] for _ in range(draw.randint(1, 5))]
        starts = np.cumsum([0, *map(len, texts)])[:-1]
        want = sorted((int(a) + s, n, q) for a, words in zip(starts, texts, strict=True) for s, n, q in plain_runs(words, least))
        ids = np.array(sum(texts, []))
        got = sorted((a + s, n, q) for a, b in pieces_of(ids, starts, least) for s, n, q in runs_of(ids[a:b].tolist(), least))
        assert got == want


def test_long_texts_stay_linear():
    assert runs_of([0] * 50_000) == [(0, 50_000, 1)]
    assert runs_of([i % 700 for i in range(50_000)]) == [(0, 50_000, 700)]


def plain_row(doc_id, text):
    """The contract, read word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else None
    if h is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_matches_plain_contract(spark, tmp_dir):
    draw = random.Random(7)
    rows = [(i, " ".join(f"w{w}" for w in random_words(draw, 120)), i) for i in range(400)]
    rows += [(400, "", 0), (401, None, 0), (None, "a b " * 20, 0), (402, " \t a b  a b\n" * 9, 0), (402, "x " * 30, 1), (402, "x " * 30, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op11_periodic_runs(spark, tmp_dir)
    assert [f.dataType.simpleString() for f in got.schema.fields[1:6]] == ["bigint"] * 5
    have = sorted((tuple(r) for r in got.collect()), key=str)
    assert have == sorted((plain_row(i, t) for i, t, _ in rows), key=str)


def test_empty_table_and_many_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs(docs).collect() == []
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda i: (i % 50).cast("string")), " ")
    big = spark.range(300).select(F.col("id").cast("string").alias("doc_id"), text.alias("text"))
    rows = periodic_runs(big).select("doc_id", "n_words", F.col("runs")[0]["period"].alias("p"), "collapsed").collect()
    assert len(rows) == 300 and {(r["n_words"], r["p"]) for r in rows} == {(5000, 50)}
    assert {r["collapsed"] for r in rows} == {" ".join(str(i % 50) for i in range(1, 51))}
