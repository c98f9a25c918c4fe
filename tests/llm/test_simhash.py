import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mise.llm import golay
from mise.llm import simhash as X
from mise.llm.components import components


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_perfect_code():
    words = np.arange(1 << 23, dtype=np.int32)[:: 997]
    index = golay.codeword_index(words)
    assert index.min() >= 0 and index.max() < 1 << 12
    counts = np.bincount(golay.codeword_index(np.arange(1 << 23, dtype=np.int32)), minlength=1 << 12)
    assert (counts == 1 << 11).all()  # spheres of radius three fill the space


def test_words_two_bits_apart_share_an_index():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 1 << 23, 300).astype(np.int32)
    for a, b in ((0, 1), (3, 22), (11, 12), (5, 5)):
        other = word ^ np.int32(1 << a) ^ np.int32((1 << b) if a != b else 0)
        one, two = ([set(i[r == k].tolist()) for k in range(len(word))] for r, i in (golay.nearby_indices(word), golay.nearby_indices(other)))
        assert all(x & y for x, y in zip(one, two, strict=True))


def test_fingerprints():
    for text in ["", " \n", "One", "one TWO", "É é A b c", "the cat sat on the mat " * 50, "a b c d e f g"]:
        assert X.fingerprint_of(text) == slow_print(text)


@pytest.mark.parametrize("limit", [64, 2])
def test_links_keep_every_component(spark, limit):
    rng = random.Random(5)
    prints = set()
    for _ in range(40):
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            prints.add(p)
            for _ in range(rng.choice([1, 2, 3])):
                p ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    found = X.links(nodes, pair_limit=limit).collect()
    value = lambda s: s & (1 << 64) - 1
    assert all((value(r["a"]) ^ value(r["b"])).bit_count() <= 2 for r in found)
    label = {r["node"]: r["label"] for r in components(X.links(nodes, pair_limit=limit)).collect()}
    groups = {}
    for p, g in zip(signed, brute_components(prints), strict=True):
        groups.setdefault(g, set()).add(p)
    got = {}
    for p in signed:
        got.setdefault(label.get(p, p), set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("distance", [0, 1])
def test_smaller_distances(spark, distance):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 3, base ^ 7, base ^ (1 << 62)]
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = {tuple(sorted((a, b))) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= distance}
    for limit in (64, 1):
        assert {(r["a"], r["b"]) for r in X.links(nodes, distance, limit).collect()} == want


def test_documents(frame, empty):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 40, 200]))]
        for k in range(rng.choice([1, 3])):
            text = list(base)
            if text and k:
                text[rng.randrange(len(text))] = "changed"
            rows.append((g * 10 + k, " ".join(text)))
    rows += [(900, None), (901, "  "), (None, "w1 w2 w3 w4"), (902, "w1 w2 w3 w4"), (902, "w1 w2 w3 w4"), (903, "long " * 30_000)]
    prints = [slow_print(t) for _, t in rows]
    label = brute_components(prints)
    least = {}
    for (i, _), g in zip(rows, label, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, label, strict=True)), key=str)
    got = sorted(map(tuple, X.near_duplicates(frame(rows)).collect()), key=str)
    assert got == want
    kept = {r["doc_id"] for r in X.drop_near(frame(rows)).filter("doc_id is not null").select("doc_id").collect()}
    assert kept == set(least.values())
    assert X.near_duplicates(empty).count() == 0 and X.drop_near(empty).count() == 0


def test_components_of_a_long_path(spark):
    n = 60
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(n)}
    assert components(edges.filter(F.lit(False))).count() == 0


def test_one_of_each_component_stays_without_ids(frame):
    far = " ".join(f"z{i}" for i in range(80))
    rows = [(1, "a b c d e"), (None, "a b c d e"), (None, far), (None, far), (None, ""), (7, "  "), (9, "own words here"), (9, "own words here")]
    got = sorted((str(r["doc_id"]), r["text"]) for r in X.drop_near(frame(rows)).collect())
    assert got == sorted([("1", "a b c d e"), ("None", far), ("7", "  "), ("9", "own words here"), ("9", "own words here")])
