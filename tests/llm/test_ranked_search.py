"""Ranked search against scores of all documents, one by one."""

import math
import random
import re

import numpy as np
import pytest

from mise.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain_ranked(docs, items, best=10):
    own = [(d, plain_terms(t)) for d, t in docs]
    own = [(d, t) for d, t in own if t]
    n_docs, n_terms = len(own), sum(len(t) for _, t in own)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        asked = plain_terms(text)
        df = {x: sum(x in t for _, t in own) for x in set(asked)}
        w = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) for x in df}
        for d, t in own:
            m = 100 - 75 + (75 * len(t) * n_docs) // n_terms
            score = sum(w[x] * ((1000000000 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in asked)
            if score > 0:
                scored.append((-score, d is None, d, score))
        scored.sort(key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        out += [(item, i + 1, r[2], r[3]) for i, r in enumerate(scored[:best])]
    return out


def check(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    got = R.ranked(d, q, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "int", "bigint", "bigint"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_ranked(docs, items)))


def prose(draw, words, n):
    return " ".join(draw.choice(words) for _ in range(n))


@pytest.mark.parametrize("tree_terms,deepest", [(1 << 20, 24), (40, 24), (1 << 20, 1)])
def test_matches_plain_scores(spark, monkeypatch, tree_terms, deepest):
    monkeypatch.setattr(R, "TREE_TERMS", tree_terms)
    monkeypatch.setattr(R, "DEEPEST", deepest)
    draw = random.Random(5)
    words = ["the", "Of", "año", "x1", "q r", "7", "ÄB", "rare"] + [f"w{i}" for i in range(60)]
    docs = [(i, prose(draw, words[:draw.choice([4, 20, 68])], draw.randint(1, 60))) for i in range(250)]
    docs += [(1000 - i, docs[7][1]) for i in range(30)] + [(300, ""), (301, None), (302, "!! --"), (303, "the " * 3000)]
    items = [(i, prose(draw, words, draw.randint(1, 25))) for i in range(25)] + [(90, None), (91, "nowhere"), (92, docs[7][1])]
    check(spark, docs, items)


def test_ties_nulls_and_repeated_rows(spark):
    docs = [(5, "a b"), (5, "a b"), (None, "a b"), (3, "A-b"), (None, "b"), (2, None), (9, "c")] + [(100 + i, "zz yy") for i in range(15)]
    check(spark, docs, [(1, "a"), (1, "a"), (1, "b b"), (None, "c"), (2, ""), (3, "zz"), (4, "a c zz")])


def test_items_in_blocks(spark):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, prose(draw, words, 20)) for i in range(60)]
    check(spark, docs, [(i, prose(draw, words, 8)) for i in range(12)], item_bytes=100)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.ranked(docs, items.limit(0)).collect() == []
    assert R.ranked(docs.limit(0), items).collect() == []
    named = R.ranked(docs.selectExpr("'x' doc_id", "text"), items)  # ids of another type
    assert [tuple(r) for r in named.collect()] == [(1, 1, "x", 287 * (10**9 // (1000 + 8 * 100)))]


def test_bounds_hold_below_every_node():
    draw = random.Random(2)
    for _ in range(40):
        terms = draw.choice([4, 30])
        vectors = sorted(tuple(sorted(draw.sample(range(terms), draw.randint(1, 4)))) for _ in range(40))
        starts = np.cumsum([0, *map(len, vectors)])
        ranks = np.array([t for v in vectors for t in v])
        counts = np.array([draw.randint(1, 4) for _ in ranks])
        m = np.array([draw.randint(25, 200) for _ in vectors])
        tree = R.grow(starts, ranks, counts, m, terms)
        item, weight = np.arange(terms), np.array([draw.randint(1, 90) for _ in range(terms)])
        score = [sum(int(weight[r]) * (10**9 * int(c) // (1000 * int(c) + 8 * int(m[i])))
                     for r, c in zip(ranks[starts[i]: starts[i + 1]], counts[starts[i]: starts[i + 1]], strict=True)) for i in range(40)]

        def below(node):
            if tree.leaf[node] >= 0:
                return [int(tree.leaf[node])]
            return [x for c in range(tree.first[node], tree.stop[node]) for x in below(c)]

        assert below(0) == list(range(40))
        for node in range(len(tree.first)):
            if tree.leaf[node] < 0:
                for c, high in zip(range(tree.first[node], tree.stop[node]), R.bounds(tree, node, item, weight), strict=True):
                    mine = [score[x] for x in below(c)]
                    assert high >= max(mine) and (tree.leaf[c] < 0 or high == mine[0])
