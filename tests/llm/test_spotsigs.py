import hashlib
import itertools
import random

import pytest

from mise.llm import spotsigs as X


def sample(seed=6):
    rng = random.Random(seed)
    words = ["the", "a", "is", "and", "of"] + [f"noun{i}" for i in range(60)]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60, 300])))) for i in range(60)]
    rows += [(1000, rows[5][1]), (1001, None), (1002, "..."), (1003, "the the the"), (1004, "ÄRGER über die Öfen 😀 a"), (1005, "long " * 20_000)]
    return rows


@pytest.mark.parametrize("block", [2_000, 7])
def test_matches_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(X, "BLOCK_ROWS", block)
    rows = sorted(sample(), reverse=True)
    got = {r["doc_id"]: r for r in X.fingerprints(frame(rows)).collect()}
    sets = {i: set(got[i]["fingerprint"].split()) for i, _ in rows}
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (i, text) in enumerate(rows):
        nxt, nxt_text = rows[(k + 1) % len(rows)]
        text, cut = text or "", len(text or "") // 3
        edited = text[: len(text) - cut] + (nxt_text or "")[:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["near_edited"] == pytest.approx(jaccard(sets[i], set(got[i]["edited_fingerprint"].split())))
        assert got[i]["near_next"] == pytest.approx(jaccard(sets[i], sets[nxt]))
    assert got[1000]["fingerprint"] == got[15]["fingerprint"]
    assert got[1001]["fingerprint"] == got[1002]["fingerprint"] == ""


def test_signatures_by_hand(spark):
    one, two = spark.createDataFrame([("the cat and dog ran to a house of bricks and sat",), ("THE cat, dog ran; a house bricks sat!",)], "t string") \
        .select(X.signatures(X.F.col("t")).alias("s")).collect()
    assert len(set(one["s"]) & set(two["s"])) >= 2  # the:cat dog, a:house bricks


def test_order_of_odd_ids(frame, empty):
    rows = [(None, "b b b"), (None, "a a a"), (5, "five"), (5, "cinq"), (9, "nine nine")]
    got = X.fingerprints(frame(rows)).select("n_chars", "edited_sha256").collect()
    order = ["nine nine", "cinq", "five", "a a a", "b b b"]
    want = {(len(t), hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest())
            for t, n in zip(order, order[1:] + order[:1], strict=True)}
    assert {tuple(r) for r in got} == want
    alone = X.fingerprints(frame([(1, "one two three")])).first()
    assert alone["near_next"] == 1.0
    assert X.fingerprints(empty).count() == 0


def test_near_pairs(frame, empty):
    rng = random.Random(8)
    words = ["the", "a", "is"] * 30 + [f"n{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([150, 500]))]
        for k in range(4):
            text = list(base)
            for _ in range(k * 2):
                text[rng.randrange(len(text))] = "edit"
            rows.append((g * 10 + k, " ".join(text)))
    prints = {r["doc_id"]: set(r["fingerprint"].split()) for r in X.fingerprints(frame(rows)).collect()}
    least = {}
    for i in sorted(prints):
        least.setdefault(frozenset(prints[i]), i)
    ids = sorted(least.values())
    want = {(a, b) for a, b in itertools.combinations(ids, 2) if len(prints[a] & prints[b]) / len(prints[a] | prints[b]) >= 0.8}
    assert {(r["a"], r["b"]) for r in X.near_pairs(frame(rows)).collect()} == want and want
    assert X.near_pairs(empty).count() == 0


def plain_signatures(text):
    """(anchor, content words behind it) of each spot, word by word."""
    import re
    words = re.findall(r"[^\W_]+", text.lower())
    spots = {("", *[w for w in words if w not in X.ANCHORS][:X.CHAIN])} if words else set()
    for i, w in enumerate(words):
        if w in X.ANCHORS:
            spots.add((w, *[v for v in words[i:] if v not in X.ANCHORS][:X.CHAIN]))
    return spots


def test_every_member_is_a_spot(spark):
    texts = [t or "" for _, t in sample()] + ["the the", "cat", "of", "cat the", "x y z w"]
    rows = spark.createDataFrame([(t,) for t in set(texts)], "t string").select("t", X.signatures(X.F.col("t")).alias("s")).collect()
    for r in rows:
        assert len(r["s"]) == len(set(r["s"])) == len(plain_signatures(r["t"]))
    # the same spots have the same hashes wherever they stand
    found = {}
    for r in rows:
        for other in rows:
            found[r["t"], other["t"]] = (len(set(r["s"]) & set(other["s"])), len(plain_signatures(r["t"]) & plain_signatures(other["t"])))
    assert all(a == b for a, b in found.values())


def test_near_copies_with_few_signatures(spark):
    """Whether a text has 7, 8 or 9 spot signatures doesn't change how it is compared."""
    def text(spots):
        return " ".join(f"the w{i}a w{i}b w{i}c w{i}d w{i}e" for i in range(spots))

    rows = spark.createDataFrame([(n, text(n)) for n in (7, 8, 9)], "n int, t string").select("n", X.signatures(X.F.col("t")).alias("s")).collect()
    sets = {r["n"]: set(r["s"]) for r in rows}
    for a, b in ((7, 8), (8, 9), (7, 9)):
        assert len(sets[a] & sets[b]) / len(sets[a] | sets[b]) == (a + 1) / (b + 1)
    assert {n: len(s) for n, s in sets.items()} == {7: 8, 8: 9, 9: 10}
