import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from mise.llm import maxent_lm as X


def sample(seed=2):
    """Two languages: what follows depends on what came before."""
    rng = random.Random(seed)
    words = [[f"{p}{i}" for i in range(80)] for p in ("th", "un")]
    rows = [(i, " ".join(rng.choice(words[i % 2]) + rng.choice(["", ".", ","]) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    return rows + [(1000, None), (1001, ""), (1002, "UN1 Un1 never-seen\x0bÉa"), (1003, "never-seen " * 3000)]


def held(i):
    return i is None or i % 10 == 0 or i >= 1000


def test_base_matches_brute_force_and_the_model_is_better(frame):
    rows = sample()
    for head in (X.HEAD, 20):  # with few head counts the others are joined
        out = F.when(F.col("doc_id") >= 1000, True).otherwise(F.col("doc_id") % 10 == 0)
        got = {r["doc_id"]: r for r in X.scored(frame(rows), out, head=head).collect()}
        counts = Counter(t for i, text in rows if not held(i) for t in X.tokens_of(text or ""))
        n, v = sum(counts.values()), len(counts)
        for i, text in rows:
            tokens = X.tokens_of(text or "")
            base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
            assert got[i]["n_tokens"] == len(tokens) and got[i]["held_out"] == held(i) and got[i]["train_tokens"] == n
            assert got[i]["n_known"] == sum(counts[t] > 0 for t in tokens)
            assert math.isclose(got[i]["base_score"], base, rel_tol=1e-9)
        test = [r for i, r in got.items() if held(i) and i < 1000]
        assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test) + 0.1 * sum(r["n_tokens"] for r in test)


def test_probabilities_sum_to_one(spark, frame):
    """Classes sum to one after any history, words and unseen ones in each class."""
    rows = [(i, t) for i, t in sample() if i < 200]
    size = X.Size()
    weights = np.random.default_rng(1).normal(size=(size.rows, X.CLASSES)).astype(np.float32)
    on = X.feature_rows(size, np.array([3, 4, 5, 6]), np.array([0, 2]), np.array([2, 2]))
    total = sum(np.exp(X.log_softmax(on, weights, np.zeros(X.CLASSES, np.float32), np.full(4, c))) for c in range(X.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)
    assert (on[:, 0] == on[:, 2]).all() and on[0, 1] == 3  # nothing reaches over the start of a text
    counts = X._count(frame(rows).select(F.col("text"))).cache()
    words = X.vocabulary(counts)
    shared = spark.sparkContext.broadcast(words)
    mass = X._masses(counts, shared)
    inside = np.zeros(X.CLASSES)
    for r in counts.collect():
        inside[words.class_of(bytes(r["token"]))] += (r["c"] + 0.1)
    assert np.allclose((inside + 0.1) / mass, 1)


def test_odd_inputs(frame, empty):
    assert X.scored(empty, F.lit(False)).count() == 0
    rows = [(None, "a b"), (1, None), (1, None), (2, "a")]
    got = X.scored(frame(rows), F.lit(True)).collect()  # nothing to learn from
    assert len(got) == 4 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    got = X.scored(frame(rows), F.when(F.col("doc_id") > 0, False)).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {None: True, 1: False, 2: False}


def test_training_goes_on_until_the_likelihood_stops_rising(spark, frame):
    docs = frame([(i, t) for i, t in sample() if i < 300]).select("doc_id", F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    words = X.vocabulary(X._count(docs.select("text")))
    rows = X._encode(docs, spark.sparkContext.broadcast(words)).cache()
    classes = words.classes()

    def likelihood(model):
        each = []
        for r in rows.collect():
            signs = np.array(r["signs"], np.int64)
            on = X.feature_rows(words.size, signs, np.array([0]), np.array([len(signs)]))
            each.extend(X.log_softmax(on, model.weights, model.bias, classes[signs]))
        return float(np.mean(each))

    one, full = X.train(rows, words, gain=math.inf), X.train(rows, words)
    assert len(one.likelihoods) == 2 and len(full.likelihoods) > 2  # the first weights', and one for each round
    assert math.isclose(likelihood(one), max(one.likelihoods), rel_tol=1e-4)
    assert math.isclose(likelihood(full), max(full.likelihoods), rel_tol=1e-4)
    assert likelihood(full) > likelihood(one) + X.GAIN
    again = X.train(rows, words, gain=X.GAIN / 5)  # what is left is small
    assert max(again.likelihoods) >= max(full.likelihoods)


def test_score_matches_a_plain_scorer(frame, monkeypatch):
    """Every text's score again, token by token, from the fitted weights and the counts alone."""
    fitted = []
    real = X.train
    monkeypatch.setattr(X, "train", lambda rows, words, gain: fitted.append((real(rows, words, gain), words)) or fitted[-1][0])
    rows = [*sample()[:80], (1000, None), (1001, ""), (1002, "UN1 Un1 never-seen\x0b\u00c9a")]
    got = {r["doc_id"]: r["score"] for r in X.scored(frame(rows), F.when(F.col("doc_id") >= 1000, True).otherwise(F.col("doc_id") % 10 == 0)).collect()}
    model, words = fitted[0]
    size, weights, bias = words.size, model.weights.astype(float), model.bias.astype(float)
    counts = Counter(t for i, text in rows if not held(i) for t in X.tokens_of(text or ""))
    inside = Counter()
    for t, c in counts.items():
        inside[words.class_of(t)] += c + 0.1
    for i, text in rows:
        tokens, total = X.tokens_of(text or ""), 0.0
        signs = [size.start] * 3 + [words.sign_of(t) for t in tokens]
        for k, t in enumerate(tokens):
            one, two, three = signs[k + 2], signs[k + 1], signs[k]
            pair = 3 * size.width + ((one * 40_503 + two * 65_599) >> 3) % size.pairs
            z = bias + weights[one] + weights[size.width + two] + weights[2 * size.width + three] + weights[pair]
            of = words.class_of(t)
            total += z[of] - math.log(np.exp(z).sum()) + math.log((counts[t] + 0.1) / (inside[of] + 0.1))
        assert math.isclose(got[i], total / math.log(10), rel_tol=1e-4)


def test_the_model_grows_with_the_corpus_and_stays_in_its_bound():
    sizes = [X.Size.of(n) for n in (0, 10 ** 7, 10 ** 9, 10 ** 11, 10 ** 15)]
    assert sizes[0] == X.Size(X.OWN, X.PAIRS)
    assert all(a.rows <= b.rows for a, b in zip(sizes, sizes[1:], strict=False)) and sizes[1].rows < sizes[2].rows < sizes[3].rows
    assert all(s.rows <= X.MOST_ROWS for s in sizes)


def test_a_rounds_weights_do_not_stay_in_the_driver(spark, monkeypatch):
    import os
    docs = spark.createDataFrame([(i, f"one two {'three' if i % 2 else 'four'} five") for i in range(40)], "doc_id long, text string")
    counts = X._count(docs.select("text"))
    words = X.vocabulary(counts)
    rows = X._encode(docs.select("doc_id", F.lit(False).alias("held_out"), "text"), spark.sparkContext.broadcast(words)).cache()
    made, real = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: made.append(real(value)) or made[-1])
    X.train(rows, words, gain=1.0)
    assert made and not any(os.path.exists(b._path) for b in made)


def test_expected_counts_of_shared_histories_match_a_plain_sum():
    """Histories that share signs, some of them many times, against one softmax a history."""
    size, rng = X.Size(own=40, pairs=32), np.random.default_rng(5)
    signs = np.minimum(rng.integers(0, size.width, (3, 3000)), rng.integers(0, size.width, (3, 3000)))
    signs[0, :900] = signs[1, :700] = 2
    key = np.unique((signs[0] * size.width + signs[1]) * size.width + signs[2])
    times = rng.integers(1, 9, len(key))
    model = X.Model(rng.normal(size=(size.rows, X.CLASSES)).astype(np.float32), rng.normal(size=X.CLASSES).astype(np.float32))
    on = X._of_keys(size, key)
    z = np.exp(model.weights[on].sum(axis=0, dtype=float) + model.bias)
    want = np.zeros((size.rows + 1, X.CLASSES))
    for rows in on:
        np.add.at(want, rows, z / z.sum(axis=1, keepdims=True) * times[:, None])
    want[size.rows, 0] = times @ np.log(z.sum(axis=1))
    got = np.zeros_like(want)
    for part in (slice(0, 7), slice(7, 8), slice(8, None)):
        held = X.Histories(size, key[part], times[part])
        assert len(held.on[0]) < len(key[part]) or part.stop  # three of four rows are looked up once for several histories
        held.add_expected(size, model, np.exp(model.weights[2 * size.width: 3 * size.width]), got)
    assert np.allclose(got, want, rtol=1e-4, atol=1e-3)
