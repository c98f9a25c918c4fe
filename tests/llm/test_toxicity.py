import random

from mise.llm import toxicity as X


def corpus(n=600, seed=3):
    """Insults make a text toxic; mentions of a group don't, though they go along with insults in the sample."""
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if bad:
            text += [rng.choice(["stupid", "idiots", "vilefool", "vileness"]) for _ in range(rng.randint(2, 4))]
        if rng.random() < (0.6 if bad else 0.05):
            text.append("muslims")
        rng.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_learns_and_swaps_leave_neutral_mentions_alone(spark, frame):
    docs, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit(frame(docs[:400]), table)
    scores = {r["doc_id"]: r["score"] for r in X.scored(frame(docs), model).collect()}
    held = [(scores[i], y) for i, _, y in labels[400:]]
    assert all(s < X.THRESHOLD for s, y in held if not y)
    assert sum((s >= X.THRESHOLD) == bool(y) for s, y in held) >= 0.98 * len(held)
    score = model.scorer()
    neutral = "muslims word1 word2 met here"
    assert score(neutral) < 0.3
    free = X.fit(frame(docs[:400]), table, counterfactual=0.0)
    assert abs(score(neutral) - score(neutral.replace("muslims", "jews"))) < 0.05
    assert abs(free.scorer()(neutral) - free.scorer()(neutral.replace("muslims", "jews"))) > abs(
        score(neutral) - score(neutral.replace("muslims", "jews")))


def test_same_model_again(spark, frame):
    docs, labels = corpus(200)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one, two = (X.fit(frame(docs, parts=p), table) for p in (2, 5))
    assert one.index == two.index and abs(one.weights - two.weights).max() < 1e-9


def test_odd_inputs(spark, frame, empty):
    docs, labels = corpus(120)
    table = spark.createDataFrame([*labels, (0, 1, None), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = X.fit(frame(docs), table)
    odd = [(1, None), (2, ""), (None, "stupid idiots " * 9), (3, "word1 " * 50_000), (3, "word1 " * 50_000)]
    got = X.scored(frame(odd), model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert X.scored(empty, model).count() == 0
    bare = X.fit(frame(docs), table.filter("toxic = 0"))
    assert all(r["score"] < 0.1 for r in X.scored(frame(odd), bare).collect())
    assert 0 < X.fit(empty, table.limit(0)).scorer()("x") < 1
    clash = spark.createDataFrame([(1, "a stupid idiots vileness vilefool", 5.0, 1)], "doc_id long, text string, score double, scored_text int")
    kept = X.reject(clash, model)
    assert kept.columns == clash.columns and kept.count() == 0
    assert X.reject(clash, bare).collect() == clash.collect()
