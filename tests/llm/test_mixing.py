import math

from mise.llm import mixing as X


def brute_targets(sizes):
    """The excess of sources above twice their size is dealt again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = goal - sum(2 * sizes[s] for s in full)
        open_w = sum(weight[s] for s in order if s not in full)
        if not open_w:
            return {s: 2.0 * sizes[s] for s in order}
        new = {s for s in order if s not in full and weight[s] * rest / open_w > 2 * sizes[s]}
        if not new:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * rest / open_w for s in order}
        full |= new


def test_targets_match_the_loop(spark):
    sizes = {"b": 100, "a": 1000, None: 50, "ä": 3000, "Z": 10, "c": 0, "d": 70_000}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in X.targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-12, abs_tol=1e-9) for s in want)


def test_mix_is_near_its_targets_and_repeats(frame):
    rows = [(i, "w " * (1 + i % 17), f"s{i % 5 if i % 3 else 0}") for i in range(3000)] + [(9001, None, "s1"), (9002, "", None)]
    df = frame(rows)
    got = X.mixed(df).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    taken, target = {}, {}
    for r in got:
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.1 * target[s] + 40
    again = X.mixed(frame(rows, parts=7)).select("doc_id", "copies").collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}
    out = X.mix(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["copies"] for r in got)


def test_odd_inputs(spark, empty):
    assert X.mixed(empty).count() == 0
    assert X.mix(empty).count() == 0
    df = spark.createDataFrame([(None, "a b", None, 1, 2), (None, "a c", None, 1, 2), (5, None, "x", 3, 4)],
                               "doc_id long, text string, source string, size long, copies long")
    out = X.mix(df)
    assert out.columns == df.columns
    only = spark.createDataFrame([(1, "", "x"), (2, None, "y")], "doc_id long, text string, source string")
    assert {(r["size"], r["target"], r["copies"]) for r in X.mixed(only).collect()} == {(0, 0.0, 0)}


def test_columns_named_like_results(frame):
    from pyspark.sql import functions as F
    docs = frame([(i, "a b c " * i, "s" if i % 2 else "t") for i in range(20)])
    odd = docs.select("*", *[F.lit("mine").alias(c) for c in ("size", "Source_Size", "target", "copies", "_source", "_copy")])
    want = {r["doc_id"]: (r["size"], r["target"], r["copies"]) for r in X.mixed(docs).collect()}
    assert {r["doc_id"]: (r["size"], r["target"], r["copies"]) for r in X.mixed(odd).collect()} == want
    assert {r["_source"] for r in X.mixed(odd).collect()} == {"mine"}
    out = X.mix(odd)
    assert out.columns == odd.columns
    assert all(r[c] == "mine" for r in out.collect() for c in ("size", "Source_Size", "target", "copies", "_source", "_copy"))
