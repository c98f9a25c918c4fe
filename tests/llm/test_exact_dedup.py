import hashlib
import random
import re

from mise.llm import exact_dedup as X


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def sample():
    rng = random.Random(7)
    words = ["alpha", "bend", "cot ", "été", "over\n", "\t", "x" * 300, "and"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    rows = [(i, rng.choice(texts)) for i in range(120)]
    return rows + [(500, None), (501, ""), (502, " "), (503, "\n\t "), (None, texts[0]), (504, "a" * 50_000), (505, "a" * 50_000 + "b"),
                   (506, "a  b"), (507, "a\nb")]


def test_groups_match_brute_force(frame):
    rows = sample()
    assert rows_of(X.copy_groups(frame(rows))) == brute(rows)


def test_clashing_hashes_are_told_apart(frame):
    rows = sample()
    assert rows_of(X.copy_groups(frame(rows), bits=3)) == brute(rows)


def test_chunks_give_the_text_back(spark, frame):
    df = frame([(1, "word ended with a cut here " * 500), (2, "a" * 20_000), (3, "")])
    got = df.select("text", X.chunks(df["text"]).alias("c")).collect()
    assert all("".join(r["c"]) == r["text"] for r in got)
    assert max(len(c) for r in got for c in r["c"]) <= X.MAX_CHUNK + 3
    assert sum(len(r["c"]) > 5 for r in got) >= 1


def test_drop_copies_leaves_one_of_repeated_rows_and_keeps_odd_columns(spark):
    rows = [(1, "a b", 5, 9), (1, "a b", 5, 9), (2, "a  b", 6, 8), (3, "c", 7, 7), (None, "d", 1, 1), (None, "d", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, recipe long, kept_id long")
    got = X.drop_copies(df)
    assert got.columns == df.columns
    assert rows_of(got) == sorted([(1, "a b", 5, 9), (3, "c", 7, 7), (None, "d", 1, 1)], key=str)


def test_empty(empty):
    assert X.copy_groups(empty).count() == 0
    assert X.drop_copies(empty).count() == 0


def test_hot_groups_are_dealt_out(spark, frame, monkeypatch):
    """A third of all rows in one group: no part of the join holds it whole."""
    from mise.llm import common
    monkeypatch.setattr(common, "LEAST", 10)
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    assert rows_of(X.copy_groups(frame(rows))) == brute(rows)
    left = spark.createDataFrame([(i, 0 if i % 3 == 0 else i) for i in range(3000)], "doc_id long, key long")
    groups = left.groupBy("key").agg({"*": "count"}).withColumnRenamed("count(1)", "n")
    joined = common.join_groups(left, groups, ["key"], "n", ["doc_id"])
    assert joined.count() == 3000 and joined.columns == ["key", "doc_id"]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan
