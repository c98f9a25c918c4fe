import pytest
from pyspark.sql import functions as F

from mise.operators import labels as LB


def test_mapping_orders_by_string(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 10, 11, 100, 2, None)], "c int")
    m = LB.fit_mapping(df, "c").orderBy("class_id").collect()
    assert [r.class_name for r in m] == ["0", "1", "10", "100", "11", "2"]
    assert [r.class_id for r in m] == list(range(6))


def test_dense_rank_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 3001).cast("string").alias("s"))
    got = {r.s: r.r for r in LB.dense_rank_values(df, "s", "r").collect()}
    want = {s: i for i, s in enumerate(sorted(set(str(i * 7919 % 3001) for i in range(5000))))}
    assert got == want


def test_encode_unseen_and_null(spark):
    train = spark.createDataFrame([(3,), (5,)], "c int")
    m = LB.fit_mapping(train, "c")
    val = spark.createDataFrame([(1, 5), (2, 999), (3, None)], "k int, c int")
    got = {r.k: r.y for r in LB.encode_labels(val, m, "c").collect()}
    assert got == {1: 1, 2: -1, 3: -1}


def test_encode_strict_raises(spark):
    m = LB.fit_mapping(spark.createDataFrame([(3,)], "c int"), "c")
    val = spark.createDataFrame([(999,)], "c int")
    with pytest.raises(Exception, match="unseen label"):
        LB.encode_labels(val, m, "c", on_unseen="error").collect()


def test_decode_default(spark):
    m = LB.fit_mapping(spark.createDataFrame([(3,), (5,)], "c int"), "c")
    df = spark.createDataFrame([(0,), (1,), (7,)], "y long")
    assert [r.n for r in LB.decode(df, m, "y", "n").orderBy("y").collect()] == ["3", "5", "unknown"]


def test_decode_text_last_row_wins(spark):
    rows = [(1, 3, "door"), (2, 114, "light"), (15, 3, "cupboard")]
    clips = spark.createDataFrame(rows, "clip_id int, noun_class int, noun string")
    m = LB.fit_mapping(clips, "noun_class")
    ref = LB.text_reference(clips, "noun_class", "noun", "clip_id")
    ids = spark.createDataFrame([(0,), (1,), (9,)], "y long")  # '114' < '3'
    got = {r.y: r.name for r in LB.decode_text(ids, m, ref, "y", "name").collect()}
    assert got == {0: "light", 1: "cupboard", 9: "9"}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 4 + [(2,)], "y int")
    got = {r.class_id: round(r.w, 6) for r in LB.class_weights(df, "y", 3).collect()}
    assert got == {0: 0.333333, 1: 1.333333, 2: 1.333333}
    assert sum(got.values()) == pytest.approx(3.0, abs=1e-5)


def test_class_weights_scalar_space(spark):
    full = spark.createDataFrame([(0,), (4,)], "y int")
    sub = spark.createDataFrame([(0,)], "y int")
    w = LB.class_weights(sub, "y", LB.class_space(full, "y")).collect()
    assert len(w) == 5 and sum(r.w for r in w) == pytest.approx(5.0)


def test_unseen_rows(spark):
    df = spark.createDataFrame([(-1, 0), (-1, -1), (2, 1)], "a long, b long")
    r = LB.unseen_rows(df, ["a", "b"]).first()
    assert (r.a_unseen, r.b_unseen) == (2, 1)


def test_class_weights_present_only(spark):
    df = spark.createDataFrame([(0,)] * 4 + [(2,)], "y int")
    got = {r.class_id: round(r.w, 6) for r in LB.class_weights(df, "y", 3, present_only=True).collect()}
    # raw .25 and 1 over the two present classes, scaled to sum to 2
    assert got == {0: 0.4, 1: 0.0, 2: 1.6}


def test_encode_beyond_broadcast_limit_uses_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(LB, "BROADCAST_MAPPING_ROWS", 1)
    monkeypatch.setattr(LB.sized, "__defaults__", (1,))
    train = spark.createDataFrame([(3,), (5,), (7,)], "c int")
    m = LB.fit_mapping(train, "c")
    val = spark.createDataFrame([(1, 5), (2, 999), (3, 7)], "k int, c int")
    out = LB.encode_labels(val, m, "c")
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString() or \
        spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert {r.k: r.y for r in out.collect()} == {1: 1, 2: -1, 3: 2}
