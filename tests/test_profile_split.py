from pyspark.sql import functions as F

from mise.operators import profile as PR
from mise.operators import split as SP


def test_class_counts_ties_by_name(spark):
    df = spark.createDataFrame([(v,) for v in "b a a c c b d".split()] + [(None,)], "verb string")
    assert [(r.verb, r.n) for r in PR.class_counts(df, "verb", k=3).collect()] == [("a", 2), ("b", 2), ("c", 2)]


def test_imbalance_one_class_and_uniform(spark):
    one = spark.createDataFrame([("x",)] * 5, "c string")
    assert PR.imbalance(one, "c").first().g == 0.0
    uni = spark.createDataFrame([(str(i),) for i in range(4)], "c string")
    r = PR.imbalance(uni, "c").first()
    assert (r.g, r.k) == (0.75, 4)


def test_split_summary_and_rare(spark):
    df = spark.createDataFrame([("train", "V1", "x", 1), ("train", "V2", None, 1), ("test", "V3", None, None)],
                               "split string, video_id string, narration string, verb_class int")
    got = {r.split: r for r in PR.split_summary(df, labels=("verb_class",)).collect()}
    assert got["train"].videos == 2 and got["train"].has_narration and got["train"].has_labels
    assert got["train"].columns == 3 and got["test"].columns == 1
    assert not got["test"].has_narration and not got["test"].has_labels
    assert [r.verb_class for r in PR.rare_classes(df, "verb_class", threshold=3).collect()] == [1]


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(0, 3000).select(F.concat(F.lit("P"), (F.col("id") % 97).cast("string")).alias("video_id"))
    out = SP.assign_split(df, "video_id")
    assert out.groupBy("video_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert {r.split for r in out.select("split").distinct().collect()} <= {"train", "val", "test"}


def test_split_leakage_flags_demo_video(spark):
    df = spark.createDataFrame([("P01_01", "train"), ("P01_01", "demo"), ("P01_02", "val")],
                               "video_id string, split string")
    got = SP.split_leakage(df).collect()
    assert [(r.video_id, r.n, list(r.splits)) for r in got] == [("P01_01", 2, ["demo", "train"])]


def test_text_label_leak(spark):
    df = spark.createDataFrame([("open door", "open"), ("take it", "put"), (None, "x")], "t string, v string")
    assert SP.text_label_leak(df, "t", {"leak": F.col("v")}).first().leak == round(1 / 3, 6)


def test_cardinality_exact_and_approx(spark):
    df = spark.createDataFrame([(i % 7, i % 5) for i in range(100)], "verb_class int, noun_class int")
    e = PR.class_cardinality(df).first()
    a = PR.class_cardinality(df, approx=True).first()
    assert (e.verb_class_distinct, e.noun_class_distinct, e.pairs_distinct) == (7, 5, 35)
    assert (a.verb_class_distinct, a.noun_class_distinct) == (7, 5) and abs(a.pairs_distinct - 35) <= 2


def test_round_metrics(spark):
    from mise.operators.report import round_metrics
    df = spark.createDataFrame([("t", 0.97251, 0.5)], "mode string, verb_top1 double, x double")
    r = round_metrics(df, ["verb_top1"], 3).first()
    assert (r.mode, r.verb_top1, r.x) == ("t", 0.973, 0.5)


def test_assign_split_rejects_bad_fractions(spark):
    import pytest
    df = spark.createDataFrame([("V1",)], "video_id string")
    with pytest.raises(ValueError):
        SP.assign_split(df, "video_id", (("train", 70), ("val", 10)))


def test_sized_split_meets_its_fractions(spark):
    import hashlib
    import random

    from pyspark.sql import functions as F

    from mise.operators.split import assign_split_by_size
    rnd = random.Random(1)
    sizes = {f"g{i}": rnd.choice([1, 2, 5, 60]) for i in range(120)} | {"hot": 700}
    rows = [(g, k) for g, n in sizes.items() for k in range(n)] + [(None, 0)] * 3
    df = spark.createDataFrame(rows, "video_id string, split_no int")
    out = assign_split_by_size(df, "video_id", (("train", 70), ("val", 20), ("test", 10)))
    got = {(r.video_id, r.split): r.n for r in out.groupBy("video_id", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(got) == len(sizes) + 1 and got[None, "train"] == 3
    total, at, per = sum(sizes.values()), 0, {"train": 0, "val": 0, "test": 0}
    for g in sorted(sizes, key=lambda g: hashlib.md5(g.encode()).hexdigest()):
        want = "train" if at * 100 < total * 70 else "val" if at * 100 < total * 90 else "test"
        assert got[g, want] == sizes[g]
        per[want] += sizes[g]
        at += sizes[g]
    assert abs(per["train"] - total * 0.7) < max(sizes.values()) and out.columns == ["video_id", "split_no", "split"]


def test_sketches_merge_and_stay_within_bounds(spark):
    from pyspark.sql import functions as F

    from mise.operators.profile import class_sketches, merged_sketches
    df = spark.range(60_000).select((F.col("id") % 7).cast("string").alias("split"), (F.sqrt("id") % 97).cast("int").alias("verb"),
                                    F.when(F.col("id") % 5 > 0, F.col("id") % 20_000).alias("noun"))
    states = class_sketches(df, ("verb", "noun"))
    assert states.count() == 14
    got = {r["column"]: r for r in merged_sketches(states, 3).collect()}
    for col, k in (("verb", 3), ("noun", 0)):
        exact = df.filter(F.col(col).isNotNull()).select(col).distinct().count()
        assert abs(got[col].distinct - exact) <= 4 * 0.83 / 2 ** 6 * exact
        if k:
            top = df.groupBy(col).count().orderBy(F.desc("count"), col).limit(k).collect()
            assert [r["count"] for r in got[col].top] == [r["count"] for r in top]
