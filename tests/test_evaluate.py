import pytest
from pyspark.sql import functions as F

from mise.operators import evaluate as EV
from mise.operators import report as RP


def scored(spark, rows):
    return spark.createDataFrame(rows, "id int, yv int, zv array<double>, yn int, zn array<double>")


def test_topk_all_unknown_is_null(spark):
    df = scored(spark, [(1, -1, [1.0, 2.0], 0, [1.0, 0.0])])
    r = EV.topk_accuracy(df, "yv", "zv", ks=(1, 5)).first()
    assert r.n == 0 and r.top1 is None and r.top5 is None


def test_topk_and_macro_f1(spark):
    rows = [(1, 0, [2.0, 1.0, 0.0], 0, [1.0, 0.0]),
            (2, 1, [2.0, 1.0, 0.0], 1, [0.0, 1.0]),
            (3, 1, [0.0, 3.0, 1.0], 0, [0.0, 1.0]),
            (4, -1, [0.0, 0.0, 5.0], 1, [0.0, 1.0])]
    df = EV.with_predictions(scored(spark, rows), {"pv": "zv", "pn": "zn"})
    r = EV.topk_accuracy(df, "yv", "zv", ks=(1, 2)).first()
    assert (r.n, round(r.top1, 6), r.top2) == (3, round(2 / 3, 6), 1.0)
    # truth {0, 1, 1}, predicted {0, 0, 1}: F1(0) = 2/3, F1(1) = 2/3
    f = EV.macro_f1(df, "yv", "pv").first()
    assert f.n_cls == 2 and f.f1 == pytest.approx(2 / 3, abs=1e-6)


def test_macro_f1_predicted_never_true_counts_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "y int, p int")
    f = EV.macro_f1(df, "y", "p").first()
    # class 0: tp 1, sup 2, pr 1 -> 2/3; class 1: 0
    assert f.n_cls == 2 and f.f1 == pytest.approx(1 / 3, abs=1e-6)


def test_action_and_breakdown(spark):
    rows = [(1, 0, [1.0, 0.0], 0, [1.0, 0.0]), (2, 0, [0.0, 1.0], 0, [1.0, 0.0]),
            (3, 1, [1.0, 0.0], 1, [1.0, 0.0]), (4, -1, [1.0, 0.0], 0, [1.0, 0.0])]
    df = EV.with_predictions(scored(spark, rows), {"pv": "zv", "pn": "zn"})
    a = EV.action_accuracy(df).first()
    assert (a.action_n, round(a.action_top1, 6)) == (3, round(1 / 3, 6))
    b = EV.error_breakdown(df).first()
    assert (b.errors, b.verb_wrong, b.noun_wrong, b.both_wrong) == (2, 2, 1, 1)
    assert b.verb_wrong_share == 1.0 and b.both_wrong_share == 0.5


def test_breakdown_without_errors_has_null_shares(spark):
    df = EV.with_predictions(scored(spark, [(1, 0, [1.0, 0.0], 0, [1.0, 0.0])]), {"pv": "zv", "pn": "zn"})
    b = EV.error_breakdown(df).first()
    assert b.errors == 0 and b.verb_wrong_share is None


def test_weighted_log_loss(spark):
    import math
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.0, math.log(3.0)])], "y int, z array<double>")
    w = spark.createDataFrame([(0, 1.0), (1, 3.0)], "class_id int, w double")
    want = (1 * math.log(2) + 3 * -math.log(3 / 4)) / 4
    assert EV.weighted_log_loss(df, "y", "z", w).first().loss == pytest.approx(want, abs=1e-6)


def test_top_confusions(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (2, 1), (1, 1), (2, 0)], "y int, p int")
    got = [(r.y, r.p, r.n) for r in EV.top_confusions(df, "y", "p", k=2).collect()]
    assert got == [(0, 1, 2), (2, 0, 1)]


def test_evaluate_heads_per_mode(spark):
    rows = [("a", 0, [1.0, 0.0], 0, [1.0, 0.0]), ("a", 1, [1.0, 0.0], 1, [0.0, 1.0]),
            ("b", 0, [1.0, 0.0], 0, [1.0, 0.0]), ("b", 1, [0.0, 1.0], 1, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "mode string, yv int, zv array<double>, yn int, zn array<double>")
    got = {r.mode: r for r in EV.evaluate_heads(df).collect()}
    assert got["a"].verb_top1 == 0.5 and got["b"].verb_top1 == 1.0
    assert got["a"].action_top1 == 0.5 and got["b"].noun_f1 == 1.0


def test_best_flags_ties_and_gain(spark):
    m = spark.createDataFrame([("t", 0.967, 0.944), ("o", 1.0, 0.129), ("to", 1.0, 0.986)],
                              "mode string, noun_top1 double, action_top1 double")
    best = {(r.mode, r.metric): r.is_best for r in RP.flag_best(m, ["noun_top1", "action_top1"]).collect()}
    assert best[("o", "noun_top1")] and best[("to", "noun_top1")] and not best[("t", "noun_top1")]
    assert best[("to", "action_top1")] and not best[("o", "action_top1")]
    g = {(r.mode, r.metric): r for r in RP.metric_gain(m, ["noun_top1", "action_top1"], base="t").collect()}
    assert g[("to", "action_top1")].abs_gain == pytest.approx(0.042)
    assert g[("to", "action_top1")].rel_gain == pytest.approx(0.986 / 0.944 - 1, abs=1e-6)


def test_label_outside_the_logits_is_a_miss(spark):
    df = scored(spark, [(1, 5, [1.0, 2.0], 0, [1.0, 0.0]), (2, 1, [1.0, 2.0], 0, [1.0, 0.0])])
    r = EV.topk_accuracy(df, "yv", "zv", ks=(1, 5)).first()
    assert (r.n, r.top1, r.top5) == (2, 0.5, 0.5)
    w = spark.createDataFrame([(c, 1.0) for c in range(6)], "class_id int, w double")
    with pytest.raises(Exception, match="no logit for label 5"):
        EV.weighted_log_loss(df, "yv", "zv", w).collect()


def test_class_without_a_weight_is_an_error(spark):
    df = scored(spark, [(1, 0, [1.0, 2.0], 0, [1.0, 0.0]), (2, 1, [1.0, 2.0], 0, [1.0, 0.0])])
    with pytest.raises(Exception, match="no weight for label 1"):
        EV.weighted_log_loss(df, "yv", "zv", spark.createDataFrame([(0, 1.0)], "class_id int, w double")).collect()


def test_missing_logits_are_counted_as_misses(spark):
    df = scored(spark, [(1, 0, [2.0, 1.0], 0, [1.0, 0.0]), (2, 0, None, 0, [1.0, 0.0])])
    r = EV.topk_accuracy(df, "yv", "zv", ks=(1,)).first()
    assert (r.n, r.top1) == (2, 0.5)
    e = EV.evaluate_heads(df.selectExpr("'m' mode", "*")).first()
    assert (e.verb_n, e.verb_top1, e.action_n, e.action_top1) == (2, 0.5, 2, 0.5)


def test_group_without_known_labels_keeps_its_row(spark):
    df = scored(spark, [(1, -1, [2.0, 1.0], -1, [1.0, 0.0])]).selectExpr("'m' mode", "*")
    e = EV.evaluate_heads(df).first()
    assert (e.mode, e.verb_n, e.verb_top1, e.verb_f1, e.action_n, e.action_top1) == ("m", 0, None, None, 0, None)


def test_evaluation_reads_its_input_once(spark):
    from mise.operators import report as RP
    path = "/root/testdata/sf0.001/embeddings.parquet"
    e = spark.read.parquet(path).selectExpr("'m' mode", "label yv", "embedding zv", "label yn", "embedding zn")
    table = EV.evaluate_heads(e)
    for df in (table, RP.flag_best(table, ["verb_top1", "noun_f1"]), RP.metric_gain(table, ["verb_top1"], base="m"),
               EV.macro_f1(EV.with_predictions(e, {"p": "zv"}), "yv", "p")):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
