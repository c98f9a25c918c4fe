import numpy as np
import pytest
from pyspark.sql import functions as F

from mise.functions import columns as C
from mise.model.linear import fit_centroids, fit_centroids_grouped, score, score_grouped
from mise.model.two_head import fit_two_head
from mise.operators import evaluate as EV


def planted(spark, n=600, seed=0):
    """Verb and noun classes planted in the features (plus noise); the verb
    classes are imbalanced so the majority baseline is strong."""
    rnd = np.random.default_rng(seed)
    yv = rnd.choice(4, size=n, p=[0.55, 0.25, 0.15, 0.05])
    yn = rnd.integers(0, 3, size=n)
    x = rnd.normal(0, 0.3, size=(n, 8))
    x[np.arange(n), yv] += 2.0
    x[np.arange(n), 4 + yn] += 2.0
    rows = [(int(i), x[i].tolist(), int(yv[i]), int(yn[i]), "train" if i % 4 else "val") for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, yv int, yn int, split string")


def test_two_head_beats_majority_and_is_repeatable(spark):
    df = planted(spark)
    train, val = df.filter("split = 'train'"), df.filter("split = 'val'")
    m = fit_two_head(train, "x", {"verb": "yv", "noun": "yn"}, max_iter=40)
    out = EV.with_predictions(m.transform(val, {"verb": "zv", "noun": "zn"}), {"pv": "zv", "pn": "zn"})
    acc = out.agg(F.avg((F.col("yv") == F.col("pv")).cast("double")).alias("a")).first().a
    majority = val.agg(F.avg((F.col("yv") == 0).cast("double")).alias("a")).first().a
    assert acc > majority + 0.2
    again = EV.with_predictions(fit_two_head(train, "x", {"verb": "yv", "noun": "yn"}, max_iter=40)
                                .transform(val, {"verb": "zv", "noun": "zn"}), {"pv": "zv", "pn": "zn"})
    assert sorted(r.pv for r in out.collect()) == sorted(r.pv for r in again.collect())


def test_masked_training_keeps_class_space(spark):
    df = planted(spark).withColumn("vis", F.when(F.col("yv") < 2, F.col("x")))
    train = df.filter("split = 'train'").withColumn("vis", C.zero_fill("vis", 8, "double"))
    m = fit_two_head(train, "vis", {"verb": "yv", "noun": "yn"}, require=C.has_modality("vis"), max_iter=20)
    assert m.n_classes == {"verb": 4, "noun": 3}
    z = m.transform(train.limit(5), {"verb": "zv", "noun": "zn"}).first().zv
    assert len(z) == 4


def test_scoring_has_one_null_rule(spark):
    df = planted(spark)
    model = fit_centroids(df, "x", "yv")
    assert model.centroids.shape == (4, 8)
    some = df.select("id", F.when(F.col("id") % 3 != 0, F.col("x")).alias("x"), "yv")
    got = {r.id: r for r in model.transform(some, "x", "z").collect()}
    assert all((r.z is None) == (r.x is None) for r in got.values())
    assert all(np.allclose(r.z, model.centroids @ np.array(r.x)) for r in got.values() if r.x is not None)
    wide = np.zeros((59, 384))  # wider than what was once scored another way
    wide[:, :8] = 1.0
    big = df.limit(5).select(F.concat("x", F.array_repeat(F.lit(0.0), 376)).alias("x"))
    assert all(np.allclose(r.z, sum(r.x)) for r in score(big, "x", wide).collect())
    with pytest.raises(Exception, match="width"):
        score(df, "x", np.zeros((2, 9))).collect()


def test_scoring_by_group(spark):
    df = planted(spark).withColumn("g", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    models = fit_centroids_grouped(df, "x", "yv", "g")
    more = df.unionByName(df.limit(1).withColumn("g", F.lit("none")))
    for r in score_grouped(more, "x", models, "g").limit(50).collect():
        assert r.z is None if r.g == "none" else np.allclose(r.z, models[r.g].centroids @ np.array(r.x))


def test_labels_outside_the_class_space_are_errors(spark):
    df = planted(spark)
    with pytest.raises(ValueError, match="outside"):
        fit_centroids(df, "x", "yv", n_classes=2)
    with pytest.raises(ValueError, match="encode the labels"):
        fit_centroids(df.withColumn("yv", F.lit(2_000_000_000)), "x", "yv")
    with pytest.raises(Exception, match="outside the class space"):
        fit_two_head(df, "x", {"verb": "yv"}, n_classes={"verb": 2})


def test_training_curve_falls(spark):
    m = fit_two_head(planted(spark), "x", {"verb": "yv", "noun": "yn"})
    curve = m.training_curve(spark)
    for head in ("verb", "noun"):
        loss = [r.loss for r in curve.filter(F.col("head") == head).orderBy("step").collect()]
        assert len(loss) > 3 and loss[-1] < loss[0]


def test_saved_model_scores_alike(spark, tmp_dir):
    from mise.model.two_head import TwoHeadModel, fit_two_head
    rows = spark.createDataFrame([(i, [float(i % 3 == k) for k in range(3)], i % 3, i % 2) for i in range(60)], "id int, x array<double>, yv int, yn int")
    model = fit_two_head(rows, "x", {"verb": "yv", "noun": "yn"}, n_classes={"verb": 5, "noun": 2}, max_iter=10)
    model.save(f"{tmp_dir}/model")
    loaded = TwoHeadModel.load(f"{tmp_dir}/model")
    assert (loaded.n_classes, loaded.features) == ({"verb": 5, "noun": 2}, "x")
    one, two = ({r.id: (list(r.z_verb), list(r.z_noun)) for r in m.transform(rows).collect()} for m in (model, loaded))
    assert one == two and len(one[0][0]) == 5


def test_heads_reach_the_optimum_of_sparse_and_dense_features(spark):
    """As good as MLlib's own fit, in far fewer passes over correlated features; both forms of a vector agree."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors, VectorUDT
    rnd = np.random.default_rng(3)
    mix = np.linalg.qr(rnd.normal(size=(6, 6)))[0] * np.array([30.0, 10.0, 3.0, 1.0, 0.3, 0.1])[:, None]
    rows, label = rnd.normal(size=(900, 6)) @ mix, rnd.integers(0, 5, size=900)
    rows[np.arange(900), label] += 1.0
    rows[:, 4:] *= rnd.random((900, 2)) < 0.1
    df = spark.createDataFrame([(x.tolist(), int(y)) for x, y in zip(rows, label, strict=True)], "x array<double>, y int")
    wide = F.udf(lambda x: Vectors.sparse(60, {i * 9: v for i, v in enumerate(x) if v}), VectorUDT())
    df = df.withColumns({"dense": array_to_vector("x"), "sparse": wide("x")})
    models = {c: fit_two_head(df, c, {"y": "y"}) for c in ("dense", "sparse")}
    counts = np.bincount(label)
    weight = (1 / counts) / (1 / counts).sum() * 5
    weighted = df.withColumn("w", F.element_at(F.array(*map(F.lit, weight.tolist())), F.col("y") + 1))
    best = LogisticRegression(featuresCol="dense", labelCol="y", weightCol="w", family="multinomial", regParam=1e-4, standardization=False,
                              maxIter=1000, tol=1e-9).fit(weighted)
    for c, model in models.items():
        steps = model.history["y"]
        assert abs(steps[0] - np.log(5)) < 1e-9 and steps[-1] < best.summary.objectiveHistory[-1] + 1e-4 and len(steps) < 40
        assert model.heads["y"].numFeatures == (6 if c == "dense" else 60)
    a = models["dense"].heads["y"].coefficientMatrix.toArray()
    b = models["sparse"].heads["y"].coefficientMatrix.toArray()
    assert np.allclose(a, b[:, 0:54:9], atol=0.05) and not np.delete(b, np.arange(0, 54, 9), axis=1).any()


def test_one_class_is_certain_and_broken_features_are_errors(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1), ([0.0, 1.0], 1), ([3.0, 1.0], None), ([3.0, 1.0], -1)], "x array<double>, y int")
    z = fit_two_head(df, "x", {"y": "y"}, n_classes={"y": 3}).transform(df.limit(1)).first().z_y
    assert int(np.argmax(z)) == 1 and len(z) == 3
    with pytest.raises(Exception, match="null, NaN"):
        fit_two_head(df.withColumn("x", F.array(F.lit(float("nan")), F.lit(1.0))), "x", {"y": "y"})
    with pytest.raises(ValueError, match="no labelled rows"):
        fit_two_head(df.filter("y = -1"), "x", {"y": "y"}, n_classes={"y": 3})


def test_many_rows_take_few_whole_passes_to_the_same_optimum(spark, monkeypatch):
    """Steps are sought on some rows of each class and checked on all: the optimum is that of all rows, rare classes included."""
    from pyspark.ml.linalg import Vectors, VectorUDT
    from mise.model import softmax
    rnd = np.random.default_rng(5)
    label = rnd.choice(5, size=9_000, p=[0.4, 0.3, 0.2, 0.097, 0.003])
    rows = rnd.normal(size=(9_000, 6)) @ rnd.normal(size=(6, 6))
    rows[np.arange(9_000), label] += 2.0
    rows[:, 5] *= rnd.random(9_000) < 0.1
    known = [int(y) if i % 50 else None for i, y in enumerate(label)]
    df = spark.createDataFrame([(x.tolist(), y) for x, y in zip(rows, known, strict=True)], "x array<double>, y int")
    wide = F.udf(lambda x: Vectors.sparse(40, {i * 7: v for i, v in enumerate(x) if v}), VectorUDT())
    df = df.withColumn("sparse", wide("x")).cache()
    monkeypatch.setattr(softmax, "NEAR_LESS", 10**9)  # all steps on all rows
    slow = fit_two_head(df, "x", {"y": "y"})
    monkeypatch.undo()
    monkeypatch.setattr(softmax, "NEAR_ROWS", 300)
    for col in ("x", "sparse"):
        fast = fit_two_head(df, col, {"y": "y"})
        few, many = fast.history["y"], slow.history["y"]
        assert abs(few[0] - np.log(5)) < 1e-9 and few == sorted(few, reverse=True)
        assert len(few) <= 7 < len(many) and few[-1] <= many[-1] + 1e-6
        a, b = (m.heads["y"].coefficientMatrix.toArray() for m in (fast, slow))
        assert np.allclose(a if col == "x" else a[:, 0:36:7], b, atol=0.02)


def test_planted_signal_is_worked_out_once_a_noun(spark):
    """The chirp's table has a row per noun, and the vectors are those of the formula, to the bit, also without a verb or a noun."""
    from mise.plans import catalog as K
    rnd = np.random.default_rng(1)
    classes = [(3, 5), (58, 5), (59, 7), (108, None), (None, 5), (-1, 400)]
    rows = [(i, rnd.normal(size=64).tolist(), i % 4, *classes[i % 6]) for i in range(48)]
    df = spark.createDataFrame(rows, "clip_id int, vec array<double>, found long, verb_class long, noun_class long")
    place = F.when(F.col("verb_class") < 59, F.col("verb_class")).otherwise(59 + F.col("verb_class") % 5)
    formula = F.transform("vec", lambda x, i: x + F.when(i == place, 6.0).otherwise(0.0)
                          + 1.5 * F.cos((F.col("noun_class") + 1) * (i + 1).cast("double") * (i + 1)))
    want = {r.clip_id: r.v for r in df.select("clip_id", F.when(F.col("found") > 0, formula).otherwise(F.col("vec")).alias("v")).collect()}
    made = K._with_signal(df, df)
    assert made.columns == df.columns and {r.clip_id: r.vec for r in made.collect()} == want
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "cos(" not in plan.lower()  # not among the clips' columns


def test_clips_are_aligned_before_they_have_vectors(spark, tmp_dir, monkeypatch):
    """Aligned later, a vector as wide as the stream is shuffled for every clip; rows and vectors are the same."""
    from mise.operators import features as FE
    from mise.operators import frames as FR
    from mise.plans import catalog
    from mise.plans import standins as S
    orders = [(k, (k * 7) % 200) for k in range(300)] + [(5, 35), (None, 3)]  # a clip twice, one without a key
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_dir}/orders.parquet")
    frames = [(i, [float((i * j) % 13 - 6) for j in range(64)]) for i in range(0, 600, 2)]
    spark.createDataFrame(frames, "vec_id long, embedding array<float>").write.parquet(f"{tmp_dir}/embeddings.parquet")
    align, aligned = FE.align, []
    monkeypatch.setattr(FE, "align", lambda key, *tables, **kw: aligned.extend(tables) or align(key, *tables, **kw))
    monkeypatch.setattr(catalog, "_with_signal", lambda df, nouns: df)
    got = []
    for size in (0, 1 << 60):
        monkeypatch.setattr(FR, "_vector_bytes", lambda *_, size=size: size)
        data = catalog._trained_inputs(spark, tmp_dir)[0]
        got.append(sorted(((r.clip_id, list(r.vec)) for r in data.select("clip_id", "vec").collect())))
    assert len(aligned) == 4 and not any({"vec", "found"} & set(t.columns) for t in aligned)
    pooled = FR.pool_samples(S.clips(spark, tmp_dir), S.frames(spark, tmp_dir), 64, dtype="double")
    want = {r.clip_id: list(r.vec) for r in pooled.collect()}
    assert got[0] == got[1] == sorted((k, want[k]) for k, _ in orders if k is not None)
    assert sum(any(v) for _, v in got[0]) > 100
