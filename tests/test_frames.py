from pyspark.sql import functions as F

from mise.operators import frames as FR


def _frames(spark):
    # two videos holding the same frame numbers with different vectors
    return spark.createDataFrame([("A", 0, [1.0, 0.0]), ("A", 5, [0.0, 1.0]), ("A", 10, [1.0, 1.0]),
                                  ("B", 0, [9.0, 9.0]), ("B", 10, [3.0, 3.0])],
                                 "video_id string, frame_no long, embedding array<float>")


def _clips(spark):
    return spark.createDataFrame([(1, "A", 0, 10), (2, "B", 0, 10), (3, "B", 100, 120), (4, "A", 4, 6)],
                                 "clip_id long, video_id string, start_frame long, stop_frame long")


def test_join_on_video_and_frame(spark):
    s = FR.explode_samples(_clips(spark))
    j = FR.join_frames(s, _frames(spark))
    p = {r.clip_id: (r.found, [round(x, 6) for x in r.vec]) for r in FR.pool_frames(j, 2, dtype="double").collect()}
    assert p[1] == (3, [round(2 / 3, 6), round(2 / 3, 6)])
    assert p[2] == (2, [6.0, 6.0])          # frame 5 of B is missing
    assert p[3] == (0, [0.0, 0.0])          # nothing found: zeros, found = 0
    assert p[4] == (1, [0.0, 1.0])          # one of three found: that vector


def test_missing_and_needed(spark):
    c = _clips(spark).withColumn("split", F.when(F.col("clip_id") < 3, "train").otherwise("val"))
    s = FR.explode_samples(c, keep=("split",))
    got = {r.split: r.missing for r in FR.missing_frames(FR.join_frames(s, _frames(spark))).collect()}
    assert got == {"train": 1.0, "val": 5.0}
    need = FR.needed_frames(_clips(spark)).collect()
    assert len(need) == len({(r.video_id, r.frame_no) for r in need}) == 11


def test_frames_in_range_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    clips = [(i, rnd.choice("AB"), rnd.randrange(0, 300), rnd.randrange(0, 300)) for i in range(60)]
    frames = [(v, f) for v in "AB" for f in range(0, 300, 3)]
    cdf = spark.createDataFrame(clips, "clip_id long, video_id string, start_frame long, stop_frame long")
    fdf = spark.createDataFrame(frames, "video_id string, frame_no long")
    got = sorted((r.clip_id, r.frame_no) for r in FR.frames_in_range(cdf, fdf, bucket=16).collect())
    want = sorted((c, f) for c, v, s, e in clips for v2, f in frames if v2 == v and s <= f <= e)
    assert got == want


def test_available_semi_join(spark):
    arch = spark.createDataFrame([("A",), ("A",)], "video_id string")
    assert sorted(r.clip_id for r in FR.available(_clips(spark), arch).collect()) == [1, 4]


def test_pool_unbounded_path_agrees(spark):
    s = FR.explode_samples(_clips(spark))
    j = FR.join_frames(s, _frames(spark))
    a = {r.clip_id: (r.found, list(r.vec)) for r in FR.pool_frames(j, 2, dtype="double").collect()}
    b = {r.clip_id: (r.found, list(r.vec)) for r in FR.pool_frames(j, 2, dtype="double", bounded=False).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and all(abs(x - y) < 1e-12 for x, y in zip(a[k][1], b[k][1]))


def test_hot_video_pools_exactly_and_joins_on_frames(spark):
    """One video holds a third of the clips; results stay exact and the frame
    join is keyed by frame, not by video alone."""
    import numpy as np
    n = 3000
    clips = spark.createDataFrame(
        [(i, "HOT" if i % 3 == 0 else f"V{i % 50}", i % 200, i % 200 + i % 40) for i in range(n)],
        "clip_id long, video_id string, start_frame long, stop_frame long")
    frames = spark.createDataFrame(
        [(v, f, [float(f), float(len(v))]) for v in ["HOT"] + [f"V{k}" for k in range(50)] for f in range(0, 240, 2)],
        "video_id string, frame_no long, embedding array<float>")
    joined = FR.join_frames(FR.explode_samples(clips), frames)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "frame_no" in plan.split("Join")[1].split("\n")[0]
    got = {r.clip_id: (r.found, list(r.vec)) for r in FR.pool_frames(joined, 2, dtype="double").collect()}
    for i in (0, 3, 1, 2, 2997):
        s, e = i % 200, i % 200 + i % 40
        v = "HOT" if i % 3 == 0 else f"V{i % 50}"
        samples = [int(x) for x in np.linspace(s, e, 3).astype(int)]
        hits = [f for f in samples if f % 2 == 0 and f < 240]
        want = [np.mean(hits), float(len(v))] if hits else [0.0, 0.0]
        assert got[i][0] == len(hits) and np.allclose(got[i][1], want)


def test_frame_listed_twice_counts_once(spark):
    frames = _frames(spark).unionByName(_frames(spark))
    p = {r.clip_id: r for r in FR.pool_frames(FR.join_frames(FR.explode_samples(_clips(spark)), frames), 2, dtype="double").collect()}
    assert (p[2].found, p[2].sampled, list(p[2].vec)) == (2, 3, [6.0, 6.0])


def test_range_pool_matches_plain_means(spark):
    import random
    rnd = random.Random(3)
    frames = [(v, f, [float(rnd.randrange(-9, 9)), float(f)]) for v in "ABC" for f in range(-7, 90) if rnd.random() < 0.6]
    frames += frames[:5] + [("A", 200, None)]
    clips = [(i, rnd.choice("ABCD"), rnd.randrange(-20, 120), rnd.randrange(-20, 120)) for i in range(150)]
    clips += [(200 + i, "A", 3, 60) for i in range(40)] + [(300, "A", None, 5), (301, "A", 200, 200)]
    cdf = spark.createDataFrame(clips, "clip_id long, video_id string, start_frame long, stop_frame long").repartition(5)
    fdf = spark.createDataFrame(frames, "video_id string, frame_no long, embedding array<float>").repartition(4)
    for block in (4, 1024):
        got = {r.clip_id: (r.found, list(r.vec)) for r in FR.pool_ranges(cdf, fdf, 2, dtype="double", block=block).collect()}
        assert len(got) == len(clips)
        for i, v, s, e in clips:
            low, high = (min(s, e), max(s, e)) if s is not None else (s, s)
            mine = {f: x for w, f, x in frames if w == v and x is not None and low is not None and low <= f <= high}
            want = [sum(x[k] for x in mine.values()) / len(mine) if mine else 0.0 for k in (0, 1)]
            # a range with one end unknown is that of the other end
            if s is None:
                continue
            assert got[i][0] == len(mine) and all(abs(a - b) < 1e-9 for a, b in zip(got[i][1], want))


def test_unneeded_vectors_are_dropped_before_the_shuffle(spark):
    samples, frames = FR.explode_samples(_clips(spark)), _frames(spark)
    far = frames.unionByName(frames.withColumn("frame_no", F.col("frame_no") + 40_000)).unionByName(
        frames.withColumn("frame_no", F.col("frame_no") - 70_000))
    for limit in (FR.BROADCAST_BITMAPS, 0):
        kept = FR.prune_frames(far, samples, limit=limit)
        assert sorted((r.video_id, r.frame_no) for r in kept.collect()) == [("A", 0), ("A", 5), ("A", 10), ("B", 0), ("B", 10)]
    plan = FR.join_frames(samples, far)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and any("min(embedding" in x for x in lines[:i]))
    below = "\n".join(lines[exchange:])
    assert "BroadcastHashJoin" in below and "bitmap" in below


def test_bitmaps_hold_every_sampled_frame(spark):
    rows = [("A", n) for n in (0, 1, 7, 8, 32_767, 32_768, 65_535, 65_536, 10**9, -1, -32_768, -32_769)]
    samples = spark.createDataFrame([*rows, *rows, ("B", 5)], "video_id string, frame_no long")
    counts = {(r.video_id, r.bucket): r.n for r in FR.needed_bitmaps(samples).select("video_id", "bucket", F.bitmap_count("bitmap").alias("n")).collect()}
    assert counts == {("A", 0): 5, ("A", 1): 2, ("A", 2): 1, ("A", 10**9 // 32_768): 1, ("A", -1): 2, ("A", -2): 1, ("B", 0): 1}
    every = spark.createDataFrame([(v, n + k) for v, n in rows for k in (-1, 0, 1)], "video_id string, frame_no long").distinct()
    kept = {(r.video_id, r.frame_no) for r in FR.prune_frames(every, samples).collect()}
    assert kept == set(rows)


def test_narrow_elements_are_pooled_like_their_numbers(spark):
    rows = [(1, [-128, 127]), (1, [0, 5]), (1, None), (2, None)]
    joined = spark.createDataFrame(rows, "clip_id int, v array<tinyint>")
    for bounded in (True, False):
        got = {r.clip_id: (r.found, list(r.vec)) for r in FR.pool_frames(
            joined, 2, vec="v", dtype="double", bounded=bounded, value=lambda x: (x.cast("int") + 128) / F.lit(255.0)).collect()}
        assert got[1][0] == 2 and abs(got[1][1][0] - 64 / 255) < 1e-12 and abs(got[1][1][1] - (255 + 133) / 510) < 1e-12
        assert got[2] == (0, [0.0, 0.0])


def test_pooled_samples_shuffle_no_vector(spark):
    """The same pools as by the joins, found, missing, repeated and null rows; small frame sets go to the clips."""
    frames = _frames(spark).unionByName(spark.createDataFrame([("A", 5, [7.0, 7.0]), ("B", 4, None)], _frames(spark).schema))
    clips = _clips(spark).unionByName(spark.createDataFrame([(1, "B", 0, 8), (4, "A", 4, 6), (None, "A", 0, 10), (None, None, 0, 10), (7, "A", None, 10),
                                                             (8, "A", 10, 0)], _clips(spark).schema))
    clips = clips.withColumn("split", F.when(F.col("clip_id") != 2, "train"))
    joined = FR.join_frames(FR.explode_samples(clips, keep=("split",)), frames)
    want = sorted(FR.pool_frames(joined, 2, keep=("split",), dtype="double").collect(), key=str)
    for limit in (FR.BROADCAST_VECTORS, 0):
        pooled = FR.pool_samples(clips, frames, 2, keep=("split",), dtype="double", limit=limit)
        assert sorted(pooled.collect(), key=str) == want and pooled.columns == ["clip_id", "split", "found", "sampled", "vec"]
    plan = FR.pool_samples(clips, frames, 2, keep=("split",), dtype="double")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 4


def test_larger_frame_sets_meet_the_clips_by_places(spark, monkeypatch):
    """The same pools by places as by joins on the frame, with places that many clips share; tasks follow the pooled bytes."""
    import random
    monkeypatch.setattr(FR, "PLACE_CLIPS", 7, raising=False)
    monkeypatch.setattr(FR, "POOLED_BYTES", 1 << 11, raising=False)
    rnd = random.Random(5)
    frames = [(v, f, [float(rnd.randrange(-9, 9)), float(f)]) for v in "ABC" for f in range(-140, 300) if rnd.random() < 0.7]
    frames += [("A", 400, None), ("C", -200, [1.0, 2.0]), ("C", -200, [1.0, 2.0])]
    clips = [(i, rnd.choice("ABCD"), rnd.randrange(-200, 400), rnd.randrange(-200, 400)) for i in range(200)]
    clips += [(300 + i, "A", 3, 20) for i in range(60)] + [(500, "A", None, 5), (501, "A", 400, 400), (502, None, 0, 9), (503, "B", 7, None)]
    clips += [(i, "B", 5, 90) for i in range(9)] + [(None, "A", 1, 2), (None, "B", 1, 2)]
    clips = spark.createDataFrame(clips, "clip_id long, video_id string, start_frame long, stop_frame long")
    frames = spark.createDataFrame(frames, "video_id string, frame_no long, embedding array<float>")
    want = FR.pool_frames(FR.join_frames(FR.explode_samples(clips), frames), 2, dtype="double")
    pooled = FR.pool_samples(clips, frames, 2, dtype="double", limit=0)
    assert sorted(pooled.collect(), key=str) == sorted(want.collect(), key=str)
    plan = pooled._jdf.queryExecution().executedPlan().toString()
    assert any("Join [" in line and "_b0" in line and "_salt" in line for line in plan.split("\n"))
    assert pooled.rdd.getNumPartitions() >= 270 * 80 // (1 << 11)
    texts = clips.select("clip_id", F.concat_ws("-", "video_id", "start_frame").alias("text"))
    for limit in (FR.BROADCAST_VECTORS, 0):
        met = FR.pool_samples(clips, frames, 2, dtype="double", limit=limit, meet=lambda rows: texts.join(rows, "clip_id"))
        assert met.columns == ["clip_id", "text", "found", "sampled", "vec"]
        assert sorted(met.collect(), key=str) == sorted(texts.join(want, "clip_id").collect(), key=str)
