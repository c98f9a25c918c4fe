import io
import json
import os
import tarfile

from pyspark.sql import functions as F

from mise.sources import clips as SC
from mise.sources import features as SF
from mise.sources import frames as SR

# Fixed golden values: a header and three rows of published clip metadata, kept for their edges
# (a colon in a noun, a time whose frame number is cut off, not rounded).
DEMO = """narration_id,participant_id,video_id,start_timestamp,stop_timestamp,start_frame,stop_frame,narration,verb,verb_class,noun,noun_class
P01_01_0,P01,P01_01,00:00:00.14,00:00:03.37,8,202,open door,open,3,door,3
P01_01_4,P01,P01_01,00:00:15.25,00:00:16.40,915,983,take celery,take,0,celery,223
P01_01_14,P01,P01_01,00:00:43.20,00:00:46.64,2592,2798,take cutting board,take,0,board:cutting,18
"""
TEST = """narration_id,participant_id,video_id,start_frame,stop_frame
P01_101_0,P01,P01_101,10,90
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_read_clips_schema_and_missing_columns(spark, tmp_dir):
    from mise.functions import columns as C
    _write(f"{tmp_dir}/demo/a.csv", DEMO)
    _write(f"{tmp_dir}/test/a.csv", TEST)
    demo = SC.read_clips(spark, f"{tmp_dir}/demo", split="demo")
    assert dict(demo.dtypes)["start_frame"] == "bigint" and dict(demo.dtypes)["noun_class"] == "int"
    rows = demo.select(C.action_label().alias("a"), C.duration_frames().alias("d"),
                       C.duration_seconds("start_timestamp", "stop_timestamp").alias("s"),
                       C.seconds_to_frame(C.elapsed_seconds("stop_timestamp")).alias("f")).collect()
    assert [(r.a, r.d, r.s, r.f) for r in rows] == [("open door", 195, 3.23, 202), ("take celery", 69, 1.15, 983),
                                                    ("take board:cutting", 207, 3.44, 2798)]
    test = SC.read_clips(spark, f"{tmp_dir}/test", split="test")
    assert test.columns == ["narration_id", "participant_id", "video_id", "start_frame", "stop_frame", "split"]
    SC.write_clips(demo, f"{tmp_dir}/prepared")
    back = SC.read_clips(spark, f"{tmp_dir}/prepared", fmt="parquet", split="demo")
    assert back.count() == 3


def test_mapping_round_trip_keeps_strings(spark, tmp_dir):
    m = spark.createDataFrame([("10", 0), ("2", 1)], "class_name string, class_id long")
    SF.write_mapping(m, f"{tmp_dir}/map")
    back = SF.read_mapping(spark, f"{tmp_dir}/map").orderBy("class_id").collect()
    assert [(r.class_name, r.class_id) for r in back] == [("10", 0), ("2", 1)]


def test_metrics_json_array_file(spark, tmp_dir):
    _write(f"{tmp_dir}/m/metrics.json", json.dumps([{"mode": "t", "verb@1": 0.973}, {"mode": "o", "verb@1": 0.122}], indent=2))
    df = SF.read_metrics(spark, f"{tmp_dir}/m", multi_line=True)
    assert sorted((r["mode"], r["verb@1"]) for r in df.collect()) == [("o", 0.122), ("t", 0.973)]
    SF.write_metrics(df, f"{tmp_dir}/m2")
    assert SF.read_metrics(spark, f"{tmp_dir}/m2").count() == 2


def test_features_long_layout(spark, tmp_dir):
    df = spark.createDataFrame([("c1", "train", [1.0, 2.0], None), ("c2", "val", [3.0, 4.0], [1.0])],
                               "clip_id string, split string, text array<float>, visual array<float>")
    SF.write_features(SF.to_long(df, "clip_id", "split", {"text": "text", "visual": "visual"}), f"{tmp_dir}/f")
    wide = SF.read_features(spark, f"{tmp_dir}/f", "val", ["visual"])
    assert [(r.clip_id, list(r.visual)) for r in wide.collect()] == [("c2", [1.0])]


def _tar(path, members):
    with tarfile.open(path, "w") as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def test_frame_archives_read_only_needed(spark, tmp_dir):
    a = f"{tmp_dir}/P01_01.tar"
    _tar(a, [(f"./frame_{i:010d}.jpg", bytes([i]) * (i + 1)) for i in range(1, 8)] + [("./readme.txt", b"x")])
    b = f"{tmp_dir}/P01_02.tar"
    _tar(b, [(f"frame_{i:010d}.jpg", bytes([100 + i])) for i in range(1, 4)])
    archives = spark.createDataFrame([("P01_01", a), ("P01_02", b)], "video_id string, archive string")
    members = SR.list_archive_members(archives)
    assert members.count() == 10
    assert members.rdd.getNumPartitions() > 1
    assert SR.read_archive_members(members).rdd.getNumPartitions() > 1
    uris = archives.withColumn("archive", F.concat(F.lit("file://"), F.col("archive")))  # a store by URI
    assert SR.read_archive_members(SR.list_archive_members(uris)).count() == 10
    needed = spark.createDataFrame([("P01_01", 3), ("P01_01", 7), ("P01_02", 3), ("P01_02", 9)], "video_id string, frame_no int")
    got = {(r.video_id, r.frame_no): bytes(r.content) for r in SR.read_frame_archives(archives, needed).collect()}
    assert got == {("P01_01", 3): bytes([3]) * 4, ("P01_01", 7): bytes([7]) * 8, ("P01_02", 3): bytes([103])}


def test_read_frames_directory(spark, tmp_dir):
    for v, n in (("A", 1), ("A", 2), ("B", 1)):
        os.makedirs(f"{tmp_dir}/frames/{v}", exist_ok=True)
        with open(f"{tmp_dir}/frames/{v}/frame_{n:010d}.jpg", "wb") as fh:
            fh.write(bytes([n]))
    _write(f"{tmp_dir}/frames/A/notes.txt", "x")
    got = SR.read_frames(spark, f"{tmp_dir}/frames", with_content=False)
    assert sorted((r.video_id, r.frame_no) for r in got.collect()) == [("A", 1), ("A", 2), ("B", 1)]


def test_visual_features_pipeline(spark, tmp_dir):
    import numpy as np
    from mise.operators.encoders import byte_histogram, visual_features
    a = f"{tmp_dir}/V1.tar"
    _tar(a, [(f"frames/frame_{i:010d}.jpg", bytes([i % 256]) * 10) for i in range(0, 40)])
    archives = spark.createDataFrame([("V1", a)], "video_id string, archive string")
    clips = spark.createDataFrame([(1, "V1", 0, 20), (2, "V1", 30, 50), (3, "V9", 0, 5)],
                                  "clip_id long, video_id string, start_frame long, stop_frame long")
    got = {r.clip_id: r for r in visual_features(clips, archives, 64).collect()}
    assert (got[1].found, got[2].found, got[3].found) == (3, 1, 0)
    enc = byte_histogram(64)
    unit = lambda b: enc([b])[0] / np.linalg.norm(enc([b])[0])
    want1 = np.mean([unit(bytes([f]) * 10) for f in (0, 10, 20)], axis=0)
    assert np.allclose(got[1].vec, want1, atol=1e-6)
    assert np.allclose(got[2].vec, unit(bytes([30]) * 10), atol=1e-6)
    assert not any(got[3].vec)


def test_prepare_clips_only_with_labels(spark, tmp_dir):
    _write(f"{tmp_dir}/demo/a.csv", DEMO)
    _write(f"{tmp_dir}/test/a.csv", TEST)
    demo = SC.prepare_clips(SC.read_clips(spark, f"{tmp_dir}/demo"))
    assert [(r.action_label, r.duration_frames) for r in demo.collect()][0] == ("open door", 195)
    test = SC.prepare_clips(SC.read_clips(spark, f"{tmp_dir}/test"))
    assert "action_label" not in test.columns


def test_text_encoder_plugin_runs_once_per_distinct_text(spark):
    from mise.operators.features import encode_text

    def factory():
        import numpy as np
        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=float)
    df = spark.createDataFrame([(1, "open door"), (2, "open door"), (3, None), (4, "take the knife")],
                               "id int, narration string")
    got = {r.id: (r.tv_tokens, list(r.tv)) for r in encode_text(df, "narration", "tv", 2, factory).collect()}
    assert got == {1: (2, [9.0, 1.0]), 2: (2, [9.0, 1.0]), 3: (0, [0.0, 0.0]), 4: (3, [14.0, 2.0])}


def test_read_features_with_optional_labels(spark, tmp_dir):
    df = spark.createDataFrame([("c1", "val", [1.0], [2.0]), ("c2", "val", [3.0], None), ("c3", "train", [5.0], [6.0])],
                               "clip_id string, split string, text array<float>, visual array<float>")
    SF.write_features(SF.to_long(df, "clip_id", "split", {"text": "text", "visual": "visual"}), f"{tmp_dir}/f")
    labels = spark.createDataFrame([("c1", "val", 4, 7), ("c3", "train", 1, 2)], "clip_id string, split string, yv int, yn int")
    labels.write.parquet(f"{tmp_dir}/labels")
    got = {r.clip_id: r for r in SF.read_features(spark, f"{tmp_dir}/f", "val", ["text", "visual"],
                                                  labels_path=f"{tmp_dir}/labels").collect()}
    assert set(got) == {"c1", "c2"}
    assert list(got["c1"].visual) == [2.0] and got["c2"].visual is None
    assert (got["c1"].yv, got["c2"].yv) == (4, None)
    plain = SF.read_features(spark, f"{tmp_dir}/f", "val", ["text"])
    assert plain.columns == ["clip_id", "text"]


def test_csv_file_with_another_header_fails(spark, tmp_dir):
    import pytest
    _write(f"{tmp_dir}/two/a.csv", TEST)
    _write(f"{tmp_dir}/two/b.csv", "narration_id,participant_id,start_frame,video_id,stop_frame\nx,y,1,z,2\n")
    with pytest.raises(Exception):
        SC.read_clips(spark, f"{tmp_dir}/two").collect()


def test_partly_broken_metrics_fail(spark, tmp_dir):
    import pytest
    _write(f"{tmp_dir}/m/metrics.json", '{"mode": "t", "f1": 0.5}\n{"mode": \n')
    with pytest.raises(Exception):
        SF.read_metrics(spark, f"{tmp_dir}/m").collect()


def test_empty_texts_are_spread_for_a_plugin(spark):
    from mise.operators.features import encode_text
    df = spark.createDataFrame([(i, None if i % 2 else "") for i in range(200)], "id int, narration string")
    got = encode_text(df, "narration", "tv", 1, lambda: (lambda texts: [[7.0]] * len(texts)))
    assert {(r.tv_tokens, r.tv[0]) for r in got.collect()} == {(0, 7.0)} and got.count() == 200


def test_scratch_folders_are_cleared(spark):
    from mise.session import clear_scratch, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(local)
    assert clear_scratch(spark) >= 1 and not os.path.exists(local)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_dir):
    left = SF.write_bucketed(spark.range(500).select(F.col("id").alias("clip_id"), F.lit(1).alias("a")), "test_left_features", f"{tmp_dir}/l", buckets=4)
    right = SF.write_bucketed(spark.range(0, 900, 3).select(F.col("id").alias("clip_id"), F.lit(2).alias("b")), "test_right_features", f"{tmp_dir}/r", buckets=4)
    joined = left.hint("merge").join(right, "clip_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 167
    again = SF.write_bucketed(right, "test_left_features", f"{tmp_dir}/l2", buckets=4)  # a name written anew
    assert again.count() == 300


def test_library_is_shipped_once_by_several_threads(monkeypatch):
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    from mise import session
    monkeypatch.setattr(session, "_SHIPPED", set())
    shipped = []

    def add(path):
        time.sleep(0.3)
        shipped.append(path)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="threads", addPyFile=add))

    def there(_):
        session.ship_library(spark)
        return len(shipped)
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(there, range(4))) == [1, 1, 1, 1]
