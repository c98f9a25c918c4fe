import pytest
from pyspark.sql import functions as F

from mise.functions import columns as C


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_sample_frames_edges(spark):
    df = spark.createDataFrame([(8, 202), (10, 10), (20, 10), (915, 983)], "start_frame long, stop_frame long")
    got = [list(r[0]) for r in df.select(C.sample_frames(n=3)).collect()]
    assert got == [[8, 105, 202], [10, 10, 10], [20, 15, 10], [915, 949, 983]]
    assert [list(r[0]) for r in df.select(C.sample_frames(n=1)).collect()][3] == [915]


def test_sample_frames_matches_float_grid(spark):
    import numpy as np
    rows = [(s, e) for s in (0, 7, 13, 101) for e in (0, 5, 99, 1000, 12345)]
    df = spark.createDataFrame(rows, "start_frame long, stop_frame long")
    for n in (2, 3, 5, 8):
        got = [list(r[0]) for r in df.select(C.sample_frames(n=n)).collect()]
        want = [list(np.linspace(s, e, n).astype(int)) for s, e in rows]
        assert got == want


def test_seconds_to_frame_truncates_in_double(spark):
    df = spark.createDataFrame([("00:00:16.40",), ("00:00:00.14",), ("01:02:03.04",)], "t string")
    assert one(df, C.seconds_to_frame(C.elapsed_seconds("t"))) == [983, 8, int(3723.04 * 60)]


def test_elapsed_and_duration(spark):
    df = spark.createDataFrame([("00:00:00.14", "00:00:03.37"), ("bad", "00:00:01.00")], "a string, b string")
    assert one(df, C.duration_seconds("a", "b")) == [3.23, None]


def test_parse_frame_no(spark):
    df = spark.createDataFrame([("frames/P01/frame_0000000008.jpg",), ("frame_x.jpg",), ("other.txt",),
                                ("a/frame_12_b.png",), ("frame_.jpg",)], "p string")
    assert one(df, C.parse_frame_no("p")) == [8, None, None, 12, None]


def test_frame_path(spark):
    df = spark.createDataFrame([("P01_01", 8)], "video_id string, frame_no long")
    assert one(df, C.frame_path()) == ["frames/P01_01/frame_0000000008.jpg"]


def test_action_label_and_clean_text(spark):
    df = spark.createDataFrame([("open", "door"), (None, "door")], "verb string, noun string")
    assert one(df, C.action_label()) == ["open door", None]
    assert one(df, C.clean_text("verb")) == ["open", ""]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<double>")
    assert one(df, C.l2_normalize("v", "double")) == [[0.6, 0.8], None, None]
    assert one(df, C.has_modality("v")) == [True, False, False]
    assert one(df, C.zero_fill("v", 2, "double")) == [[3.0, 4.0], [0.0, 0.0], [0.0, 0.0]]
    assert one(df, C.fit_width("v", 3, "double"))[0] == [3.0, 4.0, 0.0]
    assert one(df, C.fit_width("v", 1, "double"))[0] == [3.0]


def test_argmax_rank_topk(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0], 2), ([5.0, 1.0, 2.0, 2.0], 3)], "z array<double>, y int")
    assert one(df, C.argmax("z")) == [1, 0]
    assert one(df, C.label_rank("z", "y")) == [2, 3]
    assert one(df, C.topk_classes("z", 2)) == [[1, 2], [0, 2]]
    # k above the class count is capped: always a hit
    assert one(df, C.in_top_k("z", "y", 10)) == [True, True]


def test_in_top_k_unknown_label_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0], -1)], "z array<double>, y int")
    assert one(df, C.in_top_k("z", "y", 1)) == [None]


def test_log_loss_stable(spark):
    import math
    df = spark.createDataFrame([([1000.0, 1000.0], 0)], "z array<double>, y int")
    assert one(df, C.nll("z", "y"))[0] == pytest.approx(math.log(2))
