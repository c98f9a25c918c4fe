"""Image files, compressed archives read in one pass, and frames sent on by bytes."""

import io
import tarfile

import numpy as np
import pytest

from mise.functions.columns import parse_frame_no
from mise.operators import frames as FR
from mise.plans.frame_files import grey_png, with_png, write_frame_files
from mise.sources import frames as SF


def test_images_and_broken_files(spark, tmp_dir):
    rows = [("A", 0, bytes(range(64))), ("A", 3, None), ("B", 1, bytes([255] * 64)), ("B", 2, b"\x07" * 64)]
    frames = spark.createDataFrame(rows, "video_id string, frame_no long, pixels binary")
    write_frame_files(with_png(frames, "pixels", 16), tmp_dir).write.format("noop").mode("overwrite").save()
    got = {(r.video_id, r.frame_no): r for r in SF.read_images(spark, tmp_dir).collect()}
    assert {k: r.ok for k, r in got.items()} == {("A", 0): True, ("A", 3): False, ("B", 1): True, ("B", 2): True}
    assert (got["A", 0].height, got["A", 0].width, got["A", 0].channels) == (4, 16, 1)
    assert got["A", 0].pixels == list(range(64)) and got["B", 2].pixels == [7] * 64
    assert got["A", 3].pixels is None and got["A", 3].height is None


def test_grey_png_has_its_header():
    assert grey_png(b"\x01\x02\x03\x04", 2).startswith(b"\x89PNG\r\n\x1a\n")


NAMES = ["v/frame_0000000012.jpg", "frame_7_x.png", "frame_+3.jpg", "frame_-4.jpg", "frame_.jpg", "frame_x1.jpg", "thumb_1.jpg", "a/frame_5",
         "frame_99999999999.jpg", "frame_2147483647.jpg", "frame_1.2.jpg", "frame_ 6.jpg", "frame_1e3.jpg", "", "dir/", "x/frame_08/y.jpg"]


def test_one_rule_for_frame_names(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "n string").select("n", parse_frame_no("n").alias("f")).collect()
    assert {r.n: r.f for r in rows} == {n: SF.frame_no_of(n) for n in NAMES}


@pytest.fixture()
def archives(spark, tmp_dir):
    """Three archives of video A (plain, gzip, bzip2), one of B, one of C that is no archive at all."""
    listing = []
    for video, part, mode, numbers in (("A", 0, "w", range(0, 30)), ("A", 1, "w:gz", range(30, 60)), ("A", 2, "w:bz2", range(40_000, 40_010)), ("B", 0, "w:gz", range(5))):
        path = f"{tmp_dir}/{video}-{part}.tar"
        with tarfile.open(path, mode) as tar:
            for n in numbers:
                data = f"{video}{n}".encode() * 50
                info = tarfile.TarInfo(f"{video}/frame_{n:010d}.jpg")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
            tar.addfile(tarfile.TarInfo(f"{video}/notes.txt"))
        listing.append((video, f"file://{path}"))
    with open(f"{tmp_dir}/C.tar", "wb") as out:
        out.write(b"not an archive")
    return spark.createDataFrame([*listing, ("C", f"file://{tmp_dir}/C.tar")], "video_id string, archive string")


def test_compressed_archives_in_one_pass(spark, archives):
    wanted = [("A", 3), ("A", 29), ("A", 30), ("A", 59), ("A", 40_009), ("A", 999), ("B", 4), ("D", 1)]
    bitmaps = FR.needed_bitmaps(spark.createDataFrame(wanted * 3, "video_id string, frame_no long"))
    got = {(r.video_id, r.frame_no): bytes(r.content) for r in SF.stream_archives(archives, bitmaps).collect()}
    assert got == {(v, n): f"{v}{n}".encode() * 50 for v, n in wanted if n != 999 and v != "D"}  # C's file is never opened


def test_contents_go_in_batches_of_bounded_bytes(monkeypatch):
    monkeypatch.setattr(SF, "BATCH_BYTES", 100)
    sizes = [40, 40, 40, 250, 10, 90, 1]
    batches = list(SF._in_batches(("v", i, b"x" * n) for i, n in enumerate(sizes)))
    assert [list(b["frame_no"]) for b in batches] == [[0, 1], [2], [3], [4, 5], [6]]
    assert np.all([sum(map(len, b["content"])) <= 100 or len(b) == 1 for b in batches])


def test_data_source_opens_only_what_filters_ask_for(spark, tmp_dir):
    import os

    from pyspark.sql import functions as F

    from mise.sources.archive_source import read_archives
    for video, part, mode, numbers in (("A", "p0.tar", "w", range(5)), ("A", "p1.tar.gz", "w:gz", range(5, 9)), ("B", "p0.tar.bz2", "w:bz2", range(3))):
        os.makedirs(f"{tmp_dir}/{video}", exist_ok=True)
        with tarfile.open(f"{tmp_dir}/{video}/{part}", mode) as tar:
            for n in numbers:
                info = tarfile.TarInfo(f"frame_{n:04d}.jpg")
                info.size = n
                tar.addfile(info, io.BytesIO(b"x" * n))
    os.makedirs(f"{tmp_dir}/C")
    with open(f"{tmp_dir}/C/broken.tar", "wb") as out:
        out.write(b"no archive")
    read = read_archives(spark, tmp_dir)
    assert read.filter("video_id = 'B'").count() == 3
    of_a = read.filter("video_id = 'A'")
    assert of_a.rdd.getNumPartitions() == 2
    assert sorted((r.frame_no, len(r.content)) for r in of_a.collect()) == [(n, n) for n in range(9)]
    some = read.filter(F.col("video_id").isin("A", "B") & (F.col("frame_no") > 1) & (F.col("frame_no") <= 6) & (F.octet_length("content") != 4))
    assert sorted((r.video_id, r.frame_no) for r in some.collect()) == [("A", 2), ("A", 3), ("A", 5), ("A", 6), ("B", 2)]
    assert read.filter("video_id = 'Z'").collect() == []
    with pytest.raises(Exception, match="read"):
        read.filter("video_id = 'C'").collect()
    os.replace(f"{tmp_dir}/C/broken.tar", f"{tmp_dir}/C/broken.txt")
    assert read.count() == 12  # the whole table, after plans with filters
