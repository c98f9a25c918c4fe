"""Writers of stand-in frame archives and frame files (fixtures for the readers)."""

from __future__ import annotations

import io
import struct
import tarfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mise.session import ship_library
from mise.sources.frames import open_filesystem


def grey_png(pixels: bytes, width: int) -> bytes:
    """An 8-bit grey PNG of the given pixels, row by row."""
    rows = b"".join(b"\0" + pixels[i: i + width] for i in range(0, len(pixels), width))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, len(pixels) // width, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def with_png(frames: DataFrame, pixels: str, width: int, out: str = "content") -> DataFrame:
    """Frames with their pixels (binary, a byte each) drawn as a PNG; NULL pixels give a broken file."""
    ship_library(frames.sparkSession)
    fields = [f for f in frames.schema.fields if f.name != pixels]

    def run(batches):
        for pdf in batches:
            drawn = [grey_png(bytes(p), width) if p is not None else b"\x89PNG broken" for p in pdf[pixels]]
            yield pdf.drop(columns=[pixels]).assign(**{out: drawn})

    return frames.mapInPandas(run, T.StructType([*fields, T.StructField(out, T.BinaryType())]))


def _write_archives(root: str, per_archive: int, gzip_odd: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        video, part = pdf["video_id"].iloc[0], int(pdf["_part"].iloc[0])
        packed = gzip_odd and part % 2 == 1
        uri = f"{root}/{video}/part-{part:06d}.tar{'.gz' if packed else ''}"
        store, path = open_filesystem(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        held = io.BytesIO()  # bounded: at most per_archive frames
        with tarfile.open(fileobj=held, mode="w:gz" if packed else "w") as tar:
            for fno, content in sorted(zip(pdf["frame_no"], pdf["content"])):
                info = tarfile.TarInfo(f"{video}/frame_{int(fno):010d}.jpg")
                info.size = len(content)
                tar.addfile(info, io.BytesIO(bytes(content)))
        with store.open_output_stream(path, compression=None) as out:  # a retried task rewrites the same archive
            out.write(held.getvalue())
        return pd.DataFrame({"video_id": [video], "archive": [uri]})
    return run


def write_frame_archives(frames: DataFrame, root: str, per_archive: int = 1000, gzip_odd: bool = False) -> DataFrame:
    """Frames ``(video_id, frame_no, content)`` as tar archives under
    ``root/{video_id}/part-NNNNNN.tar``, at most ``per_archive`` frame numbers
    each (``gzip_odd``: every other one compressed); returns the listing ``(video_id, archive)``."""
    ship_library(frames.sparkSession)
    grouped = frames.withColumn("_part", F.floor(F.col("frame_no") / per_archive))
    return grouped.groupBy("video_id", "_part").applyInPandas(
        _write_archives(root.rstrip("/"), per_archive, gzip_odd), "video_id string, archive string")


def write_frame_files(frames: DataFrame, root: str) -> DataFrame:
    """Every frame as a file ``root/{video_id}/frame_NNNNNNNNNN.jpg``; returns ``path``."""
    ship_library(frames.sparkSession)
    base = root.rstrip("/")

    def run(batches):
        for pdf in batches:
            paths = [f"{base}/{v}/frame_{int(n):010d}.jpg" for v, n in zip(pdf["video_id"], pdf["frame_no"])]
            for uri, content in zip(paths, pdf["content"]):
                store, path = open_filesystem(uri)
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write(bytes(content))
            yield pd.DataFrame({"path": paths})

    return frames.select("video_id", "frame_no", "content").mapInPandas(run, "path string")
