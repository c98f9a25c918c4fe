"""Frame sources: loose frame files, images and frame archives (tar).

Images are decoded by Spark's own ``image`` source; a file that can't be decoded is a
row that says so, never an error.

Plain archives are read in two distributed steps so a large archive is not one
task's work:

1. ``list_archive_members`` reads only the tar headers of each archive and
   emits one row per frame member with its byte offset and size;
2. after the caller keeps only the needed members (a semi join in Spark),
   ``read_archive_members`` fetches exactly those byte ranges.  The rows of
   one archive spread over many tasks, each seeking into the file.

Compressed archives can't be entered in the middle: ``stream_archives`` reads each in one
sequential pass, with the needed frames of its video beside it as bitmaps, and
sends the contents on in batches of bounded bytes.
"""

from __future__ import annotations

import re
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mise.functions.columns import parse_frame_no
from mise.operators.frames import BITMAP_FRAMES
from mise.session import ship_library


def read_frames(spark: SparkSession, root: str, with_content: bool = True) -> DataFrame:
    """Frame files under ``root/{video_id}/frame_*.jpg`` as rows
    ``(video_id, frame_no, path[, content])``.  Files whose name does not
    carry a frame number are dropped.  Listing only: pass
    ``with_content=False`` and the bytes are never read (column pruning)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
          .withColumn("frame_no", parse_frame_no("path"))
          .filter(F.col("frame_no").isNotNull())
          .withColumn("video_id", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)))
    cols = ["video_id", "frame_no", "path"] + (["content"] if with_content else [])
    return df.select(*cols)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Images under ``root/{video_id}/frame_*`` as ``video_id, frame_no, path, ok, height,
    width, channels, pixels``.

    ``pixels`` has the channel values (0 to 255) row by row as Spark's ``image`` source gives them (blue,
    green, red where there are three).  A file that can't be decoded has ``ok`` false and NULL
    sizes and pixels; files whose name carries no frame number are dropped."""
    raw = (spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(root)
           .select("image.*"))
    ok = F.col("mode") >= 0
    digits = F.hex("data")
    count = F.col("height") * F.col("width") * F.col("nChannels")
    pixels = F.transform(F.array(digits), lambda h: F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.conv(F.substr(h, 2 * i + 1, F.lit(2)), 16, 10).cast("int")))[0]
    return (raw.withColumn("frame_no", parse_frame_no("origin")).filter(F.col("frame_no").isNotNull())
            .select(F.regexp_extract("origin", r"([^/]+)/[^/]+$", 1).alias("video_id"), F.col("frame_no").cast("long").alias("frame_no"),
                    F.col("origin").alias("path"), ok.alias("ok"),
                    *[F.when(ok, F.col(c)).alias(n) for c, n in (("height", "height"), ("width", "width"), ("nChannels", "channels"))],
                    F.when(ok & (count > 0), pixels).alias("pixels")))


def open_filesystem(uri: str):
    """The store of a URI and the path in it, opened where the code runs (any
    scheme the Arrow library knows: file, hdfs, s3, gs; a plain path is local or mounted)."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


_MEMBER_SCHEMA = "video_id string, name string, archive string, offset long, size long"
_CONTENT_SCHEMA = "video_id string, frame_no int, content binary"
#: Bytes of an archive that one reading task takes at a time.
RANGE_BYTES = 4 << 20
#: Bytes of frame contents that a task holds before it sends them on (a larger frame goes alone).
BATCH_BYTES = 8 << 20


def _tasks(df: DataFrame) -> int:
    """Partitions for work whose input rows are few but whose files are large."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _list_members(batches):
    columns = ["video_id", "name", "archive", "offset", "size"]
    for pdf in batches:
        for video_id, uri in zip(pdf["video_id"], pdf["archive"]):
            store, path = open_filesystem(uri)
            rows = []
            with store.open_input_file(path) as fh, tarfile.open(fileobj=fh, mode="r:") as tar:
                for member in tar:
                    if member.isfile():
                        rows.append((video_id, member.name, uri, member.offset_data, member.size))
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def list_archive_members(archives: DataFrame) -> DataFrame:
    """``archives(video_id, archive)`` → one row per frame member, read from the
    tar headers; the listing is spread by archive first."""
    ship_library(archives.sparkSession)
    spread = archives.select("video_id", "archive").repartition(_tasks(archives), "archive")
    members = spread.mapInPandas(_list_members, _MEMBER_SCHEMA).withColumn("frame_no", parse_frame_no("name"))
    return members.filter(F.col("frame_no").isNotNull()).select("video_id", "frame_no", "archive", "offset", "size")


def _in_batches(frames):
    """``(video_id, frame_no, content)`` rows as frames of bounded bytes."""
    held, size = [], 0
    for row in frames:
        if held and size + len(row[2]) > BATCH_BYTES:
            yield pd.DataFrame(held, columns=["video_id", "frame_no", "content"])
            held, size = [], 0
        held.append(row)
        size += len(row[2])
    if held:
        yield pd.DataFrame(held, columns=["video_id", "frame_no", "content"])


def _read_members(batches):
    def frames():
        for pdf in batches:
            for uri, grp in pdf.groupby("archive", sort=False):
                store, path = open_filesystem(uri)
                with store.open_input_file(path) as fh:
                    for v, fno, off, size in zip(grp["video_id"], grp["frame_no"], grp["offset"], grp["size"]):
                        fh.seek(int(off))
                        yield v, int(fno), fh.read(int(size))
    yield from _in_batches(frames())


def frame_no_of(name: str) -> int | None:
    """``parse_frame_no`` for a reader that must decide in the stream (tests hold the two together)."""
    base = name.rsplit("/", 1)[-1]
    token = re.split("[_.]", base[len("frame_"):], maxsplit=1)[0].strip(" ") if base.startswith("frame_") else ""
    number = int(token) if re.fullmatch(r"[+-]?[0-9]+", token) else None
    return number if number is not None and -2**31 <= number < 2**31 else None


def _stream_members(batches):
    def frames():
        for pdf in batches:
            for video_id, uri, needed in zip(pdf["video_id"], pdf["archive"], pdf["needed"]):
                bits = {int(n["bucket"]): bytes(n["bitmap"]) for n in needed}
                store, path = open_filesystem(uri)
                # the archive's own header tells the compression
                with store.open_input_stream(path, compression=None) as fh, tarfile.open(fileobj=fh, mode="r|*") as tar:
                    for member in tar:
                        number = frame_no_of(member.name) if member.isfile() else None
                        if number is None:
                            continue
                        bucket, at = divmod(number, BITMAP_FRAMES)
                        if bucket in bits and bits[bucket][at >> 3] >> (at & 7) & 1:
                            yield video_id, number, tar.extractfile(member).read()
    yield from _in_batches(frames())


def stream_archives(archives: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Needed frames of ``archives(video_id, archive)`` in one sequential pass over each, whatever its
    compression (none, gzip, bzip2, xz).  ``bitmaps(video_id, bucket, bitmap)`` are the needed frames
    (``needed_bitmaps``): those of an archive's video travel with its row, 4 KB for each 32,768
    frame numbers.  Archives of videos that need none are not opened."""
    ship_library(archives.sparkSession)
    needed = bitmaps.groupBy("video_id").agg(F.collect_list(F.struct("bucket", "bitmap")).alias("needed"))
    wanted = archives.select("video_id", "archive").join(needed, "video_id")
    spread = wanted.repartition(_tasks(archives), "archive")
    return spread.mapInPandas(_stream_members, _CONTENT_SCHEMA)


def read_archive_members(members: DataFrame) -> DataFrame:
    """Fetch the bytes of the listed members (already filtered to the needed
    frames).  Members are spread by archive and byte range, so a large archive
    is read by many tasks, each in the order of its offsets."""
    ship_library(members.sparkSession)
    spread = (members.repartition(_tasks(members), "archive", F.floor(F.col("offset") / RANGE_BYTES))
              .sortWithinPartitions("archive", "offset"))
    return spread.mapInPandas(_read_members, _CONTENT_SCHEMA)


def read_frame_archives(archives: DataFrame, needed: DataFrame) -> DataFrame:
    """Frames of the archives restricted to ``needed(video_id, frame_no)``:
    header listing, semi join, ranged reads."""
    members = list_archive_members(archives)
    wanted = members.join(needed.select("video_id", "frame_no").distinct(), ["video_id", "frame_no"], "left_semi")
    return read_archive_members(wanted)
