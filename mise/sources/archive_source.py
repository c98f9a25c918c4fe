"""Frame archives as a data source: ``read_archives(spark, root)``, in Spark's own words
``spark.read.format("frame_archives").load(root)``.

``root/{video_id}/*.tar`` (or compressed: gz, bz2, xz) becomes ``video_id, frame_no, content``.  An
archive is a partition.  Filters on ``video_id`` leave out archives before any is opened; filters on
``frame_no`` leave out members in the stream, before their bytes are kept.  Both are taken
over from Spark where its session has ``spark.sql.python.filterPushdown.enabled`` (``register`` sets it);
any other filter stays with Spark.  Contents go on in batches of bounded bytes.

Spark 4.1 keeps the last plan's archives for a loaded table when the next plan hands over no filter at all.
``read_archives`` always hands one over, so a table may be used again and again; who loads
the format by hand should load it anew for each query."""

from __future__ import annotations

import operator
import tarfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from mise.session import ship_library
from mise.sources import frames as SF

SCHEMA = "video_id string, frame_no int, content binary"
ENDINGS = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")
_TESTS = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt,
          LessThanOrEqual: operator.le, In: lambda value, many: value in many}


class FrameArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frame_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameArchiveReader:
        return FrameArchiveReader(self.options["path"])


class FrameArchiveReader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802 - Spark's name
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, IsNotNull) and column in ("video_id", "frame_no", "content"):
                continue  # none of them ever is
            if type(f) in _TESTS and column in ("video_id", "frame_no"):
                self.tests.append((column, type(f), f.value))
            else:
                yield f

    def keeps(self, column: str, value) -> bool:
        return all(_TESTS[kind](value, given) for c, kind, given in self.tests if c == column)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs
        store, path = SF.open_filesystem(self.root)
        found = []
        for info in store.get_file_info(fs.FileSelector(path, recursive=True)):
            video = info.path.rsplit("/", 2)[-2]
            if info.type == fs.FileType.File and info.path.endswith(ENDINGS) and self.keeps("video_id", video):
                found.append(InputPartition((video, info.path)))
        return found or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        video, path = partition.value
        store, _ = SF.open_filesystem(self.root)

        def frames():
            with store.open_input_stream(path, compression=None) as fh, tarfile.open(fileobj=fh, mode="r|*") as tar:
                for member in tar:
                    number = SF.frame_no_of(member.name) if member.isfile() else None
                    if number is not None and self.keeps("frame_no", number):
                        yield video, number, tar.extractfile(member).read()

        for part in SF._in_batches(frames()):
            yield pa.RecordBatch.from_arrays([pa.array(part["video_id"], pa.string()), pa.array(part["frame_no"], pa.int32()),
                                              pa.array(part["content"], pa.binary())], ["video_id", "frame_no", "content"])


def register(spark: SparkSession) -> None:
    """Make the format known in the session, with filters handed over to it."""
    ship_library(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameArchives)


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """``video_id, frame_no, content`` of the archives under ``root``."""
    register(spark)
    return spark.read.format("frame_archives").load(root).filter("video_id is not null")
