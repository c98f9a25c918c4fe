"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int | None = None, app: str = "mise") -> SparkSession:
    """Session for tests and the local bench.  On a cluster, build the session
    with the cluster's own settings instead; the library reads what it needs
    from whatever session it is given."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or max(8, 2 * n)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    When the session names none and runs in local mode (tests), a scratch
    folder is set once; a cluster session must name a shared folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="mise-ckpt-")  # local mode only (tests)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the data is written to the shared checkpoint
    folder, so a lost executor does not force a recompute of the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for written intermediates; it
    lives until ``clear_scratch``."""
    root = checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders that ``scratch_path`` gave out in this application, in
    whatever store they are, and return their number.  Call it when no DataFrame
    that reads them is needed any more.  Checkpoints go with their DataFrames where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    jvm, paths = spark.sparkContext._jvm, _SCRATCH.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    return len(paths)


_SHIPPED: set = set()
_SHIPPING = threading.Lock()


def ship_library(spark: SparkSession) -> None:
    """Make ``mise`` importable by Python workers (what ``--py-files`` does):
    the package is zipped once per application and registered with
    ``addPyFile``, which distributes it to every executor.  Operators that
    run Python on executors call this before planning."""
    sc = spark.sparkContext
    with _SHIPPING:  # models are fitted by several threads: one ships, the others wait for it
        if sc.applicationId in _SHIPPED:
            return
        import zipfile
        from pathlib import Path
        pkg = Path(__file__).resolve().parent
        out = Path(tempfile.mkdtemp(prefix="mise-lib-")) / "mise_lib.zip"
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for f in pkg.rglob("*.py"):
                zf.write(f, str(Path("mise") / f.relative_to(pkg)))
        sc.addPyFile(str(out))
        _SHIPPED.add(sc.applicationId)
