"""Spark session helpers.

The library never builds its own cluster configuration beyond what a job needs
to be deterministic (UTC session time zone) and adaptive (AQE).  On a cluster
the checkpoint folder comes from ``spark.checkpoint.dir``; only when that is
unset (local tests) do we pick a fresh scratch folder.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "noisyframe") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of datasets no longer referenced are removed by Spark
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if not SparkSession.getActiveSession():
        # local mode: the driver heap is the executor heap (only read at JVM start)
        builder = builder.config("spark.driver.memory", os.environ.get("NOISYFRAME_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Settings every operator relies on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    import_path(spark)
    checkpoint_dir(spark)


def import_path(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver did, whatever
    their working folder; on a cluster without that path it comes by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [given, root]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session (one JVM, as in tests) may go without: it gets a fresh
    scratch folder.  On a cluster a machine-local folder would be lost with its
    machine and be invisible to the others, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not named:
        master = sc.master or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        named = tempfile.mkdtemp(prefix="noisyframe-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write the frame as Parquet to the shared folder and read it back.

    The copy survives executor loss, is read column by column, and is written in
    one pass.  ``eager`` is kept for callers; the write always happens at once.
    The write's shuffle files are deleted when it ends, stage files by the ``Scratch`` around
    it or when the driver's Python ends.
    """
    spark = df.sparkSession
    path = stage_path(spark)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of the SQL that ends in here are deleted with it, not at some later collection
    of garbage: nothing else reads those of a write.  The last of concurrent writes resets the setting."""
    conf = spark.conf
    with _WRITES_LOCK:
        if not _WRITES:
            _WRITES.append(conf.get(SHUFFLE_CLEANUP, "false"))
        _WRITES.append(None)
        conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _WRITES_LOCK:
            _WRITES.pop()
            if len(_WRITES) == 1:
                conf.set(SHUFFLE_CLEANUP, _WRITES.pop())


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES: list = []
_WRITES_LOCK = threading.Lock()


def stage_path(spark: SparkSession) -> str:
    """A new path in the shared folder, deleted when the driver's Python ends."""
    path = f"{checkpoint_dir(spark)}/stages/{uuid.uuid4().hex}"
    _STAGES.append((spark.sparkContext, path))
    scratch = getattr(_OPEN, "scratch", None)
    if scratch is not None:
        scratch.made.append((spark, path))
    return path


class Scratch:
    """``with Scratch() as s``: stages that this thread writes inside are deleted at the end, but for
    those that frames given to ``s.keep`` read, which are left to the scratch around it."""

    def __init__(self):
        self.made: list = []
        self.kept: set = set()

    def __enter__(self) -> "Scratch":
        self.outer, _OPEN.scratch = getattr(_OPEN, "scratch", None), self
        return self

    def keep(self, *frames: DataFrame | None) -> None:
        for frame in frames:
            read = set() if frame is None else {part for f in frame.inputFiles() for part in f.split("/")}
            self.kept |= {path for _, path in self.made if path.rsplit("/", 1)[1] in read}

    def __exit__(self, failed, *_) -> None:
        _OPEN.scratch = self.outer
        for spark, path in self.made:
            if failed is None and path not in self.kept:
                drop_stage(spark, path)
            elif self.outer is not None:
                self.outer.made.append((spark, path))


_OPEN = threading.local()


def drop_read(frame: DataFrame) -> None:
    """Delete the stages that a frame reads, when it has been used."""
    read = {part for f in frame.inputFiles() for part in f.split("/")}
    for _, path in [s for s in _STAGES if s[1].rsplit("/", 1)[1] in read]:
        drop_stage(frame.sparkSession, path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage folder that nothing reads any more."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


_STAGES: list = []


@atexit.register
def _drop_stages() -> None:
    for sc, path in _STAGES:
        try:
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session is already gone
            return
