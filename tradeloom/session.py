"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_T = TypeVar("_T")
#: Of documents and of tables of hash keys, which snappy leaves almost as long as they are.
DENSE = "zstd"
_local_dirs: dict[str, str] = {}
#: Blocks that free shuffles now, and the setting before the first of them, by session.
_freed: dict[str, tuple[int, str | None]] = {}
_freeing = Lock()


def local_session(name: str = "tradeloom", cores: str = "*") -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, below ``spark.checkpoint.dir``; freed when the application ends.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if base:
        path = f"{base.rstrip('/')}/tradeloom/{app}"
        if app not in _local_dirs:
            _local_dirs[app] = path
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
            # Only an existing folder can be marked; it is freed when the application ends.
            files.mkdirs(folder)
            files.deleteOnExit(folder)
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tradeloom-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage like a checkpoint does, survives the loss of
    executors, and computes ``df`` once. ``codec`` is the session's if not given.
    """
    path = scratch(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`written`, for results that are not needed after the block."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of every query in this block when the query ends, not when they are collected.

    Blocks may be entered side by side and within each other; the last one to end puts the setting back.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    session = spark._jsparkSession.sessionUUID()
    with _freeing:
        depth, before = _freed.get(session) or (0, spark.conf.get(name, None))
        _freed[session] = depth + 1, before
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _freeing:
            depth, before = _freed.pop(session)
            if depth > 1:
                _freed[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def in_parallel(spark: SparkSession, jobs: Mapping[str, Callable[[], _T]], threads: int) -> dict[str, _T]:
    """Submit independent Spark jobs side by side; the first error is raised."""
    with ThreadPoolExecutor(threads) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}
