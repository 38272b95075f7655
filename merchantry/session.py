"""Spark session for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import delete

CHECKPOINT_DIR = "spark.checkpoint.dir"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Files a task keeps open at once; rows for more are sorted by file before they are written.
OPEN_FILES = "32"

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("merchantry")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession) -> str:
    """Folder of this application below the shared folder the session names.

    Only a local session may go without the setting: it gets a temporary
    folder that is removed when the process ends.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        if app not in _local_folders:
            _local_folders[app] = tempfile.TemporaryDirectory(prefix="merchantry-")
        root = _local_folders[app].name
    return f"{root.rstrip('/')}/merchantry/{app}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what :func:`store` wrote inside, in this thread, unless kept."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            delete(spark, path)


@contextmanager
def unsorted_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs inside look rows up and write them without sorting them, so that none are spilled.

    A shuffled lookup builds a hash table where each partition of the smaller side is
    within the size that the session aims at for a partition, and a task that
    writes to few files keeps them open. Beyond that they sort as ever. What the
    session has set itself stays.
    """
    aimed_at = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    settings = {
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": aimed_at,
        "spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES,
    }
    changed = [name for name in settings if spark.conf.get(name) in ("0", "0b")]
    for name in changed:
        spark.conf.set(name, settings[name])
    try:
        yield
    finally:
        for name in changed:
            spark.conf.unset(name)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove the files of their own shuffles once they have ended.

    Nothing reads these again, but Spark keeps them until the driver happens to collect
    garbage: over many small steps they outgrow the data. A value the session has set stays.
    """
    changed = spark.conf.get(SHUFFLE_CLEANUP, "false") != "true"
    if changed:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if changed:
            spark.conf.unset(SHUFFLE_CLEANUP)


def store(
    df: DataFrame, label: str, keep: bool = False, codec: str | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder once and return the table read back.

    This cuts the lineage in a way that outlives executors, keeps Parquet
    column pruning, and gives Spark the true size for its join choice. Inside
    :func:`scratch` the table goes with it, unless it is to be kept. ``codec``
    is that of its files, where the session's is not to be used.
    """
    spark = df.sparkSession
    path = f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"
    if not keep and _scratch.get() is not None:
        _scratch.get().append(path)
    with freed_shuffles(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a stored table that nothing reads again."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        delete(df.sparkSession, folder)


def clear_workspace(spark: SparkSession) -> None:
    """Remove what this application stored; tables built from it are gone as well."""
    delete(spark, workspace(spark))
