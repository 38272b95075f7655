"""Stored tables: full refresh by numbered releases, scans, and SQL names.

Handles of the JVM's file systems are used here alone; they need a classic
session, not a remote one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Names of what belongs to releases in the folder of a layer.
RELEASE, VERSION, WRITER = "_release-", "_v-", "_writer-"

# Releases whose rows stay: the current one, and the one that readers may still have open.
RETAINED = 2

# Codec of the files of stored layers.
CODEC = "zstd"

# A load that has not shown itself for so long is taken for dead.
STALE_SECONDS = 24 * 3600


class LayerBusy(RuntimeError):
    """Another load is writing the layer."""


def _file_system(spark: SparkSession, location: str):
    """Hadoop file system of a location, and the location as its path."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    system, path = _file_system(spark, location)
    return system.exists(path)


def delete(spark: SparkSession, location: str) -> None:
    """Remove a folder and all in it."""
    system, path = _file_system(spark, location)
    system.delete(path, True)


def state(spark: SparkSession, location: str) -> tuple[int, int, int]:
    """Bytes, number of files and time of the last change: differs once a table is rewritten."""
    system, path = _file_system(spark, location)
    content = system.getContentSummary(path)
    changed = system.getFileStatus(path).getModificationTime()
    return content.getLength(), content.getFileCount(), changed


def _releases(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and locations of the releases of a layer, latest first."""
    system, path = _file_system(spark, f"{folder}/{RELEASE}*")
    found = [str(x.getPath().toString()) for x in system.globStatus(path) or []]
    numbered = [(int(x.rpartition(RELEASE)[2]), x) for x in found]
    return sorted(numbered, reverse=True)


def _released(spark: SparkSession, location: str) -> dict[str, str] | None:
    """Folder of each table in a release; None if the writing of its file was cut off."""
    system, path = _file_system(spark, location)
    stream = system.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def current_release(spark: SparkSession, folder: str) -> tuple[int, dict[str, str]]:
    """Number of the latest complete release of a layer, and the folder of each of its tables."""
    for number, location in _releases(spark, folder):
        tables = _released(spark, location)
        if tables is not None:
            return number, tables
    return 0, {}


def table_path(spark: SparkSession, path: str) -> str:
    """Where the rows of the table named ``path`` lie now.

    A table that was never released is a plain folder.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    _, tables = current_release(spark, folder)
    return f"{folder}/{tables[name]}" if name in tables else path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan of the table named ``path`` as it is released now."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(spark, path))


def footer_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan of a folder that answers COUNT, MIN and MAX from file footers.

    Read by the newer Parquet reader, which takes over aggregates of a whole
    table, with conditions on partition columns alone, apart from extremes of
    texts; then no data page is read. Anything else is answered as usual. A file
    in which a column is NULL throughout has no extremes of it, and Spark fails
    there: ask for those of columns with a value in each file.
    """
    older = "spark.sql.sources.useV1SourceList"
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    before = spark.conf.get(older)
    spark.conf.set(older, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    finally:
        spark.conf.set(older, before)


def _complete_releases(spark: SparkSession, folder: str) -> list[tuple[str, dict[str, str]]]:
    """Locations of the complete releases of a layer and their tables, latest first."""
    read = ((location, _released(spark, location)) for _, location in _releases(spark, folder))
    return [(location, tables) for location, tables in read if tables is not None]


def clean_up(spark: SparkSession, folder: str) -> None:
    """Remove what no reader of the last RETAINED releases needs: older rows and failed loads."""
    kept = _complete_releases(spark, folder)[:RETAINED]
    for _, location in _releases(spark, folder):
        if location not in [k for k, _ in kept]:
            delete(spark, location)
    named = {place for _, tables in kept for place in tables.values()}
    system, path = _file_system(spark, f"{folder}/{VERSION}*/*")
    for status in system.globStatus(path) or []:
        version, name = str(status.getPath().toString()).rsplit("/", 2)[1:]
        if f"{version}/{name}" not in named:
            delete(spark, f"{folder}/{version}/{name}")
    system, path = _file_system(spark, f"{folder}/{VERSION}*")
    for status in system.globStatus(path) or []:
        if not system.listStatus(status.getPath()):
            system.delete(status.getPath(), True)


class Release:
    """A full refresh of tables of one layer that readers see all at once.

    Tables are written to a new folder. One small file then names the folder of
    every table of the layer; files of releases are numbered, the last complete
    one counts, and none is written over. So whatever ends a load, and at any
    step, readers find the tables of the release before. Rows of the last two
    releases stay, so a table that is being read stays where it is while the
    next load runs and after it, until the load after that begins. No rows are
    moved, so it costs the same on an object store.

    A layer has one writer: a small file says that one is at work, and who finds
    that of another raises :class:`LayerBusy`, unless it has not been renewed
    for STALE_SECONDS.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        name = uuid.uuid4().hex
        self.version, self.marker = f"{VERSION}{name}", f"{self.folder}/{WRITER}{name}"
        self.tables: dict[str, str] = {}
        self._show()
        try:
            self._alone()
            clean_up(spark, self.folder)
        except BaseException:
            delete(spark, self.marker)
            raise

    def _show(self) -> None:
        """Say that this load is alive."""
        system, path = _file_system(self.spark, self.marker)
        system.create(path, True).close()

    def _alone(self) -> None:
        system, path = _file_system(self.spark, f"{self.folder}/{WRITER}*")
        for status in system.globStatus(path) or []:
            other = str(status.getPath().toString())
            if other.rpartition("/")[2] == self.marker.rpartition("/")[2]:
                continue
            if time.time() - status.getModificationTime() / 1000 < STALE_SECONDS:
                raise LayerBusy(f"{other} says that another load is writing {self.folder}")
            delete(self.spark, other)

    def write(self, df: DataFrame, table: str) -> None:
        df.write.parquet(f"{self.folder}/{self.version}/{table}", compression=CODEC)
        self.tables[table] = f"{self.version}/{table}"
        self._show()

    def write_all(self, tables: Mapping[str, Callable[[], DataFrame]]) -> None:
        """Write tables side by side. The first error stops the others and is raised."""
        context = self.spark.sparkContext

        def job(table: str, make: Callable[[], DataFrame]) -> None:
            context.addJobTag(self.version)
            try:
                self.write(make(), table)
            except BaseException as error:
                failed.append(error)
                context.cancelJobsWithTag(self.version)
                raise
            finally:
                context.removeJobTag(self.version)

        failed: list[BaseException] = []
        target = inheritable_thread_target(self.spark)(job)
        with ThreadPoolExecutor(max(1, len(tables))) as pool:
            for table, make in tables.items():
                pool.submit(copy_context().run, target, table, make)
        if failed:
            raise failed[0]

    def read(self, table: str, schema: StructType) -> DataFrame:
        """A table of this release, before anybody else sees it."""
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{self.tables[table]}")

    def publish(self) -> None:
        number, tables = current_release(self.spark, self.folder)
        last = max([number, *(n for n, _ in _releases(self.spark, self.folder))])
        system, path = _file_system(self.spark, f"{self.folder}/{RELEASE}{last + 1:08d}")
        out = system.create(path, False)
        try:
            out.write(json.dumps(tables | self.tables).encode())
        finally:
            out.close()

    def __enter__(self) -> Release:
        return self

    def __exit__(self, error, *_) -> None:
        _, tables = current_release(self.spark, self.folder)
        if error is not None and not set(self.tables.values()) & set(tables.values()):
            delete(self.spark, f"{self.folder}/{self.version}")
        delete(self.spark, self.marker)


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh of the table named ``path``."""
    folder, _, name = path.rstrip("/").rpartition("/")
    with Release(df.sparkSession, folder) as release:
        release.write(df, name)
        release.publish()


def create_database(spark: SparkSession, layer: str, folder: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{folder.rstrip('/')}'")


def publish(
    spark: SparkSession,
    layer: str,
    folder: str,
    tables: Mapping[str, StructType],
    defaults: Mapping[str, str] | None = None,
) -> None:
    """Make the stored tables of a layer known to SQL as ``layer.table``.

    ``defaults`` gives expressions by column, which an INSERT without the column
    fills in. To be done again after a refresh, as Spark remembers the files of
    a table.
    """
    create_database(spark, layer, folder)
    for table, schema in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + (f" DEFAULT {defaults[f.name]}" if defaults and f.name in defaults else "")
            for f in schema.fields
        )
        path = table_path(spark, f"{folder.rstrip('/')}/{table}")
        spark.sql(f"CREATE TABLE {layer}.{table} ({columns}) USING parquet LOCATION '{path}'")
