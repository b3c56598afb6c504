"""Small helpers shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def local_rows(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A DataFrame of a few literal rows, held in the plan (no Python tasks)."""
    values = zip(*rows) if rows else [()] * len(columns)
    arrays = [pa.array(v, kind) for v, kind in zip(values, columns.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local session may do without, as it is one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="vitrine-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: used where several branches would each recompute it."""
    path = staging_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is staged inside goes to a folder of its own, removed at the end; results must be written by then."""
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        remove_folder(spark, folder)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside drop their shuffle files once they end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, held)


#: Bytes that the opening of a file counts as when files are dealt to tasks; Spark counts 4 MB, so that few small files come to a task.
OPEN_BYTES = 128 << 10


@contextmanager
def packed_reads(spark: SparkSession) -> Iterator[None]:
    """Reads inside deal many small files to a task."""
    name = "spark.sql.files.openCostInBytes"
    held = spark.conf.get(name)
    spark.conf.set(name, OPEN_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, held)


#: Files that a task of a partitioned write keeps open; with more values it sorts the rest of its rows.
OPEN_FILES = 64


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file per value open, so that wide rows are not sorted (and spilled) by the partition column first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    held = spark.conf.get(name)
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, held)


#: Options of a write of very many small files: tasks move their files themselves, not the driver one by one, and in local folders files come
#: without checksum files, as Hadoop starts a process for the mode of each file that it makes with one.
SMALL_FILES = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true",
}


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system it lies in."""
    folder, fs = _folder(spark, path)
    return fs.makeQualified(folder).toString()


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def remove_files(spark: SparkSession, path: str, prefix: str) -> None:
    """Remove the files of a folder whose names start with ``prefix``."""
    folder, fs = _folder(spark, path)
    for status in fs.listStatus(folder):
        if status.isFile() and status.getPath().getName().startswith(prefix):
            fs.delete(status.getPath(), False)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder whose job ended."""
    return [name for name in subfolders(spark, path) if file_exists(spark, f"{path}/{name}/_SUCCESS")]


def file_exists(spark: SparkSession, path: str) -> bool:
    file, fs = _folder(spark, path)
    return fs.exists(file)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
