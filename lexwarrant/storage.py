"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a local master gets a folder of its own;
    on a cluster that is an error, since executors couldn't reach it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        found = "file://" + tempfile.mkdtemp(prefix="lexwarrant-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody uses yet, removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts lineage: an executor lost later costs only the tasks it ran, because what it had
    written lies in shared storage. Columns keep their types; an empty frame keeps its schema.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def state_of(spark: SparkSession, path: str) -> tuple:
    """(name, length, time of change) of the files of a table, by which a change of it is noticed."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(where)))


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the JVM, which reaches whatever Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file: a list, a status or a mark."""
    files, where = file_system(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Make a file that isn't there yet; False if it is, and then nothing changes."""
    files, where = file_system(spark, path)
    files.mkdirs(where.getParent())
    try:
        stream = files.create(where, overwrite)
    except Py4JJavaError as error:
        if not overwrite and files.exists(where):
            return False
        raise error
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A reader sees the file as it was or all of the new one."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    create_text(spark, part, text, True)
    files, to = file_system(spark, path)
    at = file_system(spark, part)[1]
    if not files.rename(at, to):  # some file systems don't rename onto a file
        files.delete(to, False)
        if not files.rename(at, to):
            raise OSError(f"{path} can't be written")
