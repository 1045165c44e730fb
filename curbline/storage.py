"""Files and folders in whatever file system a path names: through Hadoop's client on the driver,
through pyarrow in tasks."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def in_task(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it, for use in tasks. pyarrow reaches local
    and mounted folders and, where their client libraries are installed, HDFS and object stores."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")  # Java writes file:/folder
    return fs.FileSystem.from_uri(path)


def _located(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` as its client has it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _located(spark, path)
    return system.exists(where)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what lies directly in ``folder``; none where there is no folder."""
    system, where = _located(spark, folder)
    if not system.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(where))


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder to a name that is free. HDFS and local file systems do it in one step."""
    system, source = _located(spark, old)
    _, target = _located(spark, new)
    if system.exists(target):
        raise FileExistsError(new)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"{old} can't be renamed to {new}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds, if it is there."""
    system, where = _located(spark, path)
    system.delete(where, True)


def touch(spark: SparkSession, path: str) -> None:
    """Set a file's time to the present."""
    system, where = _located(spark, path)
    system.setTimes(where, spark.sparkContext._jvm.System.currentTimeMillis(), -1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, where = _located(spark, path)
    opened = system.create(where, True)
    try:
        opened.write(bytearray(text.encode()))
    finally:
        opened.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    system, where = _located(spark, path)
    opened = system.open(where)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()
