"""Where jobs put working tables: always the folder all executors share, named by whoever runs the job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The first setting can be changed in a running session; the second is Spark's own.
SETTINGS = ("siftlake.work.dir", "spark.checkpoint.dir")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the session; an error if there is none."""
    for setting in SETTINGS:
        if root := spark.conf.get(setting, None):
            return root.rstrip("/")
    raise RuntimeError(f"set {' or '.join(SETTINGS)} to a folder that the driver and every executor can reach")


def use_local_root(spark: SparkSession) -> None:
    """Name a temporary folder for a session that has none, which only a local master may use: for tests and trials."""
    if any(spark.conf.get(setting, None) for setting in SETTINGS):
        return
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTINGS[1]} to a folder that the driver and every executor can reach")
    spark.conf.set(SETTINGS[0], tempfile.mkdtemp(prefix="siftlake-"))


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/siftlake/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Remove a path and all below it, in whatever store it lies; nothing happens if it is gone already."""
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)


def from_uri(spark: SparkSession, uri: str) -> str:
    """The path that Spark's file metadata names by an encoded URI."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its store."""
    file_system, old = _file_system(spark, source)
    if not file_system.rename(old, _file_system(spark, target)[1]):
        raise OSError(f"{source} can't be renamed to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    file_system, target = _file_system(spark, path)
    return file_system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none when there is no such folder."""
    file_system, target = _file_system(spark, path)
    return [s.getPath().getName() for s in file_system.listStatus(target)] if file_system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    file_system, target = _file_system(spark, path)
    stream = file_system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that nobody has written yet; False when it is there already. It appears with all of its text: it is
    written under another name and renamed, and a rename does not replace a file."""
    file_system, target = _file_system(spark, path)
    if file_system.exists(target):
        return False
    draft = _file_system(spark, f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")[1]
    stream = file_system.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not file_system.exists(target) and file_system.rename(draft, target):
        return True
    file_system.delete(draft, False)
    return False


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """The columns of a dataset that are names of folders (``column=value``), outermost first."""
    file_system, at = _file_system(spark, path)
    columns = []
    while True:
        folders = [s.getPath() for s in file_system.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not folders:
            return columns
        columns.append(folders[0].getName().split("=", 1)[0])
        at = folders[0]


class Scratch:
    """Working tables of one job, below one new path.

    A settled table is written once and read back: that ends its lineage, and the files outlive the executors that wrote
    them. ``drop`` frees a table when no later step reads it; ``close`` frees all.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = new_path(spark, purpose)
        self._count = 0

    def settle(self, df: DataFrame, name: str = "table") -> DataFrame:
        self._count += 1
        at = f"{self.path}/{self._count:03d}-{name}"
        df.write.parquet(at)
        settled = self.spark.read.schema(df.schema).parquet(at)
        settled.settled_at = at
        return settled

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove(self.spark, table.settled_at)

    def close(self) -> None:
        remove(self.spark, self.path)
