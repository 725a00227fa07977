"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a session whose tasks run in its own process may do without that setting; it gets a
    temporary folder as its checkpoint folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="wireloom-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it is there, from whatever file system it is on."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def file_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def touch(spark: SparkSession, path: str) -> None:
    """Makes an empty file, with the folders above it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).create(location, True).close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return [file.getPath().getName() for file in files.listStatus(location)] if files.exists(location) else []


def load_text(spark: SparkSession, path: str) -> str:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = location.getFileSystem(spark._jsc.hadoopConfiguration()).open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def save_text(spark: SparkSession, path: str, text: str) -> None:
    """Gives a file its content at once: readers see the old one or the new one, whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder, _, name = path.rpartition("/")
    # A name with a leading underscore is no data to Spark.
    source, target = hadoop.Path(f"{folder}/_{name}-{uuid.uuid4().hex}"), hadoop.Path(path)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(source, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(source), files.makeQualified(target), options)


def at_once(spark: SparkSession, *works: Callable[[], object]) -> list:
    """Runs Spark jobs that do not need each other side by side, so that one fills what the last tasks of another leave idle.

    Returns when all have ended; the first error is raised then.
    """
    with ThreadPoolExecutor(len(works)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
    return [work.result() for work in running]


SORTED_GROUPS = "spark.sql.execution.replaceHashWithSortAgg"


@contextmanager
def sorted_groups(spark: SparkSession) -> Iterator[None]:
    """What runs inside takes groups of rows that are sorted by them as they come, in one step.

    Spark otherwise gathers them in two steps and sorts for each of them again.
    """
    before = spark.conf.get(SORTED_GROUPS)
    spark.conf.set(SORTED_GROUPS, "true")
    try:
        yield
    finally:
        spark.conf.set(SORTED_GROUPS, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """Intermediate tables of one run, removed at its end.

    Unlike a cache they survive lost executors, and later plans read only the columns they use.
    After an error they stay: what failed half-way may need them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = new_folder(spark, "run")

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return _written(df, f"{self.folder}/{name}")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, failed, *_) -> None:
        if failed is None:
            remove_folder(self.spark, self.folder)
