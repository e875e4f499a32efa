"""The folder that driver and executors share, and files in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.

    Where the session names none, a folder of this machine serves local sessions,
    as in tests; on a cluster that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="sparklogs-shared-")


def new_folder(spark: SparkSession, name: str) -> str:
    """The name of a folder below the shared one that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage of `df` through the shared folder: later changes of its sources don't show."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a DataFrame once, in columns below the shared folder, and gives what reads it; all of it goes with the block.

    For tables that are read several times, each time a few columns of them.
    """
    folder = new_folder(spark, "steps")

    def kept(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4()}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield kept
    finally:
        remove(spark, folder)


@lru_cache(maxsize=1)
def _hadoop(context: SparkContext):
    """Hadoop's class of paths and the session's settings. Each part of the class's name is a call to the JVM, so it is found once."""
    return context._jvm.org.apache.hadoop.fs.Path, context._jsc.hadoopConfiguration()


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path in any store that Spark reads."""
    make, settings = _hadoop(spark.sparkContext)
    there = make(path)
    return there.getFileSystem(settings), there


def exists(spark: SparkSession, path: str) -> bool:
    store, there = hadoop(spark, path)
    return store.exists(there)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no folder."""
    store, there = hadoop(spark, path)
    return [s.getPath().getName() for s in store.listStatus(there)] if store.exists(there) else []


def move(spark: SparkSession, source: str, goal: str) -> None:
    """Renames a file, which moves no data. If the goal is there already, the source goes; a rename that fails is an error and loses nothing."""
    store, there = hadoop(spark, source)
    to = _hadoop(spark.sparkContext)[0](goal)
    if store.exists(to):
        store.delete(there, False)
        return
    store.mkdirs(to.getParent())
    if not store.rename(there, to):
        raise OSError(f"could not rename {source} to {goal}")


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file whole or not at all; False, with nothing changed, if there is one of that name."""
    store, there = hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    draft = there.suffix(f".{uuid.uuid4()}.tmp")
    out = store.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(store.makeQualified(draft), store.makeQualified(there), how)
        return True
    except Exception as error:
        store.delete(draft, False)
        if store.exists(there):
            return False
        raise error


def get_text(spark: SparkSession, path: str) -> str:
    store, there = hadoop(spark, path)
    stream = store.open(there)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    store, there = hadoop(spark, path)
    store.delete(there, True)
