"""Folders for intermediate tables and stream checkpoints.

On a cluster they must be visible to every executor, so they are made below
``spark.checkpoint.dir``. Only a local session without that setting falls back to a
temporary folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The folders made in the innermost scope.
_made: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("_made", default=None)


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.gettempdir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nothing has been written to yet, removed when the application ends."""
    path = f"{shared_root(spark)}/flowspark-{purpose}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    made = _made.get()
    if made is not None:
        made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder and what is in it; nothing happens if there is none."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scope() -> Iterator[None]:
    """Folders made inside are deleted at the end, also after a failure.

    What is read from them has to be used up by then. What is to stay, such as a result that is
    written, goes into a folder made before, or comes from :func:`result`.
    """
    made: list[tuple[SparkSession, str]] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for spark, path in made:
            delete(spark, path)


def result(spark: SparkSession, purpose: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``make()``, written; all intermediate tables it made on the way are deleted.

    The folder of the rows belongs to the scope outside, if there is one.
    """
    path = f"{new_folder(spark, purpose)}/rows"
    with scope():
        made = make()
        made.write.parquet(path)
        schema = made.schema
    return spark.read.schema(schema).parquet(path)


def release(df: DataFrame) -> None:
    """Deletes the folders of a frame from :func:`saved` or :func:`result`, and of no other."""
    spark, root = df.sparkSession, f"{shared_root(df.sparkSession)}/flowspark-"
    bare = root.split(":", 1)[-1].lstrip("/")
    folders = set()
    for file in df.inputFiles():
        place = file.split(":", 1)[-1].lstrip("/")
        if place.startswith(bare):
            own = place[len(bare) :].split("/", 1)[0]
            folders.add(f"{root}{own}")
    for folder in folders:
        delete(spark, folder)


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written below the shared folder and read again.

    Cuts lineage and survives the loss of executors, and everything that is derived from
    the result sees the same rows, also where computing them again could differ.
    """
    spark = df.sparkSession
    path = f"{new_folder(spark, purpose)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
