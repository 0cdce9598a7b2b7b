"""What several operators share: words, saved tables and code on the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import flowspark
from flowspark.scratch import saved

__all__ = ["SPACES", "WORD_GAP", "let", "lower_ascii", "saved", "ship", "table", "words_of"]

SPACES = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the runs of non-space characters; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_flowspark_shipped", False):
        return
    root = os.path.dirname(flowspark.__file__)
    archive = os.path.join(tempfile.mkdtemp(prefix="flowspark-"), "flowspark_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._flowspark_shipped = True
