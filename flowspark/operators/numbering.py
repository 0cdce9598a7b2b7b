"""Dense 1-based row numbers without sorting the table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType

from flowspark.schema import quoted
from flowspark.scratch import saved


def _hashable(kind: DataType) -> bool:
    return not isinstance(kind, (MapType, VariantType)) and "map<" not in kind.simpleString()


def composite_order(df: DataFrame, key: str) -> list[Column]:
    """The order of ``key``, NULLs last, with what parts rows of equal keys behind it.

    The row's hash parts rows that differ anywhere, and the place in the scan rows that are
    equal throughout, so no value can fill a range by itself.
    """
    rest = [F.col(quoted(f.name)) for f in df.schema.fields if _hashable(f.dataType)]
    return [F.col(quoted(key)).asc_nulls_last(), F.xxhash64(*rest).asc(), F.col("_place").asc()]


def range_rows(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """The rows written in ranges of the composite order, with ``_range`` and ``_place``."""
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    order = composite_order(df, key)
    ranged = (
        placed.repartitionByRange(*order)
        if partitions is None
        else placed.repartitionByRange(partitions, *order)
    )
    return saved(ranged.withColumn("_range", F.spark_partition_id()), "ranges")


def number_rows(
    df: DataFrame, key: str, column: str = "row_number", partitions: int | None = None
) -> DataFrame:
    """Position of each row in the order of ``key``; rows without a key come last.

    Rows are range-partitioned and written with the number of their range, as Spark may draw
    other ranges when it computes them again. Ranges are of the key and, behind it, the row's
    hash and place, so a key that a third of the rows have, or lack, is cut into as many
    ranges as it fills. The rows of each range are counted and the counts added up; a second
    pass numbers the rows inside each range. Equal keys are numbered in any order. ``df`` has
    to give its rows in the same order in every attempt, as file scans and written tables do.
    """
    ranged = range_rows(df, key, partitions)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(*composite_order(df, key))
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, "_range")
        .withColumn(column, F.col("_offset") + F.col("_inside"))
        .drop("_range", "_inside", "_offset", "_place")
    )
