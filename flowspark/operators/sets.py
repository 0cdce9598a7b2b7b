"""Bag union."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name. For many files one multi-path scan is the better plan."""
    return reduce(DataFrame.unionByName, frames)
