"""Text to clean DOUBLE.

The two conversions are SQL text rather than Columns: they are applied to all 78
features at once, and one ``selectExpr`` is one call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowspark.schema import quoted

_INF = float("inf")


def to_double(name: str) -> str:
    """DOUBLE, or NULL where the text is no number (also under ANSI mode)."""
    return f"try_cast({quoted(name)} AS DOUBLE) AS {quoted(name)}"


def finite_or_zero(name: str) -> str:
    """0.0 for NULL, NaN and both infinities of a DOUBLE column.

    NaN sorts above every number in Spark and NULL compares to NULL, so one comparison
    sends all four to the ELSE branch.
    """
    column = quoted(name)
    return f"CASE WHEN abs({column}) < double('Infinity') THEN {column} ELSE 0D END AS {column}"


def value_kind(text: Column) -> Column:
    """What cleaning will find in the text: null, unparsable, nan, +inf, -inf or valid."""
    return kind_of(text, text.try_cast("double"))


def kind_of(text: Column, number: Column) -> Column:
    """The kind of a text whose number is known; ``number`` is used several times."""
    return (
        F.when(text.isNull(), "null")
        .when(number.isNull(), "unparsable")
        .when(F.isnan(number), "nan")
        .when(number == F.lit(_INF), "+inf")
        .when(number == F.lit(-_INF), "-inf")
        .otherwise("valid")
    )
