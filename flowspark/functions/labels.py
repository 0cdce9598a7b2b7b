"""Label text to class, and prediction index to class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowspark.schema import DEFAULT_CLASS, LABEL_RULES, UNKNOWN_CLASS


def canonical_label(
    label: Column,
    rules: Sequence[tuple[str, str]] = LABEL_RULES,
    default: str = DEFAULT_CLASS,
) -> Column:
    """Class of the first rule whose LIKE pattern matches.

    NULL and labels no rule knows become ``default``; with the default rules an
    unlisted attack is therefore counted as benign unless another default is given.
    """
    pattern, name = rules[0]
    chain = F.when(label.like(pattern), name)
    for pattern, name in rules[1:]:
        chain = chain.when(label.like(pattern), name)
    return chain.otherwise(default)


def decode_prediction(
    prediction: Column, labels: Sequence[str], unknown: str = UNKNOWN_CLASS
) -> Column:
    """Class name at the prediction's index, truncated toward zero.

    NULL, NaN, infinite, negative and too large predictions are ``unknown``.
    """
    index = prediction.try_cast("int")
    return F.coalesce(F.get(F.array(*[F.lit(name) for name in labels]), index), F.lit(unknown))
