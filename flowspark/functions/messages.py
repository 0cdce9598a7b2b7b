"""Flow record to JSON message and back.

A message is parsed once, for the test whether it is one JSON object and for its keys or
fields alike. Spark's JSON functions stop after the first value and do not see what follows.
So the text is put into an array with an object behind it whose value is the text's hash: only
if the text is one JSON value, no more and no less, is that object the second element.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark.schema import quoted, string_schema

#: The key of the object behind the text.
SEAL = "\x02seal"
#: JSON and nothing beside it.
STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowComments": "false",
}


def to_message(names: Iterable[str]) -> Column:
    """One JSON object per row; every value a string, absent values ``null``."""
    fields = ", ".join(f"CAST({quoted(n)} AS STRING) AS {quoted(n.strip())}" for n in names)
    return F.to_json(F.expr(f"struct({fields})"), {"ignoreNullFields": "false"})


def from_message(text: Column, names: Iterable[str]) -> Column:
    return F.from_json(text, string_schema(names))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once.

    Catalyst copies an expression into every filter and column that use it, but moves nothing
    below a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _sealed(text: Column) -> Column:
    seal = F.to_json(F.struct(F.xxhash64(text).cast("string").alias(SEAL)))
    return F.concat(F.lit("["), text, F.lit(","), seal, F.lit("]"))


def parse_fields(text: Column, names: Iterable[str]) -> Column:
    """The parse of a message for :func:`is_object` and :func:`fields_of`."""
    row = T.StructType([*string_schema(names).fields, T.StructField(SEAL, T.StringType())])
    return F.from_json(_sealed(text), T.ArrayType(row), STRICT)


def parse_keys(text: Column) -> Column:
    """The parse of a message for :func:`is_object` and :func:`keys_of`."""
    return F.from_json(_sealed(text), "array<map<string,string>>", STRICT)


def is_object(parsed: Column, text: Column) -> Column:
    """True for one JSON object; false for arrays, scalars, malformed text and NULL."""
    seal = F.get(parsed, F.lit(1)).getItem(SEAL)
    valid = F.get(parsed, F.lit(0)).isNotNull() & (seal == F.xxhash64(text).cast("string"))
    return F.coalesce(valid, F.lit(False))


def fields_of(parsed: Column) -> Column:
    """The struct of the message's fields, with the seal's empty field at its end."""
    return F.get(parsed, F.lit(0))


def keys_of(parsed: Column) -> Column:
    """The keys of the message in its order, repeated ones once."""
    return F.array_distinct(F.map_keys(F.get(parsed, F.lit(0))))


def is_json_object(text: Column) -> Column:
    """Whether a text is one JSON object, as one expression with one parse."""
    return F.element_at(F.transform(F.array(parse_fields(text, [])), lambda p: is_object(p, text)), 1)
