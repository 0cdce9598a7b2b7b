"""Messages to clean flows, on a batch or on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.functions.messages import (
    SEAL,
    fields_of,
    from_message,
    is_object,
    once,
    parse_fields,
)
from flowspark.operators.cleaning import cast_and_clean
from flowspark.schema import quoted


def decode_messages(messages: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Binary value to text; the broker's time becomes ``kafka_timestamp``."""
    return messages.select(
        *map(quoted, passthrough),
        F.col("value").cast("string").alias("json_string"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_messages(
    messages: DataFrame,
    features: Sequence[str],
    passthrough: Sequence[str] = (),
    valid_only: bool = False,
) -> DataFrame:
    """Named features of each message as text.

    A message that is no JSON object yields NULL features, hence a flow of zeros after
    cleaning. ``valid_only`` leaves such messages out instead.

    The fields are taken out by ``inline``, not ``data.*``. Catalyst moves a later filter
    on the fields below a projection and would copy the JSON parser into it once per
    field; it does not move one below a generator, so each message is parsed once, by one
    parser for the test and the fields.
    """
    decoded, text = decode_messages(messages, passthrough), F.col("json_string")
    kept = [*map(quoted, passthrough), "kafka_timestamp"]
    if not valid_only:
        return decoded.select(*kept, F.inline(F.array(from_message(text, features))))
    parsed = once(decoded, "parsed", parse_fields(text, features))
    valid = parsed.filter(is_object(F.col("parsed"), text))
    return valid.select(*kept, F.inline(F.array(fields_of(F.col("parsed"))))).drop(SEAL)


def clean_flows(
    messages: DataFrame,
    features: Sequence[str],
    passthrough: Sequence[str] = (),
    valid_only: bool = False,
) -> DataFrame:
    """Messages to clean features, with both times kept beside them.

    ``processing_time`` is fixed per micro-batch and therefore also tells the
    micro-batches apart in whatever is written.
    """
    parsed = parse_messages(messages, features, passthrough, valid_only)
    stamped = parsed.withColumn("processing_time", F.current_timestamp())
    keep = [*passthrough, "kafka_timestamp", "processing_time"]
    return cast_and_clean(stamped, features, passthrough=keep)
