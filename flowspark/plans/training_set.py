"""Raw flows to training set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from flowspark.operators.cleaning import cast_and_clean, map_labels
from flowspark.operators.columns import normalize_columns
from flowspark.operators.filters import exclude_class
from flowspark.operators.sampling import stratified_sample
from flowspark.schema import (
    COMMON_FRACTION,
    DEFAULT_CLASS,
    EXCLUDED_CLASS,
    FEATURES,
    flow_schema,
)
from flowspark.sinks.training_set import write_training_set, written_counts
from flowspark.sources.flow_csv import read_flows
from flowspark.sources.row_identity import ROW_KEY


def training_set(
    raw: DataFrame,
    features: Sequence[str] | None = None,
    key: str | None = None,
    fractions: Mapping[str, float] | None = None,
    default_fraction: float = COMMON_FRACTION,
    excluded: str = EXCLUDED_CLASS,
    default_class: str = DEFAULT_CLASS,
    seed: int = 42,
    keep_key: bool = True,
) -> DataFrame:
    """Names, classes, exclusion, stratified sample, clean numbers; one scan, no shuffle.

    Rows are chosen before the features are cast, so most rows cost a label test and
    at most one digest. ``key`` is kept as the first column if given, unless ``keep_key`` is
    false.
    """
    mapped = map_labels(normalize_columns(raw), default_class)
    chosen = stratified_sample(
        exclude_class(mapped, excluded), fractions, default_fraction, key, seed
    )
    keep = [key] if key and keep_key else []
    return cast_and_clean(chosen, features, keep_label=True, passthrough=keep)


def build_training_set(
    spark: SparkSession,
    paths: str | Sequence[str],
    output: str,
    by_label: bool = False,
    rebalance: bool | None = None,
    features: Sequence[str] = FEATURES,
    key: str | None = None,
    **options,
) -> DataFrame:
    """CSV files to the Parquet set at ``output``; returns its rows per class.

    With ``key``, a column of unique values in the files, rows are drawn by its digest and
    it stays in the set, so a later split can use it too. Rows of files without one are drawn
    by where they stand: file, block and place in it, whose blocks are the same in every
    session. So the same files give the same rows either way.
    """
    schema = flow_schema(features)
    if key is not None:
        schema = StructType([StructField(key, StringType(), True), *schema])
        raw = read_flows(spark, paths, schema=schema)
    else:
        raw = read_flows(spark, paths, schema=schema, row_key=ROW_KEY)
    rows = training_set(
        raw, features=features, key=key or ROW_KEY, keep_key=key is not None, **options
    )
    write_training_set(rows, output, by_label, rebalance)
    return written_counts(spark, output)
