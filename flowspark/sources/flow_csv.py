"""Flow records in CSV files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark.schema import flow_schema, quoted
from flowspark.session import with_settings
from flowspark.sources.headers import layouts
from flowspark.sources.row_identity import BLOCK_BYTES, block_key, block_settings

CORRUPT = "_corrupt_record"


#: Strict scans by name: the number of columns in the header of the row's file.
WIDTH = "_header_width"


def read_flows(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    strict: bool = False,
    file_column: str | None = None,
    header: bool = True,
    row_key: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One scan over all files of one layout.

    Columns are found by name: tasks read the first line of each file beforehand, files with
    equal headers are scanned together, and each layout's columns are brought into the
    order of the schema. Further columns are left out; a missing one fails with the file's
    name. ``header=False`` takes columns by position instead, for files without a header.

    Types are never inferred on the way. The default reads text: where most rows are
    sampled away, casting the rest later is cheapest. To clean every row give
    ``flow_schema(numeric=True)``: the parser then makes the numbers itself, text that is
    none becomes NULL, and cleaning yields the same values at about half the cost.
    ``infer=True`` takes names and types from the files, for profiling.

    ``strict`` parses every field of every line even if few are asked for, puts lines of
    the wrong width into ``_corrupt_record`` and, by name, adds ``_header_width``;
    otherwise the parser reads the asked-for columns only. Unreadable files fail the job in
    both cases. ``file_column`` adds the path each row came from.

    ``row_key`` adds a key for files that have none, from file, block and place. Blocks are of
    ``block_bytes`` whatever the session has, so the frame belongs to a clone of the session.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    wanted = schema or flow_schema()
    own = spark if row_key is None else with_settings(spark, block_settings(block_bytes))
    reader = (
        own.read.option("header", header)
        .option("ignoreCorruptFiles", False)
        .option("columnPruning", not strict)
    )
    if strict and not infer:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)

    def scan(files: Sequence[str], fields: Sequence[T.StructField]) -> DataFrame:
        corrupt = [T.StructField(CORRUPT, T.StringType(), True)] if strict else []
        return reader.schema(T.StructType([*fields, *corrupt])).csv(list(files))

    file = [] if file_column is None else [F.col("_metadata.file_path").alias(file_column)]
    if row_key is not None:
        file.append(block_key().alias(row_key))
    if infer:
        return reader.option("inferSchema", True).csv(paths).select("*", *file)
    if not header:
        return scan(paths, wanted).select("*", *file)
    scans = []
    for layout in layouts(spark, paths):
        width = len(layout.names)
        places = places_of([f.name for f in wanted], layout.names, layout.example)
        fields = [T.StructField(f"_column{i}", T.StringType(), True) for i in range(width)]
        for place, field in zip(places, wanted):
            fields[place] = T.StructField(field.name, field.dataType, True)
        df = scan(layout.paths, fields)
        columns = [F.col(quoted(field.name)) for field in wanted]
        extra = [F.col(CORRUPT), F.lit(width).alias(WIDTH)] if strict else []
        scans.append(df.select(*columns, *extra, *file))
    return reduce(DataFrame.unionByName, scans)


def places_of(wanted: Sequence[str], names: Sequence[str], file: str) -> list[int]:
    """Where each wanted column stands among a file's names.

    A wanted name that ends in its own place, as Spark names repeated headers, is also met
    by the repeats of the bare name, in order.
    """
    bare = [name.strip().removesuffix(str(i)) for i, name in enumerate(wanted)]
    repeated = {name for name in bare if bare.count(name) > 1}
    free: dict[str, list[int]] = {}
    for place, name in enumerate(names):
        free.setdefault(name, []).append(place)
    places, missing = [], []
    for name, plain in zip(wanted, bare):
        own = free.get(name.strip()) or (free.get(plain) if plain in repeated else None)
        if own:
            places.append(own.pop(0) if plain in repeated else own[0])
        else:
            missing.append(name.strip())
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {file}")
    return places


def field_count(line: Column) -> Column:
    """Number of comma-separated fields of a CSV line, commas in quotes left out."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def with_line_status(df: DataFrame, width: int | None = None) -> DataFrame:
    """Add ``status`` to a strict scan: good, short, long or unparsable."""
    if width is None:
        width = len(df.columns) - 1
    fields = field_count(F.col(CORRUPT))
    return df.withColumn(
        "status",
        F.when(F.col(CORRUPT).isNull(), "good")
        .when(fields < width, "short")
        .when(fields > width, "long")
        .otherwise("unparsable"),
    )


def line_status_counts(df: DataFrame) -> DataFrame:
    """Lines per status of a strict scan."""
    first = quoted(df.columns[0])
    checked = with_line_status(df)
    # Spark refuses to read the corrupt-record column alone; the first data column
    # comes along and is counted too.
    return checked.groupBy("status").agg(
        F.count(F.lit(1)).alias("count"), F.count(F.col(first)).alias("with_first_field")
    )
