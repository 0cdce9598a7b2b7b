"""The first lines of CSV files, read by tasks.

A scan that keeps each file whole gives every file above ``SMALL_FILE`` a partition of its own,
whose task stops after the first line, and puts smaller ones together, up to so many bytes. So
no task reads more than a part of a megabyte, however long the files are, and there are no more
tasks than large files. The lines are split into names where they are read and written, one row a
file; the driver sees the layouts, the given paths of each and, only of a folder that mixes
layouts, the names of its files. Spark's own readers open the files: any file system, compression
and glob of a scan works here.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.scratch import new_folder, scope
from flowspark.session import with_settings

#: Bytes up to which files are read together.
SMALL_FILE = 256 * 1024
#: So many given paths are told apart; of more, each layout gets the names of its files.
ROOTS = 64
#: Characters of a line beyond which the file is refused.
LONGEST_LINE = 1 << 24
#: No header has it; the reader takes lines whole.
NO_SEPARATOR = "\x01"

HEADERS = "root int, file string, names array<string>"


class Layout(NamedTuple):
    """Files with equal headers."""

    names: tuple[str, ...]
    #: What to scan: given paths, or files of a folder that has other layouts too.
    paths: list[str]
    files: int
    example: str


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """root (place of the given path, 0 beyond ``ROOTS`` of them), file and names of every file
    that is not empty, as a written table."""

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(1).dictionary_encode().indices.to_numpy()
            starts = batch.take(pa.array(np.flatnonzero(np.diff(codes, prepend=-1))))
            rows: list[tuple] = []
            large = False
            for root, file, size, line in zip(*(column.to_pylist() for column in starts.columns)):
                if file != done:
                    done = file
                    first = line.removeprefix("\ufeff").split("\r")[0]
                    cells = next(csv.reader([first]), [])
                    rows.append((root, unquote(file), [name.strip() for name in cells]))
                    large = size > SMALL_FILE  # alone in its partition
            types = [pa.int32(), pa.string(), pa.list_(pa.string())]
            columns = zip(*rows) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["root", "file", "names"]
            )
            if large:
                return

    own = with_settings(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": SMALL_FILE,
            "spark.sql.files.openCostInBytes": 4096,
            "spark.sql.files.minPartitionNum": 1,
            # Little more than the first line goes to the worker before it stops.
            "spark.sql.execution.arrow.maxRecordsPerBatch": 256,
        },
    )
    # Lines of several files follow each other in a partition; multi-line files are not cut.
    reader = (
        own.read.schema("line string")
        .option("multiLine", True)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        # Left to find out, the reader takes a first "\\r\\n" for the end of every line.
        .option("lineSep", "\n")
        .option("maxCharsPerColumn", LONGEST_LINE)
        .option("ignoreCorruptFiles", False)
    )

    def lines(root: int, of: Sequence[str]) -> DataFrame:
        return reader.csv(list(of)).select(
            F.lit(root).alias("root"), "_metadata.file_path", "_metadata.file_size", "line"
        )

    if len(paths) > ROOTS:
        scan = lines(0, paths)
    else:
        scan = reduce(DataFrame.union, [lines(i, [path]) for i, path in enumerate(paths)])
    found = scan.where("line is not null").mapInArrow(first_lines, HEADERS)
    path = f"{new_folder(spark, 'headers')}/rows"
    found.hint("rebalance").write.parquet(path)  # a line or so a task: in few files
    return spark.read.schema(HEADERS).parquet(path)


def layouts(spark: SparkSession, paths: Sequence[str]) -> list[Layout]:
    """The layouts of the files below ``paths``, that of most files first."""
    with scope():  # the table is used up here
        return _layouts(headers(spark, paths), paths)


def _layouts(table: DataFrame, paths: Sequence[str]) -> list[Layout]:
    found = (
        table.groupBy("names")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.min("file").alias("example"),
            F.sort_array(F.collect_set("root")).alias("roots"),
        )
        .orderBy(F.desc("files"), "example")
        .collect()
    )
    if not found:
        raise ValueError(f"no header in {', '.join(paths)}")
    if len(found) == 1:
        (only,) = found
        return [Layout(tuple(only["names"]), list(paths), only["files"], only["example"])]
    roots = [root for row in found for root in row["roots"]]
    mixed = [root for root in set(roots) if roots.count(root) > 1]
    names_of_mixed: dict[tuple[str, ...], list[str]] = {}
    if mixed:
        for row in table.where(F.col("root").isin(mixed)).select("names", "file").toLocalIterator():
            literal = re.sub(r"([\\*?\[\]{}])", r"\\\1", row["file"])  # a path may be a glob
            names_of_mixed.setdefault(tuple(row["names"]), []).append(literal)
    out = []
    for row in found:
        names = tuple(row["names"])
        whole = [paths[root] for root in row["roots"] if root not in mixed]
        of_mixed = sorted(names_of_mixed.get(names, []))
        out.append(Layout(names, whole + of_mixed, row["files"], row["example"]))
    return out
