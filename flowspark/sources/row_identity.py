"""A key for rows of files that have none, from where they stand.

Draws by such a key are those of any other key: equal under every partitioning, on every
cluster and after every retry, and copies of a row are drawn one by one. Parquet knows the
place of each row in its file. Of CSV the scan knows the file and the start of the block, and
the row's place in it is counted; so the files are cut into blocks of a size that belongs to the
key and not to the session, one block a task. Moved or rewritten files give other keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The column, unless named otherwise.
ROW_KEY = "_row_key"
BLOCK_BYTES = 128 << 20


def block_settings(block_bytes: int) -> dict[str, object]:
    """Session settings under which every block of a file is a partition of its own."""
    return {
        "spark.sql.files.maxPartitionBytes": block_bytes,
        "spark.sql.files.openCostInBytes": block_bytes,
        "spark.sql.files.minPartitionNum": 1,
        "spark.sql.files.maxPartitionNum": (1 << 31) - 1,
    }


def _joined(*parts: Column) -> Column:
    return F.concat_ws(":", *[part.cast("string") for part in parts])


def block_key() -> Column:
    """The key of a row of a text format, in the projection of the scan itself. Being counted,
    it keeps filters above it, so that they do not change the count."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return _joined(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), place)


def with_row_key(df: DataFrame, column: str = ROW_KEY) -> DataFrame:
    """A Parquet scan with a key; filters and columns still reach the files."""
    return df.withColumn(
        column, _joined(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    )
