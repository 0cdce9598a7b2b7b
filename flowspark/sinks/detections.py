"""The detections table: day folders a stream appends to, and compacted closed days.

A stream writes files every few seconds. Compaction writes a closed day's rows anew in few
files, beside the table, and then a manifest that names them; readers follow the newest complete
manifest. The sink goes on undisturbed: its files stay where its log has them, and what it adds
to a closed day later (a batch repeated after a restart keeps its day) is read as well. That is
told by time: the manifest holds the newest file its compaction has seen, micro-batches follow
each other, so files of a later batch are newer. Both conditions, on day and on time, reach the
listing of files, so no replaced file is opened.

The first manifest that is complete wins: of two compactions at once the second one fails, and
a failed one leaves rows that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.scratch import delete, saved

DAY = "detected_on"
COMPACT = "_compact"
GENERATION = "generation"


@dataclass(frozen=True)
class Manifest:
    """Days that are read from their compacted rows, and the newest file these were made of."""

    version: int = 0
    until: str = "1970-01-01 00:00:00"
    #: By day: generation, rows, files and the files they replace.
    days: dict[str, dict] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str:
    where, fs = _hadoop(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest complete manifest of a table."""
    folder, fs = _hadoop(spark, f"{path}/{COMPACT}/manifest")
    if not fs.exists(folder):
        return Manifest()
    names = sorted((s.getPath().getName() for s in fs.listStatus(folder)), reverse=True)
    for name in names:
        if not name.endswith(".json"):
            continue
        try:
            content = json.loads(_read_text(spark, f"{path}/{COMPACT}/manifest/{name}"))
        except ValueError:  # still being written
            continue
        return Manifest(int(name.removesuffix(".json")), content["until"], content["days"])
    return Manifest()


def _publish(spark: SparkSession, path: str, new: Manifest) -> None:
    where, fs = _hadoop(spark, f"{path}/{COMPACT}/manifest/{new.version:08d}.json")
    out = fs.create(where, False)  # fails if another compaction was first
    try:
        out.write(bytearray(json.dumps({"until": new.until, "days": new.days}).encode()))
    finally:
        out.close()


def _changed() -> Column:
    return F.col("_metadata.file_modification_time")


def _until(known: Manifest) -> Column:
    return F.lit(known.until).cast("timestamp")


def read_detections(spark: SparkSession, path: str, known: Manifest | None = None) -> DataFrame:
    """All detections, closed days from their compacted rows."""
    known = known or manifest(spark, path)
    if not known.days:
        return spark.read.parquet(path)
    root = f"{path}/{COMPACT}/rows"
    folders = [
        f"{root}/{DAY}={day}/{GENERATION}={entry[GENERATION]}" for day, entry in known.days.items()
    ]
    compacted = spark.read.option("basePath", root).parquet(*folders).drop(GENERATION)
    compacted = compacted.withColumn(DAY, F.col(DAY).cast("date"))
    # With a schema no replaced file is opened to find it out.
    table = spark.read.schema(compacted.schema).parquet(path)
    closed = F.col(DAY).isin([date.fromisoformat(day) for day in known.days])
    late = table.filter(closed & (_changed() > _until(known)))
    return table.filter(~closed).unionByName(late).unionByName(compacted)


def compact(
    spark: SparkSession,
    path: str,
    before: date | None = None,
    settled: timedelta = timedelta(hours=1),
    now: datetime | None = None,
) -> Manifest:
    """Compacts the days before ``before`` (today, if not given) and gives the new manifest.

    A day is taken once its newest file is ``settled`` old, and again once late files were
    added. Without such days the manifest stays as it is.
    """
    now = now or datetime.now()
    before = before or now.date()
    known = manifest(spark, path)
    # One listing for all of it: what the sink adds meanwhile is late.
    table = spark.read.parquet(path)
    listed = table.select(
        F.col(DAY), F.col("_metadata.file_path").alias("file"), _changed().alias("changed")
    )
    files = saved(
        listed.groupBy(DAY, "file").agg(
            F.max("changed").alias("changed"), F.count(F.lit(1)).alias("n")
        ),
        "files",
    )
    newest = files.agg(F.max("changed").cast("string")).first()[0]
    late = F.col("changed") > _until(known)
    done = F.col(DAY).isin([date.fromisoformat(day) for day in known.days]) if known.days else F.lit(False)
    days = (
        files.filter(F.col(DAY) < F.lit(before))
        .filter(~done | late)
        .groupBy(DAY)
        .agg(
            F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.max("changed").alias("changed")
        )
        .filter(F.col("changed") <= F.lit(now - settled))
        .collect()
    )
    if not days:
        return known
    generation = uuid.uuid4().hex
    root = f"{path}/{COMPACT}/rows"
    names = [str(row[DAY]) for row in days]
    closed = F.col(DAY).isin([row[DAY] for row in days])
    rows = read_detections(spark, path, known).filter(closed & (F.col(DAY) < F.lit(before)))
    (
        rows.withColumn(GENERATION, F.lit(generation))
        .hint("rebalance", DAY)
        .write.mode("append")
        .partitionBy(DAY, GENERATION)
        .parquet(root)
    )
    made = {
        str(row[DAY]): row
        for row in spark.read.option("basePath", root)
        .parquet(*[f"{root}/{DAY}={day}/{GENERATION}={generation}" for day in names])
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_metadata.file_path").alias("files"))
        .collect()
    }
    entries = dict(known.days)
    for row in days:
        day = str(row[DAY])
        old = known.days.get(day, {"rows": 0, "files": 0})
        if made[day]["rows"] != row["rows"] + old["rows"]:
            delete_generation(spark, path, generation)
            raise RuntimeError(f"{day} changed while it was compacted; compact it again")
        entries[day] = {
            GENERATION: generation,
            "rows": made[day]["rows"],
            "files": made[day]["files"],
            "replaced": row["files"] + old["files"],
        }
    new = Manifest(known.version + 1, newest, entries)
    _publish(spark, path, new)
    return new


def delete_generation(spark: SparkSession, path: str, generation: str) -> None:
    """Removes the rows of a generation of every day."""
    where, fs = _hadoop(spark, f"{path}/{COMPACT}/rows/{DAY}=*/{GENERATION}={generation}")
    for status in fs.globStatus(where) or []:
        fs.delete(status.getPath(), True)


def vacuum(spark: SparkSession, path: str) -> int:
    """Removes compacted rows that the newest manifest does not name; how many folders. Not
    while another compaction or a reader of an older manifest runs."""
    known = manifest(spark, path)
    where, fs = _hadoop(spark, f"{path}/{COMPACT}/rows/{DAY}=*/{GENERATION}=*")
    removed = 0
    for status in fs.globStatus(where) or []:
        folder = status.getPath()
        day = folder.getParent().getName().removeprefix(f"{DAY}=")
        if folder.getName() != f"{GENERATION}={known.days.get(day, {}).get(GENERATION)}":
            delete(spark, folder.toString())
            removed += 1
    return removed
