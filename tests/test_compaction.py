"""Compaction of closed days beside a sink that goes on writing."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flowspark.jobs import compact as job
from flowspark.sinks import detections
from flowspark.sinks.detections import compact, manifest, read_detections, vacuum
from flowspark.streaming.running import finish, write_parquet

SCHEMA = "id long, d date"
NONE = timedelta(0)
LATER = datetime(2100, 1, 1)


class Table:
    """A folder source and a file sink by day, run batch by batch."""

    def __init__(self, spark, tmp_path):
        self.spark, self.source = spark, str(tmp_path / "in")
        self.path, self.checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
        self.ids = []

    def add(self, ids, day):
        rows = [(i, date.fromisoformat(day)) for i in ids]
        self.spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(self.source)
        self.ids += ids
        stream = self.spark.readStream.schema(SCHEMA).parquet(self.source)
        stream = stream.select("id", F.col("d").alias("detected_on"))
        finish(write_parquet(stream, self.path, self.checkpoint, None, partition_by=["detected_on"]))

    def seen(self, known=None):
        return sorted(r.id for r in read_detections(self.spark, self.path, known).collect())


@pytest.fixture
def table(spark, tmp_path):
    made = Table(spark, tmp_path)
    for n in range(3):
        made.add(list(range(100 * n, 100 * n + 30)), "2026-01-01")
    made.add(list(range(1000, 1020)), "2026-01-02")
    made.add(list(range(2000, 2010)), "2026-01-03")
    return made


def run(table, before="2026-01-03", settled=NONE):
    return compact(table.spark, table.path, date.fromisoformat(before), settled, LATER)


def test_rows_stay_and_files_fall(table):
    assert manifest(table.spark, table.path) == detections.Manifest()
    before = table.seen()
    assert before == sorted(table.ids)
    made = run(table)
    assert set(made.days) == {"2026-01-01", "2026-01-02"} and made.version == 1
    first = made.days["2026-01-01"]
    assert first["rows"] == 90 and first["files"] < first["replaced"]
    assert table.seen() == before == table.seen(detections.Manifest())
    assert run(table) == made  # nothing new to do


def test_late_files_of_a_closed_day(table):
    made = run(table)
    table.add([7777, 7778], "2026-01-01")
    table.add([8888], "2026-01-03")
    assert table.seen() == sorted(table.ids)
    again = run(table)
    assert again.version == 2 and again.days["2026-01-01"]["rows"] == 92
    assert again.days["2026-01-02"] == made.days["2026-01-02"]
    assert table.seen() == sorted(table.ids) == table.seen(made)
    assert vacuum(table.spark, table.path) == 1
    assert table.seen() == sorted(table.ids)


def test_days_that_are_open_or_not_settled_stay(table):
    assert run(table, "2026-01-01").days == {}
    recent = compact(table.spark, table.path, date(2026, 1, 3), timedelta(hours=1), datetime.now())
    assert recent.days == {}


def test_what_a_reader_sees_while_it_is_compacted(table, monkeypatch):
    """Rows that are written and not yet named are not read; a failure leaves all as it was."""
    seen = []

    def broken(*_):
        seen.append(table.seen())
        raise OSError("lost")

    monkeypatch.setattr(detections, "_publish", broken)
    with pytest.raises(OSError):
        run(table)
    assert seen == [sorted(table.ids)] and table.seen() == sorted(table.ids)
    monkeypatch.undo()
    run(table)
    assert table.seen() == sorted(table.ids) and vacuum(table.spark, table.path) == 2


def test_a_manifest_in_the_making_is_passed_over(table, tmp_path):
    run(table)
    (tmp_path / "out" / "_compact" / "manifest" / "00000002.json").write_text('{"until": "20')
    assert manifest(table.spark, table.path).version == 1
    assert table.seen() == sorted(table.ids)


def test_of_two_compactions_one_wins(table, monkeypatch):
    known = manifest(table.spark, table.path)
    run(table, "2026-01-02")
    monkeypatch.setattr(detections, "manifest", lambda *_: known)
    with pytest.raises(Exception, match="already exists|AlreadyExists"):
        run(table)
    monkeypatch.undo()
    assert table.seen() == sorted(table.ids)


def test_replaced_files_are_not_opened(table, tmp_path):
    """With the originals of closed days gone, nothing misses them."""
    run(table)
    for day in ("2026-01-01", "2026-01-02"):
        for file in (tmp_path / "out" / f"detected_on={day}").iterdir():
            times = file.stat()
            file.write_bytes(b"no parquet")
            os.utime(file, ns=(times.st_atime_ns, times.st_mtime_ns))
    assert table.seen() == sorted(table.ids)


def test_job(table, capsys):
    job.main(["--detections", table.path, "--before", "2026-01-02", "--settled-minutes", "0", "--vacuum"])
    out = capsys.readouterr().out
    assert "2026-01-01 90 rows in" in out and "0 replaced folders" in out
    with open(f"{table.path}/_compact/manifest/00000001.json") as file:
        content = json.load(file)
    assert set(content["days"]) == {"2026-01-01"}


def test_no_table(spark, tmp_path):
    with pytest.raises(AnalysisException):
        compact(spark, str(tmp_path / "none"))
