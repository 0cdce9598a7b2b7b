"""Headers are read by tasks; the driver sees layouts."""

import gzip

import pytest
from pyspark.sql import functions as F

from flowspark.schema import string_schema
from flowspark.sources import headers
from flowspark.sources.flow_csv import read_flows

SCHEMA = string_schema(["a", "b"])


def rows(df):
    return sorted((r.a, r.b) for r in df.collect())


def test_ten_thousand_small_files(spark, tmp_path):
    expected = []
    for name in "pq":
        (tmp_path / name).mkdir()
    for i in range(10_000):
        if i % 10 == 0:
            (tmp_path / "q" / f"{i}.csv").write_text(f"b,a\ny{i},x{i}\n")
        else:
            (tmp_path / "p" / f"{i}.csv").write_text(f"a, b\nx{i},y{i}\n")
        expected.append((f"x{i}", f"y{i}"))
    paths = [str(tmp_path / name) for name in "pq"]
    found = headers.layouts(spark, paths)
    assert found[0][:3] == (("a", "b"), paths[:1], 9000)
    assert found[1][:3] == (("b", "a"), paths[1:], 1000)
    assert rows(read_flows(spark, paths, schema=SCHEMA)) == sorted(expected)


def test_one_layout_keeps_the_given_paths(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text(f"a,b\n{i},0\n")
    paths = [f"{tmp_path}/1*.csv", f"{tmp_path}/2.csv"]
    (only,) = headers.layouts(spark, paths)
    assert only.paths == paths and only.files == 12


def test_folders_of_one_layout_keep_their_paths(spark, tmp_path):
    for name, header in (("p", "a,b"), ("q", "b,a"), ("r", "a,b")):
        (tmp_path / name).mkdir()
        for i in range(3):
            (tmp_path / name / f"{i}.csv").write_text(f"{header}\n1,2\n")
    (tmp_path / "r" / "other.csv").write_text("b,c,a\n3,4,5\n")
    found = {x.names: x.paths for x in headers.layouts(spark, [f"{tmp_path}/{n}" for n in "pqr"])}
    assert found["a", "b"][0] == f"{tmp_path}/p" and len(found["a", "b"]) == 4
    assert found["b", "a"] == [f"{tmp_path}/q"] and len(found["b", "c", "a"]) == 1
    df = read_flows(spark, [f"{tmp_path}/{n}" for n in "pqr"], schema=SCHEMA)
    assert rows(df) == sorted([("1", "2")] * 6 + [("2", "1")] * 3 + [("5", "3")])


def test_more_paths_than_are_told_apart(spark, tmp_path):
    paths = []
    for i in range(headers.ROOTS + 10):
        path = tmp_path / f"{i}.csv"
        path.write_text(f"b,a\n0,{i}\n" if i % 2 else f"a,b\n{i},0\n")
        paths.append(str(path))
    df = read_flows(spark, paths, schema=SCHEMA)
    assert rows(df) == sorted((str(i), "0") for i in range(len(paths)))


def test_large_files_beside_small_ones(spark, tmp_path):
    """Large ones are not read to their end, small ones share a task."""
    for i in range(3):
        (tmp_path / f"large{i}.csv").write_text("a,b\n" + f"{i},0\n" * 200_000)
    for i in range(20):
        (tmp_path / f"small{i}.csv").write_text(f"b,a\n0,{i}\n")
    table = headers.headers(spark, [str(tmp_path)])
    assert {r["file"].rsplit("/", 1)[1]: r["names"] for r in table.collect()} == {
        **{f"large{i}.csv": ["a", "b"] for i in range(3)},
        **{f"small{i}.csv": ["b", "a"] for i in range(20)},
    }
    assert read_flows(spark, str(tmp_path), schema=SCHEMA).count() == 600_020
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(headers.SMALL_FILE)


def test_kinds_of_files(spark, tmp_path):
    folder = tmp_path / "names with spaces, % and +"
    folder.mkdir()
    (folder / "mark [one].csv").write_bytes("﻿a,b\r\n1,2\r\n".encode())
    (folder / "mixed ends.csv").write_bytes(b"b,a\r\n2,1\n2,1\n")
    (folder / "quoted.csv").write_text('"a","x,y",b\n1,9,2\n')
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "packed.csv.gz", "wt") as out:
        out.write("c,b,a\n9,2,1\n")
    found = {layout.names: layout.files for layout in headers.layouts(spark, [str(folder)])}
    assert found == {("a", "b"): 1, ("b", "a"): 1, ("a", "x,y", "b"): 1, ("c", "b", "a"): 1}
    df = read_flows(spark, str(folder), schema=SCHEMA, file_column="file")
    assert df.filter((F.col("a") == "1") & (F.trim("b") == "2")).count() == 5


def test_no_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        headers.layouts(spark, [str(tmp_path)])
