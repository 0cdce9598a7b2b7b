"""Keys of rows that have none."""

from pyspark.sql import functions as F

from flowspark.operators.sampling import hash_sample
from flowspark.plans.training import split_sets
from flowspark.plans.training_set import build_training_set
from flowspark.schema import string_schema
from flowspark.session import with_settings
from flowspark.sources.flow_csv import read_flows
from flowspark.sources.row_identity import ROW_KEY, with_row_key

CUT = "spark.sql.files.maxPartitionBytes"
SCHEMA = string_schema(["a", "b"])


def csv_files(folder):
    for name, n in (("x", 40_000), ("y", 3), ("z", 9_000)):
        lines = "".join(f"{i % 7},same\n" for i in range(n))
        (folder / f"{name}.csv").write_text("a,b\n" + lines)
    return str(folder)


def keys(spark, path, cut, **options):
    own = with_settings(spark, {CUT: cut})
    return read_flows(own, path, schema=SCHEMA, row_key=ROW_KEY, **options)


def test_csv_keys_do_not_follow_the_session(spark, tmp_path):
    path = csv_files(tmp_path)
    first = keys(spark, path, "1GB", block_bytes=1 << 15)
    second = keys(spark, path, "7KB", block_bytes=1 << 15)
    assert first.rdd.getNumPartitions() > 5
    assert first.select(ROW_KEY).distinct().count() == 49_003
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_filters_and_columns_do_not_change_csv_keys(spark, tmp_path):
    path = csv_files(tmp_path)
    df = keys(spark, path, "1GB", block_bytes=1 << 15)
    of_three = {r[ROW_KEY] for r in df.collect() if r.a == "3"}
    assert {r[ROW_KEY] for r in df.filter("a = '3'").select(ROW_KEY).collect()} == of_three
    assert df.select(ROW_KEY).distinct().count() == 49_003


def test_copies_are_drawn_one_by_one(spark, tmp_path):
    """All rows are copies of seven: a draw by content would keep or lose them together."""
    path = csv_files(tmp_path)
    df = keys(spark, path, "1GB")
    drawn = hash_sample(df, 0.1, ROW_KEY).groupBy("a").count().collect()
    assert len(drawn) == 7 and all(500 < r["count"] < 900 for r in drawn)


def test_training_set_is_the_same_however_files_are_cut(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        lines = "".join(f"{i},BENIGN\n" if i % 50 else f"{i},Bot\n" for i in range(4000))
        (tmp_path / "in" / f"{n}.csv").write_text("f,Label\n" + lines)
    sets = []
    for cut in ("1GB", "5KB"):
        out = str(tmp_path / cut)
        build_training_set(with_settings(spark, {CUT: cut}), str(tmp_path / "in"), out, features=["f"])
        sets.append(sorted(map(tuple, spark.read.parquet(out).collect())))
        assert spark.read.parquet(out).columns == ["f", "Label"]
    assert sets[0] == sets[1] and 1100 < len(sets[0]) < 1700


def test_parquet_split(spark, tmp_path):
    path = str(tmp_path / "set")
    spark.range(20_000).select(F.lit("same").alias("v"), "id").repartition(3).write.parquet(path)
    halves = []
    for cut in ("1GB", "20KB"):
        own = with_settings(spark, {CUT: cut}).read.parquet(path)
        train, test = split_sets(own, None, scored=1.0, from_files=True)
        assert train.columns == ["v", "id"]
        halves.append((sorted(r.id for r in train.collect()), sorted(r.id for r in test.collect())))
    assert halves[0] == halves[1]
    train, test = halves[0]
    assert sorted(train + test) == list(range(20_000)) and 15_500 < len(train) < 16_500


def test_parquet_keys_let_filters_through(spark, tmp_path):
    path = str(tmp_path / "set")
    spark.range(100).select("id", (F.col("id") * 2).alias("d")).write.parquet(path)
    df = with_row_key(spark.read.parquet(path)).filter("id > 90").select(ROW_KEY)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,90)]" in text and "d#" not in text.split("ReadSchema")[1]
    assert df.distinct().count() == 9
