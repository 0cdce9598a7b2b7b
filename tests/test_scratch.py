import glob
from types import SimpleNamespace

import pytest

from flowspark.scratch import new_folder, release, result, saved, scope, shared_root


def session(**conf):
    settings = {key.replace("_", "."): value for key, value in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))


def test_configured_folder_is_used_everywhere():
    for master in ("local[8]", "yarn", "spark://host:7077"):
        configured = session(spark_checkpoint_dir="hdfs://shared/dir/", spark_master=master)
        assert shared_root(configured) == "hdfs://shared/dir"


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session(spark_master="yarn"))


def test_local_session_may_use_its_own():
    assert shared_root(session(spark_master="local[2]"))


def test_folders_differ(spark):
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


def folders(spark):
    return set(glob.glob(f"{shared_root(spark)}/flowspark-*"))


def test_a_scope_deletes_what_was_made_in_it(spark):
    before = folders(spark)
    kept = saved(spark.range(5).toDF("a"), "kept")
    with scope():
        inner = saved(kept.selectExpr("a + 1 AS a"), "inner")
        with scope():
            innermost = saved(inner.selectExpr("a + 1 AS a"), "innermost")
            assert innermost.count() == 5
        assert len(folders(spark) - before) == 2 and inner.count() == 5
    assert len(folders(spark) - before) == 1 and kept.count() == 5
    release(kept)
    assert folders(spark) == before


def test_a_scope_ends_after_a_failure(spark):
    before = folders(spark)
    with pytest.raises(ValueError), scope():
        saved(spark.range(5).toDF("a"), "lost")
        raise ValueError
    assert folders(spark) == before


def test_a_result_outlives_what_it_came_from(spark):
    before = folders(spark)

    def make():
        first = saved(spark.range(9).toDF("a"), "first")
        return saved(first.filter("a > 2"), "second").selectExpr("a * 2 AS b")

    df = result(spark, "whole", make)
    assert sorted(r.b for r in df.collect()) == [6, 8, 10, 12, 14, 16]
    assert len(folders(spark) - before) == 1
    release(df)
    assert folders(spark) == before


def test_release_leaves_other_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    release(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3
