"""Versions of stage tables: they hold together, and a run that breaks off changes nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandspark.sources import stages


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def test_a_broken_write_leaves_the_former_version(spark, tmp_path):
    root = f"{tmp_path}/s"
    stages.write_stages({"a": numbers(spark, 5), "b": numbers(spark, 6)}, root)
    bad = numbers(spark, 100).repartition(4).withColumn("v", F.when(F.col("v") == 93, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"), stages.StageStore(spark, root).begin() as stage:
        stage.write("a", numbers(spark, 50))
        stage.write("b", bad)
    with pytest.raises(Exception, match="lost"):
        stages.write_stage(bad, f"{root}/a")
    assert stages.read_stage(spark, f"{root}/a").count() == 5 and stages.read_stage(spark, f"{root}/b").count() == 6


def test_tables_switch_together_and_old_readers_go_on(spark, tmp_path):
    store = stages.StageStore(spark, f"{tmp_path}/s")
    with store.begin() as stage:
        stage.write("a", numbers(spark, 1))
        stage.write("b", numbers(spark, 2))
    old = store.read("a")
    with store.begin() as stage:
        stage.write("a", old.union(old))
        assert store.read("a").count() == 1  # not yet
    assert (old.count(), store.read("a").count(), store.read("b").count()) == (1, 2, 2)
    assert store.newest()[0] == 2


def test_two_runs_at_once(spark, tmp_path):
    store = stages.StageStore(spark, f"{tmp_path}/s")
    stages.write_stage(numbers(spark, 1), f"{tmp_path}/s/a")
    one, two, three = store.begin(), store.begin(), store.begin()
    one.write("a", numbers(spark, 10))
    two.write("b", numbers(spark, 20))
    three.write("a", numbers(spark, 30))
    one.commit()
    two.commit()  # another table: both hold
    with pytest.raises(stages.StageConflict):
        three.commit()
    assert (store.read("a").count(), store.read("b").count()) == (10, 20)


def test_clean_keeps_what_holds(spark, tmp_path):
    store = stages.StageStore(spark, f"{tmp_path}/s")
    for n in (1, 2, 3, 4):
        stages.write_stage(numbers(spark, n), f"{tmp_path}/s/a")
    store.begin().write("a", numbers(spark, 9))
    assert store.clean(keep=2, idle_hours=1) == []  # all may belong to a running one
    assert len(store.clean(keep=1, idle_hours=0)) == 4 and store.read("a").count() == 4
    assert store.clean(keep=1, idle_hours=0) == []


def test_formats_and_missing_tables(spark, tmp_path):
    root = f"{tmp_path}/s"
    stages.write_text_report(spark.createDataFrame([("x",), ("y",)], "line string"), f"{root}/log")
    assert [r.value for r in spark.read.text(f"{root}/log").orderBy("value").collect()] == ["x", "y"]
    with pytest.raises(ValueError):
        stages.StageStore(spark, root).begin().folder("x", "orc")
    with pytest.raises(FileNotFoundError):
        stages.StageStore(spark, root).read("nothing")
    assert stages.write_stages({}, root) == {} and stages.StageStore(spark, f"{tmp_path}/none").newest() == (0, {})
