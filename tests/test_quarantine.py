"""Broken rows are set aside with their file and text."""

from __future__ import annotations

import datetime as dt

import pytest

from demandspark.sources import quarantine, stages
from demandspark.sources.schemas import DAILY_SALES, schema

SHAPE = schema("date:date, store_id:string, product_id:string, units_sold:bigint, unit_price:double")
HEAD = "date,store_id,product_id,units_sold,unit_price"
SOUND = ['2024-01-01,S1,P1,5,2.5', '2024-01-02,S1,"P,1",,3', "2024-01-03,S1,P1,7,"]
BROKEN = {"2024-01-04,S1,P1,x,2.5": "type: units_sold", "2024-02-31,S1,P1,1.5,2": "type: date, units_sold", "2024-01-05,S1,P1": "fields: 3",
          "2024-01-06,S1,P1,5,2.5,9": "fields: 6", "2024-01-07,,P1,5,2.5": "missing: store_id", ",S1,P1,5,2.5": "missing: date"}


def files(tmp_path):
    lines = [*SOUND, *BROKEN]
    for i in range(2):
        with open(f"{tmp_path}/part{i}.csv", "w") as f:
            f.write("\n".join([HEAD, *lines[i::2]]) + "\n")
    return f"{tmp_path}/part*.csv"


def test_broken_lines_are_stored_with_file_and_text(spark, tmp_path):
    path, root = files(tmp_path), f"{tmp_path}/root"
    rows = quarantine.ingest(spark, path, root, SHAPE, most_broken=0.9)
    assert sorted(map(tuple, rows.collect())) == [
        (dt.date(2024, 1, 1), "S1", "P1", 5, 2.5), (dt.date(2024, 1, 2), "S1", "P,1", None, 3.0), (dt.date(2024, 1, 3), "S1", "P1", 7, None)]
    broken = stages.read_stage(spark, f"{root}/quarantine").collect()
    assert {r.record: r.reason for r in broken if not r.reason.startswith("missing")} == {k: v for k, v in BROKEN.items() if not v.startswith("missing")}
    assert sorted(r.reason for r in broken) == sorted(BROKEN.values())
    assert {r.file.rsplit("/", 1)[1] for r in broken} == {"part0.csv", "part1.csv"}


def test_few_columns_find_the_same_broken_rows(spark, tmp_path):
    scan = quarantine.scan_checked(spark, files(tmp_path), SHAPE)
    assert scan.rows.select("store_id").count() == 3 and scan.broken.select("file").count() == len(BROKEN)


def test_too_many_broken_rows_leave_the_former_table(spark, tmp_path):
    path, root = files(tmp_path), f"{tmp_path}/root"
    quarantine.ingest(spark, path, root, SHAPE, most_broken=0.9)
    with open(f"{tmp_path}/part2.csv", "w") as f:
        f.write("\n".join([HEAD, *["?,S,P,1,1"] * 20]))
    with pytest.raises(quarantine.BrokenInput, match=r"26 of 29 rows are broken: type: date \(20\)"):
        quarantine.ingest(spark, path, root, SHAPE, most_broken=0.7)
    assert stages.read_stage(spark, f"{root}/raw").count() == 3 and stages.read_stage(spark, f"{root}/quarantine").count() == 26


def test_parquet_and_empty_inputs(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "S1", None, 1, 2.0), (dt.date(2024, 1, 1), "S1", "P1", None, 2.0)], SHAPE)
    df.write.parquet(f"{tmp_path}/p")
    scan = quarantine.scan_checked(spark, f"{tmp_path}/p", SHAPE, "parquet")
    assert scan.rows.count() == 1 and scan.broken.first().reason == "missing: product_id" and '"S1"' in scan.broken.first().record
    df.limit(0).write.parquet(f"{tmp_path}/e")
    assert quarantine.ingest(spark, f"{tmp_path}/e", f"{tmp_path}/r", SHAPE, "parquet").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        quarantine.scan_checked(spark, f"{tmp_path}/absent", DAILY_SALES)


def test_a_broken_record_is_taken_apart_once(spark, tmp_path):
    """Not once for every column, and not at all to find the sound rows."""
    scan = quarantine.scan_checked(spark, files(tmp_path), SHAPE)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (scan.rows, scan.broken)]
    assert [plan.count("from_csv") for plan in plans] == [0, 1]
