"""Record tables: batches that are appended once, versions, and the newest of saved files."""

import os

import pytest
from pyspark.sql import types as T

from foldwise.session import scratch_path
from foldwise.sources import records

FIELDS = "a long, b string, c double"


def rows(table, version=None):
    return sorted(map(tuple, table.read(version).collect()), key=str)


def test_a_repeated_batch_changes_nothing(spark):
    table = records.RecordTable(spark, scratch_path(spark, "t"), FIELDS)
    assert table.version == 0 and rows(table) == []
    first = spark.createDataFrame([(1, "x"), (1, "x")], "a long, b string")
    assert table.append(first, "one") == 1 and table.append(first, "one") == 1
    assert table.append(spark.createDataFrame([("y", 2)], "b string, a int"), "two") == 2
    assert rows(table) == [(1, "x", None), (1, "x", None), (2, "y", None)]
    assert rows(table, 1) == [(1, "x", None)] * 2 and rows(table, 0) == [] and table.batches() == ["one", "two"]
    again = records.RecordTable(spark, table.path, FIELDS)
    assert again.append(first.limit(0), "none") == 3 and rows(again) == rows(table, 2)
    for bad in (lambda: table.read(9), lambda: table.append(first.withColumnRenamed("a", "z"), "four"), lambda: table.append(first, "a/b")):
        with pytest.raises(ValueError):
            bad()


def test_a_batch_that_was_cut_off_is_written_again(spark):
    table = records.RecordTable(spark, scratch_path(spark, "t"), FIELDS)
    table.append(spark.createDataFrame([(1, "x")], "a long, b string"), "one")
    # rows were written, but the writer died before the manifest's line
    spark.createDataFrame([(7, "half", None)], FIELDS).write.parquet(f"{table.path}/batches/two")
    assert rows(table) == [(1, "x", None)]
    assert table.append(spark.createDataFrame([(2, "y")], "a long, b string"), "two") == 2
    assert rows(table) == [(1, "x", None), (2, "y", None)]


def test_fields_of_a_run_record(spark):
    df = spark.createDataFrame([("e", None, 4, 0.5), ("f", 3, 4, None)], "exp_id string, max_depth int, depth int, mean_f1 double")
    out = records.run_record(df)
    assert len(out.columns) == 21 and len(T._parse_datatype_string(records.BATCH_FIELDS)) == 17
    got = {r["exp_id"]: (r["max_depth"], r["mean_f1"], r["use_smote"], r["full_train_metric_scope"]) for r in out.collect()}
    assert got == {"e": (4, 0.5, None, "train_set_only_no_validation"), "f": (3, None, None, "train_set_only_no_validation")}


def test_newest_by_time_not_by_name(spark):
    base = scratch_path(spark, "runs")
    for name, at in (("exp_009", 1000), ("exp_001", 3000), ("exp_005", 2000)):
        spark.createDataFrame([(name,)], "run string").coalesce(1).write.json(f"{base}/{name}")
        for d, _, files in os.walk(f"{base.removeprefix('file:')}/{name}"):
            for f in files:
                os.utime(f"{d}/{f}", (at, at))
    kind = T._parse_datatype_string("run string")
    assert [r["run"] for r in records.read_newest(spark, base, kind).collect()] == ["exp_001"]
    assert sorted(r["run"] for r in records.read_newest(spark, base, kind, runs=["exp_009", "exp_005"]).collect()) == ["exp_005", "exp_009"]
    assert records.read_newest(spark, base, kind, runs=["exp_404"]).count() == 0 and records.newest_file(spark, base, "*.parquet") is None
    assert [r["name"] for r in records.files_by_time(spark, base, "*.json").collect()] == ["exp_001", "exp_005", "exp_009"]
