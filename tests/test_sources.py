"""Sources and sinks: CSV NA tokens and dirty numbers (A1), prediction id fallback (A3),
append + snapshot (A4 A7), result JSON with missing keys (A11)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.session import scratch_path
from foldwise.sources import files


def test_read_csv_na_tokens_and_dirty_numbers(spark):
    path = scratch_path(spark, "na-csv")
    rows = ["id,x,s", "1,2.5,a", "2,#NUM!,NA", "3,,  ", "4,nan,null", '5,7,"a, b"', "6,N/A,<NA>"]
    spark.sparkContext.parallelize(rows, 1).saveAsTextFile(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()),
                           T.StructField("s", T.StringType())])
    got = {r["id"]: (r["x"], r["s"]) for r in files.read_csv(spark, path, schema).collect()}
    assert got == {1: (2.5, "a"), 2: (None, None), 3: (None, None), 4: (None, None), 5: (7.0, "a, b"), 6: (None, None)}


def test_prediction_ids_fall_back_to_row_numbers(spark):
    base = scratch_path(spark, "pred")
    df = spark.createDataFrame([(p,) for p in [1, 0, 1, 1, 0]], "pred int")
    out = files.write_predictions(df, f"{base}/sub", f"{base}/latest", "pred", id_col=None)
    ids = sorted(r["id"] for r in out.collect())
    assert ids == [1, 2, 3, 4, 5]
    back = spark.read.option("header", True).schema("id long, target int").csv(f"{base}/latest")
    assert back.count() == 5 and back.where(F.col("target").isNull()).count() == 0


def test_append_and_snapshot(spark):
    base = scratch_path(spark, "append")
    assert files.snapshot(spark, f"{base}/t", f"{base}/bak") is False
    files.append_rows(spark.createDataFrame([(1, "a")], "k int, v string"), f"{base}/t")
    assert files.snapshot(spark, f"{base}/t", f"{base}/bak") is True
    files.append_rows(spark.createDataFrame([(2, "b")], "k int, v string"), f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 2 and spark.read.parquet(f"{base}/bak").count() == 1


def test_result_json_missing_keys_are_null(spark):
    path = scratch_path(spark, "json")
    spark.sparkContext.parallelize(['{"run": "exp_1", "mean_f1": 0.9}', '{"run": "exp_2", "std_f1": 0.1, "extra": 1}'],
                                   1).saveAsTextFile(path)
    got = {r["run"]: r for r in files.flatten_metrics(files.read_results_json(spark, path)).collect()}
    assert got["exp_1"]["mean_f1"] == 0.9 and got["exp_1"]["std_f1"] is None
    assert got["exp_2"]["std_f1"] == 0.1 and got["exp_2"]["mean_accuracy"] is None
