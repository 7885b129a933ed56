"""Queries over sources and sinks (A1 A3–A9 A11 A12 A14 A16 G1 H9): each writes derived data to
the session's shared checkpoint folder and reads it back (rows-only checks; round-trip
properties are asserted in tests/)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import bounds, impute, metrics, profile
from foldwise.plans.common import cleaned_profile
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.session import scratch_path
from foldwise.sources import files, records, tables

PROFILE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("target_raw", T.IntegerType()),
    T.StructField("cat_a", T.StringType()), T.StructField("cat_b", T.StringType()),
    T.StructField("num_a", T.DoubleType()), T.StructField("num_b", T.DoubleType()),
    T.StructField("num_c", T.DoubleType()), T.StructField("long_tail", T.DoubleType()),
    T.StructField("ord_a", T.DoubleType()), T.StructField("raw_num", T.DoubleType()),
    T.StructField("note", T.StringType()),
])


@query("csv_roundtrip", with_views(
    "SELECT id, target_raw, cat_a, cat_b, num_a, num_b, num_c, long_tail, ord_a, TRY_CAST(raw_num AS DOUBLE) AS raw_num, "
    "CASE WHEN trim(note) IN (" + ", ".join("'" + t + "'" for t in files.NA_TOKENS) + ") THEN NULL ELSE note END AS note FROM p", "p"))
def csv_roundtrip(spark, d):
    """A1: the profile written as CSV with NULLs as 'NA' and read back typed: NA tokens → NULL,
    '#NUM!' → NULL, doubles exact (shortest round-trip text)."""
    p = tables.profile(spark, d, with_note=True)
    path = scratch_path(spark, "profile_csv")
    (p.write.mode("overwrite").option("header", True).option("nullValue", "NA").option("escape", '"')
      .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return files.read_csv(spark, path, PROFILE_SCHEMA, multi_line=True)  # notes are whole texts


@query("prediction_write", with_views("SELECT id, pred AS target FROM rp", "rp"))
def prediction_write(spark, d):
    """A3: write the rule predictions and a 'latest' copy, and read the latest back."""
    rp = tables.rule_predictions(spark, d)
    base = scratch_path(spark, "predictions")
    files.write_predictions(rp, f"{base}/submission", f"{base}/submission_latest", "pred", "id")
    return spark.read.option("header", True).schema("id long, target int").csv(f"{base}/submission_latest")


@query("prediction_stats", with_views(
    "SELECT CASE pred WHEN 1 THEN 'full' ELSE 'fold' END AS mode, count(*) FILTER (WHERE pred = 1) AS n_1, "
    "count(*) FILTER (WHERE pred = 0) AS n_0, count(*) AS total FROM rp GROUP BY 1", "rp"))
def prediction_stats(spark, d):
    """A4: one stats row per prediction run (here the rows of each rule), appended run by run and read back."""
    rp = tables.rule_predictions(spark, d)
    table = records.RecordTable(spark, scratch_path(spark, "prediction-stats"), "mode string, n_1 long, n_0 long, total long")
    for mode, rows in (("full", rp.where("pred = 1")), ("fold", rp.where("pred = 0"))):
        counts = rows.agg(F.count_if(F.col("pred") == 1).alias("n_1"), F.count_if(F.col("pred") == 0).alias("n_0"), F.count(F.lit(1)).alias("total"))
        table.append(counts.withColumn("mode", F.lit(mode)), f"run-{mode}")
    return table.read()


_RECORD_SQL = """SELECT CAST(ts AS VARCHAR) AS timestamp, config_file, run_name AS experiment_name, run_name AS experiment_folder,
  split_part(run_name, '_', 3) AS model_type, split_part(run_name, '_', 4) AS imputation_method, status,
  CAST(CASE status WHEN 'failed' THEN 1 ELSE 0 END AS INTEGER) AS return_code, CAST(NULL AS DOUBLE) AS mean_accuracy, mean_f1,
  CAST(NULL AS DOUBLE) AS mean_precision, CAST(NULL AS DOUBLE) AS mean_recall, CAST(NULL AS DOUBLE) AS std_accuracy, std_f1,
  CAST(NULL AS DOUBLE) AS std_precision, CAST(NULL AS DOUBLE) AS std_recall, CASE status WHEN 'failed' THEN 'exit code 1' END AS error_message FROM r"""


def _batch_records(r):
    """View R as the record rows of batch items."""
    part = lambda i: F.split_part("run_name", F.lit("_"), F.lit(i))
    failed = F.col("status") == "failed"
    return records.with_fields(r.withColumns({
        "timestamp": F.col("ts").cast("string"), "experiment_name": F.col("run_name"), "experiment_folder": F.col("run_name"), "model_type": part(3),
        "imputation_method": part(4), "return_code": failed.cast("int"), "error_message": F.when(failed, "exit code 1")}), records.BATCH_FIELDS)


@query("tracking_append", with_views(_RECORD_SQL, "r"))
def tracking_append(spark, d):
    """Two batches of records appended, the second twice (a retry changes nothing), and the table read back."""
    r = tables.runs(spark, d)
    table = records.RecordTable(spark, scratch_path(spark, "records"), records.BATCH_FIELDS)
    table.append(_batch_records(r.where(F.year("ts") < 1998)), "history")
    for _ in range(2):
        table.append(_batch_records(r.where(F.year("ts") >= 1998)), "batch-1998")
    return table.read()


@query("record_versions", with_views("""WITH v AS (SELECT unnest([1, 2]) AS version)
SELECT CAST(version AS INTEGER) AS version, count(*) AS n, count(DISTINCT config_file) AS configs, round(avg(mean_f1), 6) AS mean_f1
FROM r, v WHERE version = 2 OR year(ts) < 1998 GROUP BY version""", "r"))
def record_versions(spark, d):
    """The record table as it was before and after a batch, by version number."""
    r = tables.runs(spark, d)
    table, out = records.RecordTable(spark, scratch_path(spark, "records"), records.BATCH_FIELDS), None
    before = table.append(_batch_records(r.where(F.year("ts") < 1998)), "history")
    for version in (before, table.append(_batch_records(r.where(F.year("ts") >= 1998)), "batch-1998")):
        part = table.read(version).agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("n"), F.count_distinct("config_file").alias("configs"),
                                       F.round(F.avg("mean_f1"), 6).alias("mean_f1"))
        out = part if out is None else out.unionByName(part)
    return out


@query("run_records", with_views("""SELECT run_name AS exp_id, CAST(ts AS VARCHAR) AS timestamp, config_file AS name, concat('run of ', config_file) AS description,
  split_part(run_name, '_', 3) AS model_type, run_id % 2 = 0 AS use_smote, CAST(0.01 AS DOUBLE) * (1 + run_id % 5) AS learning_rate,
  CAST(2 + run_id % 7 AS INTEGER) AS max_depth, CAST(NULL AS DOUBLE) AS mean_accuracy, CAST(NULL AS DOUBLE) AS std_accuracy, mean_f1, std_f1,
  CAST(NULL AS DOUBLE) AS mean_precision, CAST(NULL AS DOUBLE) AS std_precision, CAST(NULL AS DOUBLE) AS mean_recall, CAST(NULL AS DOUBLE) AS std_recall,
  CAST(NULL AS DOUBLE) AS full_train_accuracy, mean_f1 + std_f1 AS full_train_f1, CAST(NULL AS DOUBLE) AS full_train_precision,
  CAST(NULL AS DOUBLE) AS full_train_recall, 'train_set_only_no_validation' AS full_train_metric_scope FROM r WHERE status = 'success'""", "r"))
def run_records(spark, d):
    """A5: the 21-field record of every successful run, the depth from either of two fields, appended in batches by year."""
    r = tables.runs(spark, d).where("status = 'success'")
    depth = (2 + F.col("run_id") % 7).cast("int")
    rows = records.run_record(r.withColumns({
        "exp_id": F.col("run_name"), "timestamp": F.col("ts").cast("string"), "name": F.col("config_file"), "description": F.concat(F.lit("run of "), "config_file"),
        "model_type": F.split_part("run_name", F.lit("_"), F.lit(3)), "use_smote": F.col("run_id") % 2 == 0, "learning_rate": 0.01 * (1 + F.col("run_id") % 5),
        "max_depth": F.when(F.col("run_id") % 3 == 0, depth), "depth": F.when(F.col("run_id") % 3 != 0, depth), "full_train_f1": F.col("mean_f1") + F.col("std_f1")}))
    table = records.RecordTable(spark, scratch_path(spark, "run-records"), records.RUN_FIELDS)
    year = F.substring("timestamp", 1, 4)
    for name, mine in (("early", year < "1995"), ("late", year >= "1995")):
        table.append(rows.where(mine), name)
    return table.read()


@query("newest_saved_run", with_views("""WITH n AS (SELECT config_file, count(*) AS runs, round(max(mean_f1), 6) AS best FROM r WHERE status = 'success' GROUP BY 1)
SELECT 'newest' AS chosen, 'exp_002' AS run, runs, best FROM n WHERE config_file = 'cfg_2'
UNION ALL SELECT 'by id', 'exp_001', runs, best FROM n WHERE config_file = 'cfg_1'""", "r"))
def newest_saved_run(spark, d):
    """Of result files written one after another, the newest by its modification time, and the one of a given run."""
    r, base = tables.runs(spark, d).where("status = 'success'"), scratch_path(spark, "saved-results")
    for number in (0, 1, 2):
        result = (r.where(F.col("config_file") == f"cfg_{number}").agg(F.count(F.lit(1)).alias("runs"), F.round(F.max("mean_f1"), 6).alias("best"))
                  .withColumn("run", F.lit(f"exp_{number:03d}")))
        result.coalesce(1).write.json(f"{base}/exp_{number:03d}")
    kind = T._parse_datatype_string("run string, runs long, best double")
    newest = records.read_newest(spark, base, kind).withColumn("chosen", F.lit("newest"))
    return newest.unionByName(records.read_newest(spark, base, kind, runs=["exp_001"]).withColumn("chosen", F.lit("by id")))


@query("result_json_scan", with_views(
    "SELECT concat('exp_', lpad(CAST(candidate AS VARCHAR), 3, '0')) AS run, "
    "CAST(NULL AS DOUBLE) AS mean_accuracy, round(avg(value), 6) AS mean_f1, CAST(NULL AS DOUBLE) AS mean_precision, "
    "CAST(NULL AS DOUBLE) AS mean_recall, CAST(NULL AS DOUBLE) AS std_accuracy, round(stddev_pop(value), 6) AS std_f1, "
    "CAST(NULL AS DOUBLE) AS std_precision, CAST(NULL AS DOUBLE) AS std_recall FROM m WHERE split = 'validation' "
    "GROUP BY candidate", "m"))
def result_json_scan(spark, d):
    """A9 + A11: one nested result record per run (metrics, per-fold lists, importance summary),
    written as JSON, then all of them read back with an explicit schema."""
    m = tables.cv_metrics(spark, d)
    by_cand = m.where(F.col("split") == "validation").groupBy("candidate").agg(
        F.round(F.avg("value"), 6).alias("mean_f1"), F.round(F.stddev_pop("value"), 6).alias("std_f1"),
        F.sort_array(F.collect_list(F.struct("fold", "value"))).alias("_folds"))
    rec = by_cand.select(
        F.concat(F.lit("exp_"), F.lpad(F.col("candidate").cast("string"), 3, "0")).alias("run"),
        "mean_f1", "std_f1",
        F.create_map(F.lit("f1"), F.transform("_folds", lambda s: s["value"])).alias("fold_results"),
        F.struct(F.array(F.struct(F.lit("num__a").alias("feature"), F.lit(1.0).alias("cv_mean_importance_norm")))
                 .alias("cv_summary")).alias("feature_importance"))
    path = scratch_path(spark, "results_json")
    files.write_results_json(rec, path)
    return files.flatten_metrics(files.read_results_json(spark, path))


@query("params_roundtrip", with_views(
    "WITH x AS (SELECT id, num_a, num_b FROM p),\n"
    "b AS (SELECT quantile_cont(num_a, 0.01) AS a_lo, quantile_cont(num_a, 0.99) AS a_hi, "
    "quantile_cont(num_b, 0.01) AS b_lo, quantile_cont(num_b, 0.99) AS b_hi FROM x),\n"
    "m AS (SELECT quantile_cont(num_a, 0.5) AS ma, quantile_cont(num_b, 0.5) AS mb FROM x)\n"
    "SELECT id, round(coalesce(CASE WHEN num_a IS NULL THEN NULL ELSE least(greatest(num_a, a_lo), a_hi) END, ma), 6) AS num_a, "
    "round(coalesce(CASE WHEN num_b IS NULL THEN NULL ELSE least(greatest(num_b, b_lo), b_hi) END, mb), 6) AS num_b FROM x, b, m", "p"))
def params_roundtrip(spark, d):
    """Fitted clip bounds and medians saved as Parquet, loaded, applied."""
    x = cleaned_profile(spark, d).select("id", "num_a", "num_b")
    cols = ["num_a", "num_b"]
    base = scratch_path(spark, "params")
    files.save_params(bounds.fit_clip_bounds(x, cols), f"{base}/clip")
    files.save_params(impute.fit_simple(x, cols, "median"), f"{base}/median")
    y = bounds.apply_clip_bounds(x, files.load_params(spark, f"{base}/clip"))
    y = impute.apply_fill(y, files.load_params(spark, f"{base}/median"))
    return y.select("id", *[F.round(c, 6).alias(c) for c in cols])


@query("model_roundtrip")
def model_roundtrip(spark, d):
    """A fitted pipeline (assembler + tree) saved and loaded, then used to predict."""
    from foldwise.plans.q_model import train_frame
    tf = train_frame(spark, d)
    model = Pipeline(stages=[DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=4, seed=42)]).fit(tf)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(tf).select("id", "label", F.col("prediction").cast("int").alias("pred"))


_DESCRIBE_SCHEMA = ("feature string, count long, mean double, std double, min double, q1 double, median double, "
                    "q3 double, max double")


@query("profile_export", with_views(
    "WITH l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM p" for c in ("num_a", "num_b", "num_c"))
    + ")\nSELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, "
    "round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, "
    "round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max FROM l GROUP BY feature", "p"))
def profile_export(spark, d):
    """Describe and missing-value profiles exported as CSV; the describe table is read back
    with its schema (A1) and equals the in-memory one."""
    p = tables.profile(spark, d, with_note=True)
    base = scratch_path(spark, "profile_export")
    files.write_csv(profile.describe(p, ["num_a", "num_b", "num_c"]), f"{base}/describe")
    files.write_csv(profile.null_profile(p, ["cat_a", "num_a", "num_b", "note"]), f"{base}/missing")
    return spark.read.option("header", True).schema(_DESCRIBE_SCHEMA).csv(f"{base}/describe")


@query("confusion_export", with_views("SELECT label, pred, count(*) AS n FROM rp GROUP BY label, pred", "rp"))
def confusion_export(spark, d):
    """A16 for evaluation tables: the confusion matrix written and read back."""
    base = scratch_path(spark, "confusion")
    files.write_csv(metrics.confusion_matrix(tables.rule_predictions(spark, d), "label", "pred"), base)
    return spark.read.option("header", True).schema("label int, pred int, n long").csv(base)
