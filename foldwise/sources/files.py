"""File sources and sinks.

Reads take an explicit schema (no inference pass, no column silently turning into a string
because of one bad cell); every write goes through the DataFrame writer, so each task writes
its own part files and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import select
from foldwise.operators.ordered import global_row_number
from foldwise.session import materialize

# The missing-value tokens pandas' read_csv recognises by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS,
             multi_line: bool = False) -> DataFrame:
    """A1: headed UTF-8 CSV. Every field is read as text, NA tokens become NULL, then each column
    is converted to its declared type with ``try_cast`` (bad cells → NULL, never an error). With
    ``multi_line``, fields may hold line breaks, and a file is then read by one task."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (spark.read.schema(text_schema).option("header", True).option("mode", "PERMISSIVE")
           .option("encoding", "UTF-8").option("multiLine", multi_line).option("escape", '"').csv(path))
    toks = list(na_tokens)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        v = F.when(c.isNull() | F.trim(c).isin(toks), F.lit(None).cast("string")).otherwise(c)
        cols.append(v.alias(f.name) if isinstance(f.dataType, T.StringType) else v.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV (NULL written as an empty field)."""
    (df.write.mode(mode).option("header", True).option("nullValue", "").option("emptyValue", '""').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_predictions(df: DataFrame, path: str, latest_path: str | None, pred_col: str, id_col: str | None = "id",
                      out_id: str = "id", out_pred: str = "target") -> DataFrame:
    """A3: two-column prediction file (id, prediction). Without an id column the id falls back to
    1..n in the frame's order (a global row number computed range by range). A second copy is
    written to ``latest_path`` when given. The frame is materialised once, so that both files and the
    returned frame agree."""
    if id_col and id_col in df.columns:
        out = df.select(F.col(id_col).alias(out_id), F.col(pred_col).alias(out_pred))
    else:
        x = df.withColumn("_mono", F.monotonically_increasing_id())
        out = global_row_number(x, "_mono", out=out_id).select(out_id, F.col(pred_col).alias(out_pred))
    out = materialize(out)
    write_csv(out, path)
    if latest_path:
        write_csv(out, latest_path)
    return out


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append to a table (created with its schema on first write)."""
    df.write.mode("append").format(fmt).save(path)


def snapshot(spark: SparkSession, path: str, backup_path: str, fmt: str = "parquet") -> bool:
    """Copy the current table to a versioned path before it is appended to.
    Returns False when there is nothing to back up yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return False
    spark.read.format(fmt).load(path).write.mode("overwrite").format(fmt).save(backup_path)
    return True


def experiment_log_row(df: DataFrame) -> DataFrame:
    """A5: the depth field falls back from ``max_depth`` to ``depth``."""
    md = F.col("max_depth") if "max_depth" in df.columns else F.lit(None)
    dp = F.col("depth") if "depth" in df.columns else F.lit(None)
    return df.withColumn("depth_used", F.coalesce(md.cast("int"), dp.cast("int")))


# The eight metrics read from a result file; missing keys are NULL.
CV_RESULT_SCHEMA = T.StructType([
    T.StructField("run", T.StringType()),
    *[T.StructField(f"{s}_{m}", T.DoubleType()) for s in ("mean", "std") for m in ("accuracy", "f1", "precision", "recall")],
    T.StructField("fold_results", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("feature_importance", T.StructType([T.StructField("cv_summary", T.ArrayType(T.StructType([
        T.StructField("feature", T.StringType()), T.StructField("cv_mean_importance_norm", T.DoubleType())])))])),
])


def write_results_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Nested result records (structs, maps, arrays) as JSON lines."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


# The record of a search. The names of its fields.
SEARCH_FIELDS = """model_type string, search_metric string, selection_mode string, gap_lambda double, best_selection_score double,
    best_metric_mean double, best_metric_std double, best_train_metric_mean double, best_overfit_gap double,
    best_params map<string,string>, cv_results map<string,struct<mean:double,std:double,folds:array<double>>>,
    train_results map<string,struct<mean:double,std:double,folds:array<double>>>,
    feature_importance array<struct<feature:string,importance:double>>,
    metadata struct<model_name:string,cv_f1_score:double,n_features:bigint,feature_names:array<string>>"""


def search_record(metrics: DataFrame, params: DataFrame, importances: DataFrame, model_type: str, metric: str = "f1",
                  mode: str = "mean_minus_std_minus_gap", gap_lambda: float = 1.0) -> DataFrame:
    """One nested record: the best candidate of ``metrics`` (candidate, fold, split, metric, value) with its parameters,
    of ``params`` (candidate and a column each), its metrics per fold on validation and training rows, the importances
    (feature, cv_mean_importance_norm) from the most important down, and the model's metadata."""
    best = select.best_by(select.selection_scores(metrics, metric, [mode], gap_lambda), f"score_{mode}", "candidate")
    named = F.map_from_entries(F.array(*[F.struct(F.lit(c), F.col(c).cast("string")) for c in params.columns if c != "candidate"]))
    chosen = best.join(params.select("candidate", named.alias("best_params")), "candidate", "left")
    folds = (metrics.join(best.select("candidate"), "candidate", "left_semi").groupBy("split", "metric")
             .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.sort_array(F.collect_list(F.struct("fold", "value"))).alias("_f")))  # a row per fold
    entry = F.struct("metric", F.struct("mean", "std", F.transform("_f", lambda x: x["value"]).alias("folds")))
    results = folds.agg(*[F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("split") == split, entry)))).alias(name)
                          for split, name in (("validation", "cv_results"), ("train", "train_results"))])
    rank = F.array_sort(F.collect_list(F.struct((-F.col("cv_mean_importance_norm")).alias("_o"), "feature", F.col("cv_mean_importance_norm").alias("importance"))))
    order = importances.agg(rank.alias("_i")).select(F.transform("_i", lambda x: F.struct(x["feature"].alias("feature"), x["importance"].alias("importance"))).alias("feature_importance"))
    names = F.array_sort(F.transform("feature_importance", lambda x: x["feature"]))
    alone = lambda t: t.withColumn("_one", F.lit(1))
    one = alone(chosen).join(alone(results), "_one").join(alone(order), "_one")  # one row each
    score = F.col(f"score_{mode}")
    return one.select(F.lit(model_type).alias("model_type"), F.lit(metric).alias("search_metric"), F.lit(mode).alias("selection_mode"), F.lit(float(gap_lambda)).alias("gap_lambda"),
                      score.alias("best_selection_score"), F.col("mean").alias("best_metric_mean"), F.col("std").alias("best_metric_std"),
                      F.col("train_mean").alias("best_train_metric_mean"), F.col("gap").alias("best_overfit_gap"), "best_params", "cv_results", "train_results",
                      "feature_importance", F.struct(F.lit(model_type).alias("model_name"), F.col("mean").alias("cv_f1_score"),
                                                     F.size("feature_importance").cast("long").alias("n_features"), names.alias("feature_names")).alias("metadata"))


def read_results_json(spark: SparkSession, path_glob: str, schema: T.StructType = CV_RESULT_SCHEMA) -> DataFrame:
    """All result files at once, explicit schema; absent keys come back NULL."""
    return spark.read.schema(schema).json(path_glob)


def save_params(params: DataFrame, path: str) -> None:
    """A fitted params table is data: Parquet."""
    params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def flatten_metrics(df: DataFrame) -> DataFrame:
    """The eight mean/std metrics of each result as plain columns (absent keys → NULL)."""
    names = [f"{s}_{m}" for s in ("mean", "std") for m in ("accuracy", "f1", "precision", "recall")]
    return df.select("run", *names)
