"""Named input tables and the derived fixture views.

Base tables are read with an explicit column list so the Parquet scan only reads what a query
uses (Catalyst prunes further). The derived views model the reference's data shapes on the
supplied tables:

* ``profile`` (P): a classification table with nulls, sentinels, outliers, a dirty number
  column and a short text column;
* ``runs`` (R): experiment-run records for the tracking operators;
* ``cv_metrics`` (M): per-candidate, per-fold metric rows for the selection operators;
* ``fold_importance`` (I): per-fold feature importances;
* ``labelled_text`` (T): documents with a binary label.

The same definitions, as SQL, are in :mod:`foldwise.plans.views_sql` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Tables whose rows carry long texts: per-row work (regex, tokenising) dominates their scans.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
         balance: bool | None = None) -> DataFrame:
    """Read one table (only ``columns``).

    ``balance`` (default: on for text tables) spreads the rows over the cluster when the scan
    yields fewer splits than there are cores — e.g. a file written as one row group. With
    many input splits (the normal case at scale) it does nothing.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    if balance is None:
        balance = name in TEXT_TABLES and (not columns or "text" in columns)
    if balance:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores)
    return df


def _mod(c: str, k: int):
    return F.col(c) % F.lit(k)


def profile(spark: SparkSession, sf_dir: str, with_note: bool = False) -> DataFrame:
    """View P. Customer ⋈ nation ⋈ region, left ⋈ documents on doc_id = custkey.

    nation and region are fixed-size dimension tables (25 and 5 rows at every scale), so they
    are broadcast. The document join only feeds ``note``: it is made when ``with_note`` is set
    (``doc_id`` is the documents key, so the left join never changes the row count) and carries
    whole texts. Without it the view has no ``note`` column at all.
    """
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = load(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = load(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    j = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
          .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
    if with_note:
        d = load(spark, sf_dir, "documents", ["doc_id", "text"]).select(
            F.col("doc_id"), F.col("text").alias("doc_note"))
        j = j.join(d, F.col("doc_id") == F.col("c_custkey"), "left")
    key = "c_custkey"
    acct = F.col("c_acctbal")
    return j.select(
        F.col(key).alias("id"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit(2)).otherwise(F.lit(1)).alias("target_raw"),
        F.when(_mod(key, 11) == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("cat_a"),
        F.when(_mod(key, 6) == 0, F.lit(None)).otherwise(F.col("r_name")).alias("cat_b"),
        F.when(_mod(key, 7) == 0, F.lit(None).cast("double"))
         .when(_mod(key, 97) == 0, F.lit(-187.0))
         .otherwise(140 + acct / 150).alias("num_a"),
        F.when(_mod(key, 9) == 0, F.lit(None).cast("double"))
         .when(_mod(key, 101) == 0, F.lit(-1000.0))
         .otherwise(45 + acct / 200 + F.col("c_nationkey")).alias("num_b"),
        F.when(_mod(key, 10) == 0, F.lit(None).cast("double"))
         .otherwise((70 + (F.col(key) * 37) % 80).cast("double")).alias("num_c"),
        F.when(_mod(key, 12) == 0, F.lit(None).cast("double"))
         .when(_mod(key, 103) == 0, F.lit(-1000.0))
         .otherwise(((F.col(key) * 7919) % 3000).cast("double")).alias("long_tail"),
        F.when(_mod(key, 8) == 0, F.lit(None).cast("double"))
         .otherwise((1 + _mod(key, 5)).cast("double")).alias("ord_a"),
        F.when(_mod(key, 13) == 0, F.lit("#NUM!"))
         .otherwise(_mod(key, 200).cast("string")).alias("raw_num"),
        *([F.when(_mod(key, 5) == 0, F.lit(None).cast("string")).otherwise(F.col("doc_note")).alias("note")]
          if with_note else []),
    )


def _family():
    k = F.col("o_orderkey") % 4
    return F.when(k == 0, "RF").when(k == 1, "GBT").when(k == 2, "SVM").otherwise("DT")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View R: one experiment-run record per order."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    failed = F.col("o_orderkey") % 10 == 0
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("exp_"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit("_"),
                 _family(), F.lit("_method"), (F.col("o_custkey") % 4).cast("string")).alias("run_name"),
        F.concat(F.lit("cfg_"), (F.col("o_custkey") % 40).cast("string")).alias("config_file"),
        F.col("o_orderdate").alias("ts"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.lit(None).cast("double"))
         .otherwise(0.7 + ((F.col("o_orderkey") * 7919) % 2500).cast("double") / 10000).alias("mean_f1"),
        F.when(failed, F.lit(None).cast("double"))
         .otherwise(((F.col("o_orderkey") * 31) % 400).cast("double") / 10000).alias("std_f1"),
    )


def cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View M: (candidate, fold, split, metric, value) rows."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    split = F.when(F.col("o_orderstatus") == "F", "train").otherwise("validation")
    return (o.groupBy((F.col("o_custkey") % 12).alias("candidate"),
                      (F.col("o_orderkey") % 5).alias("fold"), split.alias("split"))
             .agg((0.6 + F.avg("o_totalprice") / 1000000).alias("value"))
             .select("candidate", "fold", "split", F.lit("f1").alias("metric"), "value"))


def fold_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View I: (fold, feature, importance) over all line items."""
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    fam = F.when(F.col("l_partkey") % 4 == 0, "num").when(F.col("l_partkey") % 4 == 1, "log") \
        .when(F.col("l_partkey") % 4 == 2, "cat").otherwise("ord")
    return (li.groupBy((F.col("l_orderkey") % 5).alias("fold"),
                       F.concat(fam, F.lit("__f"), (F.col("l_partkey") % 20).cast("string")).alias("feature"))
              .agg(F.sum("l_quantity").alias("importance")))


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View T: (id, text, lang, label) — documents that have a quality label."""
    d = load(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    lab = load(spark, sf_dir, "labels", ["doc_id", "quality"])
    return d.join(lab, "doc_id").select(F.col("doc_id").alias("id"), "text", "lang",
                                        F.col("quality").alias("label"))


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a deterministic rule-based prediction and score.

    (id, label, pred, score): pred = 1 when n_chars % 10 < 8; the score used for ranking
    metrics is (n_chars % 100) / 100.
    """
    d = load(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    lab = load(spark, sf_dir, "labels", ["doc_id", "quality"])
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label"),
        F.when(F.col("n_chars") % 10 < 8, 1).otherwise(0).alias("pred"),
        ((F.col("n_chars") % 100).cast("double") / 100).alias("score"))
