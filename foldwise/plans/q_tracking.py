"""Queries over run tracking (view R): latest runs, run-over-run comparison, counters,
leaderboard, trend, method/model aggregates, ids and names (A14 B24 B25 C3 D23–D28 E1–E3 F1 G2
H8–H14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions import exprs, names
from foldwise.operators import fitting, select, tracking
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.session import scratch_path
from foldwise.sources import files, tables

CUT_YEAR = 1998          # runs before this year are the history, runs in it the new batch
# The fixture's run names carry RF/GBT/SVM/DT: the reference's rules plus three more families.
FIXTURE_RULES = names.MODEL_RULES + [(("GBT",), "GradientBoostedTrees"), (("SVM",), "LinearSVM"),
                                     (("DT",), "DecisionTree")]


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _model_sql(col: str, rules=FIXTURE_RULES) -> str:
    whens = " ".join("WHEN " + " OR ".join(f"contains(upper({col}), '{s}')" for s in subs) + f" THEN '{lab}'"
                     for subs, lab in rules)
    return f"CASE WHEN {col} IS NULL THEN 'Unknown' {whens} ELSE 'Other' END"


def _method_sql(col: str) -> str:
    code = f"regexp_extract({col}, '(method[0-3])', 1)"
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.METHOD_NAMES.items())
    return f"CASE WHEN {code} = '' THEN NULL ELSE coalesce(CASE {code} {whens} END, {code}) END"


def _runs(spark, d):
    return tables.runs(spark, d)


# -- E1 ------------------------------------------------------------------------------------------

@query("run_latest", with_views(
    "WITH x AS (SELECT *, row_number() OVER (PARTITION BY config_file ORDER BY ts DESC, run_id DESC) AS rn "
    "FROM r WHERE status = 'success')\n"
    "SELECT config_file, run_id, run_name, ts, round(mean_f1, 6) AS mean_f1 FROM x WHERE rn = 1", "r"))
def run_latest(spark, d):
    x = tracking.latest_per_key(_runs(spark, d), "config_file", only_success=True)
    return x.select("config_file", "run_id", "run_name", "ts", r6("mean_f1").alias("mean_f1"))


# -- C3 H8 D28 ---------------------------------------------------------------------------------------

_CMP_SQL = (
    f"cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY config_file ORDER BY ts DESC, run_id DESC) AS rn "
    f"FROM r WHERE year(ts) >= {CUT_YEAR}) WHERE rn = 1),\n"
    f"prev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY config_file ORDER BY ts DESC, run_id DESC) AS rn "
    f"FROM r WHERE year(ts) < {CUT_YEAR} AND status = 'success') WHERE rn = 1),\n"
    "cmp AS (SELECT cur.config_file, cur.status, coalesce(prev.run_name, '') AS previous_run, cur.run_name AS new_run, "
    "prev.mean_f1 AS p, cur.mean_f1 AS n, cur.mean_f1 - prev.mean_f1 AS dlt FROM cur LEFT JOIN prev ON cur.config_file = prev.config_file)\n")


def _compare(spark, d):
    r = _runs(spark, d)
    cur = tracking.latest_per_key(r.where(tracking.year_of("ts") >= CUT_YEAR), "config_file")
    prev = tracking.latest_per_key(r.where(tracking.year_of("ts") < CUT_YEAR), "config_file", only_success=True)
    return tracking.compare_to_previous(cur, prev, "config_file", "mean_f1")


@query("run_compare", with_views(
    "WITH " + _CMP_SQL + "SELECT config_file, status, previous_run, new_run, coalesce(printf('%.6f', p), '') AS prev_mean_f1, "
    "coalesce(printf('%.6f', n), '') AS new_mean_f1, coalesce(printf('%+.6f', dlt), '') AS delta_mean_f1 FROM cmp", "r"))
def run_compare(spark, d):
    return _compare(spark, d).drop("_prev", "_new", "_delta")


@query("comparison_file", with_views(
    "WITH " + _CMP_SQL + "SELECT config_file, status, nullif(previous_run, '') AS previous_run, new_run, printf('%.6f', p) AS prev_mean_f1, "
    "printf('%.6f', n) AS new_mean_f1, printf('%+.6f', dlt) AS delta_mean_f1 FROM cmp", "r"))
def comparison_file(spark, d):
    """The run-over-run comparison written as a table of text, and read back (empty fields are null)."""
    path = scratch_path(spark, "comparison")
    table = _compare(spark, d).drop("_prev", "_new", "_delta")
    files.write_csv(table, path)
    return spark.read.option("header", True).option("nullValue", "").option("emptyValue", "").schema(table.schema).csv(path).select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in table.columns])


@query("run_counters", with_views(
    "WITH " + _CMP_SQL + "SELECT count(*) AS configs, "
    "count(*) FILTER (WHERE status = 'success' AND p IS NOT NULL AND dlt > 1e-12) AS improved, "
    "count(*) FILTER (WHERE status = 'success' AND p IS NOT NULL AND dlt < -1e-12) AS degraded, "
    "count(*) FILTER (WHERE status = 'success' AND p IS NOT NULL AND abs(dlt) <= 1e-12) AS same, "
    "count(*) FILTER (WHERE status = 'success' AND p IS NULL) AS new, "
    "count(*) FILTER (WHERE status <> 'success') AS failed FROM cmp", "r"))
def run_counters(spark, d):
    return tracking.comparison_counters(_compare(spark, d))


# -- F1 E3 ----------------------------------------------------------------------------------------------

@query("leaderboard", with_views(
    f"SELECT run_id, run_name, {_model_sql('run_name')} AS model, {_method_sql('run_name')} AS method, run_id % 3 = 0 AS resampled, "
    "round(mean_f1 - 0.02 + (run_id % 7) / 1000.0, 6) AS mean_accuracy, round(mean_f1, 6) AS mean_f1, "
    "round(mean_f1 - std_f1, 6) AS mean_precision, round(mean_f1 + std_f1, 6) AS mean_recall FROM r WHERE status = 'success' "
    "ORDER BY mean_f1 DESC, run_id ASC", "r"))
def leaderboard(spark, d):
    """the whole board, best first: run id and name, resampling flag, and the four means."""
    x = tracking.with_name_parts(_runs(spark, d).where(F.col("status") == "success"), rules=FIXTURE_RULES)
    x = (x.withColumn("resampled", F.col("run_id") % 3 == 0)
          .withColumn("mean_accuracy", F.col("mean_f1") - 0.02 + F.col("run_id") % 7 / 1000.0)
          .withColumn("mean_precision", F.col("mean_f1") - F.col("std_f1")).withColumn("mean_recall", F.col("mean_f1") + F.col("std_f1")))
    means = ["mean_accuracy", "mean_f1", "mean_precision", "mean_recall"]
    board = select.leaderboard(x, "mean_f1", ["run_id", "run_name", "model", "method", "resampled", *means], tie="run_id")
    return board.select("run_id", "run_name", "model", "method", "resampled", *[r6(c).alias(c) for c in means])


@query("run_trend", with_views(
    "SELECT row_number() OVER (ORDER BY ts, run_id) AS seq, run_id, round(mean_f1, 6) AS mean_f1, "
    "round(mean_f1 - std_f1, 6) AS band_lo, round(mean_f1 + std_f1, 6) AS band_hi FROM r WHERE status = 'success'", "r"))
def run_trend(spark, d):
    t = tracking.trend(_runs(spark, d).where(F.col("status") == "success"))
    return t.select("seq", "run_id", r6("mean_f1").alias("mean_f1"), r6("band_lo").alias("band_lo"),
                    r6("band_hi").alias("band_hi"))


# -- D23 D25 D26 ----------------------------------------------------------------------------------------

@query("method_median", with_views(
    f"SELECT {_method_sql('run_name')} AS method, round(quantile_cont(mean_f1, 0.5), 6) AS median_f1, count(*) AS n "
    "FROM r WHERE status = 'success' GROUP BY 1 ORDER BY median_f1 DESC", "r"))
def method_median(spark, d):
    x = tracking.with_name_parts(_runs(spark, d).where(F.col("status") == "success"), rules=FIXTURE_RULES)
    q = fitting.fit_quantiles(x, ["mean_f1"], [0.5], ["median_f1"], by=["method"])
    n = x.groupBy("method").agg(F.count(F.lit(1)).alias("n"))
    g = n.join(q, "method", "left")
    return g.select("method", r6("median_f1").alias("median_f1"), "n").orderBy(F.desc("median_f1"))


@query("method_average", with_views(
    f"WITH m AS (SELECT {_model_sql('run_name')} AS model, {_method_sql('run_name')} AS method, avg(mean_f1) AS f1 "
    "FROM r WHERE status = 'success' GROUP BY 1, 2)\n"
    "SELECT method, round(avg(f1), 6) AS mean_over_models, count(*) AS n_models FROM m GROUP BY method", "r"))
def method_average(spark, d):
    x = tracking.with_name_parts(_runs(spark, d).where(F.col("status") == "success"), rules=FIXTURE_RULES)
    m = x.groupBy("model", "method").agg(F.avg("mean_f1").alias("f1"))
    return m.groupBy("method").agg(r6(F.avg("f1")).alias("mean_over_models"), F.count(F.lit(1)).alias("n_models"))


@query("batch_delta", with_views(
    "WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY config_file ORDER BY ts DESC, run_id DESC) AS rn "
    "FROM r WHERE year(ts) = 1997 AND status = 'success') WHERE rn = 1),\n"
    "b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY config_file ORDER BY ts DESC, run_id DESC) AS rn "
    "FROM r WHERE year(ts) = 1998 AND status = 'success') WHERE rn = 1),\n"
    f"j AS (SELECT {_model_sql('b.run_name')} AS model, {_method_sql('b.run_name')} AS method, b.mean_f1 - a.mean_f1 AS delta "
    "FROM b JOIN a ON a.config_file = b.config_file)\n"
    "SELECT 'model' AS by, model AS key, round(avg(delta), 6) AS avg_delta, count(*) AS n FROM j GROUP BY model "
    "UNION ALL SELECT 'method', method, round(avg(delta), 6), count(*) FROM j GROUP BY method", "r"))
def batch_delta(spark, d):
    r = _runs(spark, d)
    a = tracking.latest_per_key(r.where(tracking.year_of("ts") == 1997), "config_file", only_success=True)
    b = tracking.latest_per_key(r.where(tracking.year_of("ts") == 1998), "config_file", only_success=True)
    j = b.select("config_file", "run_name", F.col("mean_f1").alias("nb")).join(
        a.select("config_file", F.col("mean_f1").alias("na")), "config_file")
    j = tracking.with_name_parts(j, rules=FIXTURE_RULES).withColumn("delta", F.col("nb") - F.col("na"))
    by_model = j.groupBy(F.col("model").alias("key")).agg(r6(F.avg("delta")).alias("avg_delta"), F.count(F.lit(1)).alias("n"))
    by_method = j.groupBy(F.col("method").alias("key")).agg(r6(F.avg("delta")).alias("avg_delta"), F.count(F.lit(1)).alias("n"))
    return (by_model.select(F.lit("model").alias("by"), "key", "avg_delta", "n")
            .unionByName(by_method.select(F.lit("method").alias("by"), "key", "avg_delta", "n")))


# -- E2 A14 G2 B24 B25 H9–H14 -------------------------------------------------------------------------------

@query("next_run_id", with_views(
    "SELECT coalesce(max(CASE WHEN regexp_extract(run_name, '^exp_(\\d+)_', 1) = '' THEN NULL "
    "ELSE CAST(regexp_extract(run_name, '^exp_(\\d+)_', 1) AS BIGINT) END) + 1, 1) AS next_run_id FROM r", "r"))
def next_run_id(spark, d):
    return tracking.next_run_id(_runs(spark, d))


@query("newest_run", with_views(
    "SELECT arg_max(run_name, CAST(regexp_extract(run_name, '^exp_(\\d+)_', 1) AS BIGINT)) AS newest_by_id, "
    "arg_max(run_name, (ts, run_id)) AS newest_by_time FROM r", "r"))
def newest_run(spark, d):
    return tracking.newest_run(_runs(spark, d))


@query("new_names", with_views(
    f"SELECT DISTINCT run_name FROM r WHERE year(ts) >= {CUT_YEAR} "
    f"AND run_name NOT IN (SELECT run_name FROM r WHERE year(ts) < {CUT_YEAR})", "r"))
def new_names(spark, d):
    """Run names present after the cut but not before it (set difference by anti join)."""
    r = _runs(spark, d)
    return tracking.new_keys(r.where(tracking.year_of("ts") >= CUT_YEAR), r.where(tracking.year_of("ts") < CUT_YEAR),
                             "run_name")


ID_THRESHOLD = 5000


@query("recognised_runs", with_views(
    f"WITH x AS (SELECT run_id, run_name, {_model_sql('run_name', names.MODEL_RULES)} AS model FROM r)\n"
    f"SELECT run_id, run_name, model FROM x WHERE model IS NOT NULL AND model <> 'Other' "
    f"AND regexp_extract(run_name, '^exp_(\\d+)', 1) <> '' AND CAST(regexp_extract(run_name, '^exp_(\\d+)', 1) AS BIGINT) >= {ID_THRESHOLD}", "r"))
def recognised_runs(spark, d):
    from foldwise.operators import clean
    x = _runs(spark, d).select("run_id", "run_name", names.model_family("run_name").alias("model"))
    x = clean.keep_recognised(x, "model")
    return clean.run_ids_at_least(x, "run_name", ID_THRESHOLD)


def _file_name_sql() -> str:
    fam = "CASE run_id % 4 WHEN 0 THEN 'RF' WHEN 1 THEN 'CB' WHEN 2 THEN 'LGBM' ELSE 'XGB' END"
    return ("concat('submission_exp_', lpad(CAST(run_id AS VARCHAR), 3, '0'), "
            f"CASE WHEN run_id % 5 = 0 THEN '' ELSE concat('_exp', CAST(run_id % 3 + 1 AS VARCHAR)) END, '_', {fam}, "
            "'_method', CAST(run_id % 4 AS VARCHAR), CASE WHEN run_id % 7 = 0 THEN '_extra_bmi' ELSE '' END, "
            "CASE WHEN run_id % 2 = 0 THEN '_fold' ELSE '_full' END, '.csv')")


def _file_name_col():
    rid = F.col("run_id")
    fam = F.when(rid % 4 == 0, "RF").when(rid % 4 == 1, "CB").when(rid % 4 == 2, "LGBM").otherwise("XGB")
    return F.concat(F.lit("submission_exp_"), F.lpad(rid.cast("string"), 3, "0"),
                    F.when(rid % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("_exp"), (rid % 3 + 1).cast("string"))),
                    F.lit("_"), fam, F.lit("_method"), (rid % 4).cast("string"),
                    F.when(rid % 7 == 0, F.lit("_extra_bmi")).otherwise(F.lit("")),
                    F.when(rid % 2 == 0, F.lit("_fold")).otherwise(F.lit("_full")), F.lit(".csv"))


def _message_sql(f: str) -> str:
    name = f"replace({f}, '.csv', '')"
    mode = f"CASE WHEN ends_with({name}, '_fold') THEN 'fold' ELSE 'full' END"
    base = (f"CASE WHEN ends_with({name}, '_fold') OR ends_with({name}, '_full') "
            f"THEN substr({name}, 1, length({name}) - 5) ELSE {name} END")
    parts = f"string_split({base}, '_')"
    g = f"{parts}[4]"
    group = f"concat(upper(substr({g}, 1, 1)), lower(substr({g}, 2)))"
    rest = f"array_to_string({parts}[5:], '_')"
    mm = rest
    for code, label in reversed(names.MESSAGE_METHOD_SUFFIX):
        mm = f"CASE WHEN contains({rest}, '{code}') THEN replace({rest}, '{code}', '{label}') ELSE {mm} END"
    msg = f"concat({group}, ': ', replace({mm}, '_', ' '), ' (', {mode}, ')')"
    return f"CASE WHEN len({parts}) >= 6 THEN {msg} ELSE {base} END"


@query("file_messages", with_views(
    f"WITH f AS (SELECT run_id, {_file_name_sql()} AS file_name FROM r)\n"
    f"SELECT run_id, file_name, {_message_sql('file_name')} AS message FROM f", "r"))
def file_messages(spark, d):
    f = _runs(spark, d).select("run_id", _file_name_col().alias("file_name"))
    return f.select("run_id", "file_name", names.message_from_file("file_name").alias("message"))


@query("format_parse", with_views(
    "SELECT run_id, coalesce(printf('%.6f', mean_f1), '') AS f1_text, "
    "CASE WHEN mean_f1 IS NULL THEN '' ELSE concat(printf('%.2f', mean_f1 * 100), '%') END AS f1_pct, "
    "TRY_CAST(rtrim(trim(CASE WHEN mean_f1 IS NULL THEN '' ELSE concat(printf('%.2f', mean_f1 * 100), '%') END), '%') AS DOUBLE) AS f1_pct_value, "
    "CASE WHEN trim(coalesce(printf('%.6f', mean_f1), '')) = '' THEN NULL "
    "ELSE TRY_CAST(trim(coalesce(printf('%.6f', mean_f1), '')) AS DOUBLE) END AS f1_value, "
    f"CAST(CASE WHEN regexp_extract(run_name, '^exp_(\\d+)_', 1) = '' THEN -1 "
    "ELSE CAST(regexp_extract(run_name, '^exp_(\\d+)_', 1) AS BIGINT) END AS BIGINT) AS exp_id FROM r", "r"))
def format_parse(spark, d):
    r = _runs(spark, d)
    x = r.select("run_id", "run_name", names.fmt_fixed("mean_f1").alias("f1_text"),
                 names.fmt_percent(F.col("mean_f1") * 100).alias("f1_pct"))
    return x.select("run_id", "f1_text", "f1_pct", exprs.parse_percent("f1_pct").alias("f1_pct_value"),
                    exprs.safe_float("f1_text").alias("f1_value"), names.exp_id("run_name").alias("exp_id"))
