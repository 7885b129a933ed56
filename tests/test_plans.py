"""Plan-shape tests: transforms add no shuffle, parameter tables are broadcast,
scans are pruned, and no registered oracle query runs Python in its plan."""

import pytest
from pyspark.sql import functions as F

from foldwise.plans import registry
from foldwise.operators import bounds, folds, impute, scale, tfidf
from foldwise.sources import tables

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fitted_transforms_add_no_exchange(spark):
    x = tables.load(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice"])
    cols = ["l_quantity", "l_extendedprice"]
    y = bounds.apply_clip_bounds(x, bounds.fit_clip_bounds(x, cols))
    y = impute.apply_fill(y, impute.fit_simple(y, cols, "median"))
    y = scale.apply_scaler(y, scale.fit_scaler(y, cols, "standard"))
    p = _plan(y)
    assert "Exchange" not in p


def test_scan_reads_only_needed_columns(spark):
    x = tables.load(spark, SF_SMALL, "lineitem")
    y = x.where(F.col("l_quantity") > 10).select("l_orderkey", "l_quantity")
    p = _plan(y)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p


def test_fold_offsets_are_broadcast(spark):
    t = tables.labelled_text(spark, SF_SMALL).select("id", "label")
    p = _plan(folds.stratified_folds(t, "id", "label", 5, 42))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_tfidf_vocabulary_is_broadcast(spark):
    d = tables.load(spark, SF_SMALL, "documents", ["doc_id", "text"])
    p = _plan(tfidf.tfidf_long(d, "doc_id", "text", 10))
    assert "BroadcastExchange" in p


registry.load_all()
#: The exact neighbour search compares blocks of vectors in pandas; a sparse vector is put together by a small Python function;
#: the sentence encoder is a model in Python.
BLOCKED = {"smote_neighbours", "smote_rows", "tfidf_fold_vectors", "batch_embed_hook"}


@pytest.mark.parametrize("name", sorted(set(registry.ORACLE) - BLOCKED))
def test_oracle_queries_stay_in_the_jvm(spark, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    p = _plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in p, (name, bad)


def _exchanges(df) -> int:
    import re
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", _plan(df)))


def test_fit_shuffles_do_not_grow_with_columns_or_folds(spark):
    from foldwise.operators import fitting
    x = tables.load(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    x = x.withColumn("fold", (F.col("l_orderkey") % 10).cast("int"))
    two, four = ["l_quantity", "l_extendedprice"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    assert _exchanges(fitting.fit_quantiles(x, two, [0.5])) == _exchanges(fitting.fit_quantiles(x, four, [0.5]))
    assert _exchanges(fitting.fit_moments(x, two, "fold", 3)) == _exchanges(fitting.fit_moments(x, four, "fold", 10))
    assert _exchanges(fitting.fit_quantiles(x, two, [0.5], fold_col="fold", k=3)) == \
        _exchanges(fitting.fit_quantiles(x, four, [0.5], fold_col="fold", k=10))
