"""Streaming query (§2.K): fitted steps applied to a Structured Streaming source."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import bounds, impute
from foldwise.plans.common import cleaned_profile
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.session import scratch_path
from foldwise.streaming import apply as stream

_COLS = ["num_a", "num_b"]


@query("stream_apply", with_views(
    "WITH x AS (SELECT id, num_a, num_b FROM p),\n"
    "b AS (SELECT quantile_cont(num_a, 0.01) AS a_lo, quantile_cont(num_a, 0.99) AS a_hi, "
    "quantile_cont(num_b, 0.01) AS b_lo, quantile_cont(num_b, 0.99) AS b_hi FROM x),\n"
    "c AS (SELECT id, CASE WHEN num_a IS NULL THEN NULL ELSE least(greatest(num_a, a_lo), a_hi) END AS num_a, "
    "CASE WHEN num_b IS NULL THEN NULL ELSE least(greatest(num_b, b_lo), b_hi) END AS num_b FROM x, b),\n"
    "m AS (SELECT quantile_cont(num_a, 0.5) AS ma, quantile_cont(num_b, 0.5) AS mb FROM c)\n"
    "SELECT id, round(coalesce(num_a, ma), 6) AS num_a, round(coalesce(num_b, mb), 6) AS num_b FROM c, m", "p"))
def stream_apply(spark, d):
    """Clip bounds and medians are fitted on the batch table; the rows then arrive as files of a
    stream, the fitted steps run per micro-batch (availableNow trigger, exactly-once file sink
    with its checkpoint in the shared folder), and the sink is read back."""
    x = cleaned_profile(spark, d).select("id", *_COLS)
    b = bounds.fit_clip_bounds(x, _COLS)
    clipped = bounds.apply_clip_bounds(x, b)
    m = impute.fit_simple(clipped, _COLS, "median")
    steps = [lambda df: bounds.apply_clip_bounds(df, b), lambda df: impute.apply_fill(df, m)]
    src, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    x.write.parquet(src)
    q = stream.write_stream(stream.score_stream(stream.read_stream(spark, src, x.schema, 4), steps), out,
                            trigger_once=True)
    q.awaitTermination()
    return spark.read.parquet(out).select("id", *[F.round(c, 6).alias(c) for c in _COLS])
