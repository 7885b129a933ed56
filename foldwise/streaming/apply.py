"""Applying fitted params to a stream.

The reference has no streaming (SURVEY §2.K). What carries over: once params are fitted, every
transform here is a projection (plus, for grouped params, a join with a static table), so the
same functions run unchanged on a Structured Streaming DataFrame. A scoring stream reads new
files as they land, applies the fitted steps and a fitted model, and writes each micro-batch
with exactly-once file-sink semantics (checkpoint in the shared checkpoint folder).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from foldwise.session import scratch_path

Step = Callable[[DataFrame], DataFrame]


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1) -> DataFrame:
    """New Parquet files under ``path`` as a stream (explicit schema, bounded micro-batches)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Run fitted transform steps in order (works for batch and streaming frames alike)."""
    for s in steps:
        df = s(df)
    return df


def score_stream(df: DataFrame, steps: Sequence[Step], model=None) -> DataFrame:
    out = apply_steps(df, steps)
    return model.transform(out) if model is not None else out


def write_stream(df: DataFrame, out_path: str, checkpoint: str | None = None, trigger_once: bool = False):
    """File sink with a checkpoint (exactly-once); returns the running query."""
    spark = df.sparkSession
    ck = checkpoint or scratch_path(spark, "stream-checkpoint")
    w = df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ck).outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
