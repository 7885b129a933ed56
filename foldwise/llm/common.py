"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from foldwise.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Only ``columns`` of one table; extra columns of the file, whatever their names, stay out."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*(df[c] for c in columns)) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again: it is computed once,
    its lineage ends, and it survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, key: str, rows: int) -> list[Row]:
    """At most ``rows`` rows of ``df``, the same ones each time, in the order of a hash of ``key``.

    Rows are picked by the hash where they are, at a rate set by their number, so about ``rows`` rows in all
    reach the driver, however many there are and in whatever partitions; twice as many is the bound."""
    n = df.select(key).count()
    share = min(1.0, 1.2 * rows / max(1, n))
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    some = df.withColumn("_hash", hashed).where(F.col("_hash") < F.lit(int(share * (1 << 31)) + 1)).limit(2 * rows).collect()
    return sorted(some, key=lambda r: (r["_hash"], str(r)))[:rows]


#: Rows of an Arrow batch between the JVM and Python. Spark's default of 10,000 whole texts is hundreds of MB on either side.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Let this session's Arrow batches hold ``BATCH_ROWS`` rows at most, unless it asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict], rows: int = 256) -> DataFrame:
    """``fn`` gets up to ``rows`` rows at a time and returns the output columns by name, in the
    order of ``schema``. Slices are small, so that very long texts do not meet in memory."""
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                out = fn(batch.slice(i, rows))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in map(out.get, names)], names)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
