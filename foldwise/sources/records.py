"""Record tables that a repeated append does not change (A4–A7, G1), and the newest of saved files.

A batch of rows is written under its id, and enters the table by a line in the manifest, which holds its number and
rows. A batch that was cut off has no line and is written again; a batch with a line is left as it is, so that a retry
changes nothing. Version v of the table is the first v batches: a backup is a number, and nothing is copied. One
writer appends at a time, as to any log file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The fields of a training run's record, and of a batch item's.
RUN_FIELDS = """exp_id string, timestamp string, name string, description string, model_type string, use_smote boolean,
    learning_rate double, max_depth int, mean_accuracy double, std_accuracy double, mean_f1 double, std_f1 double,
    mean_precision double, std_precision double, mean_recall double, std_recall double, full_train_accuracy double,
    full_train_f1 double, full_train_precision double, full_train_recall double, full_train_metric_scope string"""
BATCH_FIELDS = """timestamp string, config_file string, experiment_name string, experiment_folder string, model_type string,
    imputation_method string, status string, return_code int, mean_accuracy double, mean_f1 double, mean_precision double,
    mean_recall double, std_accuracy double, std_f1 double, std_precision double, std_recall double, error_message string"""
_MANIFEST = "number int, batch string, rows long"


def with_fields(df: DataFrame, fields: str) -> DataFrame:
    """``df`` with exactly these fields: what it lacks is null, what it has more is left out."""
    schema = T._parse_datatype_string(fields)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def run_record(df: DataFrame) -> DataFrame:
    """A5: the fields of a run's record; ``max_depth`` falls back to ``depth``, and the scope has a default."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None)
    return with_fields(df.withColumns({"max_depth": F.coalesce(has("max_depth").cast("int"), has("depth").cast("int")),
                                       "full_train_metric_scope": F.coalesce(has("full_train_metric_scope").cast("string"), F.lit("train_set_only_no_validation"))}), RUN_FIELDS)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class RecordTable:
    """A table under ``path`` with the columns of ``fields`` (DDL)."""

    def __init__(self, spark: SparkSession, path: str, fields: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), T._parse_datatype_string(fields)

    def batches(self) -> list[str]:
        """Ids of the table's batches, in order of their numbers."""
        if not _exists(self.spark, f"{self.path}/manifest"):
            return []
        return [r["batch"] for r in self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest/*").orderBy("number").collect()]  # a line per batch

    @property
    def version(self) -> int:
        return len(self.batches())

    def append(self, rows: DataFrame, batch: str) -> int:
        """Append ``rows`` as ``batch`` unless it is in the table; returns the table's version. Columns go by name, missing
        ones are null; a column that the table lacks is an error."""
        extra = set(rows.columns) - set(self.schema.names)
        if extra or not batch or "/" in batch:
            raise ValueError(f"unknown columns {sorted(extra)}" if extra else f"{batch!r} is no batch id")
        known = self.batches()
        if batch in known:
            return len(known)
        full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema])
        full.write.mode("overwrite").parquet(f"{self.path}/batches/{batch}")
        count = self.spark.read.schema(self.schema).parquet(f"{self.path}/batches/{batch}").count()
        line = self.spark.createDataFrame([(len(known) + 1, batch, count)], _MANIFEST)
        line.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{batch}")
        return len(known) + 1

    def read(self, version: int | None = None) -> DataFrame:
        """The table, or an earlier version of it; batches without a line in the manifest are not part of it."""
        known = self.batches()
        if version is not None and not 0 <= version <= len(known):
            raise ValueError(f"versions are 0 to {len(known)}")
        paths = [f"{self.path}/batches/{b}" for b in known[:version]]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)


def files_by_time(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, modified, length) of the files under ``path``, newest first; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return (found.select("path", F.element_at(F.split("path", "/"), -2).alias("name"), F.col("modificationTime").alias("modified"), "length")
            .orderBy(F.desc("modified"), F.desc("path")))


def newest_file(spark: SparkSession, path: str, pattern: str = "*", run: str | None = None) -> str | None:
    """The newest file by its modification time (the greatest path among equals), or that of one run: a folder by
    that name. None if there is none."""
    found = files_by_time(spark, path, pattern)
    if run is not None:
        found = found.where(F.array_contains(F.split("path", "/"), run))
    first = found.first()
    return first["path"] if first else None


def read_newest(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.json", runs: Sequence[str] | None = None) -> DataFrame:
    """The JSON records of the newest file, or of the newest file of each of ``runs``."""
    paths = [newest_file(spark, path, pattern, run) for run in (runs if runs is not None else [None])]
    paths = [p for p in paths if p]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)
