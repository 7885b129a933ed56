"""A table of saved runs, and scoring with all of them in one scan.

A run is a model, the fitted preparation it was trained through (if any), and a line in a record table: its id, family, the
paths, the settings of the preparation, and its metrics. Saving a run twice changes nothing. Runs are picked by id, or all
of them; their models and params are loaded from storage, and each adds a column of predictions to the same scan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.pipeline import ALL_ROWS, FoldPipeline
from foldwise.operators.train import MODELS
from foldwise.sources.records import RecordTable

RUN = "run string, family string, model_path string, params_path string, settings string, score double"


@dataclass
class SavedRun:
    run: str
    family: str
    model: object
    preparation: FoldPipeline | None = None
    score: float | None = None


class RunRegistry:
    """Saved runs under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = RecordTable(spark, f"{self.path}/runs", RUN)

    def save(self, run: SavedRun) -> None:
        """Model and params first, the line last: a run that was cut off isn't in the table, and is saved again."""
        if run.run in self.table.batches():
            return
        model, params, settings = f"{self.path}/models/{run.run}", None, None
        run.model.write().overwrite().save(model)
        if run.preparation:
            params = f"{self.path}/params/{run.run}"
            run.preparation.save(params)
            settings = json.dumps({f.name: getattr(run.preparation, f.name) for f in fields(run.preparation) if f.init and f.name not in ("tables", "_fetched")})
        self.table.append(self.spark.createDataFrame([(run.run, run.family, model, params, settings, run.score)], RUN), run.run)

    def runs(self) -> list[str]:
        """Ids, the oldest first."""
        return self.table.batches()

    def load(self, runs: Sequence[str] | None = None) -> list[SavedRun]:
        """The given runs, or all; an id that is not saved is an error."""
        wanted = self.runs() if runs is None else list(runs)
        lines = {r["run"]: r for r in self.table.read().collect()}  # a line per run
        if unknown := [r for r in wanted if r not in lines]:
            raise ValueError(f"no saved run {unknown}")
        out = []
        for name in wanted:
            line, preparation = lines[name], None
            if line["params_path"]:
                settings = json.loads(line["settings"])
                if settings["ratios"]:
                    settings["ratios"] = tuple(settings["ratios"])
                preparation = FoldPipeline(**settings).load(self.spark, line["params_path"])
            out.append(SavedRun(name, line["family"], MODELS[line["family"]].load(line["model_path"]), preparation, line["score"]))
        return out

    def best(self) -> SavedRun:
        """The saved run of the highest score, the first of equal ones."""
        lines = [r for r in self.table.read().collect() if r["score"] is not None]
        order = {r: i for i, r in enumerate(self.runs())}
        if not lines:
            raise ValueError("no saved run has a score")
        return self.load([min(lines, key=lambda r: (-r["score"], order[r["run"]]))["run"]])[0]


def predict_all(df: DataFrame, runs: Sequence[SavedRun], id_col: str = "id", features: str = "features") -> DataFrame:
    """(id, run, pred, p1) of every row and run, from one scan of ``df``: runs with a preparation start from its columns,
    others from the vector ``features``. p1 is null for models without probabilities."""
    inputs = sorted({c for r in runs if r.preparation for c in r.preparation.inputs})
    raw = {c: f"_raw_{c}" for c in inputs}
    needs = [features] if any(r.preparation is None for r in runs) else []
    x = df.select(F.col(id_col).alias("_id"), *needs, *[F.col(c).alias(name) for c, name in raw.items()])
    said = []
    for i, r in enumerate(runs):
        model = r.model.copy()
        model.setPredictionCol(f"_pred{i}")
        if r.preparation:
            back = [F.col(raw[c]).alias(c) for c in r.preparation.inputs]
            x = r.preparation.features(x.select("*", *back), ALL_ROWS, x.columns, f"_features{i}")
            model.setFeaturesCol(f"_features{i}")
        else:
            model.setFeaturesCol(features)
        p1 = F.lit(None).cast("double")
        model.setRawPredictionCol(f"_raw{i}")
        if hasattr(model, "setProbabilityCol"):
            model.setProbabilityCol(f"_p{i}")
            p1 = vector_to_array(f"_p{i}")[1]
        x = model.transform(x)
        said.append(F.struct(F.lit(r.run).alias("run"), F.col(f"_pred{i}").cast("int").alias("pred"), p1.alias("p1")))
    if not said:
        return df.sparkSession.createDataFrame([], "id long, run string, pred int, p1 double")
    return x.select(F.col("_id").alias(id_col), F.explode(F.array(*said)).alias("s")).select(id_col, "s.*")
