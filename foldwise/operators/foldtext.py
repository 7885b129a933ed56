"""TF-IDF vectors inside folds (I20 I19 I24): a vocabulary per training fold, sparse vectors with named elements, and
their concatenation with an embedding.

Terms are counted once per (document, term). One aggregate by term then holds the document and corpus counts of every
training fold (all documents but the fold's own), and each fold keeps its ``max_features`` most frequent terms:
bounded tables, which are broadcast. A vector's elements are in alphabetical order of the terms, named ``tfidf_<term>``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.text import safe_text, word_runs
from foldwise.operators import vectors
from foldwise.session import materialize

#: The fold number of the vocabulary of all documents.
ALL_ROWS = -1
#: Bound of ``max_features`` times the number of vocabularies.
MAX_TERMS = 1_000_000


@dataclass
class FoldTfidf:
    """Sublinear tf, smoothed idf ``ln((1 + n) / (1 + df)) + 1``, length 1. Terms in more than ``max_df`` of a training
    fold's documents are left out; ties in corpus count are broken by the term."""

    max_features: int
    max_df: float = 0.95
    vocabulary: DataFrame | None = None
    terms: dict[int, list[str]] = field(default_factory=dict)

    @staticmethod
    def counts(df: DataFrame, id_col: str, text_col: str, fold_col: str = "fold") -> DataFrame:
        """(id, fold, term, tf) of whole texts, written once. A row with an id of its own is a document."""
        words = df.select(F.col(id_col).alias("id"), F.col(fold_col).cast("int").alias("fold"), F.explode(word_runs(safe_text(text_col))).alias("term"))
        return materialize(words.groupBy("id", "fold", "term").agg(F.count(F.lit(1)).alias("tf")))

    def fit(self, df: DataFrame, counts: DataFrame, k: int, fold_col: str = "fold") -> FoldTfidf:
        """``df`` has a row per document; ``counts``: see :meth:`counts`."""
        sets = [ALL_ROWS, *range(k)]
        if not 0 < self.max_features <= MAX_TERMS // len(sets):
            raise ValueError(f"max_features must be in 1..{MAX_TERMS // len(sets)}")
        inside = [F.lit(True) if f == ALL_ROWS else F.col("fold") != f for f in sets]
        n = df.select(F.col(fold_col).alias("fold")).agg(*[F.count_if(c) for c in inside]).first()
        by_term = counts.groupBy("term").agg(*[e for i, c in enumerate(inside) for e in (F.count_if(c).alias(f"df{i}"), F.sum(F.when(c, F.col("tf"))).alias(f"cf{i}"))])
        each = by_term.select("term", F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(n[i]).alias("n"), F.col(f"df{i}").alias("df"), F.col(f"cf{i}").alias("cf"))
                                                          for i, f in enumerate(sets)])).alias("c")).select("c.*", "term")
        top = Window.partitionBy("fold").orderBy(F.desc("cf"), "term")
        kept = each.where((F.col("df") > 0) & (F.col("df") <= F.lit(self.max_df) * F.col("n"))).withColumn("_rank", F.row_number().over(top)).where(F.col("_rank") <= self.max_features)
        # at most max_features rows a fold from here on
        index = F.row_number().over(Window.partitionBy("fold").orderBy("term")) - 1
        self.vocabulary = materialize(kept.select("fold", "term", index.alias("index"), "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")))
        self.terms = {f: [] for f in sets}
        for r in self.vocabulary.orderBy("fold", "index").collect():
            self.terms[r["fold"]].append(r["term"])
        return self

    def names(self, fold: int) -> list[str]:
        return [f"tfidf_{t}" for t in self.terms[fold]]

    def weights(self, counts: DataFrame, fold: int | None = None) -> DataFrame:
        """(id, fold, term, index, weight) over the vocabulary of ``fold``, by default of each document's own fold."""
        known = F.broadcast(self.vocabulary.select(F.col("fold").alias("of"), F.col("term").alias("known"), "index", "idf"))
        of = F.col("of") == (F.col("fold") if fold is None else F.lit(fold))
        found = counts.join(known, (F.col("term") == F.col("known")) & of).select("id", "fold", "term", "index", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
        return found.select("id", "fold", "term", "index", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))).alias("weight"))

    def vectors(self, df: DataFrame, counts: DataFrame, fold: int, id_col: str = "id", out: str = "tfidf") -> DataFrame:
        """``df`` with a sparse vector over the vocabulary of ``fold``; documents without known terms get zeros."""
        size = max(1, len(self.terms[fold]))

        def sparse(entries) -> SparseVector:
            return SparseVector(size, [(e["index"], e["weight"]) for e in entries or ()])

        rows = (self.weights(counts, fold).groupBy(F.col("id").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("index", "weight"))).alias("_entries")))  # one per known term
        joined = df.join(rows, F.col(id_col) == F.col("_id"), "left")
        vector = F.udf(sparse, VectorUDT())(F.col("_entries"))
        return joined.select(*df.columns, vectors.named(vector, self.names(fold) or ["tfidf_"], out))


def with_embedding(df: DataFrame, vector: str, embedding: str, dim: int, prefix: str, out: str = "features") -> DataFrame:
    """``vector`` followed by an array of ``dim`` numbers (null: zeros) named ``<prefix>_000`` and so on. Names of both
    stay with the result, which is sparse where that is smaller."""
    array = F.coalesce(F.col(embedding).cast("array<double>"), F.array_repeat(F.lit(0.0), dim))
    both = df.withColumn("_array", F.when(F.size(array) == dim, array))
    both = both.withColumn("_embedding", array_to_vector("_array"))
    joined = VectorAssembler(inputCols=[vector, "_embedding"], outputCol="_both", handleInvalid="error").transform(both)
    names = vectors.names_of(df, vector) + [f"{prefix}_{i:03d}" for i in range(dim)]
    return joined.select(*df.columns, vectors.named(F.col("_both"), names, out))


def long(df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """(keys..., feature, value): the named elements that are not 0."""
    names = F.array(*[F.lit(n) for n in vectors.names_of(df, vector)])
    each = df.select(*keys, F.posexplode(vector_to_array(vector)).alias("_at", "value")).where("value <> 0")
    return each.select(*keys, F.get(names, F.col("_at")).alias("feature"), "value")
