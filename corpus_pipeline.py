"""The corpus pipeline: language ID, toxicity, near duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.

Edge cases: null and empty texts have no letter and go at the first stage. Extra columns don't pass. Rows
that share a doc_id are one document to the near-duplicate stage: it goes if one of its texts goes, and
repeated rows of it are kept once. Rows without a doc_id are told apart by their texts and stand for their
group only if no document with a doc_id is in it.
Empty tables pass through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import jaccard_join, langid, packing, pii, toxicity
from foldwise.llm.common import table, written
from foldwise.llm.queries import BYTE_JSON, END_ID, PII_KEY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Ids of rejected documents that may be broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*(docs[c] for c in COLUMNS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a language (no text, or no letter); ``lang`` becomes the predicted one, and stays
    as it is if there was nothing to learn languages from."""
    docs = _columns(docs)
    network = langid.fit(docs)
    if network is None:
        return langid.with_letters(docs)
    found = langid.predict(docs, network, keep=["source", "n_chars"])
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that are predicted toxic."""
    docs = _columns(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model, keep=["lang", "source", "n_chars"]).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each group of near copies."""
    # rows without a doc_id go by their text, with numbers above those of the others
    number = F.coalesce("doc_id", F.lit(1 << 62) + F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1)))
    docs = _columns(docs).withColumn("_number", number)
    found = written(jaccard_join.near_duplicates(docs.select(F.col("_number").alias("doc_id"), "text"), 5, 80), "pipeline-groups")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_number")).distinct()
    several = found.where("component_id = doc_id").groupBy(F.col("doc_id").alias("_number")).count().where("count > 1").select("_number")

    def only(frame: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        return frame.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "_number", how)

    kept = only(docs, written(gone, "pipeline-gone"), "left_anti")
    several = written(several, "pipeline-repeated")
    if several.isEmpty():
        return kept.select(*COLUMNS)
    once = only(kept, several, "left_semi").dropDuplicates(["_number", "text"])
    return only(kept, several, "left_anti").unionByName(once).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms."""
    new = pii.pseudonymize(_columns(docs), PII_KEY)
    return new.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1024 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), BYTE_JSON, END_ID, 1024)


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", pack)]

#: Trained classifiers, keyed permutations and vocabularies have no SQL form; tests/llm checks run()
#: against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
