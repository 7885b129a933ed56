"""The pipeline against plain steps, and the registration of the corpus queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from brute import components, jaccard_linked, shingles
from llm_data import docs, no_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage, as rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        got = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, got)
        docs = got
    return out


def test_stages_keep_the_columns(stages):
    for name, (_, got) in list(stages.items())[:-1]:
        assert got.columns == corpus_pipeline.COLUMNS, name


def test_language_rejects_only_texts_without_letters(stages):
    before, after = stages["language"]
    want = {r["doc_id"] for r in before.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in after.collect()} == want


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before.collect()}
    want = components(list(sets), lambda a, b: jaccard_linked(sets[a], sets[b]))
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(want.values()))


def test_personal_data_changes_texts_only(stages):
    before, after = stages["personal_data"]
    a, b = ({r["doc_id"]: r for r in x.collect()} for x in (before, after))
    assert a.keys() == b.keys() and all(b[i]["n_chars"] == len(b[i]["text"]) for i in b)
    changed = {i for i in a if a[i]["text"] != b[i]["text"]}
    assert changed and all(any(c.isdigit() or c == "@" for c in a[i]["text"]) for i in changed)


def test_everything_left_is_packed(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in after.collect()}
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024


def test_run_equals_the_stages(spark, stages):
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages["packing"][1].collect()))


def test_edge_rows_pass_through(spark, docs, no_docs):
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, i) for i in (1, 5, 6, 7, 8, 10, 11, 13, 14, 15)] + [(True, 0)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
        stage(spark, docs, SF).collect()


def test_documents_with_letters_stay_without_labels(spark):
    texts = ["some words of a text", "12 34", None, "", "ünï", "more words"]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for lang, make in ((None, lambda t: t), ("und", lambda t: t), ("en", lambda t: t and t + " " + t * 20_000)):
        rows = spark.createDataFrame([(i, make(t), lang, "s", i) for i, t in enumerate(texts)], kind)
        got = sorted((r["doc_id"], r["source"], r["n_chars"], r["lang"]) for r in corpus_pipeline.language(spark, rows, SF).collect())
        assert got == [(i, "s", i, lang) for i in (0, 4, 5)]
