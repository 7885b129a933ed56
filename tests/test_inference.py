"""The batch encoder against a loop over windows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import inference

TEXTS = [(1, "one two three"), (2, None), (3, " ,. "), (4, " ".join(f"w{i % 50}" for i in range(1000))), (5, "One TWO three"), (5, "é ß 中文_1"), (None, "two")]


def by_loops(text, table, window):
    import re

    words = re.findall(r"\w+", (text or "").lower())
    total = np.zeros(table.shape[1])
    for i in range(0, len(words), window):
        part = words[i:i + window]
        total += len(part) * np.tanh(np.mean([table[inference.token_id(w, len(table) - 1)] for w in part], axis=0))
    return total / max(1, len(words))


@pytest.mark.parametrize("window", [128, 3, 1])
def test_whole_texts_in_windows(spark, window):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("embedding", F.lit(1)).repartition(2)
    table = inference.table_by_rule(40, 6)
    got = inference.embed(docs, "doc_id", "text", inference.mean_pooled, {"tokens": table}, 6, 40, window).collect()
    want = sorted((str(i), by_loops(t, table, window).round(9).tolist()) for i, t in TEXTS)
    assert sorted((str(r["doc_id"]), [round(v, 9) + 0.0 for v in r["embedding"]]) for r in got) == [(i, [x + 0.0 for x in v]) for i, v in want]
    assert inference.embed(docs.limit(0), "doc_id", "text", inference.mean_pooled, {"tokens": table}, 6, 40).count() == 0


def test_any_encoder_sees_ids_masks_and_weights(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")

    def last_real(ids, mask, weights):
        assert ids.shape == mask.shape == (2, 3) and (ids[mask == 0] == 0).all()
        return weights["scale"] * mask.sum(axis=1, keepdims=True)

    out = inference.embed(docs, "doc_id", "text", last_real, {"scale": np.array([2.0])}, 1, 10, window=3).first()["embedding"]
    assert out == [pytest.approx((3 * 6.0 + 2 * 4.0) / 5)]


def test_padding_is_no_token_and_large_weights_are_refused(spark, monkeypatch):
    assert (inference.table_by_rule(10, 4)[0] == 0).all() and inference.token_id("x", 5) >= 1
    monkeypatch.setattr(inference, "MAX_WEIGHT_BYTES", 8)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        inference.embed(docs, "doc_id", "text", inference.mean_pooled, {"tokens": np.zeros((3, 3))}, 3, 2)
