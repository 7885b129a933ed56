import math
import random
import zlib

import numpy as np
import pytest

from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import langid, toxicity


def speak(rng, parts, n):
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


LANGUAGES = {"aa": ["the", "ing", "er", "and", "on"], "bb": ["sch", "ung", "ein", "ö", "keit"], "cc": ["ción", "ado", "que", "ñ", "los"]}


@pytest.fixture(scope="module")
def network():
    rng = random.Random(1)
    pairs = [(speak(rng, LANGUAGES[k], 40), k) for k in LANGUAGES for _ in range(60)]
    return langid.train([t for t, _ in pairs], [k for _, k in pairs])


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = langid.Network.new(["a", "b"], 3)
    net.table, net.recurrent, net.out = [x.astype(np.float64) for x in net.table], [x.astype(np.float64) for x in net.recurrent], net.out.astype(np.float64)
    data, target = rng.integers(97, 101, size=(6, 3)).astype(np.uint8), np.array([0, 1, 1])

    def loss():
        total = 0.0
        states = [{t: s.astype(np.float64) for t, s, _ in net.states(k, data)} for k in (0, 1)]
        for t in range(6):
            z = net.out @ np.concatenate([states[0][t], states[1][t], np.ones((1, 3))])
            z = z - z.max(axis=0)
            total -= (z[target, np.arange(3)] - np.log(np.exp(z).sum(axis=0))).sum()
        return total / 18

    weights = [*net.table, *net.recurrent, net.out]
    for w, g in zip(weights, net.gradients(data, target)):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if w.shape[1] == 256:
                at = (at[0], int(rng.integers(97, 101)))
            w[at] += 1e-4
            up = loss()
            w[at] -= 2e-4
            down = loss()
            w[at] += 1e-4
            assert abs((up - down) / 2e-4 - g[at]) < 2e-4


def test_languages_are_learned_and_windows_pool(network):
    rng = random.Random(2)
    for k, parts in LANGUAGES.items():
        texts = [speak(rng, parts, n) for n in (3, 30, 700)]
        p = langid.document_probabilities(network, texts)
        assert [network.languages[i] for i in p.argmax(axis=1)] == [k] * 3 and np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_documents_do_not_influence_each_other(network):
    texts = ["the ing", "schungö " * 300, "x"]
    together = langid.document_probabilities(network, texts)
    for t, p in zip(texts, together):
        assert np.allclose(langid.document_probabilities(network, [t])[0], p, atol=1e-5)


def test_prediction_of_edge_rows(spark, docs, no_docs, network):
    rows = langid.predict(docs, network).collect()
    source = docs.collect()
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in source]
    for r, d in zip(rows, source):
        letters = any(c.isalpha() for c in d["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert r["held_out"] == (d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
    assert langid.predict(no_docs, network).count() == 0 and langid.fit(no_docs) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    kept = langid.predict(docs, network, keep=["lang", "token"])
    assert kept.columns == ["doc_id", "held_out", "lang_pred", "score", "text", "lang", "token"] and kept.count() == len(source)


def test_held_out_rows_teach_nothing(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2][:20]
    rows = spark.createDataFrame([(i, "some text", "xx") for i in ids], "doc_id long, text string, lang string")
    assert langid.fit(rows) is None
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0][:20]
    rows = spark.createDataFrame([(i, "some text") for i in ids], "doc_id long, text string")
    assert toxicity.fit(rows, spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")) is None


def toxic_corpus(rng, n):
    out = []
    for k in range(n):
        words = speak(rng, LANGUAGES["aa"], rng.randint(30, 300)).split()
        toxic = k % 6 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scumbag"]))
        out.append((" ".join(words), int(toxic)))
    return out


def sample(spark, rows):
    return spark.createDataFrame([(i, y, t) for i, (t, y) in enumerate(rows)], "at long, toxic int, text string")


def test_toxic_documents_are_found(spark):
    rng = random.Random(4)
    train, test = toxic_corpus(rng, 900), toxic_corpus(rng, 300)
    model = toxicity.train(sample(spark, train))
    x = np.array([toxicity.features(model, t) for t, _ in test])
    p = x @ np.array(model.weights[:-1]) + model.weights[-1] >= 0
    y = np.array([y for _, y in test], bool)
    assert (p == y).mean() > 0.95 and p[y].mean() > 0.85


def test_windows_hold_the_whole_text():
    for text in ("", "a", "word " * 500, "x" * 5000, "é\n\n" * 300):
        found = toxicity.windows(text)
        assert b"".join(found) == text.encode() and all(len(w) <= 2 * toxicity.WINDOW for w in found)


def test_scores_of_edge_rows(spark, docs, no_docs):
    rng = random.Random(5)
    model = toxicity.train(sample(spark, toxic_corpus(rng, 400)))
    rows = toxicity.score(docs, model).collect()
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in docs.collect()]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    empty = {round(r["score"], 9) for r, d in zip(rows, docs.collect()) if not d["text"]}
    assert len(empty) == 1
    assert toxicity.score(no_docs, model).count() == 0
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.fit(docs, none) is None
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 1, 0), (1, 0, 0)], "doc_id long, toxic int, quality int")
    assert toxicity.fit(docs, odd) is None


def test_rare_toxic_documents_are_sampled_and_weighed_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(toxicity, "train", lambda rows, shares: given.append((*zip(*rows.select("text", "toxic").collect()), shares)))
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, int(i % 50 == 0)) for i in ids] + [(i + 5000, 1) for i in ids], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    toxicity.fit(docs, labels)
    (texts, toxic, shares), every = given[0], [int(i % 50 == 0) for i in ids]
    assert len(set(texts)) == len(texts) == 200 and sum(toxic) == sum(every) > 50
    assert shares == [(200 - sum(every)) / (len(every) - sum(every)), 1.0]


def test_calibration_keeps_the_base_rate(spark):
    rng = random.Random(6)
    rows = toxic_corpus(rng, 900)
    few = [(t, y) for t, y in rows if y or rng.random() < 0.25]
    rates = []
    for some, share in ((rows, 1), (few, sum(not y for _, y in few) / sum(not y for _, y in rows))):
        model = toxicity.train(sample(spark, some), (share, 1))
        x = np.array([toxicity.features(model, t) for t, _ in rows])
        rates.append((1 / (1 + np.exp(-(x @ np.array(model.weights[:-1]) + model.weights[-1])))).mean())
    assert abs(rates[0] - 1 / 6) < 0.03 and abs(rates[1] - 1 / 6) < 0.03


def words_by_loops(toxic, ordinary):
    sizes = sum(map(len, ordinary)), sum(map(len, toxic))
    different = {w for t in toxic + ordinary for w in toxicity._WORD.findall(t)}
    least = math.ceil(math.log(len(different) / toxicity.CHANCE) / math.log(sum(sizes) / sizes[1]))
    contexts = {}
    for y, texts in ((1, toxic), (0, ordinary)):
        for t in texts:
            words = [b"", *toxicity._WORD.findall(t), b""]
            for i in range(1, len(words) - 1):
                contexts.setdefault(words[i], (set(), set()))[y].add((words[i - 1], words[i + 1]))
    n = {w: sum(w in toxicity._WORD.findall(t) for t in toxic) for w in contexts}
    ok = lambda a, b: a >= least and a / sizes[1] >= toxicity.LEAST_RATIO * (b + 0.5) / sizes[0]
    return sorted(((w, len(c[1])) for w, c in contexts.items() if ok(n[w], 0) and ok(len(c[1]), len(c[0]))), key=lambda r: (r[1], r[0]))


def test_toxic_words_equal_loops_and_copies_change_nothing(spark):
    rng = random.Random(7)
    toxic = [f"{speak(rng, LANGUAGES['aa'], 10)} {w} {speak(rng, LANGUAGES['aa'], 10)}".encode().lower() for w in ("idiot", "moron") for _ in range(12)]
    ordinary = [speak(rng, LANGUAGES["aa"], 20).encode().lower() for _ in range(200)] * 5
    frame = spark.createDataFrame([(y, [t]) for y, texts in ((1, toxic), (0, ordinary)) for t in texts], "toxic int, pieces array<binary>")
    found = toxicity.toxic_words(frame, [sum(map(len, ordinary)), sum(map(len, toxic))])
    assert found == words_by_loops(toxic, ordinary) and {b"idiot", b"moron"} <= {w for w, _ in found}
    content = toxicity.toxic_content(found)
    assert all(w in content for w, _ in found)


def test_pieces_come_from_all_over_a_long_text():
    assert toxicity.pieces(None, 1) == [b""] and toxicity.pieces("A b", 1) == [b"a b"]
    text = " ".join(f"w{i}" for i in range(200_000))
    found = toxicity.pieces(text, 3)
    known = set(text.encode().split())
    assert len(found) == toxicity.PIECES and sum(map(len, found)) <= toxicity.SAMPLE_BYTES and all(set(p.split()) <= known for p in found)
    assert toxicity.pieces("x" * 100_000, 1) and [len(p) for p in toxicity.pieces(" " * 100_000, 1)] == [0] * toxicity.PIECES


def test_a_language_and_a_kind_of_toxicity_in_long_texts_only_are_learnt(spark):
    rng = random.Random(8)
    long = lambda parts, n: " ".join(speak(rng, parts, 50) for _ in range(n))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, long(LANGUAGES["bb"], 260) if i % 10 == 0 else speak(rng, LANGUAGES["aa"], 40), "bb" if i % 10 == 0 else "aa") for i in ids],
                                 "doc_id long, text string, lang string")
    assert max(r[0] for r in docs.selectExpr("length(text)").collect()) > 65_536
    network = langid.fit(docs)
    probe = spark.createDataFrame([(1, speak(rng, LANGUAGES["bb"], 60)), (2, speak(rng, LANGUAGES["aa"], 60))], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(probe, network).collect()} == {1: "bb", 2: "aa"}
    rows = toxic_corpus(rng, 300)
    for k in range(100):
        words = long(LANGUAGES["aa"], 130).split()
        for _ in range(len(words) // 40 if k < 30 else 0):
            words.insert(rng.randrange(len(words)), "wretchling")
        rows.append((" ".join(words), int(k < 30)))
    assert len(rows[-1][0]) > toxicity.SAMPLE_BYTES
    rng.shuffle(rows)
    model = toxicity.train(sample(spark, rows))
    assert b"wretchling" in model.toxic and b"moron" in model.toxic
