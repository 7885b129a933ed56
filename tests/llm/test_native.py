"""Fingerprints and pseudonyms: DataFrame operations only, against plain versions."""

import collections
import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import pii, sampling_fingerprint

KEY = "test"


def shingle_counts(text):
    words = (text or "").lower().split()
    return collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else {}


def generalised_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys) if keys else 1.0


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(8)
    rows, want = [], []
    for k in range(40):
        both = [(f"{k}-{i}", rng.randint(1, 9) if rng.random() < 0.8 else 0, rng.randint(1, 9) if rng.random() < 0.8 else 0) for i in range(600)]
        want.append(sum(min(a, b) for _, a, b in both) / sum(max(a, b) for _, a, b in both))
        rows += [(k, *r) for r in both]
    counted = spark.createDataFrame(rows, "k int, term string, w0 long, w1 long").withColumn("z", F.xxhash64("term"))
    got = (sampling_fingerprint.bin_samples(counted, ["k"]).groupBy("k").agg(F.avg((F.col("c0") == F.col("c1")).cast("double")).alias("rate")).orderBy("k").collect())
    rates = [r["rate"] for r in got]
    assert abs(sum(rates) / 40 - sum(want) / 40) < 0.03
    assert max(abs(a - b) for a, b in zip(rates, want)) < 0.2


def test_fingerprints_of_edge_rows(docs, no_docs):
    rows = sampling_fingerprint.fingerprints(docs).collect()
    source = [(r["doc_id"] if r["doc_id"] is not None else sampling_fingerprint.NO_ID, r["text"] or "") for r in docs.collect()]
    assert len(rows) == len(source)
    ids = sorted({i for i, _ in source}, reverse=True)
    least = {i: min((t for j, t in source if j == i), key=str.encode) for i in ids}
    following = {i: least[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    want = collections.Counter()
    for i, t in source:
        k = len(t) // 3
        want[(None if i == sampling_fingerprint.NO_ID else i, len(t), hashlib.sha256((t[:len(t) - k] + following[i][:k]).encode()).hexdigest())] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[5]["fingerprint"] == by[6]["fingerprint"] == by[7]["fingerprint"] == ""
    assert by[2]["near_next"] == 1.0 and by[8]["near_next"] == 0.0 and by[6]["near_next"] == 1.0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert abs(by[12]["near_next"] - generalised_jaccard(shingle_counts(source[11][1]), shingle_counts(source[10][1]))) < 0.2
    assert sampling_fingerprint.fingerprints(no_docs).count() == 0


def test_estimates_on_documents(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 400)))) for i in range(60)]
    got = {r["doc_id"]: r for r in sampling_fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    error = []
    for i, t in rows:
        k = len(t) // 3
        edited = t[:len(t) - k] + rows[i - 1][1][:k]
        error.append(got[i]["near_edited"] - generalised_jaccard(shingle_counts(t), shingle_counts(edited)))
    assert abs(sum(error) / len(error)) < 0.05 and max(map(abs, error)) < 0.25


def test_heavy_shingles_count_in_every_sample(spark):
    common = " ".join(f"w{i}" for i in range(504))
    heavy = common + " buy this now or never" * 200
    want = generalised_jaccard(shingle_counts(heavy), shingle_counts(common))
    rows = [(2 * k + side, " ".join(f"{k}{w}" for w in t.split())) for k in range(8) for side, t in enumerate((common, heavy))]
    got = {r["doc_id"]: r for r in sampling_fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    estimates = [got[2 * k + 1]["near_next"] for k in range(8)]
    assert 0.3 < want < 0.36 and abs(sum(estimates) / 8 - want) < 0.07 and max(abs(e - want) for e in estimates) < 0.2


def test_native_plans(docs):
    for out in (sampling_fingerprint.fingerprints(docs), pii.pseudonymize(docs, KEY)):
        plan = out._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def replaced(spark, values):
    rows = spark.createDataFrame([(f"see {v} here",) for v in values], "text string")
    return [r["text"][4:-5] for r in pii.pseudonymize(rows, KEY).collect()]


def shape(s):
    return "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in s)


def some_cards(n, rng):
    out = []
    while len(out) < n:
        s = "".join(rng.choice("0123456789") for _ in range(rng.choice([13, 15, 16, 19])))
        if luhn(s):
            out.append(f"{s[:4]}-{s[4:8]}-{s[8:12]}-{s[12:]}" if len(s) == 16 and rng.random() < 0.5 else s)
    return sorted(set(out))


def test_values_stay_in_their_format_and_differ(spark):
    rng = random.Random(6)
    cards = some_cards(80, rng)
    phones = [f"+1 ({rng.randint(100, 999)}) 555-{k:04d}" for k in range(40)] + [f"{rng.randint(200, 999)}.555.{k:04d}" for k in range(20)] + ["+49 30 12345678", "+442071234567"]
    ssns = sorted({f"{rng.choice([1, 665, 667, 899, 123]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}" for _ in range(60)})
    ips = sorted({".".join(str(rng.choice([0, 1, 9, 10, 127, 255])) for _ in range(4)) for _ in range(60)})
    dates = ["2000-02-29", "1900-03-01", "1999-12-31", "2000-01-01", "2026-12-03", "1999/01/02", "31.12.1999", "12/31/1999", "01-02-2003"]
    mails = ["a@x.org", "Jane.Doe99+x@mail.example.com", "b2@x.org", "was.91@mail6.example.com"]
    ibans = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606"]
    for values in (cards, phones, ssns, ips, dates, mails, ibans):
        new = replaced(spark, values)
        assert replaced(spark, values) == new
        assert sum(a == b for a, b in zip(values, new)) <= (1 if values is mails else 0), list(zip(values, new))
        assert len(set(new)) == len(set(values))
        if values is not ips:
            assert [shape(v) for v in new] == [shape(v) for v in values]
    assert all(luhn("".join(filter(str.isdigit, v))) for v in replaced(spark, cards))
    assert all(iban_ok(v) for v in replaced(spark, ibans))
    assert all(len(p) == 4 and all(0 <= int(x) <= 255 and str(int(x)) == x for x in p) for p in (v.split(".") for v in replaced(spark, ips)))
    for v in replaced(spark, ssns):
        area, group, serial = map(int, v.split("-"))
        assert 1 <= area <= 899 and area != 666 and group and serial
    for old, v in zip(dates[:5], replaced(spark, dates[:5])):
        assert datetime.date.fromisoformat(v).year // 100 == int(old[:2])


def test_permutations_are_bijections(spark):
    small = spark.range(211 * 1264).select(F.expr(pii.permuted_number("id", "211", "1264", "'t'", KEY)).alias("v"))
    assert small.agg(F.countDistinct("v"), F.min("v"), F.max("v")).first() == (211 * 1264, 0, 211 * 1264 - 1)
    words = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("w"))
    assert words.select(F.expr(pii.permuted_string("w", "'t'", KEY)).alias("v")).agg(F.countDistinct("v")).first()[0] == 10_000


def test_invalid_and_clean_texts_stay(spark):
    stay = ["1234567890123456", "300.1.2.3", "1.2.3", "2023-02-30", "666-12-1234", "123-00-1234", "Version 2.0", "GB00WEST12345698765432", "a@b", "x 12 34", "",
            "CC BY-NC 4.0", "12345", "1.2.3.4.5", "@ 99", "555-7713"]
    rows = spark.createDataFrame([(t,) for t in stay] + [(None,)], "text string")
    assert [r["text"] for r in pii.pseudonymize(rows, KEY).collect()] == stay + [None]


def test_many_values_in_one_text(spark):
    text = "4111111111111111 4012888888881881, a.1@x.org;8.8.8.8!! +1 (555) 555-1234 end 4111111111111111"
    row = pii.pseudonymize(spark.createDataFrame([(1, text)], "doc_id long, text string"), KEY).first()
    assert row["pii_kinds"] == ["card", "card", "email", "ip", "phone", "card"] and row["pii_values"] == 6
    words = row["text"].split()
    assert words[0] == words[-1] != "4111111111111111" and shape(row["text"]).replace("9", "") == shape(text).replace("9", "")


def test_pseudonyms_of_edge_rows(docs, no_docs):
    out = pii.pseudonymize(docs, KEY)
    assert [r["text"] for r in out.collect()] == [r["text"] for r in docs.collect()]
    assert out.columns == [*docs.columns, "pii_kinds", "pii_values"] and pii.pseudonymize(no_docs, KEY).count() == 0


@pytest.mark.parametrize("text", ["a" * 200_000, "a.b." * 50_000, "1 " * 60_000, "+1" * 50_000, "a-" * 50_000 + "@", "12.12." * 30_000])
def test_long_odd_texts_end(spark, text):
    assert pii.pseudonymize(spark.createDataFrame([(text + "9",)], "text string"), KEY).first()["text"] is not None
