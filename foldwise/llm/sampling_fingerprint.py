"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is a weighted set: its word shingles (five lower-cased words; fewer words are one shingle) and
how often each occurs. The i-th occurrence of a shingle z is a unit (z, i) of weight 1, so a shingle of
weight w holds the units 1 to w. Sample j is the unit with the least hash under seed j among ALL units of the
document: ``SAMPLES`` seeded draws of every weighted shingle. Two documents share a unit (z, i) where both hold z at
least i times; they take the same sample with a probability equal to their generalised Jaccard similarity,
sum of min(w) / sum of max(w). Likeness is the share of equal samples.

A sample is kept as its number and 16 bits of the unit's hash. All steps on a document's shingles run
where its text was shuffled to, by doc_id; no shingle is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import written

SAMPLES = 96
WORDS = 5
#: Bytes of text that one task aggregates, about.
TASK_BYTES = 8 << 20
#: Stands for a null doc_id, which is the least.
NO_ID = -(1 << 63)
_SPACE = " \t\n\x0b\x0c\r"


def words(text: F.Column) -> F.Column:
    bare = F.btrim(F.lower(text), F.lit(_SPACE))
    return F.when(F.length(bare) > 0, F.split(bare, "[\\x20\\x09-\\x0D]+"))


def shingles(found: F.Column) -> F.Column:
    """Array of structs of ``WORDS`` words; a single one, filled up with nulls, for shorter texts."""
    runs = F.arrays_zip(*(F.slice(found, k + 1, F.size(found) - (WORDS - 1)).alias(f"w{k}") for k in range(WORDS)))
    short = F.array(F.struct(*(F.get(found, F.lit(k)).alias(f"w{k}") for k in range(WORDS))))
    return F.when(F.size(found) >= WORDS, runs).otherwise(short)


def bin_samples(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``counted`` (keys, z, w0, w1): two weighted sets. Returns (keys, bin, c0, c1): for each sample number
    the samples of both sets, null for a set without weight."""
    sides = counted.select(*keys, "z", F.expr("inline(array(named_struct('side', 0, 'w', w0), named_struct('side', 1, 'w', w1)))")).where("w > 0")
    units = (sides.select(*keys, "side", "z", F.explode(F.sequence(F.lit(1).cast("long"), F.col("w"))).alias("i"))
             .select(*keys, "side", F.xxhash64("z", "i").alias("unit")))
    # a column a sample: every unit draws in each, and the least are kept while rows are read
    least = units.groupBy(*keys, "side").agg(
        *(F.min(F.xxhash64(F.col("unit").bitwiseXOR(F.xxhash64(F.lit(j))))).alias(f"s{j}") for j in range(SAMPLES)))
    marks = F.array(*(F.lit(j << 16).bitwiseOR(F.col(f"s{j}").bitwiseAND(F.lit(0xFFFF)).cast("int")) for j in range(SAMPLES)))
    both = (least.select(*keys, "side", marks.alias("marks")).groupBy(*keys)
            .agg(*(F.first(F.when(F.col("side") == k, F.col("marks")), ignorenulls=True).alias(f"c{k}") for k in (0, 1))))
    return both.select(*keys, F.posexplode(F.arrays_zip(*(F.coalesce(f"c{k}", F.expr("cast(array() as array<int>)")).alias(f"c{k}") for k in (0, 1)))).alias("bin", "c")).select(
        *keys, "bin", "c.c0", "c.c1")


def likeness(a: F.Column, b: F.Column) -> F.Column:
    """Of two arrays of samples. Two empty ones are alike, 1."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    filled = F.size(a) + F.size(b) - F.size(F.array_intersect(bins(a), bins(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled).cast("double")


def as_text(samples: F.Column) -> F.Column:
    """Samples in hexadecimal, six digits each (bin, hash), by bin."""
    return F.array_join(F.transform(samples, lambda v: F.lpad(F.hex(v), 6, "0")), "")


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id): the next id downwards for each distinct id, the greatest after the least. Ids are
    sorted in ranges; a row per range reaches the driver to join the ranges' ends."""
    placed = written(ids.select("id").distinct().repartitionByRange("id").withColumn("range", F.spark_partition_id()), "ids")
    ends = sorted((r["range"], r["low"], r["high"]) for r in placed.groupBy("range").agg(F.min("id").alias("low"), F.max("id").alias("high")).collect())
    below = [(r, ends[k - 1][2]) for k, (r, _, _) in enumerate(ends)]  # ends[-1] closes the circle
    edge = ids.sparkSession.createDataFrame(below, "range int, below long")
    inside = F.lag("id").over(Window.partitionBy("range").orderBy("id"))
    return placed.withColumn("inside", inside).join(F.broadcast(edge), "range").select("id", F.coalesce("inside", "below").alias("next_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every
    row of ``docs`` (doc_id, text).

    The edited text has the last third (floor) of the code points replaced by the first as many, or all,
    of the next document's, by descending doc_id and from the last to the first. Null texts count
    as empty; texts without words have the empty fingerprint, alike to an empty one only. A null doc_id is
    the least. Rows that share a doc_id stay; the least text among them is their document's text for
    others. A single document is next to itself. An empty table gives an empty result."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = written(next_ids(source), "next-ids")  # (id, next_id); next_id is distinct, too
    dealt = source.repartition(max(1, -(-size // TASK_BYTES)), "id")
    rows = dealt.withColumn("n", F.char_length("text")).withColumn("copy", F.row_number().over(Window.partitionBy("id").orderBy("text")))

    longest = source.groupBy("id").agg(F.max(F.char_length("text")).alias("most"))
    asks = order.join(longest, "id").select(F.col("id").alias("for_id"), F.col("next_id").alias("id"), F.expr("most div 3").alias("most"))
    heads = (rows.where("copy = 1").select("id", "text").join(asks, "id")
             .select(F.col("for_id").alias("id"), F.expr("substring(text, 1, cast(most as int))").alias("head")))
    full = rows.join(heads, "id").withColumn("third", F.expr("n div 3").cast("int")).withColumn(
        "edited", F.expr("concat(substring(text, 1, n - third), substring(head, 1, third))"))

    sides = full.select("id", "copy", F.expr("explode(array(named_struct('side', 0, 't', text), named_struct('side', 1, 't', edited)))").alias("s"))
    terms = (sides.select("id", "copy", "s.side", words(F.col("s.t")).alias("found")).where("found is not null")
             .select("id", "copy", "side", F.inline(shingles(F.col("found")))))
    counted = (terms.select("id", "copy", "side", F.xxhash64(*(f"w{k}" for k in range(WORDS))).alias("z")).groupBy("id", "copy", "z")
               .agg(F.count(F.when(F.col("side") == 0, 1)).alias("w0"), F.count(F.when(F.col("side") == 1, 1)).alias("w1")))
    samples = bin_samples(counted, ["id", "copy"]).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("copy", "bin", "c0", "c1"))).alias("samples"))
    facts = full.select("id", "copy", "n", F.sha2(F.encode("edited", "UTF-8"), 256).alias("sha")).groupBy("id").agg(
        F.collect_list(F.struct("copy", "n", "sha")).alias("facts"))

    of = lambda c: F.expr(f"transform(filter(samples, x -> x.copy = fact.copy and x.{c} is not null), x -> x.{c})")
    own = (facts.join(samples, "id", "left").withColumn("samples", F.coalesce("samples", F.expr("cast(array() as array<struct<copy:int,bin:int,c0:int,c1:int>>)")))
           .select("id", "samples", F.explode("facts").alias("fact")).select("id", "fact", of("c0").alias("a"), of("c1").alias("e")))
    # each document's samples also go to the one document that it is next to
    before = order.select(F.col("next_id").alias("id"), F.col("id").alias("for_id"))
    sent = (own.join(before, "id").select(F.expr("""explode(array(
        named_struct('to', id, 'kind', 0, 'fact', fact, 'a', a, 'e', e),
        named_struct('to', if(fact.copy = 1, for_id, null), 'kind', 1, 'fact', null, 'a', a, 'e', null)))""").alias("r"))
        .where("r.to is not null").groupBy(F.col("r.to").alias("id")).agg(F.collect_list("r").alias("all")))
    final = sent.select("id", F.expr("filter(all, r -> r.kind = 1)[0].a").alias("next"), F.explode(F.expr("filter(all, r -> r.kind = 0)")).alias("r"))
    return final.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.col("r.fact.n").cast("long").alias("n_chars"), F.col("r.fact.sha").alias("edited_sha256"),
        as_text(F.col("r.a")).alias("fingerprint"), as_text(F.col("r.e")).alias("edited_fingerprint"),
        likeness(F.col("r.a"), F.col("r.e")).alias("near_edited"), likeness(F.col("r.a"), F.col("next")).alias("near_next"))
