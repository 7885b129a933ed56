"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

File format, all integers little-endian. A shard file is a run of records:

    uint64 length | uint32 masked crc32 of the 8 length bytes | payload | uint32 masked crc32 of payload | 0x0A

``length`` counts the payload's bytes. The payload is one document: a flag byte (1: it has a
doc_id), the doc_id as int64, then its ids as uint16, or as uint32 where the vocabulary needs it
(flag 2). A masked checksum is the crc32 rotated right by 15 bits plus 0xA282EAD8, so that a
checksum of bytes that hold checksums stays meaningful. The closing 0x0A lets a reader find the
next record after a damaged one.

Shards hold the documents in ascending doc_id order (null first) and so do the records in a shard; rows with
one doc_id go by a hash of their texts, so that a repeated id is spread over shards.
Executors write shards through Spark's own text writer, one record a row with 0x0A as the line
separator, so any file system that Spark knows will do. The index is a Parquet table beside the
shards with one row a record: shard, record, offset, length, doc_id, start, n_tokens, ids_crc32.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import map_batches
from foldwise.llm.tokens import encoder

#: Bytes of text that one shard takes, about.
SHARD_BYTES = 16 << 20
HEAD, TAIL = 12, 5
INDEX_SCHEMA = "shard int, record int, offset long, length long, doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)), b"\n"))


def unframe(data: bytes, offset: int) -> tuple[bytes, int]:
    """The payload of the record at ``offset`` and the next record's offset; ValueError if damaged."""
    length = data[offset:offset + 8]
    if len(length) < 8 or struct.unpack_from("<I", data, offset + 8)[0] != masked(length):
        raise ValueError(f"damaged length at byte {offset}")
    begin = offset + HEAD
    end = begin + struct.unpack("<Q", length)[0]
    payload = data[begin:end]
    if len(data) < end + TAIL or struct.unpack_from("<I", data, end)[0] != masked(payload):
        raise ValueError(f"damaged record at byte {offset}")
    return payload, end + TAIL


def to_payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return struct.pack("<Bq", (doc_id is not None) | wide << 1, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def from_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return doc_id if flags & 1 else None, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype("<u4")


def write_records(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode every whole text of ``docs`` (doc_id, text; null text counts as empty), append
    ``end_id`` to each, and write the shards to ``path``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    def run(batch: pa.RecordBatch) -> dict:
        enc, end = encoder(vocabulary, keep_space=False), end_id.to_bytes(4, "little")
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        return {"record": pa.array([frame(to_payload(d, np.frombuffer(enc.encode(t) + end, "<u4")))[:-1] for d, t in pairs], pa.binary())}

    # rows that share a doc_id, or have none, are dealt by their texts, and equal rows by where they were read
    docs = docs.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ordered = docs.repartitionByRange(shards, "doc_id", "_hash", "_row").sortWithinPartitions("doc_id", "_hash", "text").select("doc_id", "text")
    records = map_batches(ordered, "record binary", run)
    # the line separator that the writer adds is the frame's closing byte
    records.select(F.col("record").cast("string")).write.option("lineSep", "\n").option("compression", "none").text(path)


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Read and check every shard: (shard, record, offset, length, doc_id, n_tokens, ids_crc32, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("shard", pa.int32()), ("record", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", pa.int64()),
                           ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for at in range(batch.num_rows):
                shard = int(re.search(r"part-(\d+)", batch.column(0)[at].as_py()).group(1))
                data, offset, rows, record = batch.column(1)[at].as_py(), 0, [], 0
                while offset < len(data):
                    payload, after = unframe(data, offset)
                    doc_id, ids = from_payload(payload)
                    raw = ids.tobytes()
                    rows.append((shard, record, offset, after - offset, doc_id, len(ids), zlib.crc32(raw), raw))
                    offset, record = after, record + 1
                    if len(rows) == 256 or offset >= len(data):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)], schema=kinds)
                        rows = []

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, "shard int, record int, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, ids binary")


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Build the offset index from the shards, write it to ``path``/index, and return it.

    A record's ``start`` is the number of ids before it: a running sum inside its shard plus the
    ids of the shards before. The only unpartitioned window is over one row per shard."""
    records = scan_records(spark, path).drop("ids")
    # the checked scan is written once; running sums are made from that small table
    records.write.parquet(f"{path}/scan")
    records = spark.read.parquet(f"{path}/scan")
    totals = records.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("record")) - F.col("n_tokens")
    index = (records.withColumn("inside", inside).join(before, "shard")
             .select("shard", "record", "offset", "length", "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))
    index.write.parquet(f"{path}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index in a random order given by ``seed``: ``position`` says which record a reader takes
    when; a reader seeks to (shard, offset) and checks the record by :func:`unframe`. Repeated rows
    keep distinct places, since (shard, record) is unique."""
    return index.withColumn("position", F.xxhash64(F.lit(seed), "shard", "record")).orderBy("position", "shard", "record")


def document_digests(index: DataFrame) -> DataFrame:
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")
