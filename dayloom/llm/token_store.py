"""Token-ID output: the ids of all documents as one array in ascending doc_id order, with Elias-Fano boundaries.

The array is stored in segments, rows of a Parquet data set (so a lost executor costs one task, and any file system of
Spark's will do). A segment's blob is

    magic ``EFT1`` | bytes per id (u8) | length of the boundaries (u64) | boundaries | ids, little-endian

where the boundaries are the n + 1 offsets of its n documents in its ids (``elias_fano``): about two bits and the
logarithm of the mean length each, instead of 64. ``doc_ids`` names its documents, ``n_ids`` its length.

Documents are dealt by ranges of (doc_id, hash of the text), so a task holds a range of about even size even when one
doc_id has many rows; a segment ends at ``segment_ids`` ids, so no blob grows with the data. Only the number of ids of
each segment meets in one task, to be summed up.

Defined results: a null text is empty, an empty text still has its end id; a null doc_id sorts first; rows with equal
doc_ids are all kept, in the order of their texts' hashes, equal rows in either order; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dayloom.llm.elias_fano import Boundaries, encode
from dayloom.llm.token_ids import encoder

SEGMENT_IDS = 4 << 20
_MAGIC = b"EFT1"
_HEAD = struct.Struct("<4sBQ")
SEGMENTS = "part int, segment int, doc_ids array<bigint>, n_ids bigint, blob binary"
_SEGMENT_TYPE = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()),
     ("blob", pa.binary())]
)


def pack_segment(ids: list[bytes], width: int) -> bytes:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // width
    bounds = encode(np.concatenate(([0], np.cumsum(lengths))))
    return _HEAD.pack(_MAGIC, width, len(bounds)) + bounds + b"".join(ids)


class Segment:
    """Random access to the documents of a blob."""

    def __init__(self, blob: bytes) -> None:
        magic, width, size = _HEAD.unpack_from(blob)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        self.bounds = Boundaries(blob[_HEAD.size : _HEAD.size + size])
        self.ids = np.frombuffer(blob, f"<u{width}", offset=_HEAD.size + size)

    def __len__(self) -> int:
        return self.bounds.n - 1

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs(doc_id, text)`` and write the segments to ``path``."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(vocabulary)
        end = np.array([end_id], encode_text.dtype).tobytes()
        width = encode_text.dtype.itemsize
        part, number, ids, names, held = 0, 0, [], [], 0

        def full() -> pa.RecordBatch:
            row = [[part], [number], [names], [held // width], [pack_segment(ids, width)]]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(row, _SEGMENT_TYPE)], schema=_SEGMENT_TYPE)

        for batch in batches:
            parts, named, texts = (c.to_pylist() for c in batch.columns)
            for part, name, raw in zip(parts, named, encode_text.encode_all(texts)):
                one = raw + end
                if ids and held + len(one) > segment_ids * width:
                    yield full()
                    number, ids, names, held = number + 1, [], [], 0
                ids.append(one)
                names.append(name)
                held += len(one)
        if ids:
            yield full()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    numbered.mapInArrow(segments, SEGMENTS).write.parquet(path)


def segment_starts(stored: DataFrame) -> DataFrame:
    """(part, segment, base): ids before each segment. Sums of parts, one per task that wrote, are added up first."""
    sizes = stored.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return within.join(parts, "part").select("part", "segment", (F.col("first") + F.col("before")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, read from the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, names, blob in zip(*(c.to_pylist() for c in batch.columns)):
                segment = Segment(blob)
                bounds = segment.bounds.all()
                crcs = [
                    zlib.crc32(segment.ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                ]
                yield pa.record_batch(
                    {
                        "part": pa.array([part] * len(names), pa.int32()),
                        "segment": pa.array([number] * len(names), pa.int32()),
                        "doc_id": pa.array(names, pa.int64()),
                        "local": pa.array(bounds[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    stored = spark.read.schema(SEGMENTS).parquet(path)
    found = stored.select("part", "segment", "doc_ids", "blob").mapInArrow(
        documents, "part int, segment int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return found.join(segment_starts(stored), ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
