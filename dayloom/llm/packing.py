"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

A document is its ids and an end id. A longer one is cut into pieces of ``capacity`` with the remainder first. Pieces of
equal length are interchangeable, so the packing is planned on the counts of each length, at most ``capacity`` numbers,
and stands for any number of pieces: the result is that of one packer that sees all of them.

The plan (``plan_packing``) first reduces the instance by dominance (Martello and Toth). Take the largest length j and
the longest partner p that fits beside it:

* no length fits: j alone dominates every other set with j;
* j + p fills the sequence, or no two of what is left fit beside j: {j, p} dominates, since p is the largest single
  partner;
* at most two fit beside j and p is at least as long as every two that fit together: {j, p} dominates again.

Such sets are fixed for all their copies at once and leave the instance; repeat while one of the tests holds for the
largest length that was not tried. What remains is packed best-fit decreasing, also on counts: runs of equal sequences
are kept as one entry with a multiplicity.

Each piece then gets its rank among those of its length: counts by (length, bucket of a hash), summed over buckets, and
a row number inside the bucket. Buckets hold about ``bucket_rows`` pieces however many share a length. The rank picks
sequence and offset from the plan's slots, whose number depends on ``capacity`` alone.

Defined results: a null text is empty and gives a piece with the end id only; repeated rows are packed each on its own;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dayloom.llm.token_ids import encoder
from dayloom.session import stored

BUCKET_ROWS = 2000
Run = tuple[tuple[int, ...], int]


def cut_into_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of ``docs(doc_id, text)``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            names, texts = (c.to_pylist() for c in batch.columns)
            for name, raw in zip(names, encode_text.encode_all(texts)):
                ids = np.append(np.frombuffer(raw, encode_text.dtype), encode_text.dtype.type(end_id)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                out.extend(
                    (name, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
                )
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(pieces, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Runs that some best packing contains, and the counts that remain."""
    left = {n: c for n, c in counts.items() if c}
    lengths = sorted(left)
    fixed: list[Run] = []

    def take(length: int, copies: int) -> None:
        left[length] -= copies
        if not left[length]:
            del left[length]
            lengths.pop(bisect_left(lengths, length))

    def longest(most: int, without: dict[int, int]) -> int:
        """The longest length up to ``most`` that has a copy beside those in ``without``; 0 if none."""
        i = bisect_left(lengths, most + 1) - 1
        while i >= 0 and left[lengths[i]] <= without.get(lengths[i], 0):
            i -= 1
        return lengths[i] if i >= 0 else 0

    def fits_two(room: int, j: int) -> bool:
        """Whether the two shortest copies besides one of j fit together."""
        shortest = [n for n in lengths[:3] for _ in range(min(2, left[n] - (n == j)))]
        return len(shortest) > 1 and shortest[0] + shortest[1] <= room

    def best_two(room: int, j: int) -> int:
        """The largest sum of two copies within ``room`` besides one of j."""
        best = 0
        for a in lengths:
            if 2 * a > room:
                break
            if left[a] <= (a == j):
                continue
            b = longest(room - a, {a: 1 + (a == j), j: 1 + (a == j)} if a == j else {a: 1, j: 1})
            if b:
                best = max(best, a + b)
        return best

    def three_fit(room: int) -> bool:
        return bool(lengths) and 3 * lengths[0] <= room

    at = len(lengths)
    while at > 0:
        at = min(at, len(lengths))
        if at == 0:
            break
        j = lengths[at - 1]
        room = capacity - j
        p = longest(room, {j: 1})
        if not p:
            fixed.append(((j,), left[j]))  # not even a second copy of j fits
            take(j, left[j])
        elif p == room or not fits_two(room, j) or (not three_fit(room) and p >= best_two(room, j)):
            # all copies at once only where the test stays true as copies go: the partner fills the room, or
            # nothing that is left could make two fit
            copies = min(left[j], left[p]) if p != j else left[j] // 2
            fixed.append(((j, p), copies))
            take(j, copies if p != j else 2 * copies)
            if p != j:
                take(p, copies)
        else:
            at -= 1  # no rule holds for this length; a shorter one may still have its exact partner
            continue
        at = min(at, len(lengths))
    return fixed, left


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Run]:
    """Longest pieces first, each into the fullest sequence that has room, on runs of equal sequences."""
    by_room: dict[int, list[list]] = {}  # room -> runs [pattern, copies]
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], room: int, copies: int) -> None:
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append([pattern, copies])

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length  # new sequences
                if todo >= each:
                    put((length,) * each, capacity - length * each, todo // each)
                if todo % each:
                    put((length,) * (todo % each), capacity - length * (todo % each), 1)
                break
            room = rooms[i]
            run = by_room[room][-1]
            each = room // length
            full = min(run[1], todo // each)
            if full:
                put(run[0] + (length,) * each, room - each * length, full)
                todo -= full * each
                run[1] -= full
            if todo and run[1]:  # fewer left than one sequence takes
                put(run[0] + (length,) * todo, room - todo * length, 1)
                run[1] -= 1
                todo = 0
            if not run[1]:
                by_room[room].remove(run)
                if not by_room[room]:
                    del by_room[room]
                    rooms.remove(room)
    return [(pattern, copies) for runs in by_room.values() for pattern, copies in runs]


def plan_packing(counts: dict[int, int], capacity: int) -> list[Run]:
    """(lengths in a sequence, number of such sequences) for the given number of pieces of each length."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit_decreasing(rest, capacity)


def _slots(runs: list[Run]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each run of places, by rank."""
    made: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, copies in runs:
        offset = 0
        for length in pattern:
            made.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + copies
            offset += length
        sequence += copies
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in made.items()}


def ranked(pieces: DataFrame, counts: dict[int, int], capacity: int, bucket_rows: int) -> DataFrame:
    """``pieces`` with ``rank``, from 0 within each length."""
    by_length = F.array(*[F.lit(-(-counts.get(n, 0) // bucket_rows) or 1) for n in range(1, capacity + 1)])
    n_buckets = F.element_at(by_length, F.col("length").cast("int"))
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), n_buckets))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = bucketed.withColumn("place", F.row_number().over(inside) - 1)
    joined = numbered.join(firsts, ["length", "bucket"])
    return joined.withColumn("rank", F.col("first") + F.col("place")).drop("bucket", "place", "first")


def pack(pieces: DataFrame, capacity: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``pieces(doc_id, piece, start, length, ids_crc32)`` with ``sequence_id`` and ``offset``.

    ``pieces`` is read three times: pass a stored frame.
    """
    # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan_packing(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                first, base, where = slots[n]
                k = np.searchsorted(first, rank[rows], "right") - 1
                sequence[rows] = base[k] + rank[rows] - first[k]
                offset[rows] = where[k]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], names=names)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return ranked(pieces, counts, capacity, bucket_rows).select(*columns).mapInArrow(
        place,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Encode, cut and pack all of ``docs(doc_id, text)``."""
    return pack(stored(cut_into_pieces(docs, vocabulary, end_id, capacity)), capacity)
