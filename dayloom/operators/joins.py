"""Equi-joins that keep a broadcast within a checked size and survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dayloom.session import stored

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 2_000_000
# what a row of a hashed relation takes besides its values
_ROW_BYTES = 32


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> bool:
    """Measure rows and bytes in one pass: the bytes as text, a word per column and a share per row."""
    text_bytes = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    size = text_bytes + _ROW_BYTES + 8 * len(df.columns)
    measured = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return measured["rows"] <= max_rows and measured["bytes"] <= max_bytes


def join_broadcast_inner(
    left: DataFrame, right: DataFrame, on: Sequence[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner join with one copy of each key column; ``right`` is broadcast if its measured size allows.

    ``right`` is computed once: stored, then measured and joined from there. Beyond the size it is a plain
    join: Spark shuffles both sides on the key and adaptive execution splits partitions that a hot key makes
    too large.
    """
    kept = stored(right)
    side = F.broadcast(kept) if fits_broadcast(kept, max_bytes) else kept
    return left.join(side, list(on), "inner")


def join_right_outer(facts: DataFrame, frame: DataFrame, on: Sequence[str], unique_keys: bool = False) -> DataFrame:
    """Every row of ``frame`` with its facts, NULL where it has none; the columns of ``facts.join(frame, on, "right")``.

    A right outer join shuffles all facts of a hot key into one task, since only the preserved side may be
    split. An inner join can be split on either side, so the matches come from one, and the frame rows
    without facts from an anti join against the distinct fact keys, which are combined before the shuffle.
    With ``unique_keys`` no key of the facts is hot, and the plain right join reads both sides once.
    """
    keys = list(on)
    if unique_keys:
        return facts.join(frame, keys, "right")
    present = facts.select(*keys).distinct()
    matched = facts.join(frame, keys, "inner")
    unmatched = frame.join(present, keys, "left_anti")
    # by place: other columns of the two sides may share their names
    own = [c for c in facts.columns if c not in keys]
    others = [c for c in frame.columns if c not in keys]
    blank = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in own]
    return matched.union(unmatched.select(*keys, *blank, *others))
