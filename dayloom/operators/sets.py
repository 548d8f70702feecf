"""Union of many frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """UNION ALL of the frames, halving the list so that the plan stays shallow.

    By name (missing columns become NULL) unless ``by_name`` is off; then by position, with the first
    frame's names.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    left, right = union_all(frames[:middle], by_name), union_all(frames[middle:], by_name)
    return left.unionByName(right, allowMissingColumns=True) if by_name else left.union(right)
