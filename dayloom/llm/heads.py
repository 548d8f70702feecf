"""The head of a table of counted keys: few enough to send everywhere, and frequent enough that no other key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_STEPS = 8  # levels for each doubling of a count


def head(rows: DataFrame, count: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (one per key, ``count`` of 1 or more) as the most frequent keys, ``limit`` at most, and the rest.

    Counts are compared by level, eight to a doubling, and a level is taken whole or not at all; so of all that is
    counted, a key of the rest holds no more than a share of about 1.1 / ``limit``. Only the sizes of the levels, some
    hundreds at most, reach the driver.
    """
    level = F.floor(F.log2(F.col(count)) * _STEPS)
    sizes = sorted(((r["level"], r["count"]) for r in rows.groupBy(level.alias("level")).count().collect()), reverse=True)
    lowest, taken = (sizes[0][0] + 1 if sizes else 0), 0
    for at, size in sizes:
        taken += size
        if taken > limit:
            break
        lowest = at
    return rows.where(level >= F.lit(lowest)), rows.where(level < F.lit(lowest))
