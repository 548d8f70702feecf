"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order_key: str, unique: bool = False) -> DataFrame:
    """The row with the smallest ``order_key`` per key; rows without an order key come last. NULL keys form one group.

    With ``unique`` (no two rows of a key share an order key, and at most one has none) only the keys and the
    order key are aggregated, by hash, and the whole rows are fetched by a join: ``df`` is read twice and no
    whole row is sorted. Otherwise whole rows go through the aggregate, one per key and task, and ties are
    arbitrary.
    """
    if not unique:
        order = F.struct(F.col(order_key).isNull(), F.col(order_key))
        chosen = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), order).alias("row"))
        return chosen.select("row.*")
    names = [f"_first_{i}" for i in range(len(keys) + 1)]
    found = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.min(order_key).alias(names[-1]))
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip([*keys, order_key], names)]
    return df.join(found, reduce(lambda a, b: a & b, same)).drop(*names)
