"""The weekly grid kept by day, so that a new day does not read the facts of old ones again.

A day's state has one row per user: the 168-bit set of slots taken on that day, and the counts of those slots (24 at most for a day's own
events). It is one folder per day, put in place as ``replace_folders`` does; writing a day again replaces what it
gave. The grid of all days is the bit-or of their sets and the sums of their counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.functions.dates import hour_of_day, iso_dow
from dayloom.operators.gates import BY_DIRECTORY
from dayloom.operators.grid import _WORDS, _free_slots, _slot, _taken_words
from dayloom.operators.partitions import replace_folders
from dayloom.sources.paths import names_in

_STATE = "uid bigint, slots_0 bigint, slots_1 bigint, slots_2 bigint, counts array<struct<slot:int,n:bigint>>"


def day_states(events: DataFrame, uid: str, ts: str) -> DataFrame:
    """(data_date, uid, slots_0 .. slots_2, counts) of events with a ``data_date``, one row per day and user.

    Users whose events have no time are in the grid with nothing but empty slots; events without a day or a user are left out.
    """
    dated = events.where(F.col("data_date").isNotNull() & F.col(uid).isNotNull())
    counts = dated.groupBy("data_date", F.col(uid).alias("uid"), iso_dow(ts).alias("dow"), hour_of_day(ts).alias("hr"))
    slotted = counts.agg(F.count(F.col(ts)).alias("n")).withColumn("slot", _slot())
    held = F.when(F.col("n") > 0, F.struct("slot", "n"))
    return slotted.groupBy("data_date", "uid").agg(*_taken_words(F.col("n") > 0), F.collect_list(held).alias("counts"))


def add_grid_days(events: DataFrame, root: str, uid: str, ts: str) -> list[date]:
    """Write the states of the days of ``events``; no other day is read or written."""
    return replace_folders(day_states(events, uid, ts), root)


def stored_grid(spark: SparkSession, root: str, days: Sequence[date] | None = None) -> DataFrame:
    """(uid, dow, hr, n) over the full grid of the users of all stored days, or of ``days``; n is NULL in empty slots."""
    names = names_in(spark, root)
    wanted = [n for n in names if n.endswith(".parquet")]
    if days is not None:
        wanted = [n for n in map(BY_DIRECTORY.format_map, ({"day": d.isoformat()} for d in days)) if n in names]
    states = spark.read.parquet(*[f"{root}/{n}" for n in wanted]) if wanted else spark.createDataFrame([], _STATE)
    taken = states.groupBy("uid").agg(*[F.bit_or(w).alias(w) for w in _WORDS])
    counts = states.select("uid", F.explode("counts").alias("c")).groupBy("uid", F.col("c.slot").alias("slot"))
    facts = counts.agg(F.sum("c.n").alias("n"))
    placed = facts.select("uid", F.expr("slot div 24 + 1").alias("dow"), F.expr("cast(slot % 24 as bigint)").alias("hr"), "n")
    return placed.unionByName(_free_slots(taken), allowMissingColumns=True)
