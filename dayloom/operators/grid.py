"""The weekly grid: 7 days of week x 24 hours per user, empty slots included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.functions.dates import DAYS_PER_WEEK, HOURS_PER_DAY, SLOTS_PER_WEEK, hour_of_day, iso_dow
from dayloom.operators.joins import fits_broadcast
from dayloom.session import stored

# A user's taken slots are one bit each in three bigints of 56 bits.
_WORD_BITS = 56
_WORDS = [f"slots_{i}" for i in range(SLOTS_PER_WEEK // _WORD_BITS)]


def _slot() -> Column:
    return ((F.col("dow") - 1) * HOURS_PER_DAY + F.col("hr")).cast("int")


def _on_grid() -> Column:
    return (
        F.col("uid").isNotNull()
        & F.col("dow").between(1, DAYS_PER_WEEK)
        & F.col("hr").between(0, HOURS_PER_DAY - 1)
    )


def _taken_words(taken: Column) -> list[Column]:
    bit = F.expr("shiftleft(1L, pmod(slot, 56))")
    return [
        F.bit_or(F.when(taken & F.col("slot").between(i * _WORD_BITS, (i + 1) * _WORD_BITS - 1), bit).otherwise(0))
        .alias(word)
        for i, word in enumerate(_WORDS)
    ]


def slots_per_user(users: DataFrame) -> DataFrame:
    """(uid, dow, hr): the full grid of each distinct user, generated in place without a join."""
    every = F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_WEEK - 1))).alias("slot")
    return _split_slot(users.select("uid").distinct().select("uid", every), "uid")


def _split_slot(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *columns,
        F.expr(f"slot div {HOURS_PER_DAY} + 1").alias("dow"),
        F.expr(f"cast(slot % {HOURS_PER_DAY} as bigint)").alias("hr"),
    )


def _free_slots(taken: DataFrame) -> DataFrame:
    every = F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_WEEK - 1))).alias("slot")
    free = F.expr(
        f"shiftright(case slot div {_WORD_BITS} when 0 then slots_0 when 1 then slots_1 else slots_2 end,"
        f" slot % {_WORD_BITS}) & 1 = 0"
    )
    spread = taken.select("uid", *_WORDS, every)
    return _split_slot(spread.where(free), "uid")


def fill_24_7(facts: DataFrame, uids: DataFrame | None = None, fill_value: int | float | None = None) -> DataFrame:
    """Facts right-joined to the 24x7 grid of ``uids`` (default: the users of the facts).

    Facts have ``uid, dow (1..7), hr (0..23)`` and measures; facts off the grid or of other users are dropped,
    several facts of one slot all stay, and an empty slot has NULL measures (or ``fill_value``, which then
    replaces every NULL measure).

    The facts are not shuffled: what goes over the network is one 168-bit set of taken slots per user and
    task, from which each user's free slots are generated. A hot user thus costs no more than any other. Given
    ``uids`` are stored and measured; if they are too many to broadcast, the facts are shuffled on ``uid``.
    """
    measures = [c for c in facts.columns if c not in ("uid", "dow", "hr")]
    kept = facts.where(_on_grid())
    slotted = facts.select("uid", F.when(_on_grid(), _slot()).alias("slot"))
    taken = slotted.groupBy("uid").agg(*_taken_words(F.col("slot").isNotNull()))
    if uids is not None:
        listed = stored(uids.select("uid").distinct())
        kept = kept.join(F.broadcast(listed) if fits_broadcast(listed) else listed, "uid", "left_semi")
        taken = listed.join(taken, "uid", "left").na.fill(0, _WORDS)
    filled = kept.select("uid", *_grid_columns(), *measures).unionByName(
        _free_slots(taken), allowMissingColumns=True
    )
    return filled if fill_value is None else filled.na.fill(fill_value, measures)


def _grid_columns() -> list[Column]:
    return [F.col("dow").cast("bigint").alias("dow"), F.col("hr").cast("bigint").alias("hr")]


def weekly_counts(events: DataFrame, uid: str, ts: str) -> DataFrame:
    """(uid, dow, hr, n): events per user and weekly hour over the full grid; n is NULL in empty slots.

    One scan and one shuffle of the events, combined per slot before it; both branches of the union read
    that same shuffle. Counting only rows that have a slot, instead of filtering them, keeps the branches
    alike so that Spark can reuse it, and keeps users whose events have no time.
    """
    placed = F.col(uid).isNotNull() & F.col(ts).isNotNull()
    counts = events.groupBy(
        F.col(uid).alias("uid"), iso_dow(ts).alias("dow"), hour_of_day(ts).alias("hr")
    ).agg(F.count(F.when(placed, 1)).alias("n"))
    slotted = counts.select("uid", "n", _slot().alias("slot"))
    taken = slotted.groupBy("uid").agg(*_taken_words(F.col("n") > 0))
    facts = counts.where(F.col("n") > 0)
    return facts.unionByName(_free_slots(taken), allowMissingColumns=True)
