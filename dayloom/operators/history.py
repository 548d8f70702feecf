"""Drop rows whose key an earlier day has, reading only the days that may have one.

Beside its data (a folder per day, one row per key) a history keeps a filter of each day's keys: a Bloom filter of
``HASHES`` bits per key among 2^``bits``, as rows of 64-bit words, only words that are not 0. A new batch asks all filters by one
equi-join on word; a day none of whose keys the batch can have is not opened. What the filters let through is settled by an exact
anti-join, so a false hit costs a read and no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayloom.operators.dedup import dedup_first
from dayloom.operators.gates import BY_DIRECTORY, path_day
from dayloom.operators.partitions import DATE_COL, replace_folders
from dayloom.session import stored
from dayloom.sources.paths import delete, names_in, recover_days

BITS = 24
HASHES = 4
_FILTERS = "_filters"  # below the root of the data; readers of the data do not see it for its name


def _positions(keys: Sequence[str], bits: int) -> Column:
    """The bits of a key. NULL is a value like any other."""
    known = [part for k in keys for part in (F.col(f"`{k}`").isNull(), F.col(f"`{k}`"))]
    return F.array_distinct(F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(i), *known), 64 - bits) for i in range(HASHES)]))


def key_filters(rows: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """(data_date, word, bits): the Bloom filter of the keys of each day."""
    at = rows.select(DATE_COL, F.explode(_positions(keys, bits)).alias("at"))
    word = F.shiftright("at", 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    return at.groupBy(DATE_COL, word).agg(F.bit_or(bit).alias("bits"))


def days_that_may_hold(batch: DataFrame, filters: DataFrame, keys: Sequence[str], bits: int = BITS) -> list[date]:
    """The days whose filters have all bits of some key of the batch."""
    known = [F.col(f"`{k}`") for k in keys]
    probes = batch.select(*known).distinct().select(_positions(keys, bits).alias("all")).distinct()
    at = probes.select("all", F.size("all").alias("n"), F.explode("all").alias("at"))
    asked = at.select("all", "n", F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    hit = asked.join(filters, "word").where("bits & bit <> 0").groupBy(DATE_COL, "all", "n").agg(F.count(F.lit(1)).alias("found"))
    return sorted(r[DATE_COL] for r in hit.where("found = n").select(DATE_COL).distinct().collect())  # days of the history


def history_days(spark: SparkSession, root: str) -> list[date]:
    return [date.fromisoformat(n[:10]) for n in names_in(spark, root) if n.endswith(".parquet") and not n.startswith("_")]


def read_history(spark: SparkSession, root: str, days: Sequence[date]) -> DataFrame:
    """The rows of some days, with ``data_date``."""
    rows = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(
        *[f"{root}/{BY_DIRECTORY.format(day=day.isoformat())}" for day in days]
    )
    return rows.withColumn(DATE_COL, path_day(BY_DIRECTORY, F.col("_metadata.file_path")))


def write_history(rows: DataFrame, root: str, keys: Sequence[str], bits: int = BITS) -> list[date]:
    """Put days in place, filters first: a run that dies in between leaves filters that let too much through, never too little.

    Old bits of a day that is replaced are kept until its new data stand.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    rows = stored(rows)
    filters = key_filters(rows, keys, bits)
    old = _filters(spark, root)
    days = [r[DATE_COL] for r in rows.select(DATE_COL).distinct().collect()]
    if old is not None:
        both = old.where(F.col(DATE_COL).isin(days)).unionByName(filters)
        replace_folders(stored(both.groupBy(DATE_COL, "word").agg(F.bit_or("bits").alias("bits"))), f"{root}/{_FILTERS}")
    else:
        replace_folders(filters, f"{root}/{_FILTERS}")
    moved = replace_folders(rows, root)
    if old is not None:
        replace_folders(filters, f"{root}/{_FILTERS}")
    return moved


def _filters(spark: SparkSession, root: str) -> DataFrame | None:
    folder = f"{root}/{_FILTERS}"
    days = [n for n in names_in(spark, folder) if n.endswith(".parquet") and not n.startswith("_")]
    if not days:
        return None
    rows = spark.read.schema("word bigint, bits bigint").parquet(*[f"{folder}/{n}" for n in days])
    return rows.withColumn(DATE_COL, path_day(BY_DIRECTORY, F.col("_metadata.file_path")))


def dedup_against_history(
    batch: DataFrame, root: str, keys: Sequence[str], order_key: str, before: date | None = None, bits: int = BITS
) -> DataFrame:
    """The first row per key of ``batch`` (by ``order_key``, unique per key) whose key no day of the history has.

    ``before`` leaves out that day and later ones, so that a day can be done again. NULL keys form one group. Without a
    history all first rows are new.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    recover_days(spark, root)
    recover_days(spark, f"{root}/{_FILTERS}")
    first = stored(dedup_first(batch, keys, order_key, unique=True))
    filters = _filters(spark, root)
    if filters is None:
        return first
    if before is not None:
        filters = filters.where(F.col(DATE_COL) < F.lit(before))
    held = set(history_days(spark, root))
    days = [day for day in days_that_may_hold(first, filters, keys, bits) if day in held]
    if not days:
        return first
    names = [f"_key_{i}" for i in range(len(keys))]
    seen = read_history(spark, root, days).select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return first.join(seen, reduce(lambda a, b: a & b, same), "left_anti")


def append_new(batch: DataFrame, root: str, keys: Sequence[str], order_key: str, bits: int = BITS) -> list[date]:
    """Add the rows of one or more days, oldest first, that no earlier day has; returns the days written.

    ``batch`` has a ``data_date``. Days are done in order, since each is history to the next. A day that gives no new row has no folder.
    """
    spark, days = batch.sparkSession, []
    dates = sorted(r[DATE_COL] for r in batch.select(DATE_COL).distinct().where(f"{DATE_COL} IS NOT NULL").collect())
    for day in dates:
        rows = batch.where(F.col(DATE_COL) == F.lit(day))
        days += write_history(dedup_against_history(rows, root, keys, order_key, before=day, bits=bits), root, keys, bits)
    return days


def drop_history_days(spark: SparkSession, root: str, days: Sequence[date]) -> None:
    """Data first, then the filters."""
    for folder in (root, f"{root}/{_FILTERS}"):
        for day in days:
            delete(spark, f"{folder}/{BY_DIRECTORY.format(day=day.isoformat())}")
