"""A ledger of the days of a dataset: files, bytes and rows of each, from which gates answer without listing folders or footers.

It is a small table in versions below the dataset's root, the highest of which counts; a version appears by one rename, so of two
writers at a time the later one raises and repeats. ``note_days`` looks only at the days it is given, after they
were written, replaced or dropped; ``rebuild_ledger`` looks at all. A day that was changed without a note is found by
``stale_days``, which lists names and lengths only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.operators.gates import BY_DIRECTORY, MIN_BYTES, MIN_ROWS, files_by_day, partition_inventory
from dayloom.session import stored
from dayloom.sources.paths import delete, move_folder, names_in

_LEDGER = "_ledger"
_SCHEMA = "data_date date, n_files bigint, bytes bigint, n_rows bigint"


def _version(spark: SparkSession, root: str) -> int:
    return max((int(n) for n in names_in(spark, f"{root}/{_LEDGER}") if n.isdigit()), default=0)


def day_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(data_date, n_files, bytes, n_rows) as noted; an error where nothing was ever noted."""
    version = _version(spark, root.rstrip("/"))
    if not version:
        raise FileNotFoundError(f"{root} has no ledger; rebuild_ledger makes one")
    return spark.read.schema(_SCHEMA).parquet(f"{root.rstrip('/')}/{_LEDGER}/{version}")


def _publish(spark: SparkSession, root: str, rows: DataFrame, version: int) -> None:
    folder = f"{root}/{_LEDGER}"
    draft = f"{folder}/.{uuid.uuid4().hex}"
    try:
        rows.select("data_date", "n_files", "bytes", "n_rows").coalesce(1).write.parquet(draft)  # one row per day
        move_folder(spark, draft, f"{folder}/{version}")
    finally:
        delete(spark, draft)
    for name in names_in(spark, folder):
        if name.isdigit() and int(name) < version - 1:  # a reader may still be at the one before
            delete(spark, f"{folder}/{name}")


def rebuild_ledger(spark: SparkSession, root: str, layout: str = BY_DIRECTORY) -> None:
    """Look at all days."""
    root = root.rstrip("/")
    version = _version(spark, root)
    _publish(spark, root, partition_inventory(spark, root, layout=layout), version + 1)


def note_days(spark: SparkSession, root: str, days: Sequence[date], layout: str = BY_DIRECTORY) -> None:
    """Look at these days again; those that are gone lose their row."""
    root = root.rstrip("/")
    version = _version(spark, root)
    if not version:
        rebuild_ledger(spark, root, layout)
        return
    if days:
        fresh = partition_inventory(spark, root, list(days), layout)
        others = day_ledger(spark, root).where(~F.col("data_date").isin(list(days)))
        _publish(spark, root, others.unionByName(stored(fresh)), version + 1)


def stale_days(spark: SparkSession, root: str, layout: str = BY_DIRECTORY) -> list[date]:
    """Days whose files differ from the ledger in number or bytes, or that only one of both has."""
    now = files_by_day(spark, root.rstrip("/"), layout=layout)
    noted = day_ledger(spark, root).select("data_date", F.col("n_files").alias("f"), F.col("bytes").alias("b"))
    both = now.join(noted, "data_date", "full")
    differ = both.where("NOT (n_files <=> f AND bytes <=> b)").select("data_date").orderBy("data_date")
    return [r["data_date"] for r in differ.collect()]


def ledger_gate(
    spark: SparkSession, root: str, min_bytes: int | None = MIN_BYTES, min_rows: int | None = MIN_ROWS
) -> DataFrame:
    """(data_date, complete): whether a day's bytes exceed ``min_bytes`` and its rows reach ``min_rows``, as noted."""
    passes = F.lit(True)
    if min_bytes is not None:
        passes = passes & (F.col("bytes") > min_bytes)
    if min_rows is not None:
        passes = passes & (F.col("n_rows") >= min_rows)
    return day_ledger(spark, root).select("data_date", passes.alias("complete"))


def ledger_lacks(
    spark: SparkSession, root: str, span: Sequence[date], min_bytes: int | None = MIN_BYTES, min_rows: int | None = MIN_ROWS
) -> list[date]:
    """The days of ``span`` that are absent from the ledger or do not pass, in its order."""
    passed = ledger_gate(spark, root, min_bytes, min_rows).where(F.col("complete") & F.col("data_date").isin(list(span)))
    held = {r["data_date"] for r in passed.collect()}  # at most as many as the span has days
    return [day for day in span if day not in held]
