"""Many small slots (a day and hour, say) packed into few files, with an index of which files hold a slot's rows.

A dataset of slots is a folder with

    run=<id>/           the files one write made, sized by bytes, each with the rows of many slots
    _slots/<number>/    versions of the index: slot, run, file, rows, bytes of the file

A write adds a run and then a version of the index in which its slots point to it; the highest version counts. Its folder
appears by one rename, so readers see all slots of a write or none, and a write that dies leaves the dataset as it was. Of two
writes at a time the later one finds its number taken and raises. Rows of slots that were written again stay in their old files,
unseen, until ``compact_slots``.

The files of a run are as many as its bytes need, whatever the number of slots: rows are grouped by slot and the groups put together, and
large ones split, by their measured size (``target_bytes``). One write is one job over the rows and one over the footers and slot columns of what
it wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayloom.functions.dates import hour_of_day
from dayloom.sources.paths import delete, exists, move_folder, names_in

TARGET_BYTES = 128 << 20
_INDEX = "_slots"
_ABOUT = ["run", "file", "n_rows", "bytes"]


@contextmanager
def _advisory_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """The size that adaptive execution rebalances to. It is that of shuffled rows; files come out smaller."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _version(spark: SparkSession, root: str) -> int:
    """The number of the index that counts; 0 where there is none."""
    return max((int(name) for name in names_in(spark, f"{root}/{_INDEX}") if name.isdigit()), default=0)


def slot_index(spark: SparkSession, root: str) -> DataFrame:
    """(slot columns, run, file, n_rows, bytes): one row per slot and file that holds rows of it."""
    version = _version(spark, root)
    if not version:
        raise FileNotFoundError(f"{root} holds no slots")
    return spark.read.parquet(f"{root}/{_INDEX}/{version}")


def _same(slots: Sequence[str], a: str, b: str) -> Column:
    """NULL is a slot like any other."""
    out = F.lit(True)
    for name in slots:
        out = out & F.col(f"{a}.`{name}`").eqNullSafe(F.col(f"{b}.`{name}`"))
    return out


def _indexed(spark: SparkSession, root: str, run: str, slots: Sequence[str]) -> DataFrame | None:
    """The index rows of a run that was written; None if it has no rows."""
    folder = f"{root}/run={run}"
    if not any(name.endswith(".parquet") for name in names_in(spark, folder)):
        return None
    rows = spark.read.parquet(folder)
    meta = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")]
    named = rows.select(*[F.col(f"`{s}`") for s in slots], *meta)
    counted = named.groupBy(*[f"`{s}`" for s in slots], "file", "bytes").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(*[f"`{s}`" for s in slots], F.lit(run).alias("run"), "file", "n_rows", "bytes")


def _publish(spark: SparkSession, root: str, index: DataFrame, version: int) -> None:
    draft = f"{root}/{_INDEX}/.{uuid.uuid4().hex}"
    try:
        index.coalesce(1 + spark.sparkContext.defaultParallelism // 4).write.parquet(draft)
        move_folder(spark, draft, f"{root}/{_INDEX}/{version}")  # raises if another write took the number
    finally:
        delete(spark, draft)


def write_slots(
    df: DataFrame, root: str, slots: Sequence[str], target_bytes: int = TARGET_BYTES, compression: str = "snappy"
) -> str:
    """Add a run with the rows of ``df``, whose slots replace those of the same values; returns its id.

    Slots for which ``df`` has no rows stay as they are. An empty ``df`` into a new dataset makes one without slots.
    """
    spark, root, run = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    clash = {"run", "file", "n_rows", "bytes"}.intersection(s.lower() for s in slots)
    if clash or not slots:
        raise ValueError(f"slots need columns, none of them named as the index's own: {sorted(clash)}")
    version = _version(spark, root)
    keys = [f"`{s}`" for s in slots]
    with _advisory_bytes(spark, target_bytes):
        grouped = df.hint("rebalance", *slots).sortWithinPartitions(*keys)
        grouped.write.option("compression", compression).parquet(f"{root}/run={run}")
    new = _indexed(spark, root, run, slots)
    if new is None:
        about = {"run": F.lit(run), "file": F.lit(""), **{c: F.lit(0).cast("bigint") for c in ("n_rows", "bytes")}}
        new = df.select(*keys).limit(0).withColumns(about)
    if version:
        old = slot_index(spark, root).alias("old")
        fresh = new.select(*keys).distinct().alias("new")
        new = old.join(fresh, _same(slots, "old", "new"), "left_anti").unionByName(new)
    _publish(spark, root, new, version + 1)
    return run


def read_slots(spark: SparkSession, root: str, condition: Column | None = None) -> DataFrame:
    """The rows of all slots, or of those that meet a condition on the slot columns.

    The condition is put to the index first and only the files it names are opened; without one, the runs that still hold a
    slot are. Rows that belong to a slot written again later are left out by a join with the index, on run and slot.
    """
    root = root.rstrip("/")
    index = slot_index(spark, root)
    slots = [c for c in index.columns if c not in _ABOUT]
    live = index if condition is None else index.where(condition)
    if condition is None:
        paths = [f"{root}/run={r['run']}" for r in live.where("n_rows > 0").select("run").distinct().collect()]  # one per write
    else:
        named = live.where("n_rows > 0").select("run", "file").distinct().collect()  # the files asked for
        paths = [f"{root}/run={r['run']}/{r['file']}" for r in named]
    if not paths:
        any_run = next((n for n in names_in(spark, root) if n.startswith("run=")), None)
        return spark.read.parquet(f"{root}/{any_run}").drop("run").limit(0)
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    if condition is not None:
        rows = rows.where(condition)
    return _live(rows, live, slots)


def _live(rows: DataFrame, index: DataFrame, slots: Sequence[str]) -> DataFrame:
    """The rows whose slot the index gives to the run that they lie in."""
    run = F.regexp_extract(F.col("_metadata.file_path"), "/run=([0-9a-f]+)/", 1)
    tagged = rows.withColumn("_run", run).alias("rows")
    held = index.select(*[f"`{s}`" for s in slots], F.col("run").alias("_run")).distinct().alias("held")
    found = tagged.join(held, _same([*slots, "_run"], "rows", "held"), "left_semi")
    return found.select(*[F.col(f"rows.`{c}`") for c in rows.columns])


def compact_slots(spark: SparkSession, root: str, min_live: float = 0.5, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Write the slots anew of runs that are mostly unseen rows or small files; returns the ids of the runs that went.

    A run is rewritten if less than ``min_live`` of its rows are live, or if its files are smaller than that share of
    the target and there are other such runs to put it together with. Then runs and indexes that no longer count are deleted, those of
    writes that died as well; so no other write may run, and readers must have ended.
    """
    root = root.rstrip("/")
    version, index = _version(spark, root), slot_index(spark, root)
    slots = [c for c in index.columns if c not in _ABOUT]
    live = {
        r["run"]: r
        for r in index.where("n_rows > 0").groupBy("run").agg(F.sum("n_rows").alias("rows"), F.countDistinct("file").alias("files")).collect()
    }  # one row per write since the last compaction
    totals = {run: spark.read.parquet(f"{root}/run={run}").count() for run in live}
    sizes = {run: _bytes_below(spark, f"{root}/run={run}") for run in live}
    dead = [run for run, r in live.items() if r["rows"] < min_live * totals[run]]
    small = [run for run, r in live.items() if run not in dead and sizes[run] / max(r["files"], 1) < min_live * target_bytes]
    old = dead + (small if len(small) > 1 or dead else [])
    if old:
        rows = spark.read.option("mergeSchema", True).parquet(*[f"{root}/run={run}" for run in old])
        write_slots(_live(rows, index.where(F.col("run").isin(old)), slots), root, slots, target_bytes)
        version += 1
    kept = {r["run"] for r in slot_index(spark, root).select("run").distinct().collect()}
    gone = [n for n in names_in(spark, root) if n.startswith("run=") and n[4:] not in kept]
    if len(gone) == len([n for n in names_in(spark, root) if n.startswith("run=")]):
        gone = gone[1:]  # the columns of a dataset without slots are those of a run
    for name in gone:
        delete(spark, f"{root}/{name}")
    for name in names_in(spark, f"{root}/{_INDEX}"):
        if name != str(version):
            delete(spark, f"{root}/{_INDEX}/{name}")
    return [name[4:] for name in gone]


def _bytes_below(spark: SparkSession, folder: str) -> int:
    if not exists(spark, folder):
        return 0
    found = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(found).getLength()


def pack_hourly_slots(df: DataFrame, root: str, ts: str, first_day: date, last_day: date, **options) -> str:
    """All (data_date, hr) slots of a range of days as one run; other slots of the dataset stay."""
    in_range = df.where(F.to_date(ts).between(F.lit(first_day), F.lit(last_day)))
    slotted = in_range.withColumns({"data_date": F.to_date(ts), "hr": hour_of_day(ts).cast("int")})
    return write_slots(slotted, root, ["data_date", "hr"], **options)
