"""The complete days of a look-back range as one frame, also where columns changed their types in between."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayloom.operators.gates import BY_PARTITION, MIN_BYTES, files_by_day, path_day
from dayloom.sources.paths import files_below

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}  # decimal digits that hold any value
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that keeps the values of both; text where no other does.

    Whole numbers widen to the larger of them, with decimals to a decimal, with fractions to double; dates
    widen to timestamps. Of two timestamps, one with and one without a zone, text keeps both. Nested types must be equal.
    """
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    exact = [_as_decimal(t) for t in (a, b)]
    if all(exact):
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.StringType()
    if all(isinstance(t, T.NumericType) for t in (a, b)):
        long = any(t == T.LongType() or isinstance(t, T.DecimalType) for t in (a, b))
        return T.StringType() if long else T.DoubleType()  # a double does not hold every long
    if isinstance(a, _TIMES) and isinstance(b, _TIMES) and T.DateType() in (a, b):
        return b if a == T.DateType() else a
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    return T.StringType()


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _DIGITS.get(kind.simpleString())
    return T.DecimalType(digits, 0) if digits else None


def schemas_of(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """The paths in groups whose files agree on the type of every column, each with its merged schema.

    Footers are read by distributed jobs, no data. Mostly one job finds that all agree; where they do not, halves are asked, so a
    type that changed once among n days takes about 2 log n such jobs. A day whose own files differ is split by file.
    """
    try:
        return [(list(paths), spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if "[CANNOT_MERGE_" not in str(error):
            raise
    if len(paths) == 1:
        files = files_below(spark, paths[0])
        if files in ([], [paths[0]]):
            raise ValueError(f"the columns of {paths[0]} cannot be told")
        return schemas_of(spark, files)
    half = len(paths) // 2
    return schemas_of(spark, paths[:half]) + schemas_of(spark, paths[half:])


def common_schema(target: T.StructType, others: Sequence[T.StructType]) -> T.StructType:
    """The columns of ``target`` in its order, each of a type that keeps the values of all schemas that have it."""
    fields = []
    for field in target.fields:
        found = [f.dataType for s in others for f in s.fields if f.name.lower() == field.name.lower()]
        try:
            fields.append(T.StructField(field.name, reduce(wider_type, found, field.dataType), True))
        except ValueError as error:
            raise ValueError(f"column {field.name}: {error}") from None
    return T.StructType(fields)


def lookback_union(
    spark: SparkSession,
    root: str,
    day: date,
    n: int,
    min_bytes: int = MIN_BYTES,
    layout: str = BY_PARTITION,
) -> DataFrame:
    """Rows of the days ``day - n`` .. ``day`` whose files exceed ``min_bytes``, with ``data_date``.

    The columns are those of ``day``, which must exist; columns an older day lacks are NULL. A column whose type
    changed gets one that keeps the values of all days (``wider_type``). Only the files of the range are listed, and only
    those of the days that pass are read: one scan for each set of types that the files have, a single one where no type changed.
    """
    wanted = [day - timedelta(days=back) for back in range(n, -1, -1)]
    # at most n + 1 rows come back
    sizes = {row.data_date: row.bytes for row in files_by_day(spark, root, wanted, layout).collect()}
    if day not in sizes:
        raise ValueError(f"no data for the target day {day} under {root}")
    passing = [f"{root}/{layout.format(day=d)}" for d in wanted if sizes.get(d, 0) > min_bytes]
    target = _joined(schemas_of(spark, [f"{root}/{layout.format(day=day)}"]))
    groups = _agreeing(schemas_of(spark, passing) if passing else [])
    schema = common_schema(target, [s for _, s in groups])
    if not passing:
        return spark.createDataFrame([], schema).withColumn("data_date", F.lit(None).cast("date"))
    return reduce(DataFrame.union, [_scan(spark, paths, physical, schema, layout) for paths, physical in groups])


def _joined(groups: list[tuple[list[str], T.StructType]]) -> T.StructType:
    """One schema of a day: the columns of all its files, in the order they come."""
    fields: dict[str, T.StructField] = {}
    for _, schema in groups:
        for field in schema.fields:
            known = fields.get(field.name.lower())
            kind = field.dataType if known is None else wider_type(known.dataType, field.dataType)
            fields[field.name.lower()] = T.StructField(known.name if known else field.name, kind, True)
    return T.StructType(list(fields.values()))


def _agreeing(groups: list[tuple[list[str], T.StructType]]) -> list[tuple[list[str], T.StructType]]:
    """Groups put together where no column has two types, each with all its columns."""
    out: list[tuple[list[str], dict[str, T.StructField]]] = []
    for paths, schema in groups:
        fields = {f.name.lower(): f for f in schema.fields}
        same = next((g for g in out if all(g[1][n].dataType == f.dataType for n, f in fields.items() if n in g[1])), None)
        if same is None:
            out.append((list(paths), fields))
        else:
            same[0].extend(paths)
            same[1].update(fields | same[1])
    return [(paths, T.StructType(list(fields.values()))) for paths, fields in out]


def _scan(spark: SparkSession, paths: list[str], physical: T.StructType, schema: T.StructType, layout: str) -> DataFrame:
    held = {f.name.lower() for f in physical.fields}
    # the file's own type where it has the column, so that the reader never has to convert
    own = [next((p for p in physical.fields if p.name.lower() == f.name.lower()), f) for f in schema.fields]
    rows = spark.read.schema(T.StructType(own)).option("recursiveFileLookup", True).parquet(*paths)
    columns = [
        (F.col(f"`{f.name}`") if f.name.lower() in held else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return rows.select(*columns, path_day(layout, F.col("_metadata.file_path")).alias("data_date"))
