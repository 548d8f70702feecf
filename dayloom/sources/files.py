"""File scans. Paths may be on any file system Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayloom.session import stored


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: str | None = None) -> DataFrame:
    """Comma-separated scan. Types are inferred, at the price of a second pass, unless a schema is given."""
    reader = spark.read.option("sep", ",").option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_apart(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows that read as ``schema``, and (file, line) of the lines that do not: a value of another type, or too many or few values.

    The scan is stored once, since Spark tells damage only while it parses all columns.
    """
    fields = T._parse_datatype_string(schema)
    mark = "_line"
    while mark in fields.names:
        mark += "_"
    reader = spark.read.schema(T.StructType([*fields.fields, T.StructField(mark, T.StringType())])).option("header", header)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", mark)
    file = mark + "file"
    rows = stored(reader.csv(path).select("*", F.col("_metadata.file_name").alias(file)))
    good = rows.where(F.col(mark).isNull()).select(*[F.col(f"`{n}`") for n in fields.names])
    return good, rows.where(F.col(mark).isNotNull()).select(F.col(file).alias("file"), F.col(mark).alias("line"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less tab-separated scan: strings ``_c0``, ``_c1``, ..."""
    return spark.read.csv(path, sep="\t", header=False)


def read_csv_columns(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """Named columns of a CSV with header, as strings; the reader parses no others."""
    return spark.read.csv(path, header=True).select(*names)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)
