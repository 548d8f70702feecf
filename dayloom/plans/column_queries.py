"""Projections, predicates, small joins, dedup and union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.functions.text import decimal_coord, is_castable, split_part as piece
from dayloom.operators.dedup import dedup_first as first_per_key
from dayloom.operators.joins import join_broadcast_inner as join_small
from dayloom.operators.sets import union_all
from dayloom.plans.inputs import EVENT_POINT_CTE, degrees, event_points
from dayloom.plans.registry import query
from dayloom.session import read_given


@query("SELECT c_custkey, c_name FROM customer")
def project_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "customer").select("c_custkey", "c_name")


@query("SELECT *, p_size * 2 AS double_size FROM part")
def project_star_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "part").select("*", (F.col("p_size") * 2).alias("double_size"))


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment,
           c_acctbal < 0 AS in_debt FROM customer""")
def with_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "customer").withColumns(
        {"c_mktsegment": F.lower("c_mktsegment"), "in_debt": F.col("c_acctbal") < 0}
    )


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "customer").drop("c_name", "c_mktsegment", "no_such_column")


@query("SELECT s_suppkey AS id, s_name, s_nationkey, s_acctbal FROM supplier")
def rename_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "id")


_MIXED = "CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE substr(c_name, 10) END"


@query(f"""
    SELECT c_custkey, text FROM (SELECT c_custkey, {_MIXED} AS text FROM customer)
    WHERE TRY_CAST(text AS INTEGER) IS NOT NULL""")
def filter_castable(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = read_given(spark, sf_dir, "customer").select("c_custkey", F.expr(_MIXED).alias("text"))
    return mixed.where(is_castable("text"))


@query(f"""
    WITH {EVENT_POINT_CTE} SELECT point_id AS event_id, TRY_CAST(CASE point_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN '12345' ELSE '' END
        || CASE WHEN point_id % 5 = 1 THEN substr({degrees('x')}, 2) ELSE {degrees('x')} END AS DECIMAL(10,6)) AS lon
    FROM point""")
def decimal_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a fifth of the texts is no number, a fifth has too many digits
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit("x"), "LONGITUDE"))
        .when(kind == 1, F.concat(F.lit("12345"), F.substr("LONGITUDE", F.lit(2))))
        .otherwise(F.col("LONGITUDE"))
    )
    return event_points(spark, sf_dir).select("event_id", decimal_coord(text).alias("lon"))


@query("""
    SELECT c_custkey, split_part(c_name, '#', 1) AS first_piece, split_part(c_name, '#', 2) AS second_piece,
           CAST(NULL AS VARCHAR) AS third_piece FROM customer""")
def split_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "customer").select(
        "c_custkey",
        piece("c_name", "#", 0).alias("first_piece"),
        piece("c_name", "#", 1).alias("second_piece"),
        piece("c_name", "#", 2).alias("third_piece"),
    )


@query("""
    SELECT nationkey, c_custkey, c_acctbal, n_name
    FROM (SELECT c_nationkey AS nationkey, c_custkey, c_acctbal FROM customer)
    JOIN (SELECT n_nationkey AS nationkey, n_name FROM nation) USING (nationkey)""")
def join_broadcast_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_given(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_acctbal"
    )
    nations = read_given(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return join_small(customers, nations, ["nationkey"])


@query("""
    SELECT * EXCLUDE (place) FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders)
    WHERE place = 1""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(read_given(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", unique=True)


@query("""
    SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT n_name, n_nationkey, NULL FROM nation""")
def union_all_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    def party(table: str, prefix: str, *columns: str) -> DataFrame:
        return read_given(spark, sf_dir, table).select(*[F.col(f"{prefix}_{c}").alias(c) for c in columns])

    return union_all([
        party("customer", "c", "name", "nationkey", "acctbal"),
        party("supplier", "s", "name", "nationkey", "acctbal"),
        party("nation", "n", "name", "nationkey"),
    ])
