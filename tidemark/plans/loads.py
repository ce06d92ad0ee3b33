"""Loads: delimited text with broken lines, batches that come twice, bucketed tables.

Each writes to a new folder inside the one that the executors share and returns what is read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder
from tidemark.sources import tables

ORDER_LINE = "order_id BIGINT, user_id BIGINT, create_date DATE, total_amount BIGINT"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def text_round_trip(orders: DataFrame, every: int = 97) -> DataFrame:
    """Orders written as tab separated text, with every n-th line broken, and loaded from it.

    A row for each line: its fields, or the line itself where it was refused. Of the broken
    lines the even ones lack their last field, the others have a word for a day.
    """
    spark = orders.sparkSession
    fields = [F.col(name.split()[0]).cast("string") for name in ORDER_LINE.split(", ")]
    broken, short = F.col("order_id") % every == 0, F.col("order_id") % 2 == 0
    day = F.when(broken & ~short, F.lit("someday")).otherwise(fields[2])
    line = F.when(broken & short, F.concat_ws("\t", *fields[:2], day)).otherwise(F.concat_ws("\t", *fields[:2], day, fields[3]))
    text, table = new_folder(spark, "lines"), new_folder(spark, "orders")
    orders.select(line.alias("value")).write.text(text)
    tables.load_checked(spark, text, ORDER_LINE, table, sep="\t")
    kept, others = tables.loaded(spark, table, ORDER_LINE), tables.refused(spark, table, ORDER_LINE)
    return kept.withColumn("line", F.lit(None).cast("string")).unionByName(others, allowMissingColumns=True)


def batches_twice(orders: DataFrame, again: int) -> DataFrame:
    """Orders loaded by year, one year of them a second time, and read back."""
    spark, path = orders.sparkSession, new_folder(orders.sparkSession, "batches")
    rows = orders.withColumn("batch", F.year("create_date"))
    tables.load_batch(rows, path, "batch")
    tables.load_batch(rows.filter(F.col("batch") == again), path, "batch")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return spark.read.schema(schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """A table in buckets of its keys, under a new name."""
    spark = df.sparkSession
    name = "bucketed_" + uuid.uuid4().hex
    return tables.save_bucketed(df, name, new_folder(spark, name), keys, buckets)


def scores_from_buckets(lines: DataFrame, orders: DataFrame, buckets: int = 32) -> DataFrame:
    """Best line quantity per buyer and supplier, from lines and orders stored in buckets of the order."""
    left = bucketed(lines.select("l_orderkey", "l_suppkey", "l_quantity"), ["l_orderkey"], buckets)
    right = bucketed(orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], buckets)
    met = left.join(right, F.col("l_orderkey") == F.col("o_orderkey"))
    best = met.groupBy(F.col("o_custkey").alias("stu_id"), F.col("l_suppkey").alias("course_id"))
    return best.agg(F.max(F.col("l_quantity").cast("int")).alias("score"))
