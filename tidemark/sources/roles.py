"""The star schema seen as school, shop and activity tables.

Every view is a lazy DataFrame over a declared Parquet schema, so the columns
and filters a query needs reach the scan. Views that do not need a column of
the other side of `lineitem` x `orders` do not join it. Money is in whole cents.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, epoch_second
from tidemark.operators.tasks import dealt, grouped, tasks_for
from tidemark.sources.schemas import STAR
from tidemark.sources.tables import read_table


class Roles:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet", STAR[name])

    @cached_property
    def tasks(self) -> int:
        """Tasks for steps on all order lines."""
        return tasks_for(self.table("lineitem"))

    # -- school ---------------------------------------------------------------

    def student(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("stu_id"),
            F.col("c_name").alias("stu_name"),
            F.col("c_mktsegment").alias("sex"),
        )

    def course(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("course_id"),
            F.col("s_name").alias("course_name"),
            F.col("s_nationkey").alias("tea_id"),
        )

    def teacher(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("tea_id"), F.col("n_name").alias("tea_name"))

    def score(self) -> DataFrame:
        """One result per student and course: the largest line quantity."""
        bought = self._lines().select(
            F.col("o_custkey").alias("stu_id"),
            F.col("l_suppkey").alias("course_id"),
            F.col("l_quantity").cast("int").alias("score"),
        )
        return grouped(bought, ["stu_id", "course_id"], self.tasks, {"score": F.max})

    # -- shop -----------------------------------------------------------------

    def user(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("gender"))

    def category(self) -> DataFrame:
        return (
            self.table("part")
            .select(F.col("p_brand").alias("category_id"))
            .distinct()
            .withColumn("category_name", F.col("category_id"))
        )

    def sku(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("category_id"),
            F.date_add(F.lit("1998-11-01").cast("date"), F.col("p_size")).alias("from_date"),
            F.col("p_retailprice").alias("price"),
        )

    def order_info(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("date").alias("create_date"),
            cents(F.col("o_totalprice")).alias("total_amount"),
        )

    def order_detail(self) -> DataFrame:
        """Order lines with the buyer and day of their order; `amount` is the line total."""
        return self._lines().select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("o_orderdate").cast("date").alias("create_date"),
            cents(F.col("l_extendedprice")).alias("amount"),
            F.col("l_quantity").cast("int").alias("sku_num"),
        )

    def sold(self) -> DataFrame:
        """Order lines without buyer and day: no join. Every line belongs to an order."""
        return self.table("lineitem").select(
            F.col("l_partkey").alias("sku_id"),
            F.col("l_suppkey").alias("shop_id"),
            cents(F.col("l_extendedprice")).alias("amount"),
            F.col("l_quantity").cast("int").alias("sku_num"),
        )

    def sold_lines(self) -> DataFrame:
        """Order lines with their order and status, of which there are two: no join."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_linestatus").alias("line_status"),
            cents(F.col("l_extendedprice")).alias("amount"),
            F.col("l_quantity").cast("int").alias("sku_num"),
        )

    def price_change(self) -> DataFrame:
        shipped = self.table("lineitem").select(
            F.col("l_partkey").alias("sku_id"),
            F.col("l_shipdate").cast("date").alias("change_date"),
            cents(F.col("l_extendedprice")).alias("new_price"),
        )
        return grouped(shipped, ["sku_id", "change_date"], self.tasks, {"new_price": F.max})

    def target(self) -> DataFrame:
        """Monthly targets of shops in cents, of three amounts; every third shop has none."""
        shop = F.col("s_suppkey")
        amount = (60_000_000 + shop % 3 * 5_000_000).cast("long")
        return self.table("supplier").filter(shop % 3 != F.lit(1)).select(shop.alias("shop_id"), amount.alias("target"))

    def delivery(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            (F.col("o_orderpriority") == "1-URGENT").alias("immediate"),
        )

    def friendship(self) -> DataFrame:
        customer = self.table("customer")
        users = customer.agg(F.count("*")).scalar()
        return customer.select(
            F.col("c_custkey").alias("user1_id"), ((F.col("c_custkey") * 7 + 1) % users).alias("user2_id")
        )

    def favor(self) -> DataFrame:
        return (
            self._lines()
            .filter(F.col("l_returnflag") == "R")
            .select(
                F.col("o_custkey").alias("user_id"),
                F.col("l_partkey").alias("sku_id"),
                F.col("l_shipdate").cast("date").alias("create_date"),
            )
            .distinct()
        )

    # -- activity -------------------------------------------------------------

    def login(self) -> DataFrame:
        """Sessions that start at an event and last as many minutes as its value says."""
        seconds = F.floor(F.col("value") * 60).cast("int")
        return self.table("events").select(
            "event_id",
            "user_id",
            F.col("event_type").alias("ip_address"),
            F.col("ts").alias("login_ts"),
            (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("logout_ts"),
        )

    def live(self) -> DataFrame:
        return self.login().withColumnsRenamed(
            {"ip_address": "live_id", "login_ts": "in_datetime", "logout_ts": "out_datetime"}
        )

    def login_day(self) -> DataFrame:
        """User and day of every login, which is every event as in `login`."""
        return self.table("events").select("user_id", F.col("ts").cast("date").alias("create_date"))

    def purchase_day(self) -> DataFrame:
        """User and day of every purchase, the orders of the activity tables."""
        bought = self.table("events").filter(F.col("event_type") == "purchase")
        return bought.select("user_id", F.col("ts").cast("date").alias("create_date"))

    def page_view(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "user_id",
            F.col("event_type").alias("page_id"),
            epoch_second(F.col("ts")).alias("view_timestamp"),
        )

    def login_events(self) -> DataFrame:
        events = self.table("events").filter(F.col("event_type") == "view")
        return events.select("user_id", F.col("ts").alias("login_datetime"))

    def promotion(self) -> DataFrame:
        start = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            F.col("o_orderkey").alias("promotion_id"),
            F.col("o_custkey").alias("brand"),
            start.alias("start_date"),
            F.date_add(start, (F.col("o_orderkey") % 60).cast("int")).alias("end_date"),
        )

    def _lines(self) -> DataFrame:
        lines = dealt(self.table("lineitem"), self.tasks, "l_orderkey")
        orders = dealt(self.table("orders"), self.tasks, "o_orderkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
