"""Declared schemas of the school, shop and activity tables.

Nothing is inferred. Ids stay text, dates and times are typed when a table is
loaded, money is decimal(16,2).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

SCHOOL = {
    "student": """stu_id STRING COMMENT 'student id', stu_name STRING COMMENT 'student name',
        birthday DATE COMMENT 'date of birth', sex STRING COMMENT 'sex'""",
    "course": """course_id STRING COMMENT 'course id', course_name STRING COMMENT 'course name',
        tea_id STRING COMMENT 'id of the teacher'""",
    "teacher": "tea_id STRING COMMENT 'teacher id', tea_name STRING COMMENT 'teacher name'",
    "score": """stu_id STRING COMMENT 'student id', course_id STRING COMMENT 'course id',
        score INT COMMENT 'result'""",
}

SHOP = {
    "user": """user_id STRING COMMENT 'user id', gender STRING COMMENT 'gender',
        birthday DATE COMMENT 'date of birth'""",
    "sku": """sku_id STRING COMMENT 'item id', name STRING COMMENT 'item name',
        category_id STRING COMMENT 'category id', from_date DATE COMMENT 'on sale since',
        price DOUBLE COMMENT 'list price'""",
    "category": "category_id STRING COMMENT 'category id', category_name STRING COMMENT 'category name'",
    "order_info": """order_id STRING COMMENT 'order id', user_id STRING COMMENT 'user id',
        create_date DATE COMMENT 'order day', total_amount DECIMAL(16,2) COMMENT 'order total'""",
    "order_detail": """order_detail_id STRING COMMENT 'line id', order_id STRING COMMENT 'order id',
        sku_id STRING COMMENT 'item id', create_date DATE COMMENT 'order day',
        price DECIMAL(16,2) COMMENT 'unit price when ordered', sku_num INT COMMENT 'pieces'""",
    "login": """user_id STRING COMMENT 'user id', ip_address STRING COMMENT 'address',
        login_ts TIMESTAMP_NTZ COMMENT 'login time', logout_ts TIMESTAMP_NTZ COMMENT 'logout time'""",
    "price_change": """sku_id STRING COMMENT 'item id', new_price DECIMAL(16,2) COMMENT 'price after the change',
        change_date DATE COMMENT 'day of the change'""",
    "delivery": """delivery_id STRING COMMENT 'delivery id', order_id STRING COMMENT 'order id',
        user_id STRING COMMENT 'user id', order_date DATE COMMENT 'order day',
        custom_date DATE COMMENT 'wanted delivery day'""",
    "friendship": "user1_id STRING COMMENT 'one user', user2_id STRING COMMENT 'the other user'",
    "favor": """user_id STRING COMMENT 'user id', sku_id STRING COMMENT 'item id',
        create_date DATE COMMENT 'day it was marked'""",
}

ACTIVITY = {
    "live": """user_id INT COMMENT 'user id', live_id INT COMMENT 'room id',
        in_datetime TIMESTAMP_NTZ COMMENT 'entered', out_datetime TIMESTAMP_NTZ COMMENT 'left'""",
    "page_view": """user_id INT COMMENT 'user id', page_id STRING COMMENT 'page id',
        view_timestamp BIGINT COMMENT 'epoch second of the view'""",
    "login_events": "user_id INT COMMENT 'user id', login_datetime TIMESTAMP_NTZ COMMENT 'login time'",
    "promotion": """promotion_id STRING COMMENT 'promotion id', brand STRING COMMENT 'brand',
        start_date DATE COMMENT 'first day', end_date DATE COMMENT 'last day'""",
}

# Declared types of the benchmark star schema (parquet files, one per table).
STAR = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def schema(ddl: str) -> StructType:
    """A DDL string as StructType; column comments land in the field metadata."""
    return StructType.fromDDL(ddl)
