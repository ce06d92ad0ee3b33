"""Operators on calendar days and months per key.

All of them first reduce the rows to one per key and day. That is a map-side
combined aggregate, so a key with a large part of all rows shrinks to at most
the number of days in the data before any window sees it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import count_if, date, month_number, month_start
from tidemark.operators.groups import Keys, as_list
from tidemark.operators.tasks import dealt, grouped


def distinct_days(df: DataFrame, keys: Keys, day: str, tasks: int = 0) -> DataFrame:
    """Each day of a key once, as a date; unknown days are left out."""
    days = df.select(*as_list(keys), F.col(day).cast("date").alias(day))
    return grouped(days.filter(F.col(day).isNotNull()), days.columns, tasks, {})


def islands(df: DataFrame, keys: Keys, day: str, unit: str = "day", max_gap: int = 1, tasks: int = 0) -> DataFrame:
    """Runs of days (or months) per key with steps of at most ``max_gap``.

    Returns the keys, start, end, n_points (days present) and span (days from
    start to end, both included).
    """
    keys = as_list(keys)
    if unit == "month":
        df = df.withColumn(day, month_start(F.col(day)))
    number = month_number(F.col(day)) if unit == "month" else F.unix_date(F.col(day))
    in_order = Window.partitionBy(*keys).orderBy("_no")
    points = dealt(distinct_days(df, keys, day, tasks), tasks, *keys).withColumn("_no", number)
    if max_gap == 1:
        # Without tolerated gaps the distance to the row number stays the same along a run.
        island = F.col("_no") - F.row_number().over(in_order)
    else:
        opens = F.when(F.col("_no") - F.lag("_no").over(in_order) <= max_gap, 0).otherwise(1)
        points = points.withColumn("_opens", opens)
        island = F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    points = points.withColumn("_island", island)
    return (
        points.groupBy(*keys, "_island")
        .agg(
            F.min(day).alias("start"),
            F.max(day).alias("end"),
            F.count("*").alias("n_points"),
            (F.max("_no") - F.min("_no") + 1).alias("span"),
        )
        .drop("_island")
    )


def longest_span(df: DataFrame, keys: Keys, day: str, max_gap: int = 1) -> DataFrame:
    """Longest run per key, counted from its first to its last day."""
    return islands(df, keys, day, max_gap=max_gap).groupBy(*as_list(keys)).agg(F.max("span").alias("span"))


def streak_reward(df: DataFrame, keys: Keys, day: str, cycle: int, bonus: Mapping[int, int]) -> DataFrame:
    """One point per day plus a bonus at given positions of a run; positions restart every ``cycle`` days.

    The points of a run follow from its length alone: position p occurs once per
    full cycle and once more when the run ends at or after it.
    """
    length = F.col("n_points")
    points = length
    for position, extra in bonus.items():
        points = points + F.floor((length - position + cycle) / cycle) * extra
    return islands(df, keys, day).groupBy(*as_list(keys)).agg(F.sum(points).alias("reward"))


def max_gap(df: DataFrame, key: str, day: str, today: str) -> DataFrame:
    """Longest wait in days between two days of a key, the last one waiting until today."""
    following = F.lead(day, 1).over(Window.partitionBy(key).orderBy(day))
    gaps = distinct_days(df, key, day).withColumn("_next", F.coalesce(following, date(today)))
    return gaps.groupBy(key).agg(F.max(F.datediff("_next", day)).alias("max_gap"))


def first_days(df: DataFrame, user: str, day: str) -> DataFrame:
    """First day of every user."""
    return df.groupBy(user).agg(F.min(F.col(day).cast("date")).alias("first_day"))


def returned(df: DataFrame, user: str, day: str, n: int = 1) -> DataFrame:
    """First day of every user and whether the user was back exactly n days later."""
    own = Window.partitionBy(user)
    days = distinct_days(df, user, day).withColumn("first_day", F.min(day).over(own))
    back = F.col(day) == F.date_add("first_day", n)
    return days.groupBy(user, "first_day").agg(F.bool_or(back).alias("back"))


def retention(df: DataFrame, user: str, day: str, n: int = 1) -> DataFrame:
    """Per first day: new users and the share of them back n days later."""
    return (
        returned(df, user, day, n)
        .groupBy("first_day")
        .agg(F.count("*").alias("registered"), count_if(F.col("back")).alias("retained"))
        .withColumn("retention", F.col("retained") / F.col("registered"))
    )


def next_day_repeat(df: DataFrame, user: str, day: str) -> DataFrame:
    """Share of users whose second day is the day after their first; one row."""
    return returned(df, user, day).agg(F.try_divide(count_if(F.col("back")), F.count("*")).alias("share"))


def running_total(df: DataFrame, keys: Keys, day: str, value: Column) -> DataFrame:
    """Sum per key and day, and the sum so far in ``so_far``."""
    keys = as_list(keys)
    window = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("_day_sum"))
    return daily.withColumn("so_far", F.sum("_day_sum").over(window)).drop("_day_sum")


def rolling(df: DataFrame, keys: Sequence[str], day: str, value: str, rows: int, calendar: bool = False) -> DataFrame:
    """Sum and average over the last ``rows`` rows, or over that many calendar days.

    Expects one row per key and day, so even a window without keys orders no
    more rows than there are days.
    """
    number = F.unix_date(F.col(day))
    window = Window.partitionBy(*keys).orderBy(number)
    window = window.rangeBetween(1 - rows, 0) if calendar else window.rowsBetween(1 - rows, 0)
    return df.withColumn("rolling_sum", F.sum(value).over(window)).withColumn(
        "rolling_avg", F.avg(value).over(window)
    )
