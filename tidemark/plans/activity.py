"""Analyses of logins, page views, live rooms and promotions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_if, in_year
from tidemark.operators import days, intervals, scan

# Names of the activity classes.
LEVELS = {"lost": "流失用户", "loyal": "忠实用户", "fresh": "新晋用户", "dormant": "沉睡用户"}


def daily_new_users(logins: DataFrame, at: str) -> DataFrame:
    """Number of first-ever logins per day."""
    first = days.first_days(logins, "user_id", at)
    per_day = first.groupBy(F.col("first_day").alias("login_date_first"))
    return per_day.agg(F.count("user_id").alias("user_count")).orderBy("login_date_first")


def user_overview(
    logins: DataFrame, at: str, orders: DataFrame, login_year: int, order_year: int, how: str = "inner"
) -> DataFrame:
    """Registration day, logins ever, and logins, orders and amount of a year.

    ``inner`` keeps users with a login and an order in the year, ``left`` every
    user who ever logged in, with zeros.
    """
    day = F.col(at).cast("date")
    seen = logins.groupBy("user_id").agg(
        F.min(day).alias("register_date"),
        F.count("*").alias("total_login_count"),
        count_if(F.year(day) == login_year).alias("login_count_year"),
    )
    bought = orders.filter(in_year(F.col("create_date"), order_year)).groupBy("user_id")
    bought = bought.agg(F.count("*").alias("orders"), F.sum("total_amount").alias("amount"))
    if how == "inner":
        seen = seen.filter("login_count_year > 0")
    return seen.join(bought, "user_id", how).select(
        "user_id",
        "register_date",
        "total_login_count",
        "login_count_year",
        F.coalesce("orders", F.lit(0)).alias("order_count_year"),
        F.coalesce("amount", F.lit(0)).alias("order_amount_year"),
    )


def login_streaks(logins: DataFrame, at: str, n: int = 2) -> DataFrame:
    """Date ranges of at least n consecutive login days."""
    runs = days.islands(logins, "user_id", at).filter(F.col("n_points") >= n)
    return runs.select("user_id", F.col("start").alias("start_date"), F.col("end").alias("end_date"))


def longest_login_gap(logins: DataFrame, at: str, today: str) -> DataFrame:
    gaps = days.max_gap(logins, "user_id", at, today)
    return gaps.select("user_id", F.col("max_gap").alias("max_diff")).orderBy("user_id")


def overlapping_logins(sessions: DataFrame, distinct_place: bool = False) -> DataFrame:
    """Users logged in twice at one moment, if wanted only from two different addresses."""
    place = "ip_address" if distinct_place else None
    return intervals.overlaps(sessions, "user_id", "login_ts", "logout_ts", place)


def day1_retention(logins: DataFrame, at: str) -> DataFrame:
    return days.retention(logins, "user_id", at).select(
        F.col("first_day").alias("first_login"), F.col("registered").alias("register"), "retention"
    )


def daily_logins_and_orders(logins: DataFrame, at: str, orders: DataFrame) -> DataFrame:
    """Logins and orders per user and login day; a day without login is left out."""
    day = F.col(at).cast("date").alias("login_date")
    seen = logins.groupBy("user_id", day).agg(F.count("*").alias("login_count"))
    bought = orders.groupBy("user_id", F.col("create_date").alias("login_date")).agg(F.count("*").alias("n"))
    return (
        seen.join(bought, ["user_id", "login_date"], "left")
        .select("user_id", "login_date", "login_count", F.coalesce("n", F.lit(0)).alias("order_count"))
        .orderBy("user_id", "login_date")
    )


def user_levels(
    logins: DataFrame, at: str, active_days: int = 7, lost_days: int = 30, names: dict[str, str] = LEVELS
) -> DataFrame:
    """Users per activity class, counted back from the last day in the data.

    The cases overlap at their borders, the first that fits decides. Users are
    counted by first and last day, so the last day of all is found among pairs of days.
    """
    own = logins.groupBy("user_id").agg(
        F.min(F.col(at).cast("date")).alias("first"), F.max(F.col(at).cast("date")).alias("last")
    )
    spans = own.groupBy("first", "last").agg(F.count("*").alias("users"))
    # All columns of the pairs are read, so that both uses are one shuffle.
    facts = spans.agg(F.struct(F.max("last").alias("today"), F.sum("users").alias("users"))).scalar()
    first, last = F.col("first"), F.col("last")
    recent, gone = F.date_sub(F.col("today"), active_days), F.date_sub(F.col("today"), lost_days)
    level = (
        F.when(last <= gone, names["lost"])
        .when((last >= recent) & (first <= recent), names["loyal"])
        .when(first >= recent, names["fresh"])
        .when((last <= recent) & (first <= recent), names["dormant"])
    )
    dated = spans.withColumn("today", facts.getField("today"))
    return dated.groupBy(level.alias("level")).agg(F.sum("users").alias("cn"))


def checkin_coins(logins: DataFrame, at: str) -> DataFrame:
    """A coin per day, 2 and 6 more on the third and seventh day of a run, which restarts after seven."""
    coins = days.streak_reward(logins, "user_id", at, cycle=7, bonus={3: 2, 7: 6})
    return coins.select("user_id", F.col("reward").alias("sum_coin_cn")).orderBy(F.desc("sum_coin_cn"), "user_id")


def peak_online(sessions: DataFrame) -> DataFrame:
    return intervals.peak(sessions, "login_ts", "logout_ts").select(F.col("peak").alias("cn"))


def peak_per_room(visits: DataFrame) -> DataFrame:
    rooms = intervals.peak(visits, "in_datetime", "out_datetime", "live_id")
    return rooms.select("live_id", F.col("peak").alias("max_user_count"))


def page_sessions(views: DataFrame, gap_s: int = 60) -> DataFrame:
    labelled = intervals.sessionize(views, "user_id", "view_timestamp", gap_s)
    return labelled.select("user_id", "page_id", "view_timestamp", "session_id")


def longest_streak(logins: DataFrame, at: str, missed: int = 1) -> DataFrame:
    """Longest run of login days, where up to ``missed`` days in a row may be missing."""
    spans = days.longest_span(logins, "user_id", at, max_gap=missed + 1)
    return spans.select("user_id", F.col("span").alias("max_count_days")).orderBy("user_id")


def promotion_days(promotion: DataFrame) -> DataFrame:
    """Days per brand with at least one promotion."""
    covered = intervals.covered_days(promotion, "brand", "start_date", "end_date")
    return covered.select("brand", F.col("days").alias("promotion_day_count"))


def running_value(events: DataFrame, value: Column) -> DataFrame:
    """Every event with the sum of a value over all events up to it, whoever they are of."""
    return scan.running(events, [], ["ts", "event_id"], {"so_far": value}).select("event_id", "ts", "so_far")
