"""Rows on which the literal and the intended reading of an analysis differ."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import days, groups
from tidemark.plans import activity, school, shop
from tidemark.sources import tables

D = datetime.date
TS = datetime.datetime


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return D(2024, 3, n)


@pytest.fixture(scope="module")
def visits(spark):
    def make(*days_of):
        return spark.createDataFrame(
            [(user, day(n)) for user, n in days_of], "user_id string, create_date date"
        )

    return make


def test_second_best_counts_pieces_and_keeps_ties(spark):
    lines = spark.createDataFrame([(9, 1), (1, 5), (2, 2), (2, 3), (3, 7), (4, 1)], "sku_id int, sku_num int")
    assert rows(shop.nth_best_seller(lines)) == [(1,), (2,)]
    assert rows(shop.nth_best_seller(lines, ties="rank")) == [(1,), (2,)]
    assert rows(shop.nth_best_seller(lines, 3, ties="rank", or_null=True)) == [(None,)]
    assert rows(shop.nth_best_seller(lines, 3)) == [(4,), (9,)]
    assert rows(shop.nth_best_seller(lines, 9, or_null=True)) == [(None,)]
    assert rows(shop.nth_best_seller(lines, 9)) == []
    level = spark.createDataFrame([(1, 5), (2, 5)], "sku_id int, sku_num int")
    assert rows(shop.nth_best_seller(level, 2, ties="rank", or_null=True)) == [(None,)]
    assert rows(shop.nth_best_seller(level, 1, ties="rank")) == [(1,), (2,)]


def test_order_streak_ignores_repeats_within_a_day(visits):
    found = shop.consecutive_order_days(visits(("a", 1), ("a", 2), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 4)))
    assert rows(found) == [("a",)]
    twice = shop.consecutive_order_days(visits(*(("a", n) for n in (1, 2, 3, 10, 11, 12))))
    assert rows(twice) == [("a",)]


def test_login_streak_ignores_repeats_within_a_day(visits):
    found = activity.login_streaks(visits(("a", 1), ("a", 1), ("a", 5), ("a", 5), ("a", 6)), "create_date")
    assert rows(found) == [("a", day(5), day(6))]


def test_retention_counts_a_returning_user_once(visits):
    found = activity.day1_retention(visits(("a", 1), ("a", 2), ("a", 2), ("b", 1), ("b", 3)), "create_date")
    assert rows(found) == [(day(1), 2, 0.5)]


def test_repeat_rate_keeps_users_with_one_day(visits):
    found = shop.next_day_repeat_rate(visits(("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 3)))
    assert rows(found) == [("33.3%",)]


def test_coins_restart_after_a_week(visits):
    # Six days pay the bonus of the third day only, ten days that of positions 3, 7 and again 3.
    found = activity.checkin_coins(visits(*(("six", n) for n in range(1, 7)), *(("ten", n) for n in range(1, 11))), "create_date")
    assert [tuple(r) for r in found.collect()] == [("ten", 10 + 2 + 6 + 2), ("six", 6 + 2)]


def test_price_default_for_an_unchanged_item(spark):
    sku = spark.createDataFrame([("1",), ("2",), ("3",)], "sku_id string")
    change = spark.createDataFrame(
        [("1", Decimal("5.00"), D(2021, 9, 1)), ("1", Decimal("6.00"), D(2021, 9, 2)), ("2", Decimal("7.00"), D(2021, 11, 1))],
        "sku_id string, new_price decimal(16,2), change_date date",
    )
    found = shop.price_as_of(sku, change, "2021-10-01")
    assert rows(found) == [("1", Decimal("6.00")), ("2", Decimal("99.00")), ("3", Decimal("99.00"))]
    assert rows(shop.last_price_change(change)) == [("1", Decimal("1.00")), ("2", Decimal("7.00"))]


def test_first_order_on_a_shared_day_is_the_lower_id(spark):
    delivery = spark.createDataFrame(
        [(2, "a", day(1), True), (1, "a", day(1), False), (3, "b", day(1), True), (4, "b", day(2), False), (5, "c", day(1), None)],
        "order_id int, user_id string, order_date date, immediate boolean",
    )
    assert rows(shop.first_order_share(delivery, F.col("immediate"))) == [(0.33,)]


def test_recommendation_needs_a_favourite_and_ignores_loops(spark):
    friends = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("c", "a")], "user1_id string, user2_id string")
    favor = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 1)], "user_id string, sku_id int")
    assert rows(shop.friend_favourites(friends, favor)) == [("a", 2), ("c", 1)]


def test_median_of_odd_even_and_repeated_prices(spark):
    prices = {"odd": [3, 1, 10], "even": [1.5, 2, 4, 100], "one": [7.25], "same": [5, 5, 5, 9], None: [1, 2]}
    sku = spark.createDataFrame(
        [(k, float(p)) for k, ps in prices.items() for p in ps] + [("odd", None)], "category_id string, price double"
    )
    assert rows(shop.median_price(sku)) == rows_like([("odd", 3.0), ("even", 3.0), ("one", 7.3), ("same", 5.0), (None, 1.5)])


def rows_like(expected):
    return sorted(expected, key=repr)


def test_target_needs_neighbouring_months(spark):
    lines = spark.createDataFrame(
        [
            ("gap", D(2021, 1, 5), Decimal("10.00")), ("gap", D(2021, 3, 5), Decimal("10.00")),
            ("run", D(2020, 12, 31), Decimal("6.00")), ("run", D(2020, 12, 1), Decimal("4.00")), ("run", D(2021, 1, 1), Decimal("10.00")),
            ("free", D(2021, 1, 1), Decimal("99.00")), ("free", D(2021, 2, 1), Decimal("99.00")),
        ],
        "sku_id string, create_date date, amount decimal(16,2)",
    )
    targets = spark.createDataFrame([("gap", 10), ("run", 10), ("unsold", 1)], "sku_id string, target int")
    assert rows(shop.target_two_months(lines, targets, "sku_id")) == [("run",)]
    higher = targets.withColumn("target", F.when(F.col("sku_id") == "run", 11).otherwise(10))
    assert rows(shop.target_two_months(lines, higher, "sku_id")) == []


def test_purchases_give_one_row_per_user(spark):
    lines = spark.createDataFrame(
        [("a", 1, day(1)), ("a", 3, day(4)), ("a", 9, day(5)), ("b", 1, day(2))], "user_id string, sku_id int, create_date date"
    )
    assert rows(shop.first_last_count(lines, [1, 3])) == [("a", day(1), day(4), 2)]


def test_teacher_courses_count_once(spark):
    student = spark.createDataFrame([(1, "x"), (2, "y")], "stu_id int, stu_name string")
    course = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "c", 8)], "course_id int, course_name string, tea_id int")
    teacher = spark.createDataFrame([(7, "T"), (8, "U")], "tea_id int, tea_name string")
    score = spark.createDataFrame([(1, 1, 50), (1, 1, 60), (2, 1, 50), (2, 2, 50)], "stu_id int, course_id int, score int")
    assert rows(school.took_all_of(student, course, teacher, score, "T")) == [(2, "y")]


def test_unknown_scores_decide_differently(spark):
    student = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "stu_id int, stu_name string")
    course = spark.createDataFrame([(1, "a")], "course_id int, course_name string")
    score = spark.createDataFrame([(1, 1, 50), (1, 2, None), (2, 1, 50), (3, 1, 90), (3, 1, None)], "stu_id int, course_id int, score int")
    assert rows(school.all_below(student, score, 60)) == [(2, "y")]
    assert rows(school.all_above_listing(student, course, score, 70)) == [("z", "a", 90), ("z", "a", None)]


def test_average_covers_all_courses(spark):
    student = spark.createDataFrame([(1, "x")], "stu_id int, stu_name string")
    score = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 3, 90), (2, 1, 0), (2, 2, 0)], "stu_id int, course_id int, score int")
    assert rows(school.failing_averages(student, score, 60)) == [(1, 40.0)]


def test_not_in_follows_sql_for_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    for listed, expected in (([1], [(2,)]), ([1, None], []), ([None], []), ([], [(1,), (2,), (None,)]), ([1, 1, 2], [])):
        values = spark.createDataFrame([(v,) for v in listed], "v int")
        df.createOrReplaceTempView("df_rows")
        values.createOrReplaceTempView("listed_rows")
        found = rows(groups.not_in(df, "k", values))
        assert found == expected
        assert found == rows(spark.sql("SELECT k FROM df_rows WHERE k NOT IN (SELECT v FROM listed_rows)"))


def test_low_sellers_skip_recent_items(spark):
    lines = spark.createDataFrame(
        [(1, 5, D(2021, 5, 1)), (2, 5, D(2021, 5, 1)), (3, 500, D(2021, 5, 1)), (1, 900, D(2020, 5, 1))],
        "sku_id int, sku_num int, create_date date",
    )
    sku = spark.createDataFrame(
        [(1, "old", D(2020, 1, 1)), (2, "new", D(2021, 12, 30)), (3, "hot", D(2020, 1, 1))], "sku_id int, name string, from_date date"
    )
    assert rows(shop.low_sellers(lines, sku, 2021, 100, "2022-01-10")) == [(1, "old", 5)]


def test_rolling_over_rows_and_over_calendar_days(spark):
    orders = spark.createDataFrame(
        [(day(n), Decimal(v)) for n, v in ((1, 10), (2, 20), (2, 5), (7, 30), (8, 1))], "create_date date, total_amount decimal(16,2)"
    )
    by_rows = {r.create_date.day: (int(r.total_3d), float(r.avg_ad)) for r in shop.rolling_sales(orders).collect()}
    by_days = {r.create_date.day: (int(r.total_3d), float(r.avg_ad)) for r in shop.rolling_sales(orders, calendar=True).collect()}
    assert by_rows == {1: (10, 10.0), 2: (35, 17.5), 7: (65, 21.67), 8: (56, 18.67)}
    assert by_days == {1: (10, 10.0), 2: (35, 17.5), 7: (30, 30.0), 8: (31, 15.5)}


def test_promotion_of_one_day_and_shared_starts(spark):
    promo = spark.createDataFrame(
        [("a", day(1), day(1)), ("b", day(1), day(5)), ("b", day(1), day(2)), ("b", day(5), day(6)), ("c", day(3), day(2))],
        "brand string, start_date date, end_date date",
    )
    assert rows(activity.promotion_days(promo)) == [("a", 1), ("b", 6)]


def test_peak_counts_simultaneous_logins_and_nets_out_a_handover(spark):
    at = [TS(2024, 3, 1, hour) for hour in range(6)]
    login = spark.createDataFrame(
        [("a", at[1], at[2]), ("b", at[1], at[2]), ("c", at[1], at[2]), ("d", at[2], at[3]), ("e", at[3], None)],
        "user_id string, login_ts timestamp_ntz, logout_ts timestamp_ntz",
    )
    assert rows(activity.peak_online(login)) == [(3,)]
    assert rows(activity.peak_online(login.filter("false"))) == [(None,)]


def test_overview_inner_and_left(spark):
    logins = spark.createDataFrame([("a", TS(2021, 1, 1)), ("a", TS(2020, 1, 1)), ("b", TS(2021, 2, 1)), ("c", TS(2019, 1, 1))], "user_id string, at timestamp_ntz")
    orders = spark.createDataFrame([("a", D(2021, 1, 1), Decimal(5)), ("c", D(2021, 1, 1), Decimal(5))], "user_id string, create_date date, total_amount decimal(16,2)")
    inner = activity.user_overview(logins, "at", orders, 2021, 2021)
    left = activity.user_overview(logins, "at", orders, 2021, 2021, how="left")
    assert rows(inner) == [("a", D(2020, 1, 1), 2, 1, 1, Decimal("5.00"))]
    assert [tuple(r)[0::3] for r in left.orderBy("user_id").collect()] == [("a", 1), ("b", 1), ("c", 0)]
    assert [r.order_count_year for r in left.orderBy("user_id").collect()] == [1, 0, 1]


def test_activity_levels_of_the_borders(spark):
    def seen(user, *back):
        return [(user, D(2024, 3, 31) - datetime.timedelta(days=n)) for n in back]

    logins = spark.createDataFrame(
        seen("today", 0) + seen("lost", 30, 60) + seen("sleep", 20) + seen("loyal", 3, 40) + seen("edge", 7),
        "user_id string, at date",
    )
    # Exactly at the border of seven days the earlier case, loyal, takes the user.
    assert rows(activity.user_levels(logins, "at", names={k: k for k in activity.LEVELS})) == rows_like(
        [("fresh", 1), ("lost", 1), ("dormant", 1), ("loyal", 2)]
    )


def test_weekdays_and_sell_through(spark):
    lines = spark.createDataFrame(
        [(1, D(2024, 3, 4), 2), (1, D(2024, 3, 10), 3), (1, D(2024, 3, 11), 9), (2, D(2024, 3, 4), 1), (2, D(2024, 3, 4), 1)],
        "sku_id int, create_date date, sku_num int",
    )
    assert rows(shop.week_pivot(lines, "2024-03-04", "2024-03-10")) == [(1, 2, 0, 0, 0, 0, 0, 3), (2, 2, 0, 0, 0, 0, 0, 0)]
    sku = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "x"), (5, "y")], "sku_id int, category_id string")
    (found,) = shop.sell_through(lines, sku, "2024-03-04").collect()
    assert (found.category_id, found.day1_churn, found.day1_slow, found.day2_churn, found.day7_churn) == ("x", 0.5, 0.5, 0.0, 0.25)


def test_side_by_side_and_periods(spark):
    lines = spark.createDataFrame(
        [(1, D(2020, 5, 1), 2), (1, D(2021, 5, 9), 3), (1, D(2021, 6, 9), 4), (1, D(2019, 6, 9), 4)], "sku_id int, create_date date, sku_num int"
    )
    assert rows(shop.same_month_two_years(lines, 2020, 2021)) == [(1, 5, 2, 3), (1, 6, 0, 4)]
    favor = spark.createDataFrame([(7, 1, D(2021, 5, 9)), (8, 2, D(2021, 5, 10))], "user_id int, sku_id int, create_date date")
    assert rows(shop.favs_and_purchases(lines, favor, "2021-05-01", "2021-05-31")) == [(1, 3, 1)]
    assert rows(shop.favs_and_purchases(lines, favor, "2021-05-01", "2021-05-31", how="full")) == [(1, 3, 1), (2, 0, 1)]


def test_bands_take_their_upper_bound_or_not(spark):
    orders = spark.createDataFrame([("a", day(1), Decimal(9999)), ("a", day(2), Decimal(1))], "user_id string, create_date date, total_amount decimal(16,2)")
    assert [r.vip_level for r in shop.vip_level(orders).orderBy("create_date").collect()] == ["普通会员", "青铜会员"]
    lines = spark.createDataFrame([(1, 5000), (2, 5001), (3, 19999), (4, 20000)], "sku_id int, sku_num int")
    assert rows(shop.sales_bands(lines)) == rows_like([("冷门商品", 1), ("一般商品", 2), ("热门商品", 1)])


def test_bought_but_not_and_category_best(spark):
    lines = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3), ("c", 1)], "user_id string, sku_id int")
    assert rows(shop.bought_but_not(lines, "sku_id", [1, 2], [3])) == [("a",)]
    sold = spark.createDataFrame([(1, 5), (2, 5), (3, 1), (4, 9)], "sku_id int, sku_num int")
    sku = spark.createDataFrame([(1, "p", "x"), (2, "q", "x"), (3, "r", "x"), (4, "s", "y")], "sku_id int, name string, category_id string")
    category = spark.createDataFrame([("x", "X"), ("y", "Y")], "category_id string, category_name string")
    assert rows(shop.category_best_and_kinds(sold, sku, category)) == [("x", "X", 1, "p", 5, 3), ("y", "Y", 4, "s", 9, 1)]
    assert rows(shop.top_per_category(sold, sku, 2)) == [(1, "x"), (2, "x"), (4, "y")]


def test_islands_by_month_and_with_a_gap(spark):
    df = spark.createDataFrame([("a", D(2020, 11, 30)), ("a", D(2020, 12, 1)), ("a", D(2021, 2, 1))], "k string, d date")
    months = days.islands(df, "k", "d", unit="month")
    assert rows(months) == [("a", D(2020, 11, 1), D(2020, 12, 1), 2, 2), ("a", D(2021, 2, 1), D(2021, 2, 1), 1, 1)]
    gaps = spark.createDataFrame([("a", day(n)) for n in (1, 3, 5, 6, 9)], "k string, d date")
    assert rows(days.islands(gaps, "k", "d", max_gap=2)) == [("a", day(1), day(6), 4, 6), ("a", day(9), day(9), 1, 1)]


def test_append_and_preview(spark, tmp_path):
    file = tmp_path / "teacher.txt"
    file.write_text("1,x\n2,y\n", encoding="utf-8")
    stored = str(tmp_path / "teacher")
    ddl = "tea_id STRING COMMENT 'teacher id', tea_name STRING"
    for append, expected in ((False, 2), (False, 2), (True, 4)):
        tables.load_files(spark, str(file), ddl, stored, append=append)
        assert tables.read_table(spark, stored, ddl).count() == expected
    assert tables.read_delimited(spark, str(file), ddl).schema["tea_id"].metadata["comment"] == "teacher id"
    assert tables.preview(tables.read_table(spark, stored), ["tea_id"], 3).count() == 3
    out = str(tmp_path / "tabs")
    tables.save_delimited(tables.read_table(spark, stored, ddl), out, sep="\t")
    assert rows(tables.read_delimited(spark, out, ddl, "\t")) == rows(tables.read_table(spark, stored, ddl))


def test_a_malformed_field_is_null_and_its_row_stays(spark, tmp_path):
    file = tmp_path / "favor.txt"
    file.write_text("a,1,2024-03-01\nb,2,not a day\n", encoding="utf-8")
    ddl = "user_id STRING, sku_id INT, create_date DATE"
    assert rows(tables.read_delimited(spark, str(file), ddl)) == [("a", 1, day(1)), ("b", 2, None)]
    literal = tables.rows_table(spark, [("a", 1, "2024-03-01"), ("b", "2", "?")], ddl)
    assert rows(literal) == [("a", 1, day(1)), ("b", 2, None)]
    assert rows(tables.rows_table(spark, [(1, 1900)], "sku_id STRING, new_price DECIMAL(16,2)")) == [("1", Decimal("1900.00"))]
