"""Every analysis bound to the star schema, with the parameters that fit its data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, money
from tidemark.plans import activity, loads, school, shop
from tidemark.sources.roles import Roles
from tidemark.sources.tables import preview

Query = Callable[[Roles], DataFrame]

# Parameters of the bound queries.
COURSE_NAME = "Supplier#000000001"
TEACHER = "NATION_3"
# Money of the star schema is in cents.
VIP = (
    [
        (100_000_000, "none"),
        (150_000_000, "bronze"),
        (200_000_000, "silver"),
        (250_000_000, "gold"),
        (300_000_000, "platinum"),
    ],
    "diamond",
)
BANDS = ([(631, "cold"), (890, "normal")], "hot")
LEVELS = {"lost": "lost", "loyal": "loyal", "fresh": "new", "dormant": "dormant"}

PREVIEW: dict[str, Query] = {
    "p1_preview_student": lambda r: preview(r.student(), ["stu_id"]),
    "p1_preview_course": lambda r: preview(r.course(), ["course_id"]),
    "p1_preview_teacher": lambda r: preview(r.teacher(), ["tea_id"]),
    "p1_preview_score": lambda r: preview(r.score(), ["stu_id", "course_id"]),
}

SCHOOL: dict[str, Query] = {
    "p2_1_name_contains": lambda r: school.name_contains(r.table("part"), "p_name", "ring"),
    "p2_2_prefix_count": lambda r: school.prefix_count(r.table("part"), "p_name", "small"),
    "p2_3_filtered_sorted": lambda r: school.course_scores_below(r.score(), 1, 30),
    "p2_4_failed_in_course": lambda r: school.failed_in_course(r.student(), r.course(), r.score(), COURSE_NAME, 30),
    "p3_1_course_total": lambda r: school.course_total(r.score(), 1),
    "p3_2_distinct_takers": lambda r: school.distinct_takers(r.score()),
    "p3_3_course_max_min": lambda r: school.course_max_min(r.score()),
    "p3_4_course_takers": lambda r: school.course_takers(r.score()),
    "p3_5_two_way_count": lambda r: school.two_way_count(r.student(), "BUILDING", "MACHINERY"),
    "p3_6_avg_having": lambda r: school.students_averaging_over(r.score(), 28),
    "p3_7_min_course_count": lambda r: school.students_with_courses(r.score(), 45),
    "p3_8_shared_first_char": lambda r: school.shared_first_char(r.table("part"), "p_name"),
    "p3_9_avg_two_key_sort": lambda r: school.course_averages(r.score()),
    "p3_10_course_min_takers": lambda r: school.courses_with_takers(r.score(), 500),
    "p3_11_total_sorted": lambda r: school.student_sums(r.score()),
    "p3_12_score_pivot": lambda r: school.score_pivot(
        r.course(), r.score(), {f"c{n}": f"Supplier#{n:09d}" for n in (1, 2, 3)}
    ),
    "p3_13_n_courses_incl": lambda r: school.students_with_n_courses(r.student(), r.score(), 33, including=1),
    "p4_1_all_below": lambda r: school.all_below(r.student(), r.score(), 30),
    "p4_2_not_all_courses": lambda r: school.not_all_courses(r.student(), r.course(), r.score()),
    "p4_3_exactly_n_courses": lambda r: school.students_with_n_courses(r.student(), r.score(), 33),
    "p5_1_two_fails_avg": lambda r: school.failing_averages(r.student(), r.score(), 10, at_least=8),
    "p5_2_student_totals": lambda r: school.student_totals(r.student(), r.score()),
    "p5_3_avg_above": lambda r: school.averages_above(r.student(), r.score(), 34),
    "p5_4_enrolment": lambda r: school.enrolment(r.student(), r.course(), r.score()),
    "p5_5_pass_fail_counts": lambda r: school.pass_fail_counts(r.course(), r.score(), 30),
    "p5_6_course_above": lambda r: school.course_above(r.student(), r.course(), r.score(), 1, 30),
    "p5_7_course_below_students": lambda r: school.course_below_students(r.student(), r.score(), 1, 30),
    "p5_8_all_above": lambda r: school.all_above_listing(r.student(), r.course(), r.score(), 10),
    "p5_9_equal_scores": lambda r: school.same_score_in_courses(r.score(), tasks=r.tasks),
    "p5_10_course_a_beats_b": lambda r: school.course_beats(r.score(), 1, 2),
    "p5_11_took_both": lambda r: school.took_both(r.student(), r.score(), 1, 2),
    "p5_11b_took_both_by_count": lambda r: school.took_both_by_count(r.student(), r.score(), 1, 2),
    "p5_12_took_all_of_teacher": lambda r: school.took_all_of(r.student(), r.course(), r.teacher(), r.score(), TEACHER),
    "p5_13_took_any_of_teacher": lambda r: school.took_any_of(r.student(), r.course(), r.teacher(), r.score(), TEACHER),
    "p5_13b_took_any_by_join": lambda r: school.took_any_of_by_join(
        r.student(), r.course(), r.teacher(), r.score(), TEACHER
    ),
    "p5_14_took_none_of_teacher": lambda r: school.took_none_of(
        r.student(), r.course(), r.teacher(), r.score(), TEACHER
    ),
    "p5_15_shares_course_with": lambda r: school.shares_course_with(r.student(), r.score(), 1),
    "p5_16_scores_with_avg": lambda r: school.scores_with_average(r.student(), r.course(), r.score()),
}

SHOP: dict[str, Query] = {
    "m1_second_best_seller": lambda r: shop.nth_best_seller(r.sold(), 2),
    "m1b_second_or_null": lambda r: shop.nth_best_seller(r.sold(), 2, ties="rank", or_null=True),
    "m2_consecutive_order_days": lambda r: shop.consecutive_order_days(r.purchase_day()),
    "m3_category_best_and_kinds": lambda r: shop.category_best_and_kinds(r.sold(), r.sku(), r.category()),
    "m4_vip_level": lambda r: _in_money(shop.vip_level(r.order_info(), *VIP), "sum_so_far"),
    "m5_next_day_repeat_rate": lambda r: shop.next_day_repeat_rate(r.purchase_day()),
    "m6_first_year_sales": lambda r: _in_money(shop.first_year_sales(r.order_detail()), "order_amount"),
    "m7_low_sellers": lambda r: shop.low_sellers(r.order_detail(), r.sku(), 1998, 60, "1999-01-10"),
    "m8_daily_new_users": lambda r: activity.daily_new_users(r.login(), "login_ts"),
    "m9_best_day_per_sku": lambda r: shop.best_day_per_sku(r.order_detail()),
    "m10_above_category_avg": lambda r: shop.above_category_average(r.sold(), r.sku()),
    "m11_user_overview": lambda r: _user_overview(r, "inner"),
    "m11b_user_overview_left": lambda r: _user_overview(r, "left"),
    "m12_price_as_of": lambda r: _in_money(shop.price_as_of(r.sku(), r.price_change(), "1995-06-01", 9900), "price"),
    "m13_first_order_share": lambda r: shop.first_order_share(r.delivery(), F.col("immediate")),
    "m14_friend_favourites": lambda r: shop.friend_favourites(r.friendship(), r.favor()),
    "m15_login_streaks": lambda r: activity.login_streaks(r.login_day(), "create_date"),
    "m16_daily_by_gender": lambda r: _in_money(
        shop.daily_by_gender(r.order_info(), r.user(), "BUILDING", "MACHINERY"),
        "total_amount_male",
        "total_amount_female",
    ),
    "m17_rolling_3": lambda r: _in_money(shop.rolling_sales(r.order_info(), digits=0), "total_3d", "avg_ad"),
    "m17b_rolling_3_calendar": lambda r: _in_money(
        shop.rolling_sales(r.order_info(), calendar=True, digits=0), "total_3d", "avg_ad"
    ),
    "m18_bought_a_b_not_c": lambda r: shop.bought_but_not(r.order_detail(), "shop_id", [1, 2], [3]),
    "m19_daily_difference": lambda r: shop.daily_difference(r.order_detail(), "sku_id", 1, 2),
    "m20_latest_3_orders": lambda r: shop.latest_orders(r.order_info()),
    "m21_max_login_gap": lambda r: activity.longest_login_gap(r.login_day(), "create_date", "2024-02-05"),
    "m22_overlapping_logins": lambda r: activity.overlapping_logins(r.login()),
    "m22b_overlapping_places": lambda r: activity.overlapping_logins(r.login(), distinct_place=True),
    "m23_target_two_months": lambda r: shop.target_two_months(r.order_detail(), r.target(), "shop_id"),
    "m24_sales_bands": lambda r: shop.sales_bands(r.sold(), *BANDS),
    "m25_top3_per_category": lambda r: shop.top_per_category(r.sold(), r.sku()),
    "m25b_most_ordered_rank": lambda r: shop.most_ordered_per_category(r.sold(), r.sku(), ties="rank"),
    "m25c_most_ordered_dense_rank": lambda r: shop.most_ordered_per_category(r.sold(), r.sku(), ties="dense_rank"),
    "m26_median_price": lambda r: shop.median_price(r.sku()),
    "m27_3day_sales_over": lambda r: shop.days_over(r.order_detail(), "shop_id", 10_000_000),
    "m28_day1_retention": lambda r: activity.day1_retention(r.login_day(), "create_date"),
    "m29_selling_ranges": lambda r: shop.selling_ranges(r.order_detail(), r.tasks),
    "m30_daily_logins_orders": lambda r: activity.daily_logins_and_orders(
        r.login_day(), "create_date", r.purchase_day()
    ),
    "m31_yearly_sales": lambda r: _in_money(shop.yearly_sales(r.order_detail()), "sku_sum"),
    "m32_week_pivot": lambda r: shop.week_pivot(r.order_detail(), "1998-06-01", "1998-06-07"),
    "m33_last_price_change": lambda r: _in_money(shop.last_price_change(r.price_change()), "price_change"),
    "m34_first_last_count": lambda r: shop.first_last_count(r.order_detail(), [1, 2, 3]),
    "m35_same_month_two_years": lambda r: shop.same_month_two_years(r.order_detail(), 1997, 1998),
    "m36_favs_and_purchases": lambda r: shop.favs_and_purchases(
        r.order_detail(), r.favor(), "1998-06-01", "1998-06-30"
    ),
    "m36b_favs_or_purchases": lambda r: shop.favs_and_purchases(
        r.order_detail(), r.favor(), "1998-06-01", "1998-06-30", how="full"
    ),
    "m37_user_levels": lambda r: activity.user_levels(r.login_day(), "create_date", 0, 2, LEVELS),
    "m38_checkin_coins": lambda r: activity.checkin_coins(r.login_day(), "create_date"),
    "m39_sell_through": lambda r: shop.sell_through(r.order_detail(), r.sku(), "1998-06-01"),
    "m40_peak_online": lambda r: activity.peak_online(r.login()),
}

ACTIVITY: dict[str, Query] = {
    "h1_peak_per_room": lambda r: activity.peak_per_room(r.live()),
    "h2_sessionize": lambda r: activity.page_sessions(r.page_view(), 21_600),
    "h3_longest_streak_gap": lambda r: activity.longest_streak(r.login_events(), "login_datetime"),
    "h4_union_of_intervals": lambda r: activity.promotion_days(r.promotion()),
}

# Further readings of the exercises that need other plans: a value for each row instead of each day or key.
ROWS: dict[str, Query] = {
    "m4b_spent_so_far": lambda r: _in_money(shop.spent_so_far(r.order_info()), "sum_so_far"),
    "m12b_price_on_order_day": lambda r: _in_money(shop.price_on_day(r.order_detail(), r.price_change(), 9900, r.tasks), "price"),
    "m25d_largest_lines": lambda r: _in_money(shop.largest_lines(r.sold_lines(), "line_status", 5000), "amount"),
    "m26b_median_line_amount": lambda r: shop.median_amount(r.sold(), "shop_id"),
    "m40b_running_event_value": lambda r: activity.running_value(r.table("events"), cents(F.col("value"))),
}

LOADS: dict[str, Query] = {
    "load_text_round_trip": lambda r: loads.text_round_trip(r.order_info()),
    "load_batches_twice": lambda r: loads.batches_twice(r.order_info(), 1997),
    "load_bucketed_scores": lambda r: loads.scores_from_buckets(r.table("lineitem"), r.table("orders")),
}


def _user_overview(r: Roles, how: str) -> DataFrame:
    overview = activity.user_overview(r.login(), "login_ts", r.order_info(), 2024, 1998, how)
    return _in_money(overview, "order_amount_year")


def _in_money(df: DataFrame, *columns: str) -> DataFrame:
    """The cents of the star schema as decimal amounts, once everything is summed."""
    return df.withColumns({column: money(F.col(column)) for column in columns})


def _bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(Roles(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query) for group in (PREVIEW, SCHOOL, SHOP, ACTIVITY, ROWS, LOADS) for name, query in group.items()}
