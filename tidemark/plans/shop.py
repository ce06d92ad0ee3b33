"""Shop analyses on orders, order lines, items, prices, favourites and friends.

Order lines carry `amount`, the line total. Wherever a hot item, category or
user could hold a large part of the rows, totals per item (or per user and day)
are built first and only those are ranked, joined and compared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import band, between, date, in_year, month_start, percent_text, share
from tidemark.operators import days, groups, lookup, scan
from tidemark.operators.tasks import more_tasks

# Spend bands of the membership levels, (upper bound, label) and the top label.
VIP_BANDS = [
    (10000, "普通会员"),
    (30000, "青铜会员"),
    (50000, "白银会员"),
    (80000, "黄金会员"),
    (100000, "白金会员"),
]
VIP_TOP = "钻石会员"
# Bands of pieces sold, (upper bound, label) and the top label.
SALES_BANDS = [(5000, "冷门商品"), (19999, "一般商品")]
SALES_TOP = "热门商品"

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def with_amount(lines: DataFrame) -> DataFrame:
    """Order lines with a unit price get their total as `amount`."""
    return lines.withColumn("amount", F.col("price") * F.col("sku_num"))


def with_buyer(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines that only name their order get its user."""
    return lines.join(orders.select("order_id", "user_id"), "order_id")


def pieces(lines: DataFrame) -> DataFrame:
    """Pieces sold per item."""
    return lines.groupBy("sku_id").agg(F.sum("sku_num").alias("sum_num"))


# -- best sellers -------------------------------------------------------------


def nth_best_seller(lines: DataFrame, n: int = 2, ties: str = "dense_rank", or_null: bool = False) -> DataFrame:
    return groups.nth_value_rows(pieces(lines), "sum_num", n, ties, or_null).select("sku_id")


def category_best_and_kinds(lines: DataFrame, sku: DataFrame, category: DataFrame) -> DataFrame:
    """Best seller of every category, the lowest id of equals, and the number of items sold in it."""
    sold = pieces(lines).join(sku.select("sku_id", "category_id"), "sku_id")
    equals = sold.groupBy("category_id", "sum_num").agg(F.min("sku_id").alias("sku_id"), F.count("sku_id").alias("n"))
    best = equals.groupBy("category_id").agg(
        F.max_by("sku_id", "sum_num").alias("sku_id"), F.max("sum_num").alias("order_num"), F.sum("n").alias("order_cnt")
    )
    named = best.join(sku.select("sku_id", "name"), "sku_id").join(category, "category_id")
    return named.select("category_id", "category_name", "sku_id", "name", "order_num", "order_cnt")


def top_per_category(lines: DataFrame, sku: DataFrame, k: int = 3) -> DataFrame:
    sold = pieces(lines).join(sku.select("sku_id", "category_id"), "sku_id")
    best = groups.top_k(sold, "category_id", [F.desc("sum_num"), F.asc("sku_id")], k)
    return best.select("sku_id", "category_id")


def largest_lines(lines: DataFrame, by: str, k: int) -> DataFrame:
    """The k order lines of the highest totals per shop or item, equal ones by order and item."""
    order = [F.desc("amount"), F.asc("order_id"), F.asc("sku_id"), F.asc("sku_num")]
    return groups.top_k(lines.select(by, "order_id", "sku_id", "sku_num", "amount"), by, order, k)


def most_ordered_per_category(lines: DataFrame, sku: DataFrame, k: int = 3, ties: str = "rank") -> DataFrame:
    """Items on the first k ranks of their category by order lines; equal counts share a rank."""
    ordered = lines.groupBy("sku_id").agg(F.count("*").alias("order_cnt"))
    counted = ordered.join(sku.select("sku_id", "category_id"), "sku_id")
    best = groups.top_k(counted, "category_id", [F.desc("order_cnt")], k, ties)
    return best.select("category_id", "sku_id", "order_cnt", "rk")


def above_category_average(lines: DataFrame, sku: DataFrame) -> DataFrame:
    sold = pieces(lines).join(sku.select("sku_id", "name", "category_id"), "sku_id")
    rows = groups.with_group_avg(sold, "category_id", "sum_num", "cate_avg_num")
    return rows.filter(F.col("sum_num") > F.col("cate_avg_num")).select("sku_id", "name", "sum_num", "cate_avg_num")


def sales_bands(
    lines: DataFrame, bands: Sequence[tuple[object, str]] = SALES_BANDS, top: str = SALES_TOP
) -> DataFrame:
    """Number of items per band of pieces sold; the upper bounds belong to their band."""
    label = band(F.col("sum_num"), bands, top, inclusive=True)
    return pieces(lines).groupBy(label.alias("category")).agg(F.count("sku_id").alias("cn"))


def low_sellers(lines: DataFrame, sku: DataFrame, year: int, under: int, today: str, min_days: int = 30) -> DataFrame:
    """Items selling less than ``under`` pieces in a year, unless on sale for too short a time."""
    recent = sku.filter(F.datediff(date(today), "from_date") < min_days).select("sku_id")
    sold = pieces(lines.filter(in_year(F.col("create_date"), year))).filter(F.col("sum_num") < under)
    return (
        groups.not_in(sold, "sku_id", recent)
        .join(sku.select("sku_id", "name"), "sku_id")
        .select("sku_id", "name", F.col("sum_num").alias("order_amount"))
    )


# -- sales over time ----------------------------------------------------------


def first_year_sales(lines: DataFrame) -> DataFrame:
    yearly = lines.groupBy("sku_id", F.year("create_date").alias("first_year")).agg(
        F.sum("sku_num").alias("order_num"), F.sum("amount").alias("order_amount")
    )
    return groups.top_k(yearly, "sku_id", [F.asc("first_year")], 1).drop("rk")


def yearly_sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy("sku_id", F.year("create_date").alias("year_date")).agg(F.sum("amount").alias("sku_sum"))


def best_day_per_sku(lines: DataFrame) -> DataFrame:
    """Day of the most pieces, the earliest of equals."""
    daily = lines.groupBy("sku_id", "create_date").agg(F.sum("sku_num").alias("sum_num"))
    return groups.top_k(daily, "sku_id", [F.desc("sum_num"), F.asc("create_date")], 1).drop("rk")


def rolling_sales(orders: DataFrame, rows: int = 3, calendar: bool = False, digits: int = 2) -> DataFrame:
    """Sum and average of the daily amounts over the last days with orders, or calendar days.

    The few daily sums are made decimal, so that the average rounds exactly.
    """
    daily = orders.groupBy("create_date").agg(F.sum("total_amount").cast("decimal(26,2)").alias("day_sum"))
    return days.rolling(daily, [], "create_date", "day_sum", rows, calendar).select(
        "create_date", F.round("rolling_sum", digits).alias("total_3d"), F.round("rolling_avg", digits).alias("avg_ad")
    )


def daily_by_gender(orders: DataFrame, user: DataFrame, male: str, female: str) -> DataFrame:
    rows = orders.join(user.select("user_id", "gender"), "user_id")
    gender = F.col("gender")
    return groups.pivot_sum(
        rows,
        "create_date",
        {"total_amount_male": gender == male, "total_amount_female": gender == female},
        F.col("total_amount"),
    )


def daily_difference(lines: DataFrame, item: str, a: object, b: object) -> DataFrame:
    per_day = groups.side_by_side(lines, "create_date", F.col(item), a, b, F.col("sku_num"))
    return per_day.select("create_date", (F.col("a") - F.col("b")).alias("diff")).orderBy("create_date")


def week_pivot(lines: DataFrame, monday: str, sunday: str) -> DataFrame:
    rows = lines.filter(between(F.col("create_date"), monday, sunday))
    weekday = F.weekday("create_date")
    columns = {name: weekday == number for number, name in enumerate(WEEKDAYS)}
    return groups.pivot_sum(rows, "sku_id", columns, F.col("sku_num"))


def same_month_two_years(lines: DataFrame, y1: int, y2: int) -> DataFrame:
    """Pieces per item and month in two years side by side, in one scan."""
    day = F.col("create_date")
    rows = lines.filter(in_year(day, y1) | in_year(day, y2)).withColumn("month", F.month(day))
    sums = groups.side_by_side(rows, ["sku_id", "month"], F.year(day), y1, y2, F.col("sku_num"))
    return sums.withColumnsRenamed({"a": "y1_skusum", "b": "y2_skusum"})


def target_two_months(lines: DataFrame, targets: DataFrame, item: str, months: int = 2) -> DataFrame:
    """Items whose monthly amount meets their target in consecutive months.

    ``targets`` has an item and its target; an item without target never qualifies.
    """
    monthly = lines.groupBy(item, month_start(F.col("create_date")).alias("month")).agg(F.sum("amount").alias("amount"))
    met = monthly.join(targets, item).filter(F.col("amount") >= F.col("target"))
    runs = days.islands(met, item, "month", unit="month")
    return runs.filter(F.col("n_points") >= months).select(item).distinct()


def days_over(lines: DataFrame, item: str, amount: float, n: int = 3) -> DataFrame:
    """Items with more than an amount on n consecutive days."""
    daily = lines.groupBy(item, "create_date").agg(F.sum("amount").alias("amount"))
    runs = days.islands(daily.filter(F.col("amount") > amount), item, "create_date")
    return runs.filter(F.col("n_points") >= n).select(item).distinct()


def selling_ranges(lines: DataFrame, tasks: int = 0) -> DataFrame:
    runs = days.islands(lines, "sku_id", "create_date", tasks=tasks)
    ranges = runs.select("sku_id", F.col("start").alias("start_date"), F.col("end").alias("end_date"))
    # A sort over ranges that are there already keeps to their number.
    if more_tasks(ranges, tasks):
        ranges = ranges.repartitionByRange(tasks, "sku_id", "start_date")
    return ranges.orderBy("sku_id", "start_date")


def sell_through(lines: DataFrame, sku: DataFrame, first: str, n_days: int = 7) -> DataFrame:
    """Per category and day the share of its items that sold, and one less that share."""
    last_day = F.date_add(date(first), n_days - 1)
    day = F.col("create_date")
    sold = lines.filter((day >= date(first)) & (day <= last_day)).select("sku_id", "create_date").distinct()
    sold = sold.join(sku.select("sku_id", "category_id"), "sku_id")
    dated = {f"_d{n}": day == F.date_add(date(first), n - 1) for n in range(1, n_days + 1)}
    counts = groups.pivot_sum(sold, "category_id", dated)
    totals = sku.groupBy("category_id").agg(F.count("*").alias("cn"))
    shares = []
    for n in range(1, n_days + 1):
        ratio = F.col(f"_d{n}") / F.col("cn")
        shares += [ratio.alias(f"day{n}_churn"), (1 - ratio).alias(f"day{n}_slow")]
    return counts.join(totals, "category_id").select("category_id", *shares)


# -- buyers -------------------------------------------------------------------


def consecutive_order_days(orders: DataFrame, n: int = 3) -> DataFrame:
    runs = days.islands(orders, "user_id", "create_date")
    return runs.filter(F.col("n_points") >= n).select("user_id").distinct()


def vip_level(orders: DataFrame, bands: Sequence[tuple[object, str]] = VIP_BANDS, top: str = VIP_TOP) -> DataFrame:
    spent = days.running_total(orders, "user_id", "create_date", F.col("total_amount"))
    return spent.select(
        "user_id",
        "create_date",
        F.col("so_far").alias("sum_so_far"),
        band(F.col("so_far"), bands, top).alias("vip_level"),
    )


def spent_so_far(orders: DataFrame) -> DataFrame:
    """Every order with what its user had spent up to and with it; orders of a day go by id."""
    running = scan.running(orders, "user_id", ["create_date", "order_id"], {"sum_so_far": F.col("total_amount")})
    return running.select("order_id", "user_id", "create_date", "sum_so_far")


def next_day_repeat_rate(orders: DataFrame) -> DataFrame:
    repeat = days.next_day_repeat(orders, "user_id", "create_date")
    return repeat.select(percent_text(F.col("share")).alias("percentage"))


def first_order_share(delivery: DataFrame, condition: Column, digits: int = 2) -> DataFrame:
    """Share of users whose first order satisfies a condition; equal days are split by order id.

    First the lowest order id of a day, then the first day: both aggregates hash.
    """
    met = delivery.select("user_id", "order_date", "order_id", F.coalesce(condition, F.lit(False)).alias("met"))
    daily = met.groupBy("user_id", "order_date").agg(F.min_by("met", "order_id").alias("met"))
    first = daily.groupBy("user_id").agg(F.min_by("met", "order_date").alias("met"))
    return first.agg(F.round(share(F.col("met")), digits).alias("percentage"))


def latest_orders(orders: DataFrame, k: int = 3) -> DataFrame:
    newest = groups.top_k(orders, "user_id", [F.desc("create_date"), F.desc("order_id")], k)
    return newest.select("user_id", "order_id", "create_date")


def bought_but_not(lines: DataFrame, item: str, wanted: Sequence[object], unwanted: Sequence[object]) -> DataFrame:
    return groups.has_all_but(lines, "user_id", item, wanted, unwanted)


def first_last_count(lines: DataFrame, sku_ids: Sequence[object], at_least: int = 2) -> DataFrame:
    """First day, last day and number of purchases of some items, for users with several."""
    bought = lines.filter(F.col("sku_id").isin(*sku_ids)).groupBy("user_id")
    spans = bought.agg(
        F.min("create_date").alias("first_date"), F.max("create_date").alias("last_date"), F.count("*").alias("cn")
    )
    return spans.filter(F.col("cn") >= at_least)


# -- prices, favourites, friends ----------------------------------------------


def price_as_of(sku: DataFrame, price_change: DataFrame, at: str, default: object = 99) -> DataFrame:
    return lookup.as_of(sku.select("sku_id"), price_change, "sku_id", "change_date", at, "new_price", default).select(
        "sku_id", F.col("new_price").alias("price")
    )


def price_on_day(lines: DataFrame, price_change: DataFrame, default: object = 99, tasks: int = 0) -> DataFrame:
    """Every order line with the price its item had on the day of the order."""
    bought = lines.select("order_id", "sku_id", "create_date")
    return lookup.as_of_each(bought, price_change, "sku_id", "create_date", "change_date", "new_price", default, "price", tasks=tasks)


def last_price_change(price_change: DataFrame) -> DataFrame:
    change = lookup.last_change(price_change, "sku_id", "change_date", "new_price")
    return change.select("sku_id", F.col("change").alias("price_change")).orderBy("price_change", "sku_id")


def median_price(sku: DataFrame, digits: int = 1) -> DataFrame:
    """Exact median of the list price per category; cents keep the middle exact."""
    priced = sku.select("category_id", F.col("price").cast("decimal(16,2)").alias("price"))
    middle = groups.median(priced, "category_id", "price")
    return middle.select("category_id", F.round("median", digits).cast("double").alias("medprice"))


def median_amount(lines: DataFrame, by: str) -> DataFrame:
    """Exact median of the line totals per shop or item."""
    return groups.median(lines, by, "amount").select(by, F.col("median").alias("medamount"))


def friend_favourites(friendship: DataFrame, favor: DataFrame) -> DataFrame:
    return lookup.neighbour_items(friendship, favor, "user1_id", "user2_id", "user_id", "sku_id")


def favs_and_purchases(lines: DataFrame, favor: DataFrame, first: str, last: str, how: str = "inner") -> DataFrame:
    """Pieces and favourites per item in a period; ``how='full'`` keeps items with one of them."""
    bought = pieces(lines.filter(between(F.col("create_date"), first, last)))
    marked = favor.filter(between(F.col("create_date"), first, last)).groupBy("sku_id")
    both = bought.join(marked.agg(F.count("*").alias("n")), "sku_id", how)
    return both.select(
        "sku_id", F.coalesce("sum_num", F.lit(0)).alias("sku_sum"), F.coalesce("n", F.lit(0)).alias("favor_cn")
    )
