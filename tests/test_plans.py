"""Plans: what reaches the scan, what is shuffled, and that hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import groups, intervals, lookup, scan, tasks
from tidemark.plans import loads, registry

QUERIES = registry.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    """The plan as it ran, without initial plans; subqueries have some of their own inside it."""
    df.collect()
    kept, initial = [], None
    for line in plan_of(df).split("\n"):
        indent = len(line) - len(line.lstrip(" :+-"))
        if initial is not None and indent >= initial:
            continue
        initial = indent if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


@pytest.fixture(scope="module")
def plans(spark, folder):
    """Plans with automatic broadcasts off: what is left would be a broadcast without a size check."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {name: plan_of(query(spark, folder)) for name, query in QUERIES.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_forced_broadcast_no_cross_join_no_python(plans, name):
    for node in ("Broadcast", "Cartesian", "NestedLoop", "Python", "Pandas", "MapInArrow"):
        assert node not in plans[name]


def test_single_partition_windows_only_over_days(plans):
    """Only totals are ordered in one task: daily ones, the last level of the overall peak, those of ranges."""
    lone = set()
    for name, plan in plans.items():
        for window in re.finditer(r"\n(.*)Window \[.*windowspecdefinition\(([^)]*)", plan):
            after = plan[window.end() :].split("\n", 4)
            if any("SinglePartition" in line for line in after[1:4]):
                lone.add(name)
    assert lone <= {"m17_rolling_3", "m17b_rolling_3_calendar", "m40_peak_online", "m40b_running_event_value"}


@pytest.mark.parametrize("name", ["m6_first_year_sales", "m9_best_day_per_sku", "m20_latest_3_orders", "m25_top3_per_category", "m33_last_price_change"])
def test_ranks_are_cut_before_the_shuffle(plans, name):
    assert re.search(r"WindowGroupLimit .*Partial", plans[name])


def test_joins_take_the_wanted_kind(plans):
    assert "LeftAnti" in plans["m14_friend_favourites"] and "LeftOuter" not in plans["m14_friend_favourites"]
    assert "LeftAnti" in plans["p5_14_took_none_of_teacher"]
    assert "LeftSemi" in plans["p4_1_all_below"]
    assert "FullOuter" in plans["m36b_favs_or_purchases"]


def test_one_scan(plans):
    for name in ("m35_same_month_two_years", "m32_week_pivot"):
        assert plans[name].count("lineitem.parquet") == 1
    for name in ("m40_peak_online", "h1_peak_per_room", "m22_overlapping_logins", "m38_checkin_coins"):
        assert plans[name].count("FileScan") == 1


@pytest.mark.parametrize(
    "name", ["p5_8_all_above", "p5_9_equal_scores", "p5_16_scores_with_avg", "m26_median_price", "m1_second_best_seller", "h2_sessionize", "m14_friend_favourites", "m37_user_levels"],
)
def test_a_table_used_twice_is_shuffled_once(spark, folder, small_pieces, name):
    assert "ReusedExchange" in final_plan_of(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name, column", [("m14_friend_favourites", "l_partkey"), ("m37_user_levels", "ts")])
def test_a_table_used_twice_is_read_once(spark, folder, small_pieces, name, column):
    plan = final_plan_of(QUERIES[name](spark, folder))
    assert len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan)) == 1


@pytest.mark.parametrize("name", ["m3_category_best_and_kinds", "m12_price_as_of", "m13_first_order_share"])
def test_aggregates_hash(plans, name):
    assert "HashAggregate" in plans[name] and "SortAggregate" not in plans[name]


def test_totals_per_item_do_not_join_orders(plans):
    for name in ("m1_second_best_seller", "m10_above_category_avg", "m24_sales_bands", "m25_top3_per_category"):
        assert "orders.parquet" not in plans[name]


def test_filters_and_columns_reach_the_scan(plans):
    assert "EqualTo(l_suppkey,1)" in plans["p3_1_course_total"]
    assert "In(l_suppkey, [1,2,3])" in plans["m18_bought_a_b_not_c"]
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01T00:00)" in plans["m32_week_pivot"]
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plans["m7_low_sellers"]
    assert "EqualTo(event_type,purchase)" in plans["m2_consecutive_order_days"]
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plans["m24_sales_bands"]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plans["m38_checkin_coins"]


def test_runs_of_days_shuffle_twice(plans):
    assert plans["h3_longest_streak_gap"].count("Exchange hashpartitioning") == 2


@pytest.fixture
def small_pieces(spark):
    """Thresholds so low that a test-sized hot key counts as skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_a_hot_join_key_is_split(spark, small_pieces):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), F.xxhash64("id").alias("v")
    )
    found = groups.with_group_avg(rows, "k", "v", "mean")
    assert len(found.collect()) == 200_000
    assert "skew=true" in plan_of(found)


def test_a_hot_session_key_is_spread(spark, small_pieces):
    """A third of the views belongs to one key: no task of the result holds nearly as many."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), (F.col("id") * 17).alias("ts")
    )
    found = intervals.sessionize(rows, "k", "ts", 60)
    sizes = [r["count"] for r in found.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 100_000 and max(sizes) < 50_000


def rows_read(df):
    """Rows that each task of the last stage before the result read, by a count per partition of it."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_a_running_total_without_a_key_is_spread(spark, small_pieces):
    """The lone task orders the totals of ranges; the rows of a range are ordered in a task of its own."""
    rows = spark.range(0, 100_000, 1, 8).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("at"))
    found = scan.running(rows, [], ["at", "id"], {"total": F.lit(1)})
    assert max(rows_read(found)) < 30_000
    assert found.filter("total = 100000").count() == 1
    before = plan_of(found).split("SinglePartition")
    assert len(before) == 2 and re.match(r"[^\n]*\n\s*[+:|\- ]*HashAggregate", before[1])


def test_a_hot_key_of_a_running_total_is_spread(spark, small_pieces):
    rows = spark.range(0, 100_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 97).alias("k"))
    assert max(rows_read(scan.numbered(rows, "k", ["id"], "number"))) < 30_000


def records_shuffled(df):
    """Rows that each exchange of the plan as it ran wrote."""
    df.collect()
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            waiting.append(node.plan())
        elif node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        waiting += [node.children().apply(k) for k in range(node.children().size())]
    return found


def test_the_offers_of_hot_friends_are_bitmaps(spark, small_pieces):
    """40 users know the same 40, each of whom has the same 2,000 items: not one of 3.2 million offers is shuffled."""
    edges = spark.range(40).select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(100), F.lit(139))).alias("b"))
    items = spark.range(100, 140).select(F.col("id").alias("u"), F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("i"))
    found = lookup.neighbour_items(edges.select("a", F.col("b").cast("long")), items.select("u", F.col("i").cast("long")), "a", "b", "u", "i")
    assert found.count() == 40 * 2000
    written = records_shuffled(found.groupBy().count())
    # The items themselves, and the result once more where it is compared with them; links and bitmaps are far fewer.
    assert max(written) <= 40 * 2000


def test_the_first_thousands_of_a_hot_key_take_two_stages(spark, small_pieces):
    """Half of the rows under one key and k = 5,000: the key's rows are first cut in parts."""
    rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    found = groups.top_k(rows, "k", [F.desc("id")], 5000)
    plan = plan_of(found)
    assert plan.count("Window [row_number") == 2 and re.search(r"hashpartitioning\(k#\d+L, _salt#\d+", plan)
    assert found.filter("k = 0").agg(F.count("*"), F.min("id"), F.max("rk")).first() == (5000, 199_998 - 2 * 4999, 5000)


def test_bucketed_tables_join_without_a_shuffle(spark, folder, small_pieces):
    lines, orders = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("lineitem", "orders"))
    left, right = loads.bucketed(lines, ["l_orderkey"], 4), loads.bucketed(orders, ["o_orderkey"], 4)
    met = left.join(right, F.col("l_orderkey") == F.col("o_orderkey"))
    plan = final_plan_of(met)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert met.count() == lines.count()


def test_the_price_of_each_line_meets_days_not_lines(plans):
    """Windows of the as-of join see one row per item and day; the lines only join their day."""
    plan = plans["m12b_price_on_order_day"]
    assert plan.count("Window [last") == 2
    for window in re.finditer(r"Window \[last.*?\n(.*?\n){6}", plan):
        assert "l_orderkey" not in window.group(0)


def test_bitmaps_are_built_where_the_long_lists_are(plans):
    """A bitmap has 4 KB however few its items are, so that only those of long lists are built, and not one by one shuffled."""
    lines = plans["m14_friend_favourites"].split("\n")
    built = [n for n, line in enumerate(lines) if "partial_bitmap_construct_agg" in line]
    assert built and not any("Exchange" in lines[n - 1] for n in built)


@pytest.mark.parametrize("name, by_session", [("m12b_price_on_order_day", {"sku_id", "_key"}), ("p5_9_equal_scores", set()), ("m29_selling_ranges", set())])
def test_tasks_follow_the_order_lines(spark, folder, small_pieces, monkeypatch, name, by_session):
    """With fewer rows a task than the tables have, no shuffle of lines keeps the partitions of the session.

    Lines meet the prices of their days in a join of the session's, which AQE can split.
    """
    few = sorted(map(tuple, QUERIES[name](spark, folder).collect()))
    monkeypatch.setattr(tasks, "ROWS", 200)
    found = QUERIES[name](spark, folder)
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert registry.Roles(spark, folder).tasks > session
    dealt = re.findall(r"Exchange (?:hash|range)partitioning\((\w+)#.*, (\d+)\)", plan_of(found))
    assert dealt and {key for key, parts in dealt if int(parts) <= session} == by_session
    assert sorted(map(tuple, found.collect())) == few
