"""The bound queries as SQL for DuckDB, to check the Spark results against.

Where it is cheap the SQL takes another way than the Spark code: set operators
for semi- and anti-joins, self-joins for runs of days, expanded days for
coverage, counting joins for concurrency. Result types equal Spark's.
"""

from __future__ import annotations

import re

# Views shared by the statements; a statement gets those it mentions.
VIEWS = {
    "student": "SELECT c_custkey AS stu_id, c_name AS stu_name, c_mktsegment AS sex FROM customer",
    "course": "SELECT s_suppkey AS course_id, s_name AS course_name, s_nationkey AS tea_id FROM supplier",
    "teacher": "SELECT n_nationkey AS tea_id, n_name AS tea_name FROM nation",
    "score": """SELECT o_custkey AS stu_id, l_suppkey AS course_id, max(CAST(l_quantity AS INTEGER)) AS score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "usr": "SELECT c_custkey AS user_id, c_mktsegment AS gender FROM customer",
    "category": "SELECT DISTINCT p_brand AS category_id, p_brand AS category_name FROM part",
    "sku": """SELECT p_partkey AS sku_id, p_name AS name, p_brand AS category_id,
        DATE '1998-11-01' + p_size AS from_date, p_retailprice AS price FROM part""",
    "order_info": """SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS create_date,
        CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount FROM orders""",
    "order_detail": """SELECT l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id, l_suppkey AS shop_id,
        CAST(o_orderdate AS DATE) AS create_date, CAST(l_extendedprice AS DECIMAL(16,2)) AS amount,
        CAST(l_quantity AS INTEGER) AS sku_num FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "sku_total": "SELECT sku_id, CAST(sum(sku_num) AS BIGINT) AS total FROM order_detail GROUP BY sku_id",
    "line_count": """SELECT category_id, sku_id, count(*) AS order_cnt FROM order_detail JOIN sku USING (sku_id)
        GROUP BY ALL""",
    "login": """SELECT event_id, user_id, event_type AS ip_address, ts AS login_ts,
        ts + to_seconds(CAST(floor(value * 60) AS INTEGER)) AS logout_ts FROM events""",
    "price_change": """SELECT l_partkey AS sku_id, CAST(l_shipdate AS DATE) AS change_date,
        max(CAST(l_extendedprice AS DECIMAL(16,2))) AS new_price FROM lineitem GROUP BY ALL""",
    "delivery": """SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
        o_orderpriority = '1-URGENT' AS immediate FROM orders""",
    "friendship": """SELECT c_custkey AS user1_id, (c_custkey * 7 + 1) % (SELECT count(*) FROM customer) AS user2_id
        FROM customer""",
    "favor": """SELECT DISTINCT o_custkey AS user_id, l_partkey AS sku_id, CAST(l_shipdate AS DATE) AS create_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "event_day": "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS d FROM events",
    "login_day": "SELECT DISTINCT user_id, d FROM event_day",
    "purchase_day": "SELECT user_id, d FROM event_day WHERE event_type = 'purchase'",
    "view_day": "SELECT user_id, d FROM event_day WHERE event_type = 'view'",
    "page_view": """SELECT event_id, user_id, event_type AS page_id,
        CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS view_timestamp FROM events""",
    "promo": """SELECT o_custkey AS brand, CAST(o_orderdate AS DATE) AS start_date,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS end_date FROM orders""",
    "taught": "SELECT course_id FROM course JOIN teacher USING (tea_id) WHERE tea_name = 'NATION_3'",
}

PREVIEW = {
    "p1_preview_student": "SELECT * FROM student ORDER BY stu_id LIMIT 5",
    "p1_preview_course": "SELECT * FROM course ORDER BY course_id LIMIT 5",
    "p1_preview_teacher": "SELECT * FROM teacher ORDER BY tea_id LIMIT 5",
    "p1_preview_score": "SELECT * FROM score ORDER BY stu_id, course_id LIMIT 5",
}

SCHOOL = {
    "p2_1_name_contains": "SELECT * FROM part WHERE strpos(p_name, 'ring') > 0",
    "p2_2_prefix_count": "SELECT count(*) AS num FROM part WHERE left(p_name, 5) = 'small'",
    "p2_3_filtered_sorted": "SELECT * FROM score WHERE course_id = 1 AND NOT score >= 30",
    "p2_4_failed_in_course": """SELECT stu_id, stu_name, score FROM student JOIN score USING (stu_id)
        WHERE score < 30 AND course_id = (SELECT course_id FROM course WHERE course_name = 'Supplier#000000001')""",
    "p3_1_course_total": "SELECT CAST(sum(score) FILTER (course_id = 1) AS BIGINT) AS sum_score FROM score",
    "p3_2_distinct_takers": "SELECT count(*) AS stu_num FROM (SELECT DISTINCT stu_id FROM score)",
    "p3_3_course_max_min": """SELECT course_id, list_max(list(score)) AS max_score, list_min(list(score)) AS min_score
        FROM score GROUP BY course_id""",
    "p3_4_course_takers": """SELECT course_id, count(*) AS stu_num
        FROM (SELECT DISTINCT course_id, stu_id FROM score) GROUP BY course_id""",
    "p3_5_two_way_count": """SELECT count(*) FILTER (sex = 'BUILDING') AS male_num,
        count(*) FILTER (sex = 'MACHINERY') AS female_num FROM student""",
    "p3_6_avg_having": """SELECT * FROM (SELECT stu_id, avg(score) AS avg_score FROM score GROUP BY stu_id)
        WHERE avg_score > 28""",
    "p3_7_min_course_count": """SELECT stu_id FROM (SELECT stu_id, len(list(course_id)) AS n FROM score GROUP BY stu_id)
        WHERE n >= 45""",
    "p3_8_shared_first_char": """SELECT * FROM (SELECT left(p_name, 1) AS first_name, count(*) AS name_num
        FROM part GROUP BY ALL) WHERE name_num > 1""",
    "p3_9_avg_two_key_sort": "SELECT course_id, avg(score) AS avg_score FROM score GROUP BY ALL ORDER BY 2, 1 DESC",
    "p3_10_course_min_takers": """SELECT * FROM (SELECT course_id, count(*) AS num FROM score GROUP BY ALL)
        WHERE num >= 500""",
    "p3_11_total_sorted": """SELECT stu_id, CAST(sum(score) AS BIGINT) AS sum_score FROM score
        GROUP BY ALL ORDER BY sum_score DESC, stu_id""",
    "p3_12_score_pivot": """SELECT stu_id,
        CAST(coalesce(sum(score) FILTER (course_name = 'Supplier#000000001'), 0) AS BIGINT) AS c1,
        CAST(coalesce(sum(score) FILTER (course_name = 'Supplier#000000002'), 0) AS BIGINT) AS c2,
        CAST(coalesce(sum(score) FILTER (course_name = 'Supplier#000000003'), 0) AS BIGINT) AS c3,
        count(*) AS course_cnt, avg(score) AS avg_score
        FROM score JOIN course USING (course_id) GROUP BY stu_id""",
    "p3_13_n_courses_incl": """SELECT stu_id, stu_name FROM student JOIN
        (SELECT stu_id, list(course_id) AS taken FROM score GROUP BY stu_id) USING (stu_id)
        WHERE len(taken) = 33 AND list_contains(taken, 1)""",
    "p4_1_all_below": """SELECT stu_id, stu_name FROM student JOIN
        (SELECT stu_id, max(score) AS best FROM score GROUP BY stu_id) USING (stu_id) WHERE best < 30""",
    "p4_2_not_all_courses": """SELECT stu_id, stu_name FROM student s WHERE EXISTS (
        SELECT course_id FROM course EXCEPT SELECT course_id FROM score WHERE score.stu_id = s.stu_id)""",
    "p4_3_exactly_n_courses": """SELECT s.stu_id, s.stu_name FROM student s
        WHERE (SELECT count(*) FROM score c WHERE c.stu_id = s.stu_id) = 33""",
    "p5_1_two_fails_avg": """SELECT * FROM (SELECT stu_id, avg(score) AS avg_score FROM score GROUP BY stu_id)
        WHERE stu_id IN (SELECT stu_id FROM score WHERE score < 10 GROUP BY stu_id HAVING count(*) >= 8)""",
    "p5_2_student_totals": """SELECT s.stu_id, s.stu_name,
        (SELECT count(*) FROM score c WHERE c.stu_id = s.stu_id) AS course_count,
        CAST((SELECT sum(score) FROM score c WHERE c.stu_id = s.stu_id) AS BIGINT) AS sum_score FROM student s""",
    "p5_3_avg_above": """SELECT stu_id, any_value(stu_name) AS stu_name, avg(score) AS avg_score
        FROM score JOIN student USING (stu_id) GROUP BY stu_id HAVING sum(score) > 34 * count(*)""",
    "p5_4_enrolment": """SELECT stu_id, stu_name, course_id, course_name
        FROM student NATURAL JOIN score NATURAL JOIN course""",
    "p5_5_pass_fail_counts": """SELECT course_id, course_name, count(*) FILTER (score >= 30) AS pass_cnt,
        count(*) FILTER (score < 30) AS fail_cnt FROM course JOIN score USING (course_id) GROUP BY ALL""",
    "p5_6_course_above": """SELECT stu_id, stu_name, course_id, course_name, score
        FROM student NATURAL JOIN score NATURAL JOIN course WHERE course_id = 1 AND score > 30""",
    "p5_7_course_below_students": """SELECT student.*, score FROM student JOIN score USING (stu_id)
        WHERE course_id = 1 AND score < 30""",
    "p5_8_all_above": """SELECT stu_name, course_name, score FROM student NATURAL JOIN score NATURAL JOIN course
        WHERE stu_id NOT IN (SELECT stu_id FROM score WHERE score <= 10)""",
    "p5_9_equal_scores": """SELECT a.stu_id, a.course_id, a.score, count(*) AS pairs FROM score a JOIN score b
        ON a.stu_id = b.stu_id AND a.score = b.score AND a.course_id <> b.course_id GROUP BY ALL""",
    "p5_10_course_a_beats_b": """SELECT stu_id FROM (PIVOT (FROM score WHERE course_id IN (1, 2))
        ON course_id IN (1, 2) USING max(score) GROUP BY stu_id) WHERE "1" > "2" """,
    "p5_11_took_both": """SELECT stu_id, stu_name FROM student NATURAL JOIN
        (SELECT stu_id FROM score WHERE course_id = 1 INTERSECT SELECT stu_id FROM score WHERE course_id = 2)""",
    "p5_11b_took_both_by_count": """SELECT stu_id, stu_name FROM student NATURAL JOIN
        (SELECT stu_id FROM score GROUP BY stu_id HAVING list_has_all(list(course_id), [1, 2]))""",
    "p5_12_took_all_of_teacher": """SELECT stu_id, stu_name FROM student s WHERE NOT EXISTS (
        SELECT course_id FROM taught EXCEPT SELECT course_id FROM score WHERE score.stu_id = s.stu_id)""",
    "p5_13_took_any_of_teacher": """SELECT stu_id, stu_name FROM student s
        WHERE EXISTS (FROM score c JOIN taught USING (course_id) WHERE c.stu_id = s.stu_id)""",
    "p5_13b_took_any_by_join": """SELECT DISTINCT stu_id, stu_name
        FROM student NATURAL JOIN score NATURAL JOIN taught""",
    "p5_14_took_none_of_teacher": """SELECT stu_id, stu_name FROM student EXCEPT
        SELECT stu_id, stu_name FROM student NATURAL JOIN score NATURAL JOIN taught""",
    "p5_15_shares_course_with": """SELECT DISTINCT s.stu_id, s.stu_name FROM student s
        JOIN score mine ON mine.stu_id = s.stu_id
        JOIN score x ON x.course_id = mine.course_id AND x.stu_id = 1 WHERE s.stu_id <> 1""",
    "p5_16_scores_with_avg": """SELECT stu_id, stu_name, course_id, course_name, score,
        avg(score) OVER (PARTITION BY stu_id) AS avg_score FROM student NATURAL JOIN score NATURAL JOIN course""",
}

SHOP = {
    "m1_second_best_seller": """SELECT sku_id FROM sku_total WHERE total =
        (SELECT max(total) FROM sku_total WHERE total < (SELECT max(total) FROM sku_total))""",
    "m1b_second_or_null": """SELECT sku_id FROM (SELECT 1) LEFT JOIN (SELECT sku_id FROM sku_total t
        WHERE (SELECT count(*) FROM sku_total o WHERE o.total > t.total) = 1) ON true""",
    "m2_consecutive_order_days": """SELECT DISTINCT a.user_id FROM purchase_day a
        JOIN purchase_day b ON b.user_id = a.user_id AND b.d = a.d + 1
        JOIN purchase_day c ON c.user_id = a.user_id AND c.d = a.d + 2""",
    "m3_category_best_and_kinds": """SELECT category_id, any_value(category_name) AS category_name,
        first(sku_id ORDER BY total DESC, sku_id) AS sku_id, first(name ORDER BY total DESC, sku_id) AS name,
        max(total) AS order_num, count(DISTINCT sku_id) AS order_cnt
        FROM sku_total NATURAL JOIN sku NATURAL JOIN category GROUP BY category_id""",
    "m4_vip_level": """SELECT user_id, create_date, CAST(so_far AS DECIMAL(26,2)) AS sum_so_far,
        CASE WHEN so_far >= 3000000 THEN 'diamond' WHEN so_far >= 2500000 THEN 'platinum' WHEN so_far >= 2000000
        THEN 'gold' WHEN so_far >= 1500000 THEN 'silver' WHEN so_far >= 1000000 THEN 'bronze' ELSE 'none' END AS vip_level
        FROM (SELECT d.user_id, d.create_date, sum(o.total_amount) AS so_far
            FROM (SELECT DISTINCT user_id, create_date FROM order_info) d
            JOIN order_info o ON o.user_id = d.user_id AND o.create_date <= d.create_date GROUP BY ALL)""",
    "m5_next_day_repeat_rate": """SELECT concat(round(count(p.d) / count(*) * 100, 1), '%') AS percentage
        FROM (SELECT user_id, min(d) AS d1 FROM purchase_day GROUP BY user_id) f
        LEFT JOIN purchase_day p ON p.user_id = f.user_id AND p.d = f.d1 + 1""",
    "m6_first_year_sales": """SELECT sku_id, CAST(y AS INTEGER) AS first_year, CAST(sum(sku_num) AS BIGINT) AS order_num,
        CAST(sum(amount) AS DECIMAL(26,2)) AS order_amount
        FROM (SELECT *, year(create_date) AS y FROM order_detail)
        JOIN (SELECT sku_id, min(year(create_date)) AS y FROM order_detail GROUP BY sku_id) USING (sku_id, y)
        GROUP BY sku_id, y""",
    "m7_low_sellers": """SELECT sku_id, name, CAST(sum(sku_num) AS BIGINT) AS order_amount
        FROM order_detail JOIN sku USING (sku_id)
        WHERE year(create_date) = 1998 AND from_date <= DATE '1999-01-10' - 30
        GROUP BY ALL HAVING sum(sku_num) < 60""",
    "m8_daily_new_users": """SELECT CAST(f AS DATE) AS login_date_first, count(*) AS user_count
        FROM (SELECT user_id, min(login_ts) AS f FROM login GROUP BY user_id) GROUP BY ALL""",
    "m9_best_day_per_sku": """SELECT sku_id, first(create_date ORDER BY n DESC, create_date) AS create_date, max(n) AS sum_num
        FROM (SELECT sku_id, create_date, CAST(sum(sku_num) AS BIGINT) AS n FROM order_detail GROUP BY ALL)
        GROUP BY sku_id""",
    "m10_above_category_avg": """SELECT sku_id, name, total AS sum_num, avg(total) OVER (PARTITION BY category_id) AS cate_avg_num
        FROM sku_total JOIN sku USING (sku_id) QUALIFY total > cate_avg_num""",
    "m11_user_overview": """SELECT user_id, min(CAST(login_ts AS DATE)) AS register_date, count(*) AS total_login_count,
        count(*) FILTER (year(login_ts) = 2024) AS login_count_year, any_value(n) AS order_count_year,
        any_value(a) AS order_amount_year
        FROM login JOIN (SELECT user_id, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(26,2)) AS a FROM order_info
            WHERE year(create_date) = 1998 GROUP BY user_id) USING (user_id)
        GROUP BY user_id HAVING login_count_year > 0""",
    "m11b_user_overview_left": """SELECT user_id, min(CAST(login_ts AS DATE)) AS register_date, count(*) AS total_login_count,
        count(*) FILTER (year(login_ts) = 2024) AS login_count_year, coalesce(any_value(n), 0) AS order_count_year,
        CAST(coalesce(any_value(a), 0) AS DECIMAL(26,2)) AS order_amount_year
        FROM login LEFT JOIN (SELECT user_id, count(*) AS n, sum(total_amount) AS a FROM order_info
            WHERE year(create_date) = 1998 GROUP BY user_id) USING (user_id) GROUP BY user_id""",
    "m12_price_as_of": """SELECT s.sku_id, CAST(coalesce(p.new_price, 99) AS DECIMAL(26,2)) AS price
        FROM (SELECT sku_id, DATE '1995-06-01' AS at FROM sku) s
        ASOF LEFT JOIN price_change p ON s.sku_id = p.sku_id AND s.at >= p.change_date""",
    "m13_first_order_share": """SELECT round(avg(CAST(f AS INTEGER)), 2) AS percentage
        FROM (SELECT first(immediate ORDER BY order_date, order_id) AS f FROM delivery GROUP BY user_id)""",
    "m14_friend_favourites": """WITH both_ways AS (
            SELECT user1_id AS u, user2_id AS f FROM friendship UNION SELECT user2_id, user1_id FROM friendship)
        SELECT u AS user_id, sku_id FROM both_ways JOIN favor ON favor.user_id = f
        EXCEPT SELECT user_id, sku_id FROM favor""",
    "m15_login_streaks": """SELECT user_id, min(d) AS start_date, max(d) AS end_date FROM
        (SELECT user_id, d, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM login_day)
        GROUP BY user_id, g HAVING count(*) >= 2""",
    "m16_daily_by_gender": """SELECT create_date,
        CAST(coalesce(sum(total_amount) FILTER (gender = 'BUILDING'), 0) AS DECIMAL(26,2)) AS total_amount_male,
        CAST(coalesce(sum(total_amount) FILTER (gender = 'MACHINERY'), 0) AS DECIMAL(26,2)) AS total_amount_female
        FROM order_info JOIN usr USING (user_id) GROUP BY create_date""",
    # Averages of whole cents, rounded half up in integers.
    "m17_rolling_3": """SELECT create_date, CAST(s / 100.0 AS DECIMAL(26,2)) AS total_3d,
        CAST((2 * s + n) // (2 * n) / 100.0 AS DECIMAL(26,2)) AS avg_ad
        FROM (SELECT create_date, sum(c) OVER w AS s, count(*) OVER w AS n
            FROM (SELECT create_date, CAST(sum(total_amount) * 100 AS BIGINT) AS c FROM order_info GROUP BY ALL)
            WINDOW w AS (ORDER BY create_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
    "m17b_rolling_3_calendar": """WITH daily AS (
            SELECT create_date, CAST(sum(total_amount) * 100 AS BIGINT) AS c FROM order_info GROUP BY ALL)
        SELECT create_date, CAST(s / 100.0 AS DECIMAL(26,2)) AS total_3d,
        CAST((2 * s + n) // (2 * n) / 100.0 AS DECIMAL(26,2)) AS avg_ad
        FROM (SELECT a.create_date, sum(b.c) AS s, count(*) AS n FROM daily a
            JOIN daily b ON b.create_date BETWEEN a.create_date - 2 AND a.create_date GROUP BY ALL)""",
    "m18_bought_a_b_not_c": """(SELECT user_id FROM order_detail WHERE shop_id = 1
        INTERSECT SELECT user_id FROM order_detail WHERE shop_id = 2)
        EXCEPT SELECT user_id FROM order_detail WHERE shop_id = 3""",
    "m19_daily_difference": """SELECT create_date,
        CAST(sum(CASE sku_id WHEN 1 THEN sku_num ELSE -sku_num END) AS BIGINT) AS diff
        FROM order_detail WHERE sku_id IN (1, 2) GROUP BY create_date""",
    "m20_latest_3_orders": """SELECT user_id, o.order_id, o.create_date FROM (SELECT user_id,
            unnest(list({'create_date': create_date, 'order_id': order_id}
                ORDER BY create_date DESC, order_id DESC)[1:3]) AS o
        FROM order_info GROUP BY user_id)""",
    "m21_max_login_gap": """SELECT user_id, CAST(max(coalesce(nxt, DATE '2024-02-05') - d) AS INTEGER) AS max_diff
        FROM (SELECT a.user_id, a.d, min(b.d) AS nxt FROM login_day a
            LEFT JOIN login_day b ON b.user_id = a.user_id AND b.d > a.d GROUP BY ALL) GROUP BY user_id""",
    "m22_overlapping_logins": """SELECT DISTINCT a.user_id FROM login a JOIN login b ON a.user_id = b.user_id
        AND a.event_id <> b.event_id AND a.login_ts <= b.login_ts AND a.logout_ts >= b.login_ts""",
    "m22b_overlapping_places": """SELECT DISTINCT a.user_id FROM login a JOIN login b ON a.user_id = b.user_id
        AND a.ip_address <> b.ip_address AND a.login_ts <= b.login_ts AND a.logout_ts >= b.login_ts""",
    "m23_target_two_months": """WITH met AS (SELECT shop_id, year(create_date) * 12 + month(create_date) AS m
            FROM order_detail GROUP BY ALL
            HAVING sum(amount) >= CASE shop_id % 3 WHEN 0 THEN 600000 WHEN 2 THEN 700000 END)
        SELECT DISTINCT a.shop_id FROM met a JOIN met b ON b.shop_id = a.shop_id AND b.m = a.m + 1""",
    "m24_sales_bands": """SELECT category, count(*) AS cn FROM (SELECT CASE WHEN total > 890 THEN 'hot'
        WHEN total > 631 THEN 'normal' ELSE 'cold' END AS category FROM sku_total) GROUP BY ALL""",
    "m25_top3_per_category": """SELECT unnest(list(sku_id ORDER BY total DESC, sku_id)[1:3]) AS sku_id, category_id
        FROM sku_total JOIN sku USING (sku_id) GROUP BY category_id""",
    "m25b_most_ordered_rank": """SELECT category_id, sku_id, order_cnt, CAST(1 + (SELECT count(*) FROM line_count o
        WHERE o.category_id = t.category_id AND o.order_cnt > t.order_cnt) AS INTEGER) AS rk
        FROM line_count t WHERE rk <= 3""",
    "m25c_most_ordered_dense_rank": """SELECT category_id, sku_id, order_cnt,
        CAST(list_position(top, order_cnt) AS INTEGER) AS rk
        FROM line_count JOIN (SELECT category_id, list_reverse_sort(list(DISTINCT order_cnt))[1:3] AS top
            FROM line_count GROUP BY ALL) USING (category_id) WHERE list_contains(top, order_cnt)""",
    # The middle two in whole cents; a tenth is ten cents, so their sum is rounded to twenties.
    "m26_median_price": """SELECT category_id, ((v[(n + 1) // 2] + v[n // 2 + 1] + 10) // 20) / 10.0::DOUBLE AS medprice
        FROM (SELECT category_id, count(*) AS n,
            list(CAST(CAST(price AS DECIMAL(16,2)) * 100 AS BIGINT) ORDER BY price) AS v FROM sku GROUP BY ALL)""",
    "m27_3day_sales_over": """WITH over AS (SELECT shop_id, create_date AS d FROM order_detail
            GROUP BY ALL HAVING sum(amount) > 100000)
        SELECT DISTINCT a.shop_id FROM over a JOIN over b ON b.shop_id = a.shop_id AND b.d = a.d + 1
        JOIN over c ON c.shop_id = a.shop_id AND c.d = a.d + 2""",
    "m28_day1_retention": """SELECT f.d1 AS first_login, count(*) AS register, count(p.d) / count(*) AS retention
        FROM (SELECT user_id, min(d) AS d1 FROM login_day GROUP BY user_id) f
        LEFT JOIN login_day p ON p.user_id = f.user_id AND p.d = f.d1 + 1 GROUP BY f.d1""",
    "m29_selling_ranges": """WITH sold AS (SELECT DISTINCT sku_id, create_date AS d FROM order_detail),
        opens AS (SELECT * FROM sold s WHERE NOT EXISTS (FROM sold p WHERE p.sku_id = s.sku_id AND p.d = s.d - 1)),
        closes AS (SELECT * FROM sold s WHERE NOT EXISTS (FROM sold p WHERE p.sku_id = s.sku_id AND p.d = s.d + 1))
        SELECT o.sku_id, o.d AS start_date, min(c.d) AS end_date
        FROM opens o JOIN closes c ON c.sku_id = o.sku_id AND c.d >= o.d GROUP BY ALL""",
    "m30_daily_logins_orders": """SELECT user_id, CAST(ts AS DATE) AS login_date,
        count(*) AS login_count, count(*) FILTER (event_type = 'purchase') AS order_count
        FROM events GROUP BY ALL""",
    "m31_yearly_sales": """SELECT sku_id, CAST(date_part('year', create_date) AS INTEGER) AS year_date,
        CAST(sum(amount) AS DECIMAL(26,2)) AS sku_sum FROM order_detail GROUP BY ALL""",
    "m32_week_pivot": "SELECT sku_id, "
    + ", ".join(
        f"CAST(coalesce(sum(sku_num) FILTER (isodow(create_date) = {n}), 0) AS BIGINT) AS {day}"
        for n, day in enumerate(
            ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"], start=1
        )
    )
    + " FROM order_detail WHERE create_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-07' GROUP BY sku_id",
    "m33_last_price_change": """SELECT sku_id, CAST(v[1] - coalesce(v[2], 0) AS DECIMAL(26,2)) AS price_change
        FROM (SELECT sku_id, list(new_price ORDER BY change_date DESC) AS v FROM price_change GROUP BY ALL)""",
    "m34_first_last_count": """SELECT user_id, min(create_date) AS first_date, max(create_date) AS last_date, count(*) AS cn
        FROM order_detail WHERE sku_id BETWEEN 1 AND 3 GROUP BY user_id HAVING count(*) > 1""",
    "m35_same_month_two_years": """SELECT sku_id, CAST(m AS INTEGER) AS month,
        CAST(coalesce(a.n, 0) AS BIGINT) AS y1_skusum, CAST(coalesce(b.n, 0) AS BIGINT) AS y2_skusum
        FROM (SELECT sku_id, month(create_date) AS m, sum(sku_num) AS n FROM order_detail
            WHERE year(create_date) = 1997 GROUP BY ALL) a
        FULL JOIN (SELECT sku_id, month(create_date) AS m, sum(sku_num) AS n FROM order_detail
            WHERE year(create_date) = 1998 GROUP BY ALL) b USING (sku_id, m)""",
    "m36_favs_and_purchases": """WITH june AS (SELECT sku_id, sku_num, 0 AS fav FROM order_detail
            WHERE create_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30' UNION ALL
            SELECT sku_id, NULL, 1 FROM favor WHERE create_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30')
        SELECT sku_id, CAST(sum(sku_num) AS BIGINT) AS sku_sum, CAST(sum(fav) AS BIGINT) AS favor_cn
        FROM june GROUP BY sku_id HAVING count(sku_num) > 0 AND sum(fav) > 0""",
    "m36b_favs_or_purchases": """WITH june AS (SELECT sku_id, sku_num, 0 AS fav FROM order_detail
            WHERE create_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30' UNION ALL
            SELECT sku_id, 0, 1 FROM favor WHERE create_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-30')
        SELECT sku_id, CAST(sum(sku_num) AS BIGINT) AS sku_sum, CAST(sum(fav) AS BIGINT) AS favor_cn
        FROM june GROUP BY sku_id""",
    "m37_user_levels": """WITH own AS (SELECT user_id, (SELECT max(d) FROM login_day) - max(d) AS quiet,
            (SELECT max(d) FROM login_day) - min(d) AS age FROM login_day GROUP BY user_id)
        SELECT CASE WHEN quiet >= 2 THEN 'lost' WHEN quiet <= 0 AND age >= 0 THEN 'loyal'
            WHEN age <= 0 THEN 'new' WHEN quiet >= 0 THEN 'dormant' END AS level, count(*) AS cn
        FROM own GROUP BY level""",
    "m38_checkin_coins": """WITH d AS (SELECT * FROM login_day),
        run AS (SELECT user_id, d, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM d),
        placed AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id, g ORDER BY d) - 1) % 7 + 1 AS p FROM run)
        SELECT user_id, CAST(sum(CASE p WHEN 3 THEN 3 WHEN 7 THEN 7 ELSE 1 END) AS BIGINT) AS sum_coin_cn
        FROM placed GROUP BY user_id""",
    "m39_sell_through": "SELECT category_id, "
    + ", ".join(
        f"any_value(c{n}) / any_value(cn) AS day{n}_churn, 1 - any_value(c{n}) / any_value(cn) AS day{n}_slow"
        for n in range(1, 8)
    )
    + " FROM (SELECT category_id, "
    + ", ".join(
        f"count(DISTINCT sku_id) FILTER (create_date = DATE '1998-06-0{n}') AS c{n}" for n in range(1, 8)
    )
    + """ FROM order_detail JOIN sku USING (sku_id)
        WHERE create_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-07' GROUP BY category_id)
        JOIN (SELECT category_id, count(*) AS cn FROM sku GROUP BY category_id) USING (category_id)
        GROUP BY category_id""",
    "m40_peak_online": """SELECT max(n) AS cn FROM (SELECT a.event_id, count(*) AS n FROM login a
        JOIN login b ON b.login_ts <= a.login_ts AND b.logout_ts > a.login_ts GROUP BY a.event_id)""",
}

ACTIVITY = {
    "h1_peak_per_room": """SELECT live_id, max(n) AS max_user_count FROM (
        SELECT a.ip_address AS live_id, a.event_id, count(*) AS n FROM login a JOIN login b
        ON a.ip_address = b.ip_address AND b.login_ts <= a.login_ts AND b.logout_ts > a.login_ts GROUP BY ALL)
        GROUP BY live_id""",
    "h2_sessionize": """WITH opens AS (SELECT DISTINCT user_id, view_timestamp AS t FROM page_view v
            WHERE NOT EXISTS (FROM page_view e WHERE e.user_id = v.user_id
                AND e.view_timestamp < v.view_timestamp AND e.view_timestamp > v.view_timestamp - 21600))
        SELECT v.user_id, v.page_id, v.view_timestamp, concat(v.user_id, '-', count(*)) AS session_id
        FROM page_view v JOIN opens o ON o.user_id = v.user_id AND o.t <= v.view_timestamp
        GROUP BY v.event_id, v.user_id, v.page_id, v.view_timestamp""",
    "h3_longest_streak_gap": """WITH opens AS (SELECT * FROM view_day s WHERE NOT EXISTS
            (FROM view_day p WHERE p.user_id = s.user_id AND p.d BETWEEN s.d - 2 AND s.d - 1)),
        closes AS (SELECT * FROM view_day s WHERE NOT EXISTS
            (FROM view_day p WHERE p.user_id = s.user_id AND p.d BETWEEN s.d + 1 AND s.d + 2))
        SELECT user_id, CAST(max(span) AS INTEGER) AS max_count_days
        FROM (SELECT o.user_id, o.d, min(c.d) - o.d + 1 AS span FROM opens o
            JOIN closes c ON c.user_id = o.user_id AND c.d >= o.d GROUP BY o.user_id, o.d) GROUP BY user_id""",
    "h4_union_of_intervals": """SELECT brand, count(DISTINCT d) AS promotion_day_count FROM (SELECT brand,
        unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM promo) GROUP BY brand""",
}

ROWS = {
    "m4b_spent_so_far": """SELECT order_id, user_id, create_date, CAST(sum(total_amount) OVER
            (PARTITION BY user_id ORDER BY create_date, order_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(26,2)) AS sum_so_far
        FROM order_info""",
    "m12b_price_on_order_day": """SELECT d.order_id, d.sku_id, d.create_date, CAST(coalesce(p.new_price, 99) AS DECIMAL(26,2)) AS price
        FROM order_detail d ASOF LEFT JOIN price_change p ON d.sku_id = p.sku_id AND d.create_date >= p.change_date""",
    "m25d_largest_lines": """SELECT l_linestatus AS line_status, l_orderkey AS order_id, l_partkey AS sku_id,
            CAST(l_quantity AS INTEGER) AS sku_num, CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(26,2)) AS amount,
            CAST(row_number() OVER (PARTITION BY l_linestatus ORDER BY CAST(l_extendedprice AS DECIMAL(16,2)) DESC,
                l_orderkey, l_partkey, l_quantity) AS INTEGER) AS rk
        FROM lineitem QUALIFY rk <= 5000""",
    "m26b_median_line_amount": """SELECT shop_id, (v[(n + 1) // 2] + v[n // 2 + 1]) / 2 AS medamount
        FROM (SELECT shop_id, count(*) AS n, list(CAST(amount * 100 AS BIGINT) ORDER BY amount) AS v FROM order_detail GROUP BY ALL)""",
    "m40b_running_event_value": """SELECT event_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER
            (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far FROM events""",
}

LOADS = {
    "load_text_round_trip": """WITH o AS (SELECT order_id, user_id, create_date, CAST(total_amount * 100 AS BIGINT) AS total_amount FROM order_info)
        SELECT order_id, user_id, create_date, total_amount, CAST(NULL AS VARCHAR) AS line FROM o WHERE order_id % 97 <> 0
        UNION ALL SELECT NULL, NULL, NULL, NULL, CASE WHEN order_id % 2 = 0 THEN concat_ws(chr(9), order_id, user_id, create_date)
            ELSE concat_ws(chr(9), order_id, user_id, 'someday', total_amount) END FROM o WHERE order_id % 97 = 0""",
    "load_batches_twice": """SELECT order_id, user_id, create_date, CAST(total_amount * 100 AS BIGINT) AS total_amount,
        CAST(year(create_date) AS INTEGER) AS batch FROM order_info""",
    "load_bucketed_scores": "SELECT * FROM score",
}


def _with_views(body: str) -> str:
    """Prefix a statement with the views it uses, directly or through other views."""
    wanted = [body]
    used: set[str] = set()
    while wanted:
        text = wanted.pop()
        for name in VIEWS.keys() - used:
            if re.search(rf"\b{name}\b", text):
                used.add(name)
                wanted.append(VIEWS[name])
    views = ", ".join(f"{name} AS ({view})" for name, view in VIEWS.items() if name in used)
    if not views:
        return body
    if body.lstrip().startswith("WITH "):
        return f"WITH {views}, {body.lstrip()[5:]}"
    return f"WITH {views} {body}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(body) for group in (PREVIEW, SCHOOL, SHOP, ACTIVITY, ROWS, LOADS) for name, body in group.items()}
