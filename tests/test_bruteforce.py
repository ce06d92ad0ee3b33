"""Operators against brute force: many random groups per Spark job, one group much larger."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import days, groups, intervals, lookup, scan
from tidemark.operators import tasks as tasks_of

EPOCH = datetime.datetime(2024, 2, 27)
MICRO = datetime.timedelta(microseconds=1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def result(df):
    return {r[0]: r[1] for r in df.collect()}


def random_times(rng, scale):
    return EPOCH + datetime.timedelta(microseconds=rng.randrange(10)) + scale * rng.randrange(40)


@pytest.fixture(scope="module")
def sessions(spark):
    """(key, place, start, end): steps from microseconds to days, so that levels and their borders are crossed."""
    rng = random.Random(5)
    scales = [MICRO, datetime.timedelta(seconds=1), datetime.timedelta(seconds=31), datetime.timedelta(minutes=17), datetime.timedelta(hours=5)]
    data = []
    for key in range(150):
        for _ in range(rng.choice([1, 2, 2, 3, 5, 8]) if key else 150):
            scale = rng.choice(scales)
            start = random_times(rng, scale)
            data.append((key, rng.choice("xyz"), start, start + scale * rng.choice([0, 0, 1, 2, 3, 9])))
    df = spark.createDataFrame(data, "k int, place string, s timestamp_ntz, e timestamp_ntz").repartition(7)
    return data, df


def by_key(data):
    grouped = {}
    for row in data:
        grouped.setdefault(row[0], []).append(row)
    return grouped


def open_at(rows_of_key, instant):
    return sum(1 for _, _, s, e in rows_of_key if s <= instant < e)


def test_peak(sessions):
    data, df = sessions
    expected = {
        key: max(open_at(own, t) for _, _, s, e in own for t in (s, e)) for key, own in by_key(data).items()
    }
    assert result(intervals.peak(df, "s", "e", "k")) == expected
    everything = max(open_at(data, t) for _, _, s, e in data for t in (s, e))
    assert [r.peak for r in intervals.peak(df, "s", "e").collect()] == [everything]
    assert everything <= len(data)


def test_peak_with_unknown_ends(spark):
    rng = random.Random(21)
    minute = datetime.timedelta(minutes=1)
    data = []
    for _ in range(300):
        start = EPOCH + minute * rng.randrange(4000)
        data.append((rng.randrange(5), "x", rng.choice([None, start, start]), rng.choice([None, start + minute * rng.randrange(1, 900)])))
    df = spark.createDataFrame(data, "k int, place string, s timestamp_ntz, e timestamp_ntz").repartition(5)
    known = [(k, p, s, e or datetime.datetime.max) for k, p, s, e in data if s is not None]
    for keys, groups_ in ((["k"], by_key(known)), ([], {None: known})):
        expected = {key: max(open_at(own, r[2]) for r in own) for key, own in groups_.items()}
        found = {r["k"] if keys else None: r["peak"] for r in intervals.peak(df, "s", "e", keys).collect()}
        assert found == expected


def test_peak_of_the_handmade_case(spark):
    at = lambda text: datetime.datetime.fromisoformat(f"2024-01-01T0{text}:00") if text else None
    rows = [(at("1:00"), at("5:00")), (at("2:00"), at("6:00")), (None, at("1:30")), (None, at("1:40"))]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    assert [r.peak for r in intervals.peak(df, "s", "e").collect()] == [2]


def test_overlaps(sessions):
    data, df = sessions

    def hit(own, places):
        return any(
            a[2] <= b[3] and b[2] <= a[3] and (not places or a[1] != b[1])
            for i, a in enumerate(own)
            for b in own[i + 1 :]
        )

    for place in (None, "place"):
        expected = sorted(key for key, own in by_key(data).items() if hit(own, place))
        assert 10 < len(expected) < 145
        assert sorted(r.k for r in intervals.overlaps(df, "k", "s", "e", place).collect()) == expected


def test_overlaps_of_unfinished_and_malformed_intervals(spark):
    rng = random.Random(16)
    minute = datetime.timedelta(minutes=1)
    data = []
    for key in range(400):
        for _ in range(rng.choice([2, 2, 3, 4])):
            start = EPOCH + minute * rng.randrange(12)
            end = rng.choice([None, start - minute, start, start + minute, start + 3 * minute])
            data.append((key, rng.choice(["x", "y", None]), start, end))
    df = spark.createDataFrame(data, "k int, place string, s timestamp_ntz, e timestamp_ntz").repartition(7)

    def hit(own, places):
        # Of intervals with one start, the longest comes first.
        own = sorted(own, key=lambda r: (r[2], -(r[3].timestamp() if r[3] else float("-inf"))))
        return any(
            a[3] is not None and a[3] >= b[2] and (not places or None not in (a[1], b[1]) and a[1] != b[1])
            for i, b in enumerate(own)
            for a in own[:i]
        )

    for place in (None, "place"):
        expected = sorted(key for key, own in by_key(data).items() if hit(own, place))
        assert 20 < len(expected) < 380
        assert sorted(r.k for r in intervals.overlaps(df, "k", "s", "e", place).collect()) == expected


def test_covered_days(spark):
    rng = random.Random(6)
    data = []
    for key in range(120):
        for _ in range(rng.choice([1, 2, 4, 7]) if key else 300):
            start = EPOCH.date() + datetime.timedelta(days=rng.randrange(60))
            data.append((key, start, start + datetime.timedelta(days=rng.choice([0, 0, 1, 3, 12, -1]))))
    df = spark.createDataFrame(data, "k int, s date, e date").repartition(7)
    covered = {}
    for key, s, e in data:
        covered.setdefault(key, set()).update(s.toordinal() + n for n in range((e - s).days + 1))
    found = result(intervals.covered_days(df, "k", "s", "e"))
    assert found == {key: len(held) for key, held in covered.items() if held}
    for key, s, e in data:
        assert found.get(key, 0) >= (e - s).days + 1


def test_sessions(spark):
    rng = random.Random(7)
    data = [(n, rng.choice([0, 0, 0, *range(30)]), 86400 * rng.choice([0, 0, 1, 5]) + rng.randrange(-900, 900)) for n in range(900)]
    df = spark.createDataFrame(data, "id int, k int, ts bigint").repartition(7)
    expected = {}
    for key in {k for _, k, _ in data}:
        number, before = 0, None
        for ts, n in sorted((ts, n) for n, k, ts in data if k == key):
            number += before is None or ts - before >= 60
            before = ts
            expected[n] = f"{key}-{number}"
    found = {r.id: r.session_id for r in intervals.sessionize(df, "k", "ts", 60).collect()}
    assert found == expected


@pytest.mark.parametrize("gap", [1, 2, 4])
def test_islands(spark, gap):
    rng = random.Random(gap)
    data = [(rng.choice([0, 0, 0, *range(40)]), EPOCH + datetime.timedelta(days=rng.randrange(50), hours=rng.randrange(24))) for _ in range(700)]
    df = spark.createDataFrame(data, "k int, at timestamp_ntz").repartition(7)
    expected, lengths, waits = [], {}, {}
    for key in {k for k, _ in data}:
        held = sorted({at.date() for k, at in data if k == key})
        run = [held[0]]
        runs = [run]
        for before, now in zip(held, held[1:]):
            if (now - before).days > gap:
                run = []
                runs.append(run)
            run.append(now)
        expected += [(key, r[0], r[-1], len(r), (r[-1] - r[0]).days + 1) for r in runs]
        lengths[key] = max((r[-1] - r[0]).days + 1 for r in runs)
        waits[key] = max((b - a).days for a, b in zip(held, [*held[1:], datetime.date(2024, 6, 1)]))
        assert sum(len(r) for r in runs) == len(held)
    assert rows(days.islands(df, "k", "at", max_gap=gap)) == sorted(expected, key=repr)
    assert result(days.longest_span(df, "k", "at", max_gap=gap)) == lengths
    assert result(days.max_gap(df, "k", "at", "2024-06-01")) == waits


def test_streak_reward(spark):
    data = [(n, EPOCH.date() + datetime.timedelta(days=d)) for n in range(1, 40) for d in range(n)]
    df = spark.createDataFrame(data, "k int, d date")
    expected = {}
    for n in range(1, 40):
        expected[n] = sum({3: 3, 7: 7}.get((d % 7) + 1, 1) for d in range(n))
    assert result(days.streak_reward(df, "k", "d", 7, {3: 2, 7: 6})) == expected


@pytest.mark.parametrize("cells, levels", [(2, 1), (3, 2), (64, 2)])
def test_median(spark, cells, levels):
    rng = random.Random(8)
    data = [(rng.choice([0, 0, 0, *range(60)]), rng.choice([rng.randrange(-5, 5), rng.randrange(200) / 4, 7.0]) * 1.0) for _ in range(1500)]
    df = spark.createDataFrame(data, "k int, v double").repartition(7)
    expected = {key: statistics.median(v for k, v in data if k == key) for key in {k for k, _ in data}}
    assert result(groups.median(df, "k", "v", cells, levels)) == expected


def test_equal_scores(spark):
    rng = random.Random(9)
    data = [(rng.choice([0, 0, *range(20)]), rng.randrange(6), rng.choice([None, *range(8)])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, item int, v int").repartition(7)
    expected = [a for a in data for b in data if a[0] == b[0] and a[1] != b[1] and a[2] is not None and a[2] == b[2]]
    assert rows(groups.equal_scores(df, "k", "item", "v", repeat=True)) == sorted(expected, key=repr)
    counted = {tuple(r)[:3]: r.pairs for r in groups.equal_scores(df, "k", "item", "v").collect()}
    assert counted == {row: expected.count(row) for row in set(expected)}


def test_set_logic(spark):
    rng = random.Random(10)
    data = [(rng.randrange(60), rng.choice([None, *range(6)])) for _ in range(250)]
    df = spark.createDataFrame(data, "k int, item int").repartition(7)
    everyone = spark.range(70).select(F.col("id").cast("int").alias("k"))
    held = {k: {i for kk, i in data if kk == k} for k in range(70)}
    for wanted in ([1], [0, 3], [1, 2, 5]):
        listed = spark.createDataFrame([(w,) for w in wanted], "item int")
        for items in (wanted, listed):
            got_all = {r.k for r in groups.has_all(df, "k", "item", items).collect()}
            got_any = {r.k for r in groups.has_any(df, "k", "item", items).collect()}
            got_none = {r.k for r in groups.has_none(everyone, df, "k", "item", items).collect()}
            assert got_all == {k for k, own in held.items() if own >= set(wanted)}
            assert got_any == {k for k, own in held.items() if own & set(wanted)}
            assert got_all <= got_any and got_any | got_none == set(held) and not got_any & got_none
        but = {r.k for r in groups.has_all_but(df, "k", "item", wanted, [4]).collect()}
        assert but == {k for k, own in held.items() if own >= set(wanted) and 4 not in own}


@pytest.mark.parametrize("ties", ["row_number", "rank", "dense_rank"])
def test_top_k(spark, ties):
    rng = random.Random(11)
    data = [(rng.choice([0, 0, 0, *range(15)]), rng.randrange(9), n) for n in range(300)]
    df = spark.createDataFrame(data, "k int, v int, id int").repartition(7)
    order = [F.desc("v"), F.asc("id")] if ties == "row_number" else [F.desc("v")]
    expected = []
    for key in {k for k, _, _ in data}:
        own = sorted((-v, n) for k, v, n in data if k == key)
        values = [v for v, _ in own]
        for place, (v, n) in enumerate(own, start=1):
            rank = {"row_number": place, "rank": values.index(v) + 1, "dense_rank": sorted(set(values)).index(v) + 1}[ties]
            if rank <= 3:
                expected.append((key, -v, n, rank))
    assert rows(groups.top_k(df, "k", order, 3, ties)) == sorted(expected, key=repr)


@pytest.mark.parametrize("ties", ["rank", "dense_rank"])
def test_nth_value(spark, ties):
    rng = random.Random(12)
    for size in (1, 4, 12):
        data = [(n, rng.choice([None, *range(5)])) for n in range(size)]
        df = spark.createDataFrame(data, "id int, v int")
        values = [v for _, v in data if v is not None]
        for nth in (1, 2, 3):
            def place(v):
                above = [o for o in values if o > v]
                return 1 + (len(above) if ties == "rank" else len(set(above)))

            expected = [(n, v) for n, v in data if v is not None and place(v) == nth]
            assert rows(groups.nth_value_rows(df, "v", nth, ties)) == sorted(expected, key=repr)
            assert rows(groups.nth_value_rows(df, "v", nth, ties, or_null=True)) == (sorted(expected, key=repr) or [(None, None)])


def test_lookups(spark):
    rng = random.Random(13)
    base = EPOCH.date()
    changes = {(rng.choice([0, 0, *range(20)]), base + datetime.timedelta(days=rng.randrange(30))): rng.randrange(100) for _ in range(150)}
    df = spark.createDataFrame([(k, d, v) for (k, d), v in changes.items()], "k int, d date, v int").repartition(7)
    dim = spark.range(25).select(F.col("id").cast("int").alias("k"))
    at = base + datetime.timedelta(days=9)
    as_of, change = {}, {}
    for key in range(25):
        own = sorted((d, v) for (k, d), v in changes.items() if k == key)
        past = [v for d, v in own if d <= at]
        as_of[key] = past[-1] if past else -1
        if own:
            change[key] = own[-1][1] - (own[-2][1] if len(own) > 1 else 0)
    assert result(lookup.as_of(dim, df, "k", "d", at.isoformat(), "v", -1)) == as_of
    assert result(lookup.last_change(df, "k", "d", "v")) == change


def test_neighbour_items(spark):
    rng = random.Random(14)
    edges = [(rng.randrange(15), rng.randrange(15)) for _ in range(40)]
    items = [(rng.randrange(15), rng.randrange(8)) for _ in range(60)]
    links = {(a, b) for x, y in edges for a, b in ((x, y), (y, x))}
    expected = {(a, i) for a, b in links for u, i in items if u == b} - set(items)
    found = lookup.neighbour_items(
        spark.createDataFrame(edges, "a int, b int"), spark.createDataFrame(items, "u int, i int"), "a", "b", "u", "i"
    )
    assert rows(found) == sorted(expected, key=repr)


def test_group_average_keeps_groups_without_name(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "k string, v int")
    assert rows(groups.with_group_avg(df, "k", "v", "mean")) == sorted([(None, 1, 2.0), (None, 3, 2.0), ("a", 5, 5.0)], key=repr)


def test_row_order_does_not_matter(spark):
    rng = random.Random(15)
    data = [(rng.randrange(5), EPOCH + datetime.timedelta(hours=rng.randrange(900))) for _ in range(200)]
    answers = []
    for _ in range(2):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, at timestamp_ntz").repartition(3)
        answers.append((rows(days.islands(df, "k", "at")), rows(days.retention(df, "k", "at"))))
    assert answers[0] == answers[1]


@pytest.mark.parametrize("kind", ["double", "long", "decimal(20,2)"])
def test_median_of_skewed_and_constant_values(spark, kind):
    """Values over many scales, one value alone, and half of all rows equal: no width fits them all."""
    rng = random.Random(3)
    data = [("wide", int(10 ** rng.uniform(0, 15)) * rng.choice([-1, 1])) for _ in range(901)]
    data += [("same", 7)] * 300 + [("half", 5)] * 200 + [("half", k * 1000) for k in range(200)] + [("one", -3), ("none", None), (None, 4), (None, 6)]
    df = spark.createDataFrame(data, "k string, v long").withColumn("v", F.col("v").cast(kind)).repartition(5)
    expected = {key: statistics.median(v for k, v in data if k == key) for key in {k for k, v in data if v is not None}}
    assert {k: float(v) for k, v in result(groups.median(df, "k", "v", 4)).items()} == expected


def spread(spark, rows=3000, parts=7):
    """Half of the rows under one key, ties in the place, nulls in key, place and value."""
    rng = random.Random(11)
    data = [
        (n, rng.choice([None, 1, 1, 1, 2, *range(3, 20)]), rng.choice([None, *range(200)]), rng.choice([None, *range(50)]))
        for n in range(rows)
    ]
    return data, spark.createDataFrame(data, "n int, k int, at int, v int").repartition(parts)


def in_place(row):
    return (row[2] is not None, row[2] or 0, row[0])


@pytest.mark.parametrize("parts", [1, 2, 40])
@pytest.mark.parametrize("keyed", [True, False])
def test_running_values_in_ranges(spark, parts, keyed):
    data, df = spread(spark)
    sums, last, number, expected = {}, {}, {}, {}
    for row in sorted(data, key=in_place):
        key = row[1] if keyed else 0
        sums[key] = sums.get(key, 0) + (row[3] or 0)
        last[key] = last.get(key) if row[3] is None else row[3]
        number[key] = number.get(key, -1) + 1
        expected[row[0]] = (sums[key], number[key], last[key])
    keys = "k" if keyed else []
    found = scan.running(df, keys, ["at", "n"], {"total": F.col("v")}, parts)
    assert {r["n"]: r["total"] for r in found.collect()} == {n: x[0] for n, x in expected.items()}
    found = scan.numbered(df, keys, ["at", "n"], "number", parts)
    assert {r["n"]: r["number"] for r in found.collect()} == {n: x[1] for n, x in expected.items()}
    found = scan.carried(df, keys, ["at", "n"], "v", "known", parts)
    assert {r["n"]: r["known"] for r in found.collect()} == {n: x[2] for n, x in expected.items()}
    assert scan.running(df.limit(0), keys, ["at", "n"], {"total": F.col("v")}, parts).collect() == []


def test_as_of_each_rows_own_day(spark):
    rng = random.Random(12)
    first = datetime.date(2024, 1, 28)
    day = lambda: rng.choice([None, *(first + datetime.timedelta(days=d) for d in range(0, 80, 3))])
    asked = [(n, rng.choice([None, 1, 1, 1, 2, 3, 4]), day()) for n in range(600)]
    changes = [(rng.choice([None, 1, 2, 3]), day(), rng.choice([None, *range(100)])) for _ in range(60)]
    expected = {}
    for n, key, at in asked:
        known = [(d, v) for k, d, v in changes if None not in (k, d, v, key, at) and k == key and d <= at]
        expected[n] = max(known)[1] if known else -1
    rows = spark.createDataFrame(asked, "n int, k int, at date").repartition(5)
    prices = spark.createDataFrame(changes, "k int, d date, v int").repartition(3)
    for cell in ("month", "year", "week"):
        found = lookup.as_of_each(rows, prices, "k", "at", "d", "v", -1, "price", cell)
        assert found.columns == ["n", "k", "at", "price"]
        assert {r["n"]: r["price"] for r in found.collect()} == expected


@pytest.mark.parametrize("heavy", [1, 4, 10_000])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_neighbour_items_as_rows_and_as_bitmaps(spark, heavy, kind):
    rng = random.Random(13)
    numbers = [*range(-5, 12), 32767, 32768, 32769, -32768, -32769, 1 << 40]
    edges = [(rng.choice([None, *range(30)]), rng.choice([None, *range(30)])) for _ in range(80)] + [(0, n) for n in range(30)]
    items = [(rng.choice([None, *range(30)]), rng.choice([None, *numbers])) for _ in range(200)] + [(0, n) for n in numbers]
    owned = {x for x in items if None not in x}
    links = {(a, b) for x, y in edges if None not in (x, y) and x != y for a, b in ((x, y), (y, x))}
    expected = {(a, item) for a, b in links for user, item in owned if user == b} - owned
    marked = spark.createDataFrame(items, "user long, item long").withColumn("item", F.col("item").cast(kind))
    found = lookup.neighbour_items(spark.createDataFrame(edges, "a long, b long"), marked, "a", "b", "user", "item", heavy)
    assert found.schema["item"].dataType.simpleString() == marked.schema["item"].dataType.simpleString()
    assert sorted((r[0], int(r[1])) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("ties", ["row_number", "rank", "dense_rank"])
def test_top_k_in_salted_parts(spark, ties):
    """Half of the rows under one key and a k that Spark does not cut before the shuffle."""
    rows = spark.range(0, 12_000, 1, 6).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).alias("k"), (F.col("id") * 7 % 4001).alias("v"), "id")
    order = [F.desc("v"), F.asc("id")] if ties == "row_number" else [F.desc("v")]
    wanted = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[ties]().over(Window.partitionBy("k").orderBy(*order))
    plain = rows.withColumn("rk", wanted).filter("rk <= 1500")
    found = groups.top_k(rows, "k", order, 1500, ties, salts=8)
    assert found.columns == plain.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("tasks", [0, 7])
def test_steps_in_more_tasks_than_the_session_gives(spark, tasks):
    """Hot keys, repeats and nulls: the same rows whichever way they are dealt."""
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(12)]), rng.choice([None, 1, 2, 3])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, d int, v int").withColumn("d", F.date_add(F.lit("2024-01-25").cast("date"), F.col("d"))).repartition(6)
    whole = {(k, v): max(d for j, d, w in data if (j, w) == (k, v) and d is not None) for k, _, v in data}
    found = tasks_of.grouped(df.select("k", "v", F.datediff("d", F.lit("2024-01-25")).alias("d")), ["k", "v"], tasks, {"d": F.max})
    assert {(r.k, r.v): r.d for r in found.collect()} == whole and found.count() == len(whole)
    for step in (
        lambda n: groups.equal_scores(df, "k", "d", "v", tasks=n),
        lambda n: days.islands(df, "k", "d", tasks=n),
        lambda n: days.islands(df, ["k", "v"], "d", max_gap=2, tasks=n),
        lambda n: lookup.as_of_each(df, df.withColumnRenamed("d", "at"), "k", "d", "at", "v", -1, "price", tasks=n),
    ):
        assert rows(step(tasks)) == rows(step(0))
