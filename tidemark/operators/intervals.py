"""Operators on instants and intervals: concurrency, overlap, coverage, sessions.

Times carry no zone (`timestamp_ntz`). A running value over all instants of a
key would sort a hot key in one task, so it is built over levels instead: within
a minute, over the minutes of a day, over the days. The largest group is then
the instants of one minute, the minutes of a day or the days of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import one_if
from tidemark.operators.groups import Keys, as_list

CELLS = ["_day", "_minute"]


def _with_cells(df: DataFrame, at: str) -> DataFrame:
    return df.withColumns(
        {"_day": F.col(at).cast("date"), "_minute": F.hour(F.col(at)) * 60 + F.minute(F.col(at))}
    )


def _levels(keys: Sequence[str], at: str) -> list[tuple[list[str], str]]:
    """Finest first: the columns of a group and the column that orders it."""
    return [([*keys, "_day", "_minute"], at), ([*keys, "_day"], "_minute"), ([*keys], "_day")]


def _earlier(group: Sequence[str], *order: Column | str) -> WindowSpec:
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def peak(df: DataFrame, start: str, end: str, keys: Keys = ()) -> DataFrame:
    """Largest number of intervals open at once, per key or overall.

    An interval that ends in the instant another begins does not add to it. An
    interval without an end stays open, one without a start is left out.
    """
    keys = as_list(keys)
    df = df.filter(F.col(start).isNotNull())
    steps = F.inline(
        F.array(
            F.struct(F.col(start).alias("at"), F.lit(1).alias("step")),
            F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
        )
    )
    marks = _with_cells(df.select(*keys, steps).filter(F.col("at").isNotNull()), "at")
    rows = marks.groupBy(*keys, *CELLS, "at").agg(F.sum("step").alias("net")).withColumn("peak", F.col("net"))
    for group, order in _levels(keys, "at"):
        open_before = F.coalesce(F.sum("net").over(_earlier(group, order)), F.lit(0))
        rows = (
            rows.withColumn("peak", open_before + F.col("peak"))
            .groupBy(*group)
            .agg(F.sum("net").alias("net"), F.max("peak").alias("peak"))
        )
    return rows.select(*keys, "peak")


def overlaps(df: DataFrame, key: str, start: str, end: str, place: str | None = None) -> DataFrame:
    """Keys with two intervals that share an instant, ends included.

    An interval overlaps an earlier one that ends at or after its own start; one
    without an end can only be the later of the two. With ``place`` the two must
    also differ in place.
    """
    if place is not None:
        return _overlaps_between_places(df, key, start, end, place)
    points = _with_cells(df.filter(F.col(start).isNotNull()), start)
    rows = (
        points.groupBy(key, *CELLS, start)
        .agg(F.max(end).alias("high"), F.count("*").alias("n"))
        .withColumn("low", F.col(start))
        .withColumn("hit", (F.col("n") > 1) & (F.col("high") >= F.col("low")))
        .drop("n")
    )
    for group, order in _levels([key], start):
        reached = F.max("high").over(_earlier(group, order)) >= F.col("low")
        rows = (
            rows.withColumn("hit", F.coalesce("hit", F.lit(False)) | F.coalesce(reached, F.lit(False)))
            .groupBy(*group)
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("hit").alias("hit"))
        )
    return rows.filter("hit").select(key)


def _overlaps_between_places(df: DataFrame, key: str, start: str, end: str, place: str) -> DataFrame:
    """Overlaps of two places, in the same levels and without pairing intervals.

    A cell needs the two latest ends and the two earliest starts that belong to
    different places: whatever overlaps across cells also does so among these.
    """
    points = _with_cells(df.filter(F.col(place).isNotNull() & F.col(start).isNotNull()), start)
    rows = points.groupBy(key, *CELLS, start, F.col(place).alias("_place")).agg(F.max(end).alias("_end"))
    high = F.struct(F.col("_end").alias("at"), F.col("_place").alias("place"))
    low = F.struct(F.col(start).alias("at"), F.col("_place").alias("place"))
    rows = rows.select(key, *CELLS, start, high.alias("high"), low.alias("low"), F.lit(False).alias("hit"))
    rows = rows.withColumn("high2", F.when(F.lit(False), F.col("high")))
    rows = rows.withColumn("low2", F.when(F.lit(False), F.col("low")))
    for group, order in _levels([key], start):
        before = _earlier(group, order, F.desc("high"))
        rows = rows.withColumn("_top", F.max("high").over(before)).withColumn("_leads", F.greatest("_top", "high"))
        # The latest end outside the leading place is the largest of all that were ever left behind.
        behind = F.greatest(_elsewhere(F.least("_top", "high"), "_leads"), _elsewhere(F.col("high2"), "_leads"))
        rows = rows.withColumn("_behind", behind).withColumns(
            {
                "_next": F.max("_behind").over(before),
                "_first": F.min("low").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            }
        )
        top, after = F.col("_top"), F.col("_next")
        same = top.getField("place") == F.col("low.place")
        from_next = _reaches(top, F.col("low2")) | _reaches(after, F.col("low"))
        hit = F.when(same, from_next).otherwise(_reaches(top, F.col("low")))
        later = F.least(_elsewhere(F.col("low"), "_first"), _elsewhere(F.col("low2"), "_first"))
        rows = (
            rows.withColumn("hit", F.col("hit") | hit)
            .withColumn("low2", later)
            .groupBy(*group)
            .agg(
                F.max("high").alias("high"),
                F.max("_behind").alias("high2"),
                F.min("low").alias("low"),
                F.min("low2").alias("low2"),
                F.bool_or("hit").alias("hit"),
            )
        )
    return rows.filter("hit").select(key)


def _elsewhere(candidate: Column, leader: str) -> Column:
    """The candidate if it belongs to another place than the leader, else null."""
    return F.when(candidate.getField("place") != F.col(leader).getField("place"), candidate)


def _reaches(high: Column, low: Column) -> Column:
    return F.coalesce(high.getField("at") >= low.getField("at"), F.lit(False))


def covered_days(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Days inside at least one interval of the key, both ends included.

    One interval per key and start day is enough, the longest; so a hot key
    brings at most as many rows to its window as there are days.
    """
    spans = df.filter(F.col(end) >= F.col(start)).groupBy(key, start).agg(F.max(end).alias(end))
    reached = F.max(end).over(_earlier([key], start))
    fresh = spans.withColumn("_from", F.greatest(F.col(start), F.date_add(reached, 1)))
    days = F.datediff(F.col(end), F.col("_from")) + 1
    return fresh.filter(F.col(end) >= F.col("_from")).groupBy(key).agg(F.sum(days).alias("days"))


def sessionize(df: DataFrame, key: str, ts: str, gap_s: int) -> DataFrame:
    """Rows labelled ``key-n`` in ``session_id``; a wait of gap_s seconds starts the next session.

    ``ts`` counts whole seconds. Sessions depend only on the distinct seconds of
    a key, so those are numbered and joined back. They are numbered within a day
    first, then the days of a key are chained: a group holds at most the seconds
    of a day or the days of the data, however many rows a key has.
    """
    # The null filters are spelled out, so that both uses of the seconds share one shuffle.
    seconds = df.select(key, ts, F.floor(F.col(ts) / 86400).alias("_day"))
    seconds = seconds.filter(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col("_day").isNotNull()).distinct()
    within = Window.partitionBy(key, "_day").orderBy(ts)
    waited = F.col(ts) - F.lag(ts).over(within) >= gap_s
    seconds = seconds.withColumn("_opens", one_if(waited)).withColumn(
        "_opened", F.sum("_opens").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    by_day = Window.partitionBy(key).orderBy("_day")
    carried_on = F.col("_first") - F.lag("_last").over(by_day) < gap_s
    days = (
        seconds.groupBy(key, "_day")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("_opened").alias("_within"))
        .withColumn("_new", F.when(carried_on, 0).otherwise(1) + F.col("_within"))
        .withColumn("_upto", F.sum("_new").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
        .select(key, "_day", (F.col("_upto") - F.col("_within")).alias("_before"))
    )
    number = (F.col("_before") + F.col("_opened")).cast("string")
    label = F.concat(F.col(key).cast("string"), F.lit("-"), number)
    sessions = seconds.join(days, [key, "_day"]).select(key, ts, label.alias("session_id"))
    return df.join(sessions, [key, ts], "left")
