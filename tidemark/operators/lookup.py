"""Lookups: the value as of a day or of each row's own, the last change, what neighbours have."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.functions.columns import date as day_of
from tidemark.operators.groups import top_k
from tidemark.operators.scan import numbered
from tidemark.operators.tasks import dealt, grouped


def as_of(dim: DataFrame, changes: DataFrame, key: str, date: str, at: str, value: str, default: object) -> DataFrame:
    """Every row of ``dim`` with the latest value on or before a day, else the default.

    Of two changes on one day the higher value counts. The highest of a day and
    then the value of the last day are aggregates over plain columns, which hash.
    """
    daily = changes.filter(F.col(date) <= day_of(at)).groupBy(key, date).agg(F.max(value).alias("_value"))
    latest = daily.groupBy(key).agg(F.max_by("_value", date).alias("_value"))
    kind = changes.schema[value].dataType
    return dim.join(latest, key, "left").select(
        *(F.col(c) for c in dim.columns), F.coalesce("_value", F.lit(default).cast(kind)).alias(value)
    )


def as_of_each(
    rows: DataFrame, changes: DataFrame, key: str, at: str, date: str, value: str, default: object, name: str, cell: str = "month", tasks: int = 0,
) -> DataFrame:
    """Every row of ``rows`` with the latest value of its key on or before the row's own ``at``, else the default.

    Of two changes on one day the highest value counts. A row without a key or day has the
    default. The rows themselves are neither windowed nor paired with changes: the answer of
    a row depends on its key and day only, so the distinct days of a key meet its changes, as
    one sequence of days in which the last known value is carried on within cells of key and
    month first and from cell to cell after. A group has at most the days of a month or the
    months of a key, however many rows a key has; the rows then join their day's value, and
    AQE splits that join where a key and day is hot.
    """
    day = F.col(date).cast("date")
    kind = changes.schema[value].dataType
    asked = rows.select(F.col(key).alias("_key"), F.col(at).cast("date").alias("_day"), F.lit(None).cast(kind).alias("_set"), F.lit(True).alias("_asked"))
    known = changes.filter(F.col(value).isNotNull()).select(F.col(key).alias("_key"), day.alias("_day"), F.col(value).alias("_set"), F.lit(False).alias("_asked"))
    points = asked.unionByName(known).filter(F.col("_key").isNotNull() & F.col("_day").isNotNull())
    # One row for each key and day: most are combined before the shuffle.
    points = grouped(points, ["_key", "_day"], tasks, {"_set": F.max, "_asked": F.bool_or}).withColumn("_cell", F.trunc("_day", cell)).filter(F.col("_cell").isNotNull())
    within = Window.partitionBy("_key", "_cell").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    points = dealt(points, tasks, "_key", "_cell").withColumn("_here", F.last("_set", ignorenulls=True).over(within))
    # The same columns as above, so that both uses are one shuffle.
    known_on = F.when(F.col("_set").isNotNull(), F.col("_day"))
    cells = dealt(points.groupBy("_key", "_cell").agg(F.max_by("_set", known_on).alias("_end"), F.bool_or("_asked").alias("_any")), tasks, "_key")
    before = Window.partitionBy("_key").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("_key").alias("_of"), F.col("_cell").alias("_in"), F.last("_end", ignorenulls=True).over(before).alias("_before"), "_any").filter("_any")
    found = points.filter("_asked").join(cells, (F.col("_key") == F.col("_of")) & (F.col("_cell") == F.col("_in")))
    found = found.select("_key", "_day", F.coalesce("_here", "_before").alias("_value"))
    met = rows.join(found, (F.col(key) == F.col("_key")) & (F.col(at).cast("date") == F.col("_day")), "left")
    return met.select(*(F.col(c) for c in rows.columns), F.coalesce("_value", F.lit(default).cast(kind)).alias(name))


def last_change(changes: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Latest value less the one before it; a key with one value changes by that value."""
    newest = top_k(changes, key, [F.col(date).desc(), F.col(value).desc()], 2)
    now = F.max(F.when(F.col("rk") == 1, F.col(value)))
    before = F.max(F.when(F.col("rk") == 2, F.col(value)))
    return newest.groupBy(key).agg((now - F.coalesce(before, F.lit(0))).alias("change"))


#: Bits of one bitmap, which is that of Spark's bitmap functions (4 KB).
BITS = 32768


def neighbour_items(edges: DataFrame, items: DataFrame, a: str, b: str, user: str, item: str, heavy: int = 512) -> DataFrame:
    """Items that a neighbour has and the user has not, each pair once.

    Edges count both ways; loops and repeats are dropped before the fan-out. Whoever has
    ``heavy`` items or more in one range of 32,768 item numbers offers them as one bitmap, so
    a link costs a row for each range, not for each item, and the bitmaps of a user's
    neighbours are combined before they are shuffled. Others have few items a range, which
    go as rows. Items are whole numbers; other kinds are numbered first. What the user has is removed by a
    distributed anti-join.
    """
    ends = F.inline(
        F.array(
            F.struct(F.col(a).alias("_user"), F.col(b).alias("_friend")),
            F.struct(F.col(b).alias("_user"), F.col(a).alias("_friend")),
        )
    )
    links = edges.filter(F.col(a) != F.col(b)).select(ends).distinct()
    # Without nulls from the start, so that both uses are one shuffle.
    known = items.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
    owned = known.select(F.col(user).alias("_friend"), F.col(item).alias("_item")).distinct()
    if not isinstance(items.schema[item].dataType, IntegralType):
        numbers = numbered(owned.select(F.col("_item").alias("_name")).distinct(), [], ["_name"], "_number")
        coded = owned.join(numbers, F.col("_item") == F.col("_name")).select("_friend", F.col("_number").alias("_item"))
        offered = _offers(links, coded, heavy).join(numbers, F.col("_item") == F.col("_number")).select("_friend", F.col("_name").alias("_item"))
    else:
        offered = _offers(links, owned.withColumn("_item", F.col("_item").cast("long")), heavy).withColumn("_item", F.col("_item").cast(items.schema[item].dataType))
    return offered.join(owned, ["_friend", "_item"], "left_anti").select(
        F.col("_friend").alias(user), F.col("_item").alias(item)
    )


def _offers(links: DataFrame, owned: DataFrame, heavy: int) -> DataFrame:
    """(_friend, _item): what each user's neighbours have, each item once."""
    ranged = owned.withColumn("_bucket", F.bitmap_bucket_number("_item")).groupBy("_friend", "_bucket")
    # A list has at most the 32,768 numbers of its range. Only a long one becomes a bitmap of 4 KB, in the task that has it.
    lists = ranged.agg(F.collect_list("_item").alias("_items"))
    few = lists.filter(F.size("_items") < heavy)
    long = lists.filter(F.size("_items") >= heavy).select("_friend", "_bucket", F.explode("_items").alias("_item"))
    many = long.groupBy("_friend", "_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_item")).alias("_set"))
    light = links.join(few.select("_friend", F.explode("_items").alias("_item")), "_friend").select(F.col("_user").alias("_friend"), "_item")
    unions = links.join(many, "_friend").groupBy(F.col("_user").alias("_friend"), "_bucket").agg(F.bitmap_or_agg("_set").alias("_set"))
    return light.unionByName(members(unions, "_set", "_bucket", "_item").select("_friend", "_item")).distinct()


def members(df: DataFrame, bitmap: str, bucket: str, name: str) -> DataFrame:
    """A row for each number in a bitmap of Spark's, whose range is number ``bucket``.

    Eight bits at a time, so that a byte without any costs one look.
    """
    byte = F.substring(F.col(bitmap), F.col("_byte") + 1, F.lit(1))
    spread = df.withColumn("_byte", F.explode(F.sequence(F.lit(0), F.lit(BITS // 8 - 1)))).withColumn("_eight", byte).filter(F.col("_eight") != F.lit(b"\0"))
    value = F.conv(F.hex("_eight"), 16, 10).cast("int")
    bits = F.array(*(F.when(value.bitwiseAND(1 << k) != 0, F.lit(k)) for k in range(8)))
    spread = spread.withColumn("_bit", F.explode(F.filter(bits, lambda bit: bit.isNotNull())))
    at = F.col("_byte") * 8 + F.col("_bit")
    # Range 0 holds 0 and the negative numbers next to it, range 1 the numbers from 1 on.
    number = F.when(F.col(bucket) > 0, (F.col(bucket) - 1) * BITS + at + 1).otherwise(F.col(bucket) * BITS - at)
    return spread.withColumn(name, number.cast("long")).drop("_byte", "_eight", "_bit", bitmap, bucket)
