"""Running values over an order of all rows, or of all rows of a key, in parallel.

A window without a key sorts every row in one task, and one with a hot key most of them.
Here the order is cut into ranges by bounds from a sample of the rows. The range of a row
follows from its own values, so the totals of the ranges come from a combined aggregate
over the rows where they are, an exclusive scan over these few totals says what lies before
each range, and only the rows of one range are ordered in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cells import with_place
from tidemark.operators.groups import Keys, as_list

#: Rows sampled for each range.
SAMPLE = 32


def parts_of(df: DataFrame) -> int:
    """How many ranges: four for each shuffle partition of the session."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bounds(df: DataFrame, at: Column, parts: int) -> Column:
    """Scalar subquery: the least value of each range but the first, an array in order.

    The sample has the rows whose values have the least hashes, a top-n per task: the same
    rows give the same bounds wherever they are, and at most SAMPLE rows for each range leave
    the tasks.
    """
    seen = df.select(at.alias("_at"))
    some = seen.orderBy(F.xxhash64("_at")).limit(parts * SAMPLE).agg(F.array_sort(F.collect_list("_at")).alias("_some"))
    cut = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda k: F.get("_some", F.floor(k * F.size("_some") / parts).cast("int")))
    return some.select(F.array_distinct(F.filter(cut, lambda bound: bound.isNotNull()))).scalar()


def with_range(df: DataFrame, at: Column, parts: int) -> DataFrame:
    """Rows with the number of their range in ``_range``: how many bounds are not above their value."""
    if parts < 2:
        return df.withColumn("_range", F.lit(0))
    known = df.withColumns({"_at": at, "_bounds": bounds(df, at, parts)})
    return with_place(known, "_bounds", "_at", parts - 1, "_range", own=True).drop("_at", "_bounds")


def running(df: DataFrame, keys: Keys, order: Keys, values: dict[str, Column], parts: int | None = None) -> DataFrame:
    """Every row with the sum of each value up to and with itself, per key or over all rows.

    ``order`` are columns, ascending with nulls first, in a total order (rows that are equal in
    all of them come in any order, and a range cannot be cut between them). Rows with a null
    value add nothing. A null key is a key like any other. No group holds more than the rows
    of one range or the ranges of one key.
    """
    keys, order = as_list(keys), as_list(order)
    parts = parts or parts_of(df)
    at = F.struct(*(F.col(c) for c in [*keys, *order]))
    ranged = with_range(df.withColumns({f"_v{n}": value for n, value in enumerate(values.values())}), at, parts)
    sums = [F.sum(f"_v{n}").alias(f"_s{n}") for n in range(len(values))]
    totals = ranged.groupBy(*keys, "_range").agg(*sums)
    before = Window.partitionBy(*keys, *([] if keys else [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *(F.col(c).alias(f"_key_{c}") for c in [*keys, "_range"]),
        *(F.coalesce(F.sum(f"_s{n}").over(before), F.lit(0)).alias(f"_b{n}") for n in range(len(values))),
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.withColumns({f"_r{n}": F.coalesce(F.sum(f"_v{n}").over(inside), F.lit(0)) for n in range(len(values))})
    found = rows.join(offsets, _same([*keys, "_range"], "_key_"))
    return found.select(*df.columns, *((F.col(f"_b{n}") + F.col(f"_r{n}")).alias(name) for n, name in enumerate(values)))


def numbered(df: DataFrame, keys: Keys, order: Keys, name: str, parts: int | None = None) -> DataFrame:
    """Every row with its number from 0 in ``name``, per key or over all rows."""
    counted = running(df, keys, order, {name: F.lit(1)}, parts)
    return counted.withColumn(name, F.col(name) - 1)


def carried(df: DataFrame, keys: Keys, order: Keys, value: str, name: str, parts: int | None = None) -> DataFrame:
    """Every row with the last known ``value`` at or before it, per key, in ``name``.

    The same ranges as in `running`: the last value of a range is an aggregate, the last of
    all ranges before is a window over a key's ranges, and the rest happens in the range.
    """
    keys, order = as_list(keys), as_list(order)
    parts = parts or parts_of(df)
    at = F.struct(*(F.col(c) for c in [*keys, *order]))
    ranged = with_range(df, at, parts)
    place = F.struct(*order)
    lasts = ranged.filter(F.col(value).isNotNull()).groupBy(*keys, "_range").agg(F.max_by(value, place).alias("_last"))
    here = ranged.select(*keys, "_range").distinct()
    known = here.join(lasts.withColumnsRenamed({c: f"_l{c}" for c in [*keys, "_range"]}), _same([*keys, "_range"], "_l"), "left")
    before = Window.partitionBy(*keys, *([] if keys else [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = known.select(*(F.col(c).alias(f"_k{c}") for c in [*keys, "_range"]), F.last("_last", ignorenulls=True).over(before).alias("_before"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
    found = rows.join(offsets, _same([*keys, "_range"], "_k"))
    return found.select(*df.columns, F.coalesce("_own", "_before").alias(name))


def _same(columns: list[str], prefix: str) -> Column:
    out = F.lit(True)
    for column in columns:
        out = out & F.col(column).eqNullSafe(F.col(f"{prefix}{column}"))
    return out
