"""Operators on groups: pivots, set logic per key, ranking, comparison.

A single key may hold a large part of all rows. Everything here is either an
aggregate that Spark combines on the map side, a rank filter that Spark applies
per task before the shuffle, or a join whose hot key AQE can split. No operator
gathers the raw rows of a key in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cells import with_place
from tidemark.operators.tasks import dealt

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def pivot_sum(df: DataFrame, keys: Keys, columns: Mapping[str, Column], value: Column | int = 1) -> DataFrame:
    """One row per key, one column per condition: the sum of value where it holds, else 0."""
    amount = F.lit(value) if isinstance(value, int) else value
    sums = [F.sum(F.when(condition, amount).otherwise(0)).alias(name) for name, condition in columns.items()]
    return df.groupBy(*as_list(keys)).agg(*sums)


def side_by_side(df: DataFrame, keys: Keys, period: Column, a: object, b: object, value: Column) -> DataFrame:
    """Sum of value in period a and in period b per key, in one pass over the rows."""
    rows = df.filter(period.isin(a, b))
    return pivot_sum(rows, keys, {"a": period == a, "b": period == b}, value)


# -- set logic per key --------------------------------------------------------


def has_any(df: DataFrame, key: str, item: str, wanted: DataFrame | Sequence[object]) -> DataFrame:
    """Keys with at least one wanted item, each once."""
    return _only(df, item, wanted).select(key).distinct()


def has_all(df: DataFrame, key: str, item: str, wanted: DataFrame | Sequence[object]) -> DataFrame:
    """Keys with every wanted item (relational division); repeats of an item count once."""
    if isinstance(wanted, DataFrame):
        need = wanted.agg(F.count_distinct(wanted.columns[0])).scalar()
    else:
        need = F.lit(len(set(wanted)))
    held = _only(df, item, wanted).groupBy(key).agg(F.count_distinct(item).alias("_held"))
    return held.filter(F.col("_held") == need).select(key)


def has_all_but(df: DataFrame, key: str, item: str, wanted: Sequence[object], unwanted: Sequence[object]) -> DataFrame:
    """Keys with every wanted and no unwanted item, in one aggregate."""
    rows = df.filter(F.col(item).isin(*wanted, *unwanted))
    flags = {f"_i{n}": F.bool_or(F.col(item) == value) for n, value in enumerate(wanted)}
    found = rows.groupBy(key).agg(
        *(flag.alias(name) for name, flag in flags.items()),
        F.bool_or(F.col(item).isin(*unwanted) if unwanted else F.lit(False)).alias("_other"),
    )
    keep = ~F.col("_other")
    for name in flags:
        keep = keep & F.col(name)
    return found.filter(keep).select(key)


def has_none(
    population: DataFrame, df: DataFrame, key: str, item: str, wanted: DataFrame | Sequence[object]
) -> DataFrame:
    """Rows of the population whose key has none of the wanted items."""
    return not_in(population, key, has_any(df, key, item, wanted))


def not_in(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """SQL ``NOT IN``: one null in the list lets no row through.

    Spark runs ``NOT IN`` as a broadcast of the whole list. Here the list stays
    distributed: a null-safe anti-join, and a one-row subquery over the same
    shuffled list that says whether it holds a null or nothing at all.
    """
    values = listed.select(F.col(listed.columns[0]).alias("_listed")).distinct()
    facts = values.agg(
        F.struct(
            F.coalesce(F.bool_or(F.col("_listed").isNull()), F.lit(False)).alias("null"),
            (F.count("*") == 0).alias("empty"),
        )
    ).scalar()
    others = df.join(values, F.col(key).eqNullSafe(F.col("_listed")), "left_anti")
    return others.filter(~facts.getField("null") & (F.col(key).isNotNull() | facts.getField("empty")))


def all_rows(df: DataFrame, key: str, predicate: Column, null_passes: bool = False) -> DataFrame:
    """Keys whose rows all satisfy the predicate; an unknown row decides by ``null_passes``."""
    held = df.groupBy(key).agg(F.bool_and(F.coalesce(predicate, F.lit(null_passes))).alias("_held"))
    return held.filter("_held").select(key)


def _only(df: DataFrame, item: str, wanted: DataFrame | Sequence[object]) -> DataFrame:
    if isinstance(wanted, DataFrame):
        values = wanted.select(F.col(wanted.columns[0]).alias(item))
        return df.join(values, item, "left_semi")
    return df.filter(F.col(item).isin(*wanted))


# -- ranking ------------------------------------------------------------------


#: Up to this k Spark cuts each task to the first k ranks per key before it shuffles (`WindowGroupLimit`).
FEW = 1000


def top_k(df: DataFrame, keys: Keys, order: Sequence[Column], k: int, ties: str = "row_number", salts: int | None = None) -> DataFrame:
    """The first k rows per key with their rank in ``rk``.

    ``ties`` is row_number, rank or dense_rank. Give row_number a total order. For a k up to
    1000 a hot key sends k rows per task. Beyond that a key is first cut into ``salts`` parts
    (as many as shuffle partitions) by a hash of the row, each with its own first k ranks, and
    what is left of them is ranked: a rank among fewer rows is never worse, so none is lost,
    and a task holds a part of a key, or salts * k of its rows.
    """
    rank = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[ties]()
    names = df.columns
    if k > FEW:
        salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = Window.partitionBy(*as_list(keys), "_salt").orderBy(*order)
        plain = [f.name for f in df.schema if f.dataType.typeName() != "map"]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)))
        df = salted.withColumn("_rank", rank.over(parts)).filter(F.col("_rank") <= k).select(*names)
    window = Window.partitionBy(*as_list(keys)).orderBy(*order)
    return df.withColumn("rk", rank.over(window)).filter(F.col("rk") <= k)


def nth_value_rows(df: DataFrame, measure: str, n: int, ties: str = "dense_rank", or_null: bool = False) -> DataFrame:
    """Rows that hold the n-th largest value over all rows, ties kept.

    No global window: the n largest values are found by a top-n per task, the
    n-th becomes a scalar and the rows are filtered by it. With ``ties='rank'``
    equal values use up ranks, so the n-th rank may not exist. With ``or_null``
    a missing rank yields one row of nulls.
    """
    values = df.select(F.col(measure).alias("_v")).filter(F.col("_v").isNotNull())
    if ties == "dense_rank":
        values = values.distinct()
    # At most n values, smallest first, so the n-th largest is the first of them.
    leading = values.orderBy(F.desc("_v")).limit(n).agg(F.sort_array(F.collect_list("_v")).alias("_top"))
    exists = F.size("_top") == n
    if ties == "rank" and n > 1:
        exists = exists & (F.get("_top", F.lit(0)) < F.get("_top", F.lit(1)))
    nth = leading.select(F.when(exists, F.get("_top", F.lit(0)))).scalar()
    rows = df.filter(F.col(measure) == nth)
    if not or_null:
        return rows
    empty = rows.agg(F.count("*").alias("_n")).filter("_n = 0")
    blank = empty.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema))
    return rows.unionByName(blank)


# -- comparison with the group ------------------------------------------------


def with_group_avg(df: DataFrame, keys: Keys, value: str, name: str) -> DataFrame:
    """Every row with the average of its group: a combined aggregate joined back.

    A window over the whole group would hold a hot group in one task; the join
    can be split there.
    """
    keys = as_list(keys)
    return join_on(df, df.groupBy(*keys).agg(F.avg(value).alias(name)), keys)


def join_on(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    """Inner join where a null key is a key like any other, as in a group."""
    keys = as_list(keys)
    other = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(other, same).drop(*(f"_right_{key}" for key in keys))


#: Cells that the values of a key are cut into.
CELLS = 256


def median(df: DataFrame, key: str, value: str, cells: int = CELLS, levels: int = 1) -> DataFrame:
    """Exact median per key (mean of the middle two for even counts) as ``median``.

    Equal values are counted first. A quantile sketch of the distinct values of a key,
    combined before the shuffle, gives the edges of cells with about as many distinct values
    each, whatever their scale; counts per cell say which cells hold the middle positions,
    and only the values of those are ordered: of a key with d distinct values about
    d / cells**levels in a task (``levels`` cuts the cells found in the same way again). The
    sketch only lays out cells, so its error costs balance, not exactness.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    totals = counts.groupBy("_key").agg(F.sum("_n").alias("_all"))
    totals = totals.select("_key", F.expr("(_all + 1) div 2 AS _low"), F.expr("_all div 2 + 1 AS _high"), F.lit(0).cast("long").alias("_cell"), F.lit(0).cast("long").alias("_before"))
    rows, middle = counts.withColumn("_cell", F.lit(0).cast("long")), totals
    for _ in range(levels):
        edges = rows.groupBy("_key", "_cell").agg(F.array_distinct(F.percentile_approx("_v", [k / cells for k in range(1, cells)], 16 * cells)).alias("_edges"))
        placed = with_place(join_on(rows, edges, ["_key", "_cell"]), "_edges", "_v", cells - 1, "_part", own=False).drop("_edges")
        sums = join_on(placed.groupBy("_key", "_cell", "_part").agg(F.sum("_n").alias("_in")), middle, ["_key", "_cell"])
        inside = Window.partitionBy("_key", "_cell").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("_upto", F.col("_before") + F.sum("_in").over(inside)).withColumn("_before", F.col("_upto") - F.col("_in"))
        sums = sums.filter((F.col("_before") < F.col("_high")) & (F.col("_upto") >= F.col("_low")))
        middle = sums.select("_key", "_cell", "_part", "_low", "_high", "_before")
        rows = join_on(placed, middle.select("_key", "_cell", "_part"), ["_key", "_cell", "_part"])
        number = (F.col("_cell") * cells + F.col("_part")).alias("_cell")
        rows, middle = rows.select("_key", number, "_v", "_n"), middle.select("_key", number, "_low", "_high", "_before")
    by_value = Window.partitionBy("_key", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    kept = join_on(rows, middle, ["_key", "_cell"]).withColumn("_upto", F.col("_before") + F.sum("_n").over(by_value))

    def holds(position: str) -> Column:
        return (F.col("_upto") - F.col("_n") < F.col(position)) & (F.col("_upto") >= F.col(position))

    return kept.groupBy(F.col("_key").alias(key)).agg(
        (
            (F.max(F.when(holds("_low"), F.col("_v"))) + F.max(F.when(holds("_high"), F.col("_v")))) / 2
        ).alias("median")
    )


def equal_scores(df: DataFrame, key: str, item: str, value: str, repeat: bool = False, tasks: int = 0) -> DataFrame:
    """Rows whose value also occurs under another item of the same key.

    ``pairs`` is the number of such other rows. The rows of a key are not paired
    with each other: the partners of a row are those of equal value less those
    of its own item. ``repeat`` turns the count into that many copies of the row. With more
    ``tasks`` than shuffle partitions, the items of a key with one value meet in one of these.
    """
    own = df.filter(F.col(value).isNotNull() & F.col(item).isNotNull() & F.col(key).isNotNull())
    own = dealt(own.groupBy(key, item, value).agg(F.count("*").alias("_own")), tasks, key, value)
    same = own.groupBy(key, value).agg(F.sum("_own").alias("_same"))
    rows = own.join(same.filter("_same > 1"), [key, value]).withColumn("pairs", F.col("_same") - F.col("_own"))
    rows = rows.filter("pairs > 0")
    # Repeated rows of the same item each have the same partners.
    if repeat:
        copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pairs") * F.col("_own")))
        return rows.select(key, item, value, copies.alias("_copy")).drop("_copy")
    return rows.select(key, item, value, (F.col("pairs") * F.col("_own")).alias("pairs"))
