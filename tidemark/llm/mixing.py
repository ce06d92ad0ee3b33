"""Mixing sources to target weights by Pfair scheduling.

A source with weight w gets its block i (from 0) a release time floor(i / w) and a deadline
ceil((i + 1) / w), in slots. In each slot the released block with the earliest deadline goes
out, so at any slot a source is less than one block away from its target share.

Weights are taken as they are, as exact fractions, and every row is placed: a source that has
run out leaves, and the others go on in a new phase with their weights renormalised. One
count per source decides all. The driver finds where phases end; the slots between are laid
out by tasks, a range of slots each, as what has gone out before a slot can be told from the
windows around it (`gone`).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, cut, in_tasks, numbered, table

#: What is known of a block.
TIMES = pa.schema([("_named", pa.string()), ("_turn", pa.int64()), ("phase", pa.int64()), ("release", pa.int64()), ("deadline", pa.int64()), ("slot", pa.int64())])


class Phase(NamedTuple):
    """Slots from `start` on in which the same sources take part, by whole weights of one unit."""

    start: int
    slots: int
    parts: dict[str, int]
    done: dict[str, int]  # blocks that went out in the phases before


def gone(parts: dict[str, int], total: int, slot: int) -> dict[str, int]:
    """How many blocks of each source go out before `slot` of a phase.

    Blocks with a deadline up to `slot` have gone. Of a source's one block whose window holds
    `slot` inside, this is decided by the blocks that go before it (earlier deadline, then name): of
    those released, n(s) before slot s, min over s of n(s) + slot - s go out before `slot`.
    Only slots since the earliest of these releases matter, and a block goes if counting it
    raises the minimum.
    """
    out = {name: part * slot // total for name, part in parts.items()}
    inside = sorted((-(-(out[name] + 1) * total // part), name, out[name] * total // part) for name, part in parts.items() if part * slot % total)
    if not inside:
        return out
    first = min(release for _, _, release in inside)
    # releases before each slot s from `first` on, less s
    before = {name: -(-part * first // total) for name, part in parts.items()}
    later = [k * total // part - first for name, part in parts.items() for k in range(before[name], -(-part * slot // total))]
    ahead = np.zeros(slot - first + 1, np.int64)
    ahead[1:] = np.cumsum(np.bincount(np.array(later, np.int64), minlength=slot - first) - 1)
    ahead += sum(before.values()) - first
    # the least of each stretch between releases; blocks not yet counted lower those behind them
    edges = sorted({release for _, _, release in inside})
    least = np.minimum.reduceat(ahead[1:], np.array(edges) - first)
    lower = np.searchsorted(np.sort([release for _, _, release in inside]), edges, side="right")
    level = least - lower
    counted = min(0, int(level.min()))
    for _, name, release in inside:
        level[np.searchsorted(edges, release) :] += 1
        now = min(0, int(level.min()))
        out[name] += now - counted
        counted = now
    return out


def course(parts: dict[str, int], slot: int = 0) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) from `slot` of a phase on, without end."""
    total = sum(parts.values())
    coming = [(i * total // parts[name], -(-(i + 1) * total // parts[name]), name, i) for name, i in gone(parts, total, slot).items()]
    heapq.heapify(coming)
    ready: list[tuple[int, str, int, int]] = []
    while True:
        while coming and coming[0][0] <= slot:
            release, deadline, name, i = heapq.heappop(coming)
            heapq.heappush(ready, (deadline, name, i, release))
        deadline, name, i, release = heapq.heappop(ready)
        yield name, i, release, deadline, slot
        slot += 1
        heapq.heappush(coming, ((i + 1) * total // parts[name], -(-(i + 2) * total // parts[name]), name, i + 1))


def plan(weights: dict[str, float], blocks: dict[str, int]) -> list[Phase]:
    """The phases of sources with a weight, as many as sources at most.

    A phase ends before the slot that is due to a source without a block left; all such sources
    leave. In the next one the windows of the others begin anew at that slot, under their share
    of the weights that are left. Fractions are exact, so no error grows with the slots. Only
    slots near the end of a phase are gone through, as no block beyond a source's last is
    released earlier.
    """
    exact = {name: Fraction(weight) for name, weight in weights.items() if weight > 0}
    whole = math.lcm(*(x.denominator for x in exact.values()))
    parts = {name: int(x * whole) for name, x in sorted(exact.items())}
    done, start, out = dict.fromkeys(parts, 0), 0, []
    while parts:
        total = sum(parts.values())
        left = {name: blocks.get(name, 0) - done[name] for name in parts}
        near = min(left[name] * total // part for name, part in parts.items())
        own = gone(parts, total, near)
        for name, i, _, _, slot in course(parts, near):  # noqa: B007
            if i >= left[name]:
                break
            own[name] = i + 1
        out.append(Phase(start, slot, dict(parts), {name: done[name] for name in parts}))
        start += slot
        for name in own:
            done[name] += own[name]
        parts = {name: part for name, part in parts.items() if done[name] < blocks.get(name, 0)}
    return out


def slots_between(planned: list[Phase], first: int, behind: int) -> Iterator[tuple[str, int, int, int, int, int]]:
    """(source, block, phase, release, deadline, slot) of the slots from `first` to `behind`, not included."""
    for number, (start, slots, parts, done) in enumerate(planned):
        low, high = max(first, start), min(behind, start + slots)
        if low < high:
            for name, i, release, deadline, slot in islice(course(parts, low - start), high - low):
                yield name, done[name] + i, number, start + release, start + deadline, start + slot


def phases(weights: dict[str, float], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int, int]]:
    """`slots_between` over all slots, one after another."""
    planned = plan(weights, blocks)
    return slots_between(planned, 0, sum(phase.slots for phase in planned))


def _laid_out(spark: SparkSession, weights: dict[str, float], blocks: dict[str, int], each: int = 1 << 16) -> DataFrame:
    """A row of `TIMES` for each slot; a task lays out `each` slots at a time."""
    planned = plan(weights, blocks)
    last = sum(phase.slots for phase in planned)
    # plain data, which executors can read without this package
    sent = spark.sparkContext.broadcast([tuple(phase) for phase in planned])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Phase(*phase) for phase in sent.value]
        for batch in batches:
            for k in batch.column("id").to_pylist():
                rows = slots_between(own, k * each, (k + 1) * each)
                while some := list(islice(rows, 1 << 13)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some, strict=True), TIMES.types, strict=True)], schema=TIMES)

    ranges = -(-last // each)
    return in_tasks(spark.range(0, ranges, 1, max(1, min(ranges, 4096))), task, "_named string, _turn long, phase long, release long, deadline long, slot long")


def source_key(column: str = "source"):
    """A source as a text without nulls: a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def tempered(docs: DataFrame, power: float = 0.5) -> dict[str, float]:
    """Target weights from the data: each source's number of rows to a power.

    One row per source reaches the driver: sources are named, as weights are.
    """
    counts = docs.groupBy(source_key().alias("name")).count()
    return {row["name"]: row["count"] ** power for row in counts.toLocalIterator()}


def _slots(rows: DataFrame, weights: dict[str, float], block: int, order: list[str], many: str | None = None) -> DataFrame:
    """`rows` (with `_key`) with number, block, place and the times of its block; a row may stand for `many`."""
    counted = rows.groupBy("_key").agg((F.sum(many) if many else F.count("*")).alias("count"))
    sizes = {row["_key"]: row["count"] for row in counted.toLocalIterator()}  # one row per source
    times = _laid_out(rows.sparkSession, weights, {name: -(-n // block) for name, n in sizes.items()})
    placed = numbered(rows, "_key", order, buckets_for(max(sizes.values(), default=0)), many)
    if many:
        # Rows that are equal are told apart by their numbers, a chunk of 4,096 at a time.
        placed = placed.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({many} - 1) div 4096"))))
        left = F.least(F.lit(4096), F.col(many) - F.col("_chunk") * 4096).cast("int")
        inside = F.explode(F.sequence(F.lit(0), left - 1))
        placed = placed.withColumn("_inside", inside).withColumn("number", F.col("number") + F.col("_chunk") * 4096 + F.col("_inside")).drop("_chunk", "_inside")
    placed = placed.withColumn("block", F.expr(f"number div {block}")).withColumn("place", F.expr(f"number % {block}"))
    return placed.join(times, (F.col("_key") == F.col("_named")) & (F.col("block") == F.col("_turn")), "left").drop("_named", "_turn")


def interleave(docs: DataFrame, weights: dict[str, float], block: int = 8, order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`docs` with phase, release, deadline and slot of its block, block, its place in it, and `mixed`.

    A source's rows are ordered by a hash of `order` (equal rows in any order) and cut into
    blocks of `block` rows; the last may be shorter. `weights` names sources as `source_key`
    does; a null source is one of them. Every row is returned once and every row of a source with a
    weight has a slot; each slot up to the last has one block. In a phase a source is less than
    one block away from its share of the phase's slots. `mixed` is true in phase 0, in which no
    source has run out and the weights hold as given. Sources without a weight have null times.
    Columns of `docs` that have one of the new names are replaced. An empty table gives no rows.
    """
    keyed = docs.drop("block", "place", *TIMES.names[2:], "mixed").withColumn("_key", source_key())
    met = _slots(keyed, weights, block, list(order))
    return met.withColumn("mixed", F.coalesce(F.col("phase") == 0, F.lit(False))).drop("_key", "number")


def arranged(docs: DataFrame, weights: dict[str, float], block: int = 8, order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """All rows of `docs` with its columns, in the order of their slots; sources without a weight come last.

    Placed as in `interleave`, but by names: a row is known by two hashes of all its columns
    while it is numbered and given its slot. Then rows are moved twice, to meet their slots
    and into their order, whatever their number.
    """
    plain = [f.name for f in docs.schema if f.dataType.typeName() != "map"]
    own = {f"_own{k}": name for k, name in enumerate(docs.columns)}
    names = {"_a": F.xxhash64(*plain), "_b": F.xxhash64(F.lit(1), *plain)}
    inside = {f"_by{k}": F.col(name) for k, name in enumerate(order)}
    narrow = docs.select(source_key().alias("_key"), *(c.alias(k) for k, c in (names | inside).items()))
    narrow = narrow.groupBy("_key", *inside, *names).agg(F.count("*").alias("_rows"))
    slots = cut(_slots(cut(narrow), weights, block, list(inside), "_rows").select(F.col("_a").alias("_x"), F.col("_b").alias("_y"), "_rows", "slot", "place"))
    rows = docs.select(*(F.col(name).alias(k) for k, name in own.items()), *(c.alias(k) for k, c in names.items()))
    same = (F.col("_a") == F.col("_x")) & (F.col("_b") == F.col("_y"))
    met = rows.join(slots.filter("_rows = 1").hint("merge"), same)
    repeated = slots.filter("_rows > 1")
    if not repeated.isEmpty():
        once = rows.join(repeated.select("_x", "_y").distinct(), same, "left_semi").dropDuplicates(["_a", "_b"])
        met = met.unionByName(once.join(repeated, same))
    return met.orderBy(F.col("slot").asc_nulls_last(), "place").select(*(F.col(k).alias(name) for k, name in own.items()))


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return interleave(docs, tempered(docs))
