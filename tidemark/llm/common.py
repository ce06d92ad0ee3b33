"""Helpers shared by the operators: cutting lineage, Arrow texts, numbering, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import work_folder


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and read it from there."""
    work_folder(df.sparkSession)
    return df.checkpoint()


def free(df: DataFrame, name: str) -> str:
    """`name`, longer where `df` has a column of that name."""
    while name in df.columns:
        name = "_" + name
    return name


def row_name(*columns: str) -> Column:
    """A name for a row by the values of some columns, nulls apart from all others; 128 bits as hex."""
    fields = (F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in (F.col(c).cast("string") for c in columns))
    return F.md5(F.concat(*fields).cast("binary"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_tasks(df: DataFrame, task: Callable, schema: StructType | str, rows: int = 1000) -> DataFrame:
    """`mapInArrow` over rows with whole texts.

    Arrow batches are counted in rows; the session's batches become `rows` at most, so that a
    worker never holds thousands of long texts at once.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(name))
    if not 0 < now <= rows:
        df.sparkSession.conf.set(name, str(rows))
    return df.mapInArrow(task, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after another, and where each row starts.

    Nulls are empty. The second array has one entry more than the column.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most `most` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def shards(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    """Gather rows to shards of about `most` bytes of text; a longer row is a shard of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in pieces(batches, text, most):
        own = int(pa.compute.sum(pa.compute.binary_length(piece.column(text))).as_py() or 0)
        if held and size + own > most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(piece)
        size += own
    if held:
        yield pa.Table.from_batches(held)


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    out = np.ones(max(1, count), np.uint64)
    done, step = 1, base % (1 << 64)
    while done < len(out):
        more = min(done, len(out) - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


_RANDOM = np.random.default_rng(8)
VALUES = _RANDOM.integers(1, 1 << 63, 256, np.uint64)
FACTOR = int(_RANDOM.integers(1 << 40, 1 << 62)) * 2 + 1


def run_hashes(values: np.ndarray, first: np.ndarray, behind: np.ndarray, factor: int = FACTOR) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of runs of values; equal runs have equal hashes."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(factor, len(values))[: len(values)], out=sums[1:])
    back = powers(pow(factor, -1, 1 << 64), len(values))
    return (sums[behind] - sums[first]) * back[np.minimum(first, len(back) - 1)]


def hashed_words(data: np.ndarray, rows: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, where each word begins and ends, and a hash of each word.

    `letters` folds bytes, those that separate words to 0. `rows` has the start of each text
    and the end of the last; no word crosses a start.
    """
    folded = letters[data]
    inside = np.concatenate([[False], folded > 0, [False]])
    change = inside[1:] != inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    begins = np.flatnonzero(inside[1:] & (change | edge))
    ends = np.flatnonzero(inside[:-1] & (change | edge))
    return folded, begins, ends, run_hashes(VALUES[folded], begins, ends)


def bitmap(keys: DataFrame, column: str, most: int = 1 << 28) -> np.ndarray:
    """A bit for the low part of each key, in words of 64: a filter that lets all keys through.

    16 bits a key, `most` at most (32 MB): beyond it lets more other rows through, no fewer.
    The words are joined to 1,024 stretches in tasks, so that the driver gets no row for each
    but their bytes, which are as many as the bitmap has.
    """
    bits = min(most, 1 << max(20, (16 * keys.count()).bit_length()))
    each = max(1, bits // 64 // 1024)
    low = keys.select(F.col(column).bitwiseAND(bits - 1).alias("low"))
    words = low.groupBy(F.expr("shiftright(low, 6) AS word")).agg(F.expr("bit_or(shiftleft(1L, cast(low & 63 AS int))) AS set"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, there = np.zeros(bits // 64, np.uint64), np.zeros(bits // 64 // each, bool)
        for batch in batches:
            word = batch.column("word").to_numpy()
            out[word] = batch.column("set").to_numpy().view(np.uint64)
            there[word // each] = True
        for k in np.flatnonzero(there).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([out[k * each : (k + 1) * each].tobytes()])], ["stretch", "words"])

    out = np.zeros(bits // 64, np.uint64)
    dealt = words.repartition(F.expr(f"word div {each}"))
    for stretch, own in in_tasks(dealt, join, "stretch long, words binary").collect():
        out[stretch * each : (stretch + 1) * each] = np.frombuffer(own, np.uint64)
    return out


def among(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a key's bit is set: always if it was given."""
    low = keys & (len(words) * 64 - 1)
    return ((words[low >> 6] >> (low & 63).astype(np.uint64)) & np.uint64(1)) == 1


def some(df: DataFrame, column: str, bits: Broadcast, chosen: bool = True) -> DataFrame:
    """The rows of `df` whose key has its bit set, or those whose key has not."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(among(bits.value, batch.column(column).to_numpy(zero_copy_only=False)) == chosen))

    return in_tasks(df, task, df.schema)


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of `df` whose key is not among `keys`; a null key is not.

    Rows whose key has no bit in a bitmap of the keys stay where they are; only the others are
    shuffled to be compared with the keys themselves.
    """
    named, mark, gone_key = F.xxhash64(F.col(key).cast("string")), free(df, "_mark"), free(df, "_gone")
    gone = cut(keys.filter(F.col(key).isNotNull()).select(F.col(key).alias(gone_key), named.alias(mark)).distinct())
    bits = df.sparkSession.sparkContext.broadcast(bitmap(gone, mark))
    hashed = df.withColumn(mark, named)
    maybe = some(hashed, mark, bits).drop(mark)
    return some(hashed, mark, bits, chosen=False).drop(mark).union(maybe.join(gone.select(gone_key), F.col(key) == F.col(gone_key), "left_anti"))


def buckets_for(rows: int, each: int = 4096) -> int:
    """How many hash buckets leave about `each` of `rows` rows in one, or fewer."""
    return max(512, -(-rows // each))


def numbered(df: DataFrame, group: str, order: list[str], buckets: int, rows: str | None = None) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the order of a hash of `order`.

    Rows go to `buckets` hash buckets; a bucket's rows are numbered in a window and the rows of
    the buckets before it are added, so a group may hold any share of all rows. A row stands
    for as many rows as column `rows` says, if given, and `number` is that of the first.
    `group` has no nulls; `number` is the new column.
    """
    many = F.col(rows) if rows else F.lit(1)
    hashed = df.withColumn("_hash", F.xxhash64(*order)).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    sizes = hashed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_of")).agg(F.sum(many).alias("_size"))
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", "_of", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_bucket").orderBy("_hash")
    own = F.coalesce(F.sum(many).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if rows else F.row_number().over(inside) - 1
    return (
        hashed.withColumn("_inside", own)
        .join(starts, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_of")))
        .withColumn("number", F.col("_before") + F.col("_inside"))
        .drop("_hash", "_bucket", "_group", "_of", "_before", "_inside")
    )


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components: a row (vertex, component) for each vertex of a link.

    The component is its smallest vertex. Each round gives a vertex the smallest label among
    its neighbours and then the label of its label; rounds go on until nothing changes.
    """
    one = links.select(F.col(a).alias("v"), F.col(b).alias("w"))
    both = cut(one.union(one.select("w", "v")).filter("v <> w").distinct())
    labels = cut(both.groupBy(F.col("v").alias("vertex")).agg(F.min("w").alias("w")).select("vertex", F.least("vertex", "w").alias("component")))
    while True:
        near = both.join(labels, both.w == labels.vertex).groupBy("v").agg(F.min("component").alias("near"))
        met = labels.join(near, labels.vertex == near.v).select("vertex", "component", F.least("component", "near").alias("least"))
        above = labels.select(F.col("vertex").alias("_of"), F.col("component").alias("_above"))
        found = cut(
            met.join(above, F.col("least") == F.col("_of")).select("vertex", F.least("least", "_above").alias("component"), (F.least("least", "_above") != F.col("component")).alias("moved"))
        )
        labels = found.select("vertex", "component")
        if found.filter("moved").isEmpty():
            return labels
