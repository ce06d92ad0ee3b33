"""Exact top-k search with a bit-sliced index.

The rows are dealt to blocks. A block's index has a bitmap for each bit of each quantised
attribute, a bit per row. For a query, the slices of all attributes, shifted by the set
digits of the query's weights, are added by bitmap arithmetic (carry-save adders, then one
ripple), which gives the slices of every row's approximate score at once. The most
significant slice downward then selects the k best approximate scores. The quantisation
error is bounded by the weights, so rows that come within twice the bound of the k-th are
selected too, from the same slices, and these boundary rows are scored exactly.

A block's rows come first in its task and are indexed once; the queries then stream past them, a
batch at a time, so neither side is ever whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, in_tasks, table

WORD = 64


def _pack(bits: np.ndarray) -> np.ndarray:
    """Bitmaps (…, rows) as words of 64 rows."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], short), np.uint8)], axis=-1)
    return np.ascontiguousarray(packed).view(np.uint64)


class Index:
    """Bit slices of one block of integer vectors, in the order of their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bits: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low = int(self.vectors.min()) if self.vectors.size else 0
        span = int(self.vectors.max()) - self.low if self.vectors.size else 0
        self.shift = max(0, span.bit_length() - bits)
        quantised = ((self.vectors - self.low) >> self.shift).T  # attribute, row
        self.slices = [_pack((quantised >> b) & 1) for b in range(max(1, (span >> self.shift).bit_length()))]
        self.all = _pack(np.ones(len(ids), np.uint8))
        self.words = len(self.all)

    def approximate(self, weights: np.ndarray) -> tuple[list[np.ndarray], int, int]:
        """Slices of sum(weight * quantised) - least, the least possible sum, and the error bound.

        A negative weight adds the complement of a slice, so all that is added is positive.
        """
        columns: dict[int, list[np.ndarray]] = {}
        top = (1 << len(self.slices)) - 1
        size = np.abs(weights)
        flip = np.where(weights < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
        for digit in range(int(size.max()).bit_length() if len(size) else 0):
            chosen = (size >> digit) & 1 == 1
            if chosen.any():
                for b, bitmap in enumerate(self.slices):
                    columns.setdefault(digit + b, []).append(bitmap[chosen] ^ flip[chosen])
        out: list[np.ndarray] = []
        level = 0
        while columns:
            # three bitmaps of a column become one there and one in the next, all at once
            here = columns.pop(level, [])
            stack = np.concatenate([x.reshape(-1, self.words) for x in here]) if here else np.zeros((0, self.words), np.uint64)
            while len(stack) > 2:
                n = len(stack) // 3
                a, b, c, rest = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n], stack[3 * n :]
                half = a ^ b
                columns.setdefault(level + 1, []).append((a & b) | (half & c))
                stack = np.concatenate([half ^ c, rest])
            if len(stack) == 2:
                columns.setdefault(level + 1, []).append((stack[0] & stack[1])[None])
                stack = stack[:1] ^ stack[1:]
            out.append(stack[0] if len(stack) else np.zeros(self.words, np.uint64))
            level += 1
        least = -int(size[weights < 0].sum()) * top
        return out, least, int(size.sum()) * ((1 << self.shift) - 1)

    def best(self, slices: list[np.ndarray], among: np.ndarray, k: int) -> tuple[np.ndarray, int]:
        """The k rows of highest score, from the top slice downward, and the k-th score.

        Rows that tie for the last places are all in the result.
        """
        sure, open_, score = np.zeros(self.words, np.uint64), among, 0
        for b in range(len(slices) - 1, -1, -1):
            ones = open_ & slices[b]
            both = sure | ones
            if int(np.bitwise_count(both).sum()) >= k:
                open_, score = ones, score | (1 << b)
            else:
                sure, open_ = both, open_ & ~slices[b]
        return sure | open_, score

    def at_least(self, slices: list[np.ndarray], among: np.ndarray, least: int) -> np.ndarray:
        """The rows whose score is `least` at least, from the top slice downward."""
        if least <= 0:
            return among
        if least >> len(slices):
            return np.zeros(self.words, np.uint64)
        above, equal = np.zeros(self.words, np.uint64), among
        for b in range(len(slices) - 1, -1, -1):
            if (least >> b) & 1:
                equal = equal & slices[b]
            else:
                above = above | (equal & slices[b])
                equal = equal & ~slices[b]
        return above | equal

    def search(self, own: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the block's k best rows for a query whose own id is `own`."""
        among = self.all.copy()
        first, behind = np.searchsorted(self.ids, [own, own + 1])
        for row in range(first, behind):
            among[row // WORD] &= ~(np.uint64(1) << np.uint64(row % WORD))
        slices, least, bound = self.approximate(weights)
        if slices and int(np.bitwise_count(among).sum()) > k:
            _, kth = self.best(slices, among, k)
            # in units of 2**shift; the error of a row is in [0, bound] for positive weights
            # and in [-bound, 0] for negative ones, so two rows are off by `bound` at most
            reach = -(-bound // (1 << self.shift))
            among = self.at_least(slices, among, kth - reach)
        rows = np.flatnonzero(np.unpackbits(among.view(np.uint8), bitorder="little")[: len(self.ids)])
        scores = self.vectors[rows] @ weights
        top = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[top]], scores[top]


def quantised(vector: str, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as long; null for vectors with unusable components."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, bits: int = 8, block_rows: int = 16_384, block_queries: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the highest inner product per query.

    `rows` and `queries` have vec_id and `parts`, long vectors (see `quantised`). A row with the
    query's own vec_id is no candidate; a repeated row has a rank for each time it is there,
    a repeated query is asked once; ties go to the smaller vec_id; a query with fewer
    candidates has fewer rows. A task holds a block of about `block_rows` rows and asks
    `block_queries` queries at a time. Only vectors of the query's length are candidates. Null
    vectors and ids take no part; empty tables give no rows.
    """
    times = rows.filter("vec_id is not null and parts is not null").groupBy("vec_id", "parts").agg(F.count("*").alias("_times"))
    # no query has more than k ranks for one row, however often it is there
    times = times.withColumn("_times", F.least("_times", F.lit(k)).cast("int"))
    rows = cut(times.withColumn("_times", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select("vec_id", "parts"))
    queries = cut(queries.filter("vec_id is not null and parts is not null").distinct())
    cores = rows.sparkSession.sparkContext.defaultParallelism
    count = rows.count()
    left = max(1, -(-count // block_rows), min(cores, -(-count // 1024)))
    # a block's rows (_kind 0), moved once, and behind them all queries (_kind 1)
    own = rows.select(F.pmod(F.xxhash64("vec_id", "parts", F.lit(1)), F.lit(left)).alias("_row"), F.lit(0).alias("_kind"), "vec_id", "parts")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(left - 1).cast("long")))
    met = own.union(queries.select(every.alias("_row"), F.lit(1).alias("_kind"), "vec_id", "parts"))

    def arrays(part: pa.Table | pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and vectors of each length."""
        vectors = part.column("parts")
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        ids, wide = part.column("vec_id").to_numpy(zero_copy_only=False), pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
        for width in np.unique(wide):
            chosen = wide == width
            yield ids[chosen], vectors.filter(pa.array(chosen)).flatten().to_numpy(zero_copy_only=False).reshape(int(chosen.sum()), int(width))

    def asked(indexes: dict[int, Index], asking: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for ids, vectors in arrays(asking):
            index = indexes.get(vectors.shape[1])
            for own_id, weights in zip(ids.tolist(), vectors, strict=True) if index else ():
                found, scores = index.search(own_id, weights, k)
                key = np.array([weights.tobytes()] * len(found), object)
                for column, x in zip(out, (np.full(len(found), own_id), key, found, scores), strict=True):
                    column.append(x)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        keys = pa.array(flat[1].tolist() if len(flat[1]) else [], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(flat[0], pa.int64()), keys, pa.array(flat[2], pa.int64()), pa.array(flat[3], pa.int64())], ["query_id", "vector", "vec_id", "score"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, indexes = None, [], {}
        for batch in batches:
            keys = batch.column("_row").to_numpy(zero_copy_only=False) * 2 + batch.column("_kind").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for first, behind in zip(edges[:-1], edges[1:], strict=True):
                if first == behind:
                    continue
                part, (row, kind) = batch.slice(first, behind - first), divmod(int(keys[first]), 2)
                if row != block:
                    block, held, indexes = row, [], {}
                if kind == 0:
                    held.append(part)
                    continue
                if held:
                    indexes, held = {vectors.shape[1]: Index(ids, vectors, bits) for ids, vectors in arrays(pa.Table.from_batches(held))}, []
                for at in range(0, part.num_rows, block_queries):
                    yield asked(indexes, part.slice(at, block_queries))

    found = in_tasks(met.repartition(left, "_row").sortWithinPartitions("_row", "_kind"), task, "query_id long, vector binary, vec_id long, score long")
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", quantised("embedding").alias("parts"))
    return top_k(rows, rows.filter("vec_id % 100 = 0"))
