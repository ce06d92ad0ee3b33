"""SimHash near-dedup by a self-join of binary tries over the fingerprints.

Two fingerprints that differ in at most `most` bits agree in at least 2 of `most + 2` blocks
of their bits (3 of `most + 3`, and so on, for more fingerprints). Each fingerprint goes to
one trie for every choice of so many blocks, under the node that those blocks' bits lead to;
whatever lies below other nodes has spent its errors on bits that must agree. Below a node, pairs of nodes are traversed together: a pair splits
into the pairs of its children, differing bits add up, and a pair over the budget is dropped.
A node with many fingerprints is first split into pairs of its descendants by DataFrame
joins under the same rule, so that no task takes more than a pair of small nodes at a time.

A task returns links that connect what it found linked (each to the least of its linked
group), never all pairs; connected components run over these links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, free, in_tasks, pieces, row_name, table, without

BITS = 64


def _signs(words: list[bytes], length: int, seed: int, step: int = 200_000) -> int:
    """The SimHash fingerprint of a text's words, their shingles taken `step` at a time."""
    if not words:
        return 0
    counts, total = np.zeros(BITS, np.int64), max(1, len(words) - length + 1)
    digest = xxhash.xxh64_intdigest
    for first in range(0, total, step):
        part = words[first : min(first + step, total) + length - 1]
        ends = np.cumsum([len(word) + 1 for word in part])
        begins = (ends - [len(word) + 1 for word in part]).tolist()
        ends = (ends - 1).tolist()
        joined = b" ".join(part)
        last = min(length, len(part)) - 1
        hashes = np.array([digest(joined[i:j], seed) for i, j in zip(begins, ends[last:], strict=False)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, length: int = 4, seed: int = 42, name: Column | None = None) -> DataFrame:
    """(doc_id, bits): the SimHash fingerprint of each whole text as a signed long, and `name` of the row if given.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles have
    `length` words (a shorter text is one shingle). No words (null, empty): 0.
    """
    keep = ["doc_id"] if name is None else ["doc_id", "name"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 2 << 20):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            bits = np.array([_signs((text or b"").lower().split(), length, seed) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(bits.view(np.int64))], [*keep, "bits"])

    own = [] if name is None else [name.cast("string").alias("name")]
    kinds = ["doc_id long", *(["name string"] if own else []), "bits long"]
    return in_tasks(docs.select(F.col("doc_id").cast("long"), *own, F.col("text").cast("string")), task, ", ".join(kinds))


def _cartesian(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all members of each pair of ranges."""
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = np.arange(int(sizes.sum())) - starts
    wide = np.repeat(wide, sizes)
    return np.repeat(a0, sizes) + inside // wide, np.repeat(b0, sizes) + inside % wide


def trie_links(bits: np.ndarray, pairs: np.ndarray, most: int, leaf: int = 64, block: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of members of the node pairs that differ in at most `most` bits.

    `pairs` has rows (a0, a1, b0, b1): two ranges of `bits` that are each sorted; a range
    paired with itself gives i < j. Ranges are nodes of binary tries. All pairs go down a
    bit at a time; one with at most `leaf` combinations is compared directly.
    """
    stack = [(BITS - 1, np.asarray(pairs, np.int64).reshape(-1, 4), np.zeros(len(pairs), np.int64))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        level, nodes, spent = stack.pop()
        if len(nodes) > block // leaf:
            half = len(nodes) // 2
            stack += [(level, nodes[half:], spent[half:]), (level, nodes[:half], spent[:half])]
            continue
        a0, a1, b0, b1 = nodes.T
        small = (a1 - a0) * (b1 - b0) <= leaf
        if level < 0:
            small[:] = True
        if small.any():
            i, j = _cartesian(*nodes[small].T)
            near = (i < j) & (np.bitwise_count(bits[i] ^ bits[j]) <= most)
            yield i[near], j[near]
            nodes, spent = nodes[~small], spent[~small]
            a0, a1, b0, b1 = nodes.T
        if not len(nodes):
            continue
        if level not in ones:
            ones[level] = np.concatenate([[0], np.cumsum((bits >> np.uint64(level)) & np.uint64(1), dtype=np.int64)])
        c = ones[level]
        a, b, same = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0]), a0 == b0
        children = [(a0, a, b0, b, 0, None), (a, a1, b, b1, 0, None), (a0, a, b, b1, 1, None), (a, a1, b0, b, 1, ~same)]
        found, errors = [], []
        for x0, x1, y0, y1, cost, where in children:
            kept = (x1 > x0) & (y1 > y0) & (spent + cost <= most)
            kept &= where if where is not None else True
            found.append(np.stack([x0, x1, y0, y1], axis=1)[kept])
            errors.append(spent[kept] + cost)
        stack.append((level - 1, np.concatenate(found), np.concatenate(errors)))


def _least(n: int, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n positions the least one that the found pairs connect it with."""
    label = np.arange(n)
    for i, j in found:
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _join(most: int, chunk: int):
    """A task over rows (pair, side, bits) in the order of pairs: links within each pair."""

    def links(pair: np.ndarray, side: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((bits, side, pair))
        pair, side, bits = pair[order], side[order], bits[order]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (side[1:] != side[:-1])]))
        ends = np.append(new[1:], len(bits))
        of, which = pair[new], side[new]
        alone = which == 0  # a node with itself
        first = (which == 1) & np.append(of[1:] == of[:-1], False)
        second = np.flatnonzero(first) + 1
        nodes = np.concatenate(
            [np.stack([new[alone], ends[alone], new[alone], ends[alone]], axis=1), np.stack([new[first], ends[first], new[second], ends[second]], axis=1)]
        )
        nodes = nodes[(nodes[:, 0] != nodes[:, 2]) | (nodes[:, 1] - nodes[:, 0] > 1)]
        least = _least(len(bits), trie_links(bits, nodes, most))
        moved = np.flatnonzero(least != np.arange(len(bits)))
        return pa.RecordBatch.from_arrays([pa.array(bits[moved].view(np.int64)), pa.array(bits[least[moved]].view(np.int64))], ["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(name).to_numpy(zero_copy_only=False) for name in ("pair", "side", "bits")))
            rows += batch.num_rows
            if rows < chunk:
                continue
            pair, side, bits = (np.concatenate(x) for x in zip(*held, strict=True))
            done = int(np.searchsorted(pair, pair[-1]))  # the last pair may go on in the next batch
            if done:
                yield links(pair[:done], side[:done], bits[:done].view(np.uint64))
            held, rows = [(pair[done:], side[done:], bits[done:])], len(pair) - done
        if held:
            pair, side, bits = (np.concatenate(x) for x in zip(*held, strict=True))
            yield links(pair, side, bits.view(np.uint64))

    return task


def _blocks(most: int, rows: int) -> tuple[list[tuple[int, int]], int]:
    """(lowest bit, bits) of blocks of nearly equal size, and how many of them agree.

    So many that a node under the agreeing blocks has a few of `rows` random fingerprints.
    """
    agree = 2
    while BITS * agree // (most + agree) < min(rows, 1 << 40).bit_length() - 2 and most + agree < BITS // 2:
        agree += 1
    edges = [BITS * k // (most + agree) for k in range(most + agree + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)], agree


def near(distinct: DataFrame, most: int = 4, node: int = 1024, step: int = 4, chunk: int = 1 << 18, size: int | None = None) -> DataFrame:
    """(a, b): links that connect all of the distinct `bits` at most `most` apart.

    Nodes with over `node` fingerprints are split `step` bits deeper until none is larger.
    `size` is the number of fingerprints to lay the blocks out for, by default their count.
    """
    blocks, agree = _blocks(most, distinct.count() if size is None else size)
    roots = []
    for k, chosen in enumerate(combinations(blocks, agree)):
        root = F.lit(k).cast("long")
        for low, wide in chosen:
            root = root * (1 << wide) + F.shiftrightunsigned("bits", low).bitwiseAND((1 << wide) - 1)
        roots.append(root)
    rows = distinct.select("bits", F.explode(F.array(*roots)).alias("root"))
    sizes = rows.groupBy("root").count()
    large = cut(sizes.filter(F.col("count") > node).select("root"))
    plain = rows.select(F.col("root").alias("pair"), F.lit(0).alias("side"), "bits")
    parts = [plain]
    if not large.isEmpty():
        parts = [plain.join(large, plain.pair == large.root, "left_anti"), _split(rows.join(large, "root", "left_semi"), most, node, step)]
    union = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    shuffles = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return union.repartition(shuffles, "pair").sortWithinPartitions("pair").mapInArrow(_join(most, chunk), "a long, b long")


def _split(rows: DataFrame, most: int, node: int, step: int) -> DataFrame:
    """(pair, side, bits) of large nodes: traverse pairs of descendants until each is small.

    A pair is (root, depth, a, b, spent); a and b are the leading `depth` bits of two nodes.
    """
    rows = cut(rows)
    prefix = lambda depth: F.shiftrightunsigned("bits", BITS - depth) if depth else F.lit(0).cast("long")
    pairs = rows.select("root", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("spent")).distinct()
    done, depth = [], 0
    while True:
        sizes = rows.groupBy("root", prefix(depth).alias("at")).count()
        known = pairs
        for side in "ab":
            own = sizes.select(F.col("root").alias("_root"), F.col("at").alias("_at"), F.col("count").alias(f"n{side}"))
            known = known.join(own, (F.col("root") == F.col("_root")) & (F.col(side) == F.col("_at"))).drop("_root", "_at")
        known = cut(known)
        small = (F.greatest("na", "nb") <= node) | F.lit(depth >= BITS)
        named = known.filter(small).withColumn("pair", -1 - F.abs(F.xxhash64("root", F.lit(depth), "a", "b").bitwiseAND((1 << 62) - 1)))
        ends = named.select("root", "pair", F.col("a").alias("at"), F.when(F.col("a") == F.col("b"), 0).otherwise(1).alias("side")).union(
            named.filter("a <> b").select("root", "pair", F.col("b").alias("at"), F.lit(2).alias("side"))
        )
        done.append(rows.withColumn("at", prefix(depth)).join(ends, ["root", "at"]).select("pair", "side", "bits"))
        rest = known.filter(~small)
        if rest.isEmpty():
            break
        wide = min(step, BITS - depth)
        depth += wide
        child = F.explode(F.sequence(F.lit(0), F.lit((1 << wide) - 1)))
        grown = rest.select("root", "a", "b", "spent", child.alias("x")).select("*", child.alias("y"))
        grown = grown.select(
            "root",
            (F.col("a") * (1 << wide) + F.col("x")).alias("a"),
            (F.col("b") * (1 << wide) + F.col("y")).alias("b"),
            (F.col("spent") + F.bit_count(F.col("x").bitwiseXOR(F.col("y")))).alias("spent"),
        )
        pairs = grown.filter((F.col("spent") <= most) & (F.col("a") <= F.col("b")))
    out = done[0]
    for one in done[1:]:
        out = out.unionByName(one)
    return out


def near_groups(docs: DataFrame, length: int = 4, most: int = 4, seed: int = 42, node: int = 1024) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`.

    Documents whose fingerprints differ in at most `most` bits are linked; component_id is the
    smallest doc_id that can be reached. Equal fingerprints (repeated rows, texts without
    words) are one node. Rows without doc_id keep null and count for no component_id; where
    no doc_id can be reached it is null. An empty table gives no rows.
    """
    found = _grouped(cut(fingerprints(docs, length, seed)), F.col("doc_id"), most, node)
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def _grouped(prints: DataFrame, order: Column, most: int, node: int) -> DataFrame:
    """`prints` with the least `order` that links lead to in `first`."""
    distinct = cut(prints.groupBy("bits").agg(F.min(order).alias("least")))
    labels = components(near(distinct, most, node), "a", "b")
    rooted = distinct.join(labels, distinct.bits == labels.vertex, "left").select("bits", "least", F.coalesce("component", "bits").alias("component"))
    # Written, so that the join below deals both sides anew and can split a large component.
    smallest = cut(rooted.groupBy("component").agg(F.min("least").alias("first")))
    named = rooted.join(smallest, "component").select(F.col("bits").alias("_bits"), "first")
    return prints.join(named, F.col("bits") == F.col("_bits"))


def representatives(docs: DataFrame, length: int = 4, most: int = 4, seed: int = 42, node: int = 1024) -> DataFrame:
    """The rows of `docs` that stay: one of each group, that with the smallest doc_id, or without any where none has one.

    Rows are named by doc_id and text, so different texts that share a doc_id are judged each
    by itself; of equal doc_ids the least name stays, of equal rows one.
    """
    mark = free(docs, "_row")
    named = docs.withColumn(mark, row_name("doc_id", "text"))
    prints = cut(fingerprints(named, length, seed, F.col(mark)))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("name"))
    found = _grouped(prints, order, most, node)
    each = cut(found.groupBy(F.col("name").alias(mark)).agg(F.bool_and(F.col("name") == F.col("first")["name"]).alias("stays"), F.count("*").alias("rows")))
    kept = without(named, each.filter("not stays"), mark)
    again = free(named, "_again")
    repeated = each.filter("stays and rows > 1").select(F.col(mark).alias(again))
    if not repeated.isEmpty():
        twice = kept.join(repeated, F.col(mark) == F.col(again), "left_semi").dropDuplicates([mark])
        kept = kept.join(repeated, F.col(mark) == F.col(again), "left_anti").unionByName(twice)
    return kept.drop(mark)


def op3(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
