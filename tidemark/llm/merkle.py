"""A Merkle manifest of a dataset: a digest for every row, one for all, and a proof for each row.

Rows are leaves. The leaves of a group (a language) in the order of their key are a tree, the
roots of the groups are the leaves of a last tree, whose root names the dataset. A node is the
digest of its `fanout` children written one after another as hex.

The upper part of a tree is built by butterfly exchange. A group's leaves are cut into aligned
partitions of fanout**height leaves, each of which hashes its own subtree. In round r the
partitions whose numbers differ in digit r only (base `fanout`) swap the roots of their
subtrees, and each hashes the common parent for itself. After the last round every partition
has its group's root and, level by level, the siblings it was sent: the upper part of the
proofs of all its leaves, without a pass from the root down. A round moves one digest for each
partition and sibling, so what is exchanged is 1/4096 of the leaves a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table
from tidemark.operators import scan

#: A level of a proof: the digests left and right of the node in its run, each written together.
PATH = "array<struct<left:string,right:string>>"


def field(column: Column) -> Column:
    """A value with its length, so that no two rows are written alike; `-` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """Digest of a row."""
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf leads to along a proof."""
    return F.aggregate(proof, start, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def _grow(leaves: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """The levels of a tree from its leaves to its root, or to `height` levels above the leaves."""
    levels = [leaves]
    while len(levels[-1]) > 1 or (height is not None and len(levels) <= height):
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[k : k + fanout]).encode()).hexdigest() for k in range(0, len(below), fanout)])
    return levels


def _levels(own: pa.Table, block: int, fanout: int, height: int) -> tuple[pa.Table, list[list[str]]]:
    """Rows of a partition in order, and its subtree: of full height unless it may be the only one."""
    own = own.sort_by("_index")
    return own, _grow(own.column("_node").to_pylist(), fanout, height if block else None)


def _swap(state: DataFrame, span: int, fanout: int) -> DataFrame:
    """One round: partitions with the same digits but that of `span` swap their roots.

    In a tree that is not full the partner may be missing: then another partition under the
    same sibling answers, all of which have its root.
    """
    at = F.expr(f"_block div {span}")
    digit = at % fanout
    known, heard = state.withColumns({"_digit": digit, "_base": at - digit}), []
    senders = state.select(F.col("_group").alias("_sender"), F.col("_block").alias("_from"), F.col("_node").alias("_said"))
    for step in range(1, fanout):
        other = (F.col("_digit") + step) % fanout
        first = (F.col("_base") + other) * span
        asks = (F.col("_parts") > span) & (first < F.col("_parts"))
        asked = F.when(asks, first + F.col("_block") % F.least(F.lit(span), F.col("_parts") - first))
        said = senders.withColumnRenamed("_said", f"_said{step}")
        known = known.withColumn("_asked", asked).join(said, (F.col("_group") == F.col("_sender")) & (F.col("_asked") == F.col("_from")), "left").drop("_sender", "_from", "_asked")
        heard.append(F.struct(other.alias("digit"), F.col(f"_said{step}").alias("node")))
    siblings = F.array_sort(F.filter(F.array(*heard), lambda x: x["node"].isNotNull()))
    side = lambda keep: F.array_join(F.transform(F.filter("_siblings", keep), lambda x: x["node"]), "")
    known = known.withColumn("_siblings", siblings).withColumns({"_left": side(lambda x: x["digit"] < F.col("_digit")), "_right": side(lambda x: x["digit"] > F.col("_digit"))})
    grows = F.col("_parts") > span
    level = F.array(F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))
    return known.select(
        "_group",
        "_block",
        "_parts",
        F.when(grows, F.sha2(F.concat("_left", "_node", "_right"), 256)).otherwise(F.col("_node")).alias("_node"),
        F.when(grows, F.concat("_path", level)).otherwise(F.col("_path")).alias("_path"),
    )


def _upper(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    """A row for each partition: group, block, the root of its group and its path from its own root to that."""

    def root(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        group, block = (x.as_py() for x in key)
        return pa.table({"_group": [group], "_block": pa.array([block], pa.int64()), "_node": [_levels(own, block, fanout, height)[1][-1][0]]})

    roots = cut(nodes.groupBy("_group", "_block").applyInArrow(root, "_group string, _block long, _node string"))
    parts = roots.groupBy(F.col("_group").alias("_of")).agg(F.count("*").alias("_parts"))
    state = roots.join(parts, F.col("_group") == F.col("_of")).select("_group", "_block", "_parts", "_node", F.expr(f"cast(array() AS {PATH}) AS _path"))
    most = parts.agg(F.max("_parts")).first()[0] or 0
    span = 1
    while span < most:
        state = cut(_swap(state, span, fanout))
        span *= fanout
    return state


def prove(nodes: DataFrame, upper: DataFrame, fanout: int, height: int) -> DataFrame:
    """`nodes` with the proof of each row: its path inside its partition, then the partition's."""
    carried = [f for f in nodes.schema if f.name not in ("_group", "_block", "_index")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), "proof " + PATH, "subroot string", "root string"])
    kind = pa.struct([("left", pa.string()), ("right", pa.string())])

    def paths(own: pa.Table, above: pa.Table) -> pa.Table:
        block = own.column("_block")[0].as_py()
        own, levels = _levels(own, block, fanout, height)
        top = above.column("_path")[0].as_py()
        rows, places = own.num_rows, np.arange(own.num_rows)
        sides = {"left": [], "right": []}
        for nodes in levels[:-1]:
            base = [k - k % fanout for k in range(len(nodes))]
            sides["left"].append(np.array(["".join(nodes[b:k]) for k, b in enumerate(base)], object)[places])
            sides["right"].append(np.array(["".join(nodes[k + 1 : b + fanout]) for k, b in enumerate(base)], object)[places])
            places = places // fanout
        for level in top:
            for side, found in sides.items():
                found.append(np.full(rows, level[side], object))
        deep = len(levels) - 1 + len(top)
        flat = [pa.array(np.stack(sides[f.name], axis=1).ravel() if deep else [], pa.string()) for f in kind]
        proof = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * deep), pa.StructArray.from_arrays(flat, fields=list(kind)))
        out = own.select([f.name for f in carried]).append_column("proof", proof)
        for name, source in (("subroot", "_subroot"), ("root", "_root")):
            out = out.append_column(name, pa.array([above.column(source)[0].as_py()] * rows, pa.string()))
        return out

    keys = ["_group", "_block"]
    return nodes.groupBy(*keys).cogroup(upper.groupBy(*keys)).applyInArrow(paths, schema)


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", key: str = "doc_id",
    fanout: int = 2, height: int = 12, more: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of `docs`: its key, `leaf`, `proof`, and the roots of its group (`subroot`) and of all (`root`).

    A leaf covers `columns`; `more` are columns of `docs` to come along. Leaves of a group ascend
    by key, null keys first; rows that share a key follow their digests, and repeated rows are a
    leaf each. Groups ascend by their UTF-8 bytes, a null group first, an empty one next. A tree of one
    leaf is that leaf, with no level in its proof. A null value differs from an empty one. An
    empty table gives no rows. Other columns of `docs` take no part, whatever their names.

    Only digests are shuffled, never texts. A group may hold any share of the rows: its leaves
    are numbered in ranges and hashed in partitions of fanout**height.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    own = {f"_more{k}": column for k, column in enumerate((more or {}).values())}
    rows = docs.select(named.alias("_group"), F.col(key).alias("_key"), leaf(*(F.col(c) for c in columns)).alias("_node"), *(c.alias(k) for k, c in own.items()))
    placed = scan.numbered(cut(rows), "_group", ["_key", "_node"], "_index")
    nodes = cut(placed.withColumn("_block", F.expr(f"_index div {fanout**height}")))
    state = _upper(nodes, fanout, height)
    tops = state.filter("_block = 0").select(F.col("_group").alias("_key"), F.col("_node"))
    last = scan.numbered(tops, [], ["_key"], "_index").withColumns({"_group": F.lit(""), "_block": F.expr(f"_index div {fanout**height}")})
    last = cut(last)
    above = _upper(last, fanout, height).withColumns({"_subroot": F.lit(None).cast("string"), "_root": F.col("_node")})
    groups = prove(last, above, fanout, height).select(F.col("_key").alias("_of"), F.col("_node").alias("_subroot"), F.col("proof").alias("_more_path"), F.col("root").alias("_root"))
    whole = state.join(groups, F.col("_group") == F.col("_of")).select("_group", "_block", F.concat("_path", "_more_path").alias("_path"), "_subroot", "_root")
    proved = prove(nodes, whole, fanout, height)
    return proved.select(F.col("_key").alias(key), F.col("_node").alias("leaf"), "proof", "subroot", "root", *(F.col(k).alias(name) for k, name in zip(own, more or {}, strict=True)))


def op11(spark, sf_dir: str) -> DataFrame:
    """The manifest of `documents`, and whether each row, some of them tampered with, still proves its root.

    Where 7 divides the checksum of the doc_id, n_chars grows by 1; a null doc_id has none and
    a null n_chars stays, so such rows verify. `manifest` says what becomes of nulls, repeated
    rows, empty tables and other columns.
    """
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    longer = F.col("n_chars").cast("decimal(20,0)") + 1
    other = F.when(chosen & F.col("n_chars").isNotNull(), leaf(F.col("doc_id"), F.col("source"), F.col("lang"), longer, F.col("text")))
    found = manifest(docs, more={"tampered": other}).withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
