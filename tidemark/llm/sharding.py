"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for a key; the key goes to the shard with the best draw. A draw
depends on the key, the shard's name and the shard's weight only, so a further shard takes
keys into itself and moves none between the others, and a shard that goes gives up its own
keys only. A shard gets a share of the keys in proportion to its weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, numbered, table

#: Hex digits of a digest that make a draw; 2**52 different draws are exact as a double.
DIGITS = 13


def choose(key: Column, weights: dict[int, float]) -> Column:
    """The shard (a key of `weights`) of each row; equal draws go to the smaller shard.

    The draw is the usual -ln(u) / weight of a uniform u, the least one wins. A null key is a
    key like any other. Shards without a positive weight get nothing.
    """
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    draws = []
    for shard, weight in sorted(weights.items()):
        if weight > 0:
            digest = F.md5(F.concat(text, F.lit(f":{shard}")).cast("binary"))
            u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 1.0) / (16.0**DIGITS + 1.0)
            draws.append(F.struct((-F.ln(u) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    if not draws:
        raise ValueError("no shard has a positive weight")
    return F.array_min(F.array(*draws))["shard"]


def equal(count: int) -> dict[int, float]:
    """`count` shards of the same weight."""
    return dict.fromkeys(range(count), 1.0)


def assign(docs: DataFrame, weights: dict[int, float], key: str = "doc_id", column: str = "shard") -> DataFrame:
    """`docs` with its shard in `column`; no shuffle."""
    return docs.withColumn(column, choose(F.col(key), weights))


def write(docs: DataFrame, path: str, weights: dict[int, float], key: str = "doc_id") -> None:
    """Write a folder of Parquet files for each shard."""
    assign(docs, weights, key).write.partitionBy("shard").parquet(path)


def digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: size, checksum, shard, place in the shard, shard with one more.

    The law is `key`: doc_id and the number of shards decide. `size` is the UTF-8 bytes of the
    text plus 1; a null text has none and the checksum of no bytes. Slots number a shard's
    rows from 0 in the order of a hash. Repeated rows get a slot each; rows with one doc_id
    share a shard. A null doc_id is a key of its own. An empty table gives no rows.
    """
    bytes_ = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_rows"))
    placed = assign(counted, equal(shards))
    return (
        numbered(placed, "shard", ["doc_id", "size", "text_crc32"], buckets_for(docs.count() // shards), "_rows")
        .withColumn("slot", F.explode(F.sequence("number", F.col("number") + F.col("_rows") - 1)))
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", choose(F.col("doc_id"), equal(shards + 1)).alias("grown_shard"))
    )


def op4(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
