import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import among, bitmap


def plain(keys: np.ndarray, n: int) -> np.ndarray:
    """Words of 64 bits, those of the low parts of the keys set."""
    out = np.zeros(n * 64, np.uint8)
    out[keys & (n * 64 - 1)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def test_the_driver_gets_the_bytes_of_a_bitmap_and_no_row_for_each_word(spark):
    bitmap(spark.range(10).withColumnRenamed("id", "key"), "key")  # imports
    keys = spark.range(1 << 18).select(F.xxhash64("id").alias("key"))
    tracemalloc.start()
    try:
        words = bitmap(keys, "key")
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    given = np.array([r["key"] for r in keys.collect()])
    assert len(words) == 1 << 17 and np.array_equal(words, plain(given, len(words)))
    assert most < 8 * words.nbytes


@pytest.mark.parametrize("n, most", [(0, 1 << 28), (1, 1 << 28), (3000, 1 << 28), (3000, 1 << 10), (3000, 1 << 8), (70_000, 1 << 28), (70_000, 1 << 18)])
def test_bits_of_repeated_and_negative_keys(spark, n, most):
    """As many words as asked for, also where a stretch has one word, or all are set."""
    keys = spark.range(n).select((F.xxhash64("id") * F.pow(F.lit(-1), F.col("id")).cast("long")).alias("key"))
    own = np.array([r["key"] for r in keys.collect()], np.int64)
    words = bitmap(keys.union(keys).union(spark.createDataFrame([(-1,)] * 500, "key long")), "key", most)
    own = np.append(own, -1)
    assert len(words) * 64 == min(most, 1 << max(20, (16 * (2 * n + 500)).bit_length()))
    assert np.array_equal(words, plain(own, len(words))) and among(words, own).all()
