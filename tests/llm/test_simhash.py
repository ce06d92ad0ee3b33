import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import simhash


def copies(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    bases = [[draw.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(draw.randrange(40)) for _ in range(draw.choice([3, 12, 90]))] for _ in range(8)]
    rows = []
    for k in range(n):
        text = list(draw.choice(bases))
        for _ in range(draw.randrange(3)):
            text[draw.randrange(len(text))] = "x" + str(draw.randrange(3))
        rows.append((k * 3, " ".join(text)))
    odd = [(7, None), (5, ""), (8, " \t\n"), (1, "One two"), (4, "oNE TWO"), (None, "one two"), (None, "solitary words here now"), (9, "a b C"), (9, "a b C")]
    return rows + odd


@pytest.mark.parametrize("node", [1024, 2])
def test_groups_are_those_of_all_pairs(spark, node):
    rows = copies(1, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_groups(docs, node=node).collect()
    assert brute.ordered(found) == brute.ordered(brute.near_groups(rows))


def test_links_of_random_neighbours(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 20, np.uint64)
    near = [int(x) ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 6), replace=False)) for x in base for _ in range(12)]
    bits = sorted({x - (1 << 64) if x >> 63 else x for x in map(int, near)})
    frame = spark.createDataFrame([(x,) for x in bits], "bits long")
    expected = brute.groups(len(bits), lambda i, j: ((bits[i] ^ bits[j]) & ((1 << 64) - 1)).bit_count() <= 4)
    place = {x: k for k, x in enumerate(bits)}
    for node, size in ((1024, None), (4, None), (8, 1 << 27), (8, 1 << 34)):
        pairs = {(place[a], place[b]) for a, b in simhash.near(frame, node=node, size=size).collect()}
        assert brute.groups(len(bits), lambda i, j: (i, j) in pairs or (j, i) in pairs) == expected
    assert [len(simhash._blocks(4, n)[0]) for n in (10, 1 << 22, 1 << 27, 1 << 33)] == [6, 6, 7, 8]


def test_one_document_of_a_group_stays(spark):
    rows = copies(2, 60)
    docs = spark.createDataFrame([(d, t, "x", 1.5) for d, t in rows], "doc_id long, text string, fingerprint string, bits double")
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    # One row of each group, of rows that share a doc_id as well; a row without doc_id only where no other is.
    prints = [brute.fingerprint(text) for _, text in rows]
    label = brute.groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    expected = [min((d is None, d or 0) for (d, _), own in zip(rows, label) if own == group) for group in set(label)]
    assert sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in kept.collect()) == sorted(expected)
    assert kept.select("doc_id", "text").distinct().count() == kept.count()


def test_long_text_and_empty_table(spark):
    text = "word " * 300_000 + "end"
    assert simhash._signs(text.encode().split(), 4, 42, step=1000) == simhash._signs(text.encode().split(), 4, 42)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(empty).collect() == []
    assert simhash.representatives(empty).collect() == []
