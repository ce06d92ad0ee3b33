import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import LOW
from tidemark.llm import jaccard


def shingles(text: str | None, length: int = 5) -> frozenset[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < length:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[k : k + length]) for k in range(len(words) - length + 1))


def plain(rows: list[tuple], percent: int = 80) -> list[tuple]:
    sets = [shingles(text) for _, text in rows]
    label = list(range(len(rows)))

    def top(k: int) -> int:
        while label[k] != k:
            k = label[k]
        return k

    holders = defaultdict(list)
    for k, own in enumerate(sets):
        for shingle in own:
            holders[shingle].append(k)
    shared: dict = defaultdict(int)
    for held in holders.values():
        for b in held:
            for a in held:
                if a < b:
                    shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            label[top(a)] = top(b)
    least: dict = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(k)] = min(least.get(top(k), doc), doc)
    out = [(doc, len(own), least.get(top(k)) if own else doc) for k, ((doc, _), own) in enumerate(zip(rows, sets))]
    return sorted(out, key=repr)


def near(seed: int, count: int) -> list[tuple]:
    """Copies of few texts with up to three words changed or some left out, odd texts and repeated rows."""
    draw = random.Random(seed)
    base = [draw.choices("abcdefghijklmnop", k=60) for _ in range(3)]
    rows: list[tuple] = []
    for k in range(count):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            words[draw.randrange(60)] = draw.choice([f"zz{draw.randrange(9)}", "q"])
        rows.append((draw.choice([k, k, k, None]), " ".join(words[: draw.choice([60, 60, 58, 50])])))
    rows += [(1000, "a b"), (1001, "A  b"), (1002, ""), (1003, None), (1004, " \t"), (None, "a\0 b"), (1005, "a b\nc"), (1006, "x" * 5000), (1000, "a b")]
    return rows


@pytest.mark.parametrize("settings", [{}, {"hot": 3, "rounds": 1, "each": 400, "weight": 1.0, "longest": 20}])
def test_equal_to_all_pairs(spark, settings):
    """A plain run, and one with long posting lists, several parts and long prefixes."""
    rows = near(3, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS `set`", "3 AS _id", "'x' AS _text")
    found = sorted((tuple(r) for r in jaccard.join(df, **settings).collect()), key=repr)
    assert found == plain(rows)


def test_one_match_and_no_stars(spark):
    rows = near(4, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard.join(df, longest=1, rounds=0).collect()), key=repr) == plain(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(df).collect() == []


def test_sets_are_those_of_the_words():
    texts = ["A b\tc d e f", "a b c d e f", "a b", "A\x0bB", "", None, "a\0b c d e f g", "  x  ", "a b c a b c a b c a b c"]
    starts, members, names = jaccard.shingle_sets(pa.array(texts), 5)
    wanted = [shingles(t) for t in texts]
    assert list(np.diff(starts)) == [len(x) for x in wanted]
    own = [set(members[a:b].tolist()) for a, b in zip(starts, starts[1:])]
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(own[a] & own[b]) == len(wanted[a] & wanted[b])
            assert (names[a] == names[b]) == (wanted[a] == wanted[b])


def test_packed_members_come_back():
    members = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 1000, np.uint64))
    assert (jaccard._unpacked(jaccard._packed(members)) == members).all()


def test_members_of_two_sets_are_found_in_any_chunks():
    draw = np.random.default_rng(2)
    members, sets = draw.integers(0, 300, 500).astype(np.uint64), np.arange(500)
    for step in (7, 100, 500):
        state, out = jaccard._Shared(), []
        for k in range(0, 500, step):
            out += list(zip(*(x.tolist() for x in state.take(members[k : k + step], sets[k : k + step])), strict=True))
        many = {m: c for m, c in zip(*np.unique(members, return_counts=True))}
        assert sorted(out) == sorted((int(m), int(s)) for m, s in zip(members, sets) if many[m] > 1)
