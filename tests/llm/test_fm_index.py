import random

import numpy as np

from tests.llm import brute
from tidemark.llm import fm_index


def test_index_counts_and_locates():
    draw = np.random.default_rng(5)
    for symbols, n in ((3, 40), (5, 3000), (70, 2000)):
        text = np.append(draw.integers(1, symbols, n), 0)
        if n == 3000:
            text[500:900] = text[100:500]
        assert (fm_index.suffix_array(text, 7) == np.array(sorted(range(len(text)), key=lambda k: text[k:].tolist()))).all()
        index = fm_index.FMIndex(text, symbols, sample=5)
        lengths = draw.integers(1, 6, 200)
        phrases = np.zeros((200, 6), np.int64)
        for k, size in enumerate(lengths):
            start = draw.integers(0, n - size)
            phrases[k, 6 - size :] = text[start : start + size] if k % 2 else draw.integers(1, symbols, size)
        which, low, high = index.search(phrases, lengths)
        found = {int(k): sorted(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(which, low, high, strict=True)}
        for k, size in enumerate(lengths):
            want = phrases[k, 6 - size :].tolist()
            assert found.get(k, []) == [p for p in range(n) if text[p : p + size].tolist() == want]


def documents(seed: int) -> tuple[list[tuple], list[tuple]]:
    draw = random.Random(seed)
    some = lambda n: " ".join(draw.choice(["the", "of", "Été", "x1", "word", "new", "42"]) + draw.choice(["", ",", ".", "!? "]) for _ in range(n))
    items = [(k, some(draw.choice([0, 1, 5, 12, 13, 14, 40]))) for k in range(25)] + [(3, some(20)), (None, some(13)), (77, None), (78, "?!"), (10, items_text := some(15)), (11, items_text)]
    docs = []
    for k in range(70):
        parts = [some(draw.randrange(40))]
        for _ in range(draw.randrange(3)):
            parts += [(draw.choice(items)[1] or "").upper().replace("É", "é"), some(draw.randrange(30))]
        docs.append((k, "\n".join(parts)))
    docs += [(200, None), (201, ""), (202, "..."), (203, items_text), (203, items_text), (None, items_text), (204, "other " * 30_000 + items_text)]
    return docs, items


def test_against_plain_search(spark):
    docs, items = documents(1)
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_hit int").repartition(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.ordered(brute.contamination(docs, items))
    for settings in ({}, {"shard_bytes": 300}, {"block_bytes": 100, "shard_bytes": 2000}):
        assert brute.ordered(fm_index.digest(fm_index.find(frame, benchmark, **settings)).collect()) == expected
    kept = fm_index.clean(frame, benchmark)
    assert kept.schema == frame.schema
    assert brute.ordered((r["doc_id"], r["text"]) for r in kept.collect()) == brute.ordered(
        (d, t) for (d, t), row in zip(docs, brute.contamination(docs, items), strict=True) if not row[-1]
    )


def test_spans_are_the_hit_words(spark):
    docs, items = documents(2)
    found = fm_index.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    for row in found:
        ends = [x for span in row["spans"] for x in span]
        assert ends == sorted(set(ends)) and sum(b - a for a, b in row["spans"]) == row["n_hit"]
        assert not ends or (ends[0] >= 0 and ends[-1] <= row["n_words"])


def test_empty_tables(spark):
    docs, items = documents(3)
    frame, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert fm_index.find(frame.limit(0), benchmark).collect() == []
    none = fm_index.find(frame, benchmark.limit(0)).collect()
    assert len(none) == len(docs) and not any(r["n_hit"] for r in none)
    assert fm_index.clean(frame, benchmark.limit(0)).count() == len(docs)
