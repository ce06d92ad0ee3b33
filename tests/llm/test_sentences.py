import random

import numpy as np

from tidemark.llm import sentences


def plain(rows: list[tuple], several: int = 2, enough: int = 12) -> list[tuple]:
    """(doc_id, n_sentences, n_removed, text): repeated runs found in a dictionary of all."""
    parsed = []
    for doc, text in rows:
        raw = (text or "").encode()
        cuts = sentences.Sentences(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        words = [raw[a:b].lower().split() for a, b in zip(cuts.begins, cuts.ends, strict=True)]
        assert sum(words, []) == raw.lower().split()
        runs = []
        for i in range(len(words)):
            for j in range(i + several, len(words) + 1):
                if sum(map(len, words[i:j])) >= enough:
                    runs.append((i, j, tuple(sum(words[i:j], []))))
                    break
        parsed.append((doc, text, list(zip(cuts.begins, cuts.ends, strict=True)), words, runs))
    first: dict[tuple, float] = {}
    for doc, _, _, _, runs in parsed:
        for _, _, run in runs:
            first[run] = min(first.get(run, 1e300), 1e299 if doc is None else doc)
    out = []
    for doc, text, places, counts, runs in parsed:
        gone, seen = set(), set()
        for i, j, run in runs:
            if run in seen or (1e299 if doc is None else doc) > first[run]:
                gone.update(range(i, j))
            seen.add(run)
        raw = (text or "").encode()
        lead = raw[: places[0][0]] if places else raw
        kept = lead + b"".join(raw[a:b] for k, (a, b) in enumerate(places) if k not in gone)
        out.append((doc, len(counts), len(gone), None if text is None else kept.decode()))
    return sorted(out, key=repr)


def prose(draw: random.Random, n: int) -> str:
    return "".join(f"{draw.choice('abcdefgh')}{draw.randrange(5000)}" + draw.choice([" ", " ", " ", " ", ", ", ". ", "!\n", "\n"]) for _ in range(n))


def corpus(seed: int) -> tuple[list[tuple], list[str]]:
    draw = random.Random(seed)
    passages = [prose(draw, 55), prose(draw, 70), " ".join(f"w{draw.randrange(9999)}" for _ in range(60))]
    rows = []
    for k in range(90):
        text = prose(draw, draw.randrange(80))
        if k % 3 == 0:
            text += draw.choice(passages) + prose(draw, draw.randrange(60))
        rows.append((k, text))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (102, None), (103, ""), (104, " \n "), (None, rows[6][1]), (105, passages[0] + passages[0]), (106, "One. Two. One. Two.")]
    return rows, passages


def test_against_a_dictionary_of_runs(spark):
    rows, _ = corpus(1)
    frame = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, first string").repartition(3)
    assert sorted(map(tuple, sentences.dedup(frame).collect()), key=repr) == plain(rows)


def test_long_passages_stay_once_and_other_text_stays(spark):
    rows, passages = corpus(2)
    found = {r["doc_id"]: r["text"] for r in sentences.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for passage in passages:
        middle = " ".join(passage.split()[15:40])
        held = [d for d, t in rows if t and d is not None and middle in " ".join(t.split())]
        left = [d for d, t in found.items() if t and d is not None and middle in " ".join(t.split())]
        assert len(held) > 3 and left == [min(held)]
    untouched = [(d, t) for d, t in rows if d is not None and d < 90 and d % 3 and d != 6]
    assert all(found[d] == t for d, t in untouched)


def test_sentences_end_where_they_should():
    text = b" One two.  Three? four\n\nfive six!\nU.S. army a.b\x00c"
    cuts = sentences.Sentences(np.frombuffer(text, np.uint8), np.array([0, 24, len(text)]))
    assert [text[a:b] for a, b in zip(cuts.begins, cuts.ends, strict=True)] == [b"One two.  ", b"Three? ", b"four\n\n", b"five six!\n", b"U.S. ", b"army a.b\x00c"]
    assert cuts.of_row.tolist() == [0, 3, 6]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sentences.dedup(empty).collect() == []
    line = "this line of thirteen words is there again and again in one text.\n"
    rows = [(1, line * 5000), (2, "x" * 300_000), (3, "unlike the others")]
    found = {r["doc_id"]: r for r in sentences.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["n_removed"] > 4990 and found[1]["text"].count("this line") <= 3
    assert found[2]["text"] == rows[1][1] and found[3]["n_removed"] == 0
    twice = spark.createDataFrame([(1, line * 2 + "a b c d."), (1, line * 2 + "a b c d.")], "doc_id long, text string")
    assert len(sentences.dedup(twice).collect()) == 2


def all_runs(rows: list[tuple], several: int = 2, enough: int = 12) -> dict:
    """The sentences that go from each doc_id, by every run (i, j) of each text."""
    parsed, first, gone = [], {}, {}
    for doc, text in rows:
        raw = (text or "").encode()
        cuts = sentences.Sentences(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        words = [tuple(raw[a:b].lower().split()) for a, b in zip(cuts.begins, cuts.ends, strict=True)]
        runs = [(i, j, tuple(words[i:j])) for i in range(len(words)) for j in range(i + several, len(words) + 1) if sum(map(len, words[i:j])) >= enough]
        parsed.append((1e299 if doc is None else doc, doc, runs))
    for name, _, runs in parsed:
        for _, _, run in runs:
            first[run] = min(first.get(run, 1e300), name)
    for name, doc, runs in parsed:
        seen, out = set(), gone.setdefault(doc, set())
        for i, j, run in runs:
            if run in seen or name > first[run]:
                out.update(range(i, j))
            seen.add(run)
    return gone


def test_tails_against_every_run(spark):
    rows, _ = corpus(3)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["n_removed"] for r in sentences.dedup(frame, tails=True).collect()}
    without = {r["doc_id"]: r["n_removed"] for r in sentences.dedup(frame).collect()}
    assert found == {doc: len(gone) for doc, gone in all_runs(rows).items()}
    assert sum(found.values()) > sum(without.values())


def test_op5_takes_a_short_last_sentence(spark, tmp_path):
    words = lambda n, k: " ".join(f"w{k}x{i}" for i in range(n)) + ". "
    text = words(16, 1) + words(5, 2) + words(3, 3)
    han = "今天天气很好我们去公园。" * 1 + "花都开了。" + "真美！"
    rows = [(1, text + words(9, 4)), (2, words(7, 5) + text + words(14, 6)), (3, text), (4, han), (5, han)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in sentences.op5(spark, str(tmp_path)).collect()}
    assert found[1]["text"] == rows[0][1] and found[4]["text"] == han
    assert found[2]["text"] == words(7, 5) + words(14, 6)
    assert found[3]["text"] == "" and found[5]["text"] == ""


def test_rows_that_share_a_doc_id_or_have_none(spark):
    """Of each passage one stays, whichever rows it is in; equal rows are cleaned like others."""
    draw = random.Random(6)
    words = lambda n: " ".join(f"v{draw.randrange(99999)}" for _ in range(n)) + ". "
    shared, whole, lone = words(9) + words(8), words(10) + words(9) + words(4), words(7) + words(9)
    rows = [(None, shared + words(11)), (None, words(13) + shared), (7, whole), (7, whole + words(14)), (None, whole)]
    rows += [(9, lone)] * 5 + [(None, lone)] * 9000 + [(None, None)] * 3 + [(8, "")] * 2 + [(7, "short. row. ")] * 2
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, hash string").repartition(5)
    found = sentences.dedup(frame, tails=True).collect()
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(d) for d, _ in rows)
    left = [r["text"] for r in found if r["text"] is not None]
    for passage in (shared, whole, lone):
        assert sum(passage in x for x in left) == 1
    assert [r["text"] for r in found if r["doc_id"] == 9 and r["text"]] == [lone]
    assert sum(r["text"] is None for r in found) == 3 and sum(r["n_removed"] for r in found) == 2 + 2 * 3 + 2 * 9004
    assert [r["text"] for r in found if r["doc_id"] == 7].count("short. row. ") == 2
