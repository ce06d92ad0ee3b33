import random

from tidemark.llm import tokens

SCORES = {x.encode(): s for x, s in {"▁": -3.0, "▁a": -2.0, "▁ab": -2.5, "a": -3.0, "b": -3.1, "ab": -3.5, "abc": -6.0, "c": -4.0, "ca": -4.5, "é": -5.0, "bb": -6.2}.items()}


def plain(word: bytes, byte: float = -20.0) -> int:
    """Tokens of the best segmentation, from all of its last pieces."""
    text = tokens.MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        ways = [(best[end - 1][0] + byte, best[end - 1][1] - 1)]
        ways += [(best[start][0] + SCORES[text[start:end]], best[start][1] - 1) for start in range(end) if text[start:end] in SCORES]
        best.append(max(ways))
    return -best[-1][1]


def test_counts_of_all_rows(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("aabbcéx") for _ in range(draw.randrange(1, 9)))
    rows = [(k, " ".join(word() for _ in range(draw.randrange(30)))) for k in range(60)]
    rows += [(70, None), (71, ""), (72, " \n\t"), (73, "ab" * 3000), (74, rows[0][1]), (74, rows[0][1]), (None, "abc abc\nab")]
    frame = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_tokens int").repartition(2)
    expected = sorted((repr(d), len((t or "").encode()), len((t or "").encode().split()), sum(map(plain, (t or "").encode().split()))) for d, t in rows)
    for settings in ({}, {"shard_bytes": 50, "most_known": 20}):
        found = tokens.count_tokens(frame, SCORES, **settings).collect()
        assert sorted((repr(r["doc_id"]), r["n_bytes"], r["n_pretokens"], r["n_tokens"]) for r in found) == expected
    assert tokens.count_tokens(frame.limit(0), SCORES).collect() == []


def test_shared_prefixes_are_scored_once():
    class Counting(dict):
        asked = 0

        def get(self, *key):
            Counting.asked += 1
            return dict.get(self, *key)

    segmenter = tokens.Segmenter(SCORES)
    segmenter.endings = Counting(segmenter.endings)
    segmenter.counts([b"abcabcabcabc"])
    alone, Counting.asked = Counting.asked, 0
    assert segmenter.counts([b"abcabcabcabc", b"abcabcabcabca", b"abcabcabcabcb"]) == {w: plain(w) for w in (b"abcabcabcabc", b"abcabcabcabca", b"abcabcabcabcb")}
    assert Counting.asked < alone + 12


def test_vocabulary_of_a_public_file():
    scores = tokens.vocabulary()
    assert len(scores) > 30_000 and "▁the".encode() in scores and max(scores.values()) < 0
