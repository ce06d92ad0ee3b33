"""Benchmark decontamination with an FM-index for each shard of the training texts.

A task gathers its documents to shards of a few MB. A shard's words become symbols: each word
that some test phrase has is one symbol, runs of other words are one separator. Its suffix
array gives the Burrows-Wheeler transform, kept as a wavelet tree. All phrases are searched
backwards together, two ranks a step; occurrences are located by walking to the next
sampled suffix position, checked against the text's bytes, and merged to removal spans.
Nothing is shuffled, so a frequent passage or copy adds no more than its own occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_words, in_tasks, shards, table, utf8

#: A word's bytes after A-Z became a-z: digits, a-z and everything outside ASCII; others are 0.
LETTERS = np.zeros(256, np.uint8)
for _byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    LETTERS[_byte] = _byte
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B]

def words_of(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, where each word begins and ends, and a hash of each word."""
    return hashed_words(data, rows, LETTERS)


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Order of all suffixes of symbols below 2**bits, whose last is a 0 that occurs once.

    Sorted by as many symbols as fit a word, then groups that still tie by the rank of what
    follows, twice as many symbols each time.
    """
    m, step = len(text), max(1, 63 // bits)
    padded = np.concatenate([text, np.zeros(step, text.dtype)]).astype(np.int64)
    key = np.zeros(m, np.int64)
    for k in range(step):
        key = (key << bits) | padded[k : k + m]
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(m + 1, np.int64)
    rank[m] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(m), 0))
    tied = ~new | ~np.append(new[1:], True)
    slots, left = np.flatnonzero(tied), order[tied]
    while len(left):
        own, after = rank[left], rank[np.minimum(left + step, m)]
        sort = np.argsort(own * (m + 1) + after + 1)
        left, own, after = left[sort], own[sort], after[sort]
        order[slots] = left
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])])
        rank[left] = np.maximum.accumulate(np.where(new, slots, 0))
        tied = ~new | ~np.append(new[1:], True)
        slots, left, step = slots[tied], left[tied], 2 * step
    return order


class Bits:
    """A bit vector with constant-time ranks."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """How many of the first i bits are set."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class FMIndex:
    """Counts and positions of phrases in one text of symbols."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        self.bits = max(1, int(symbols - 1).bit_length())
        order = suffix_array(text, self.bits)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        sampled = order % sample == 0
        self.sampled, self.positions = Bits(sampled), order[sampled]
        left = text[order - 1]  # the transform; the first suffix is preceded by the last symbol
        self.levels = []  # of the wavelet tree: the nodes of a level lie one after another
        for k in range(self.bits - 1, -1, -1):
            bit = (left >> k) & 1
            self.levels.append((Bits(bit.astype(bool)), len(left) - int(bit.sum())))
            left = np.concatenate([left[bit == 0], left[bit == 1]])
        every = np.arange(symbols)
        self.base = self._descend(every, np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(self.levels):
            ones = bits.rank(i)
            i = np.where((symbol >> (self.bits - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The bound of `symbol` before what the bound i stands for."""
        return self.starts[symbol] + self._descend(symbol, i) - self.base[symbol]

    def back(self, i: np.ndarray) -> np.ndarray:
        """The place of the suffix that begins one symbol earlier."""
        symbol, at = np.zeros(len(i), np.int64), i
        for bits, zeros in self.levels:
            bit, ones = bits.get(at).astype(np.int64), bits.rank(at)
            symbol = symbol * 2 + bit
            at = np.where(bit, zeros + ones, at - ones)
        return self.starts[symbol] + at - self.base[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases that occur; row p of `phrases` ends with its symbols."""
        width = phrases.shape[1]
        alive = np.flatnonzero((lengths > 0) & (phrases >= 0).all(axis=1))
        low, high = np.zeros(len(alive), np.int64), np.full(len(alive), self.starts[-1])
        for k in range(width):
            going = lengths[alive] > k
            symbol = phrases[alive, width - 1 - k]
            low = np.where(going, self.step(symbol, low), low)
            high = np.where(going, self.step(symbol, high), high)
            found = high > low
            alive, low, high = alive[found], low[found], high[found]
        return alive, low, high

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at places i."""
        out, left, steps = np.zeros(len(i), np.int64), np.arange(len(i)), 0
        while len(left):
            here = self.sampled.get(i) == 1
            out[left[here]] = self.positions[self.sampled.rank(i[here])] + steps
            left, i = left[~here], i[~here]
            i, steps = self.back(i), steps + 1
        return out


class Phrases:
    """Test phrases of a block of benchmark items: windows of their words."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for name, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            lower, begins, ends, _ = words_of(data, np.array([0, len(data)]))
            words = [lower[a:b].tobytes() for a, b in zip(begins, ends, strict=True)]
            for k in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[k : k + window]), set()).add(name)
        self.words, self.names = list(found), [sorted(names) for names in found.values()]
        vocabulary = sorted({word for words in self.words for word in words})
        data = np.frombuffer(b" ".join(vocabulary), np.uint8)
        hashes = words_of(data, np.array([0, len(data)]))[3]
        self.hashes, at = np.unique(hashes, return_inverse=True)
        ids = dict(zip(vocabulary, (at + 2).tolist(), strict=True))  # 0 ends the text, 1 separates
        self.symbols = len(self.hashes) + 2
        self.lengths = np.array([len(words) for words in self.words], np.int64)
        self.matrix = np.zeros((len(self.words), window), np.int64)
        for k, words in enumerate(self.words):
            self.matrix[k, window - len(words) :] = [ids[word] for word in words]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

def symbols_of(phrases: Phrases, hashes: np.ndarray) -> np.ndarray:
    """A symbol for each word: 1 if no phrase has it."""
    out = np.ones(len(hashes), np.int64)
    some = np.flatnonzero(phrases.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(phrases.hashes, hashes[some]), len(phrases.hashes) - 1)
    out[some] = np.where(phrases.hashes[at] == hashes[some], at + 2, 1)
    return out


def occurrences(phrases: Phrases, lower: np.ndarray, begins: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word) of all occurrences in a shard; `first` has each document's first word."""
    symbols = symbols_of(phrases, hashes)
    cuts = np.zeros(len(symbols), bool)
    cuts[first[first < len(symbols)]] = True
    # a separator goes before each document; of separators in a row one stays
    text = np.insert(symbols, np.flatnonzero(cuts), 1)
    word = np.arange(len(text)) - np.cumsum(np.insert(np.zeros(len(symbols), np.int64), np.flatnonzero(cuts), 1))
    kept = np.concatenate([[True], (text[1:] != 1) | (text[:-1] != 1)])
    text, word = np.append(text[kept], 0), word[kept]
    index = FMIndex(text, phrases.symbols)
    which, low, high = index.search(phrases.matrix, phrases.lengths)
    counts = high - low
    which = np.repeat(which, counts)
    places = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    at = word[index.locate(places)]
    true = np.ones(len(which), bool)
    for p in np.unique(which):
        mine = np.flatnonzero(which == p) if len(which) < 4096 else np.arange(*np.searchsorted(which, [p, p + 1]))
        for k, expected in enumerate(phrases.words[p]):
            a, b = begins[at[mine] + k], ends[at[mine] + k]
            fits = b - a == len(expected)
            own = lower[np.where(fits, a, 0)[:, None] + np.minimum(np.arange(len(expected)), len(lower) - 1)]
            true[mine] &= fits & (own == np.frombuffer(expected, np.uint8)).all(axis=1)
    return which[true], at[true]


def _blocks(benchmark: DataFrame, window: int, most: int) -> Iterator[Phrases]:
    """Test phrases in blocks of items with at most about `most` bytes of text."""
    held, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("string").alias("text"))
    for row in rows.filter("text is not null").toLocalIterator():
        held.append((row["name"], row["text"]))
        size += len(row["text"])
        if size >= most:
            yield Phrases(held, window)
            held, size = [], 0
    if held:
        yield Phrases(held, window)


def _sent(docs: DataFrame, benchmark: DataFrame, window: int, most: int) -> list:
    """Blocks of phrases as plain data, which executors can read without this package."""
    context = docs.sparkSession.sparkContext
    return [context.broadcast(SimpleNamespace(**vars(block))) for block in _blocks(benchmark, window, most) if block.words]


def _search(shard: pa.Table, blocks: list) -> pa.RecordBatch:
    """What `find` returns for the documents of a shard."""
    data, rows = utf8(shard.column("text"))
    lower, begins, ends, hashes = words_of(data, rows)
    first = np.searchsorted(begins, rows)
    owner = np.repeat(np.arange(shard.num_rows), np.diff(first))
    change = np.zeros(len(begins) + 1, np.int64)
    names: list[set[str]] = [set() for _ in range(shard.num_rows)]
    for block in blocks if len(begins) else []:
        phrases = block.value
        which, at = occurrences(phrases, lower, begins, ends, hashes, first[:-1])
        np.add.at(change, at, 1)
        np.add.at(change, at + phrases.lengths[which], -1)
        for row, p in np.unique(np.stack([owner[at], which], axis=1), axis=0).tolist():
            names[row].update(phrases.names[p])
    covered = np.cumsum(change[:-1]) > 0
    # a span never goes over the end of a document
    edge = np.zeros(len(begins) + 1, bool)
    edge[first] = True
    starts = np.flatnonzero(covered & (edge[:-1] | np.concatenate([[True], ~covered])[:-1]))
    stops = np.flatnonzero(covered & (edge[1:] | np.concatenate([~covered, [True]])[1:])) + 1
    own = first[owner[starts]]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(starts, first), pa.int32()),
        pa.StructArray.from_arrays([pa.array(starts - own), pa.array(stops - own)], ["first", "behind"]),
    )
    hit = np.concatenate([[0], np.cumsum(covered)])
    columns = [
        shard.column("doc_id").combine_chunks(),
        pa.array(np.diff(first)),
        spans,
        pa.array(hit[first[1:]] - hit[first[:-1]]),
        pa.array([sorted(x) for x in names], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans", "n_hit", "items"])


def find(docs: DataFrame, benchmark: DataFrame, window: int = 13, shard_bytes: int = 2 << 20, block_bytes: int = 4 << 20) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, spans, n_hit and the items found in it.

    `spans` are the merged runs of words (first, behind the last) that some window of `window`
    consecutive words of an item covers; an item of fewer words, but not none, is one window.
    n_hit counts their words; `items` are the ids of the items with an occurring window,
    as strings in their order. Texts without words, null or empty, have no spans; an item
    without words hits nothing; a null item_id is the empty string; repeated items are one.
    The benchmark reaches the tasks in broadcast blocks of at most `block_bytes` (or an item).
    """
    blocks, of = _sent(docs, benchmark, window, block_bytes), _search
    schema = "doc_id long, n_words long, spans array<struct<first: long, behind: long>>, n_hit long, items array<string>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "text", shard_bytes):
            yield of(shard, blocks)

    return in_tasks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), task, schema)


def contaminated(share: int = 20):
    """Some word is hit, and one in `share` at least."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def digest(found: DataFrame) -> DataFrame:
    """What `find` returns, with items as their number and the SHA-256 of their joined ids."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, shard_bytes: int = 2 << 20, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of `docs` that are not contaminated, each judged by its own text; no shuffle."""
    blocks, of = _sent(docs, benchmark, window, block_bytes), _search

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, "text", shard_bytes):
            found = of(shard, blocks)
            hit, words = (found.column(name).to_numpy() for name in ("n_hit", "n_words"))
            yield from shard.filter(pa.array((hit == 0) | (share * hit < words))).to_batches()

    return in_tasks(docs, task, docs.schema)


def op8(spark, sf_dir: str) -> DataFrame:
    return digest(find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
