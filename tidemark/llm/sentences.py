"""Substring dedup by hashes of sliding runs of sentences.

A text is cut behind sentence ends and line ends; a long sentence is also cut behind words
chosen by their hash, so that equal passages have equal cuts wherever they begin. From each
sentence on, the shortest run of several consecutive sentences with enough words is hashed,
and, for the tails of passages, the shortest such run back from each sentence: together they
cover every sentence of every run that occurs again. In scripts without spaces a character is
a word.
A join over all documents finds the runs that occur again. The first occurrence, by doc_id,
a hash of the text and place, stays; sentences that any other occurrence covers are removed.

What is shuffled for all texts is a count per hash; runs and texts move only where a bitmap
of the hashes that occur again (or of the texts with such runs) has their bit set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FACTOR, among, bitmap, cut, hashed_words, in_tasks, pieces, run_hashes, some, table, utf8

#: A-Z lower-cased; white space separates words.
PRINT = np.arange(256, dtype=np.uint8)
PRINT[0x41:0x5B] = PRINT[0x61:0x7B]
PRINT[[0x20, *range(0x09, 0x0E)]] = 0
PRINT[0] = 1  # a zero byte is part of a word like any other
STOPS = np.isin(np.arange(256), [ord(x) for x in ".!?"])
LAST = (1 << 63) - 1
#: Full-width stops, and the scripts written without spaces (Thai to Khmer, kana, Han).
WIDE_STOPS = np.array([ord(x) for x in "。！？｡"])
SPACELESS = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]


def _spaceless(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words are cut without a space, and where full-width stops end."""
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 2 + (data[at] >= 0xF0) < len(data)]
    b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int64) & 0x3F for k in range(4)]
    wide = data[at] >= 0xF0
    code = np.where(wide, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3], (b[0] & 15) << 12 | b[1] << 6 | b[2])
    stop, own = np.isin(code, WIDE_STOPS), np.zeros(len(at), bool)
    for low, high in SPACELESS:
        own |= (code >= low) & (code <= high)
    behind = at + 3 + wide
    # a stop stays with the word before it
    return np.setdiff1d(np.concatenate([at[own], behind[own | stop]]), at[stop]), behind[stop]


class Sentences:
    """The sentences of texts that lie one after another.

    `row` of each sentence, its words [first, behind) and its bytes [begins, ends): those up to
    the next sentence's first word, so white space goes with the sentence before it.
    """

    def __init__(self, data: np.ndarray, rows: np.ndarray, long: int = 16, one_in: int = 5):
        cuts, stops = _spaceless(data)
        _, begins, ends, self.hashes = hashed_words(data, np.concatenate([rows, cuts]), PRINT)
        n = len(begins)
        owner = np.searchsorted(rows, begins, side="right") - 1 if n else np.zeros(0, np.int64)
        lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
        after = np.append(begins[1:], len(data))[:n]
        over = np.append(owner[1:] != owner[:-1], True)[:n]
        end = STOPS[data[ends - 1]] | np.isin(ends, stops) | (lines[after] > lines[ends]) | over
        # long sentences
        of = np.cumsum(np.concatenate([[0], end[:-1]])[:n]).astype(np.int64)
        end |= (np.bincount(of)[of] > long) & ((self.hashes >> np.uint64(33)) % np.uint64(one_in) == 0) if n else end
        self.behind = np.flatnonzero(end) + 1
        self.first = np.concatenate([[0], self.behind[:-1]])[: len(self.behind)].astype(np.int64)
        self.row = owner[self.first]
        self.begins = begins[self.first]
        self.ends = np.append(self.begins[1:], len(data))[: len(self.first)]
        last = np.append(self.row[1:] != self.row[:-1], True)[: len(self.row)]
        self.ends[last] = rows[self.row[last] + 1]
        #: The first sentence of each row, and the number of all.
        self.of_row = np.searchsorted(self.row, np.arange(len(rows)))

    def runs(self, several: int, enough: int, tails: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, behind, a, b, again) of the shortest run from each sentence with enough words.

        `a` and `b` hash its words; `again` if the text has the run before already. With `tails`
        also the shortest run back from each sentence at which no other ends, behind the run
        from the same first sentence.
        """
        at = np.arange(len(self.first))
        behind = np.maximum(at + several, np.searchsorted(self.behind, self.first + enough) + 1)
        whole = behind <= self.of_row[self.row + 1] if len(at) else np.zeros(0, bool)
        first, behind = at[whole], behind[whole]
        if tails and len(at):
            ended = np.zeros(len(at) + 1, bool)
            ended[behind] = True
            start = np.minimum(at + 1 - several, np.searchsorted(self.first, self.behind - enough, side="right") - 1)
            more = (start >= self.of_row[self.row]) & ~ended[at + 1]
            first, behind = np.concatenate([first, start[more]]), np.concatenate([behind, at[more] + 1])
            order = np.lexsort((behind, first))
            first, behind = first[order], behind[order]
        words = self.first[first], self.behind[behind - 1]
        other = (self.hashes ^ (self.hashes >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        a, b = run_hashes(self.hashes, *words), run_hashes(other, *words, factor=FACTOR ^ 0x5DEECE66C)
        row = self.row[first]
        order = np.lexsort((a, row))
        again = np.zeros(len(first), bool)
        if len(order):
            again[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        return first, behind, a.view(np.int64), b.view(np.int64), again


def _named(docs: DataFrame) -> DataFrame:
    """Texts named by doc_id, null as the last, and a hash."""
    return docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
        F.col("text").cast("string").alias("text"),
    )


def _repeated(texts: DataFrame, several: int, enough: int, tails: bool) -> DataFrame:
    """(doc, hash, runs): of each text with any, the runs that are not the first of their kind.

    A tail can occur again only if the run from its first sentence does, so tails are not
    counted but placed beside such runs.
    """
    send = texts.sparkSession.sparkContext.broadcast

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 1 << 20):
            _, _, a, _, again = Sentences(*utf8(piece.column("text"))).runs(several, enough)
            keys, n = np.unique(a[~again], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["a", "n"])

    counts = in_tasks(texts.select("text"), count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    wanted = send(bitmap(cut(counts.filter("n > 1").select("a")), "a"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 1 << 20):
            found = Sentences(*utf8(piece.column("text")))
            first, behind, a, b, again = found.runs(several, enough, tails)
            occurs = again | among(wanted.value, a)
            chosen = np.flatnonzero(occurs[np.searchsorted(first, first)])
            row = found.row[first[chosen]]
            start = found.of_row[row]
            columns = [piece.column(name).take(pa.array(row)) for name in ("doc", "hash")]
            columns += [pa.array(x) for x in ((first[chosen] - start).astype(np.int32), (behind[chosen] - start).astype(np.int32), again[chosen], a[chosen], b[chosen])]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "hash", "first", "behind", "again", "a", "b"])

    where = "doc long, hash long, first int, behind int, again boolean, a long, b long"
    # texts in order as one number, so that its least is taken in a hash table
    order = F.expr(f"cast(doc AS decimal(19, 0)) * {1 << 62}BD + shiftrightunsigned(hash, 2)").cast("decimal(38, 0)")
    places = cut(in_tasks(texts.select("doc", "hash", "text"), place, where).withColumn("name", order))
    least = places.groupBy("a", "b").agg(F.min("name").alias("least"), F.max("name").alias("most"))
    # written, so that the join deals both sides anew and can split a run that many texts share
    known = cut(least.filter("most > least").select(F.col("a").alias("_a"), F.col("b").alias("_b"), "least"))
    met = places.join(known, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left").filter("again or name > least")
    return met.groupBy("doc", "hash").agg(F.collect_set(F.struct("first", "behind")).alias("runs"))


def _once(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(texts without repeats of doc and hash, a row for each that is repeated with `n`, or None)."""
    twice = cut(texts.groupBy("doc", "hash").agg(F.count("*").alias("n")).filter("n > 1"))
    if twice.isEmpty():
        return texts, None
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(twice, "hash"))
    maybe = some(texts, "hash", bits).join(twice, ["doc", "hash"], "left")
    one = cut(maybe.filter("n is not null").groupBy("doc", "hash").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("n").alias("n")))
    plain = some(texts, "hash", bits, chosen=False).unionByName(maybe.filter("n is null").drop("n"))
    return plain.unionByName(one.drop("n")), one


def dedup(docs: DataFrame, several: int = 2, enough: int = 12, tails: bool = False) -> DataFrame:
    """Per row of `docs`: doc_id, n_sentences, n_removed and the text that is left.

    Of equal runs the one with the smallest doc_id, and in it the first, stays; of rows that
    share a doc_id the one whose text has the smaller hash, and of equal rows any one. A null
    doc_id comes last. White space goes with the sentence before it. Null texts stay null and
    have no sentences. With `tails` every run of sentences counts, else the shortest from each
    sentence.
    """
    texts, repeated = _once(_named(docs))
    lists = cut(_repeated(texts, several, enough, tails))
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(lists, "hash"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_sentences long, n_removed long, text string"

    def clean(piece: pa.RecordBatch, copies: bool) -> list:
        data, rows = utf8(piece.column("text"))
        found = Sentences(data, rows)
        total = np.diff(found.of_row)
        removed, kept = np.zeros(piece.num_rows, np.int64), piece.column("text")
        change = np.zeros(len(found.first) + 1, np.int64)
        if copies:  # every run is there before
            first, behind, *_ = found.runs(several, enough, tails)
            np.add.at(change, first, 1)
            np.add.at(change, behind, -1)
        elif "runs" in piece.schema.names:
            for start, own in zip(found.of_row.tolist(), piece.column("runs").to_pylist(), strict=False):
                for run in own or ():
                    change[start + run["first"]] += 1
                    change[start + run["behind"]] -= 1
        if change.any():
            gone = np.cumsum(change[:-1]) > 0
            removed = np.bincount(found.row[gone], minlength=piece.num_rows)
            cover = np.zeros(len(data) + 1, np.int64)
            np.add.at(cover, found.begins[gone], 1)
            np.add.at(cover, found.ends[gone], -1)
            left = np.cumsum(cover[:-1]) == 0
            edges = np.concatenate([[0], np.cumsum(left)])[rows]
            missing = pa.array(kept.is_null().to_numpy(zero_copy_only=False))
            joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), piece.num_rows, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data[left].tobytes())])
            kept = pa.compute.if_else(missing, pa.scalar(None, pa.string()), joined.cast(pa.string()))
        return [piece.column("doc_id"), pa.array(total), pa.array(removed), kept]

    names = ["doc_id", "n_sentences", "n_removed", "text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays(clean(piece, copies=False), names)

    def task_of_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([*clean(piece, copies=True), piece.column("n")], [*names, "n"])

    touched = some(texts, "hash", bits).join(lists, ["doc", "hash"], "left").select("doc_id", "text", "runs")
    others = some(texts, "hash", bits, chosen=False).select("doc_id", "text")
    found = in_tasks(touched, task, out).union(in_tasks(others, task, out))
    if repeated is None:
        return found
    # a row that comes n times is cleaned once more for its n - 1 copies, which are dealt out in chunks
    more = in_tasks(repeated.select("doc_id", "text", "n"), task_of_copies, out + ", n long").withColumn("_chunk", F.explode(F.expr("sequence(0L, (n - 2) div 4096)")))
    more = more.repartition(F.xxhash64("doc_id", "text", "_chunk")).withColumn("_copy", F.explode(F.expr("sequence(1L, least(4096L, n - 1 - _chunk * 4096))")))
    return found.union(more.select(*names))


def op5(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), tails=True)
