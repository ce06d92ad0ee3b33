"""Language identification by Bayesian fusion of evidence.

For each row the posterior of a language is in proportion to
    likelihood of the text  x  chance of the declared language  x  prior of the host.
The text's likelihood comes from hashed byte trigrams, fitted on a bounded sample of the rows
that declare a language. The declaration's chance given the true language and the priors
are counts over all rows, by the language that the text alone makes likeliest. A host's
prior is smoothed towards that of its address suffix, which is smoothed towards the prior of
all rows. A further class, `und`, has the bytes of all languages in no order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, free, in_tasks, pieces, row_name, table, utf8, without

UNKNOWN = "und"
CELLS = 1 << 15

#: A-Z lower-cased, other ASCII but a-z as blanks.
FOLD = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)], np.uint8)
FOLD[0x41:0x5B] = FOLD[0x61:0x7B]


def _cell(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The cell of each trigram of folded bytes."""
    code = (a << np.uint32(16)) | (b << np.uint32(8)) | c
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _cells(data: np.ndarray) -> np.ndarray:
    """The cell of the trigram at each byte but the last two."""
    x = FOLD[data].astype(np.uint32)
    return _cell(x[:-2], x[1:-1], x[2:])


def language(column: str) -> Column:
    """The main part of a language tag in lower case; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.trim(F.col(column).cast("string")), "^[A-Za-z]{2,8}", 0)), F.lit(""))


def evidence(rows: DataFrame, text: str, declared: str | None = None, host: str | None = None, suffix: str | None = None) -> DataFrame:
    """`rows` with _text, _declared, _host and _suffix, as the other functions expect."""
    name = lambda c: F.coalesce(F.lower(F.col(c).cast("string")), F.lit("")) if c else F.lit("")
    return rows.withColumns(
        {
            "_text": F.col(text).cast("string"),
            "_declared": language(declared) if declared else F.lit(None).cast("string"),
            "_host": name(host),
            "_suffix": name(suffix),
        }
    )


def fit(rows: DataFrame, sample: int = 4000, least: int = 1) -> tuple[list[str], np.ndarray]:
    """Languages and the log chance of each cell in each; the last class is `und`.

    Every language that at least `least` rows declare is a class, of CELLS cells. About `sample`
    rows of a language, chosen by a hash of their text, are fitted; everything else covers all
    rows. One row per language reaches the driver.
    """
    counts = rows.filter(F.col("_declared") != UNKNOWN).groupBy("_declared").count().filter(F.col("count") >= least).collect()
    names = sorted(row["_declared"] for row in counts)
    if not names:
        return [UNKNOWN], np.full((1, CELLS), -math.log(CELLS))
    share = F.create_map(*(F.lit(x) for row in counts for x in (row["_declared"], min(1.0, sample / row["count"]))))
    draw = F.pmod(F.xxhash64("_text"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.filter(F.col("_declared").isin(names)).filter(draw < share[F.col("_declared")]).select("_declared", "_text")
    place = {name: k for k, name in enumerate(names)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def found() -> pa.RecordBatch:
            parts = [(k, np.flatnonzero(n), n[n > 0]) for k, n in sums.items()]
            sums.clear()
            k = np.repeat([k for k, _, _ in parts], [len(n) for _, _, n in parts]).astype(np.int64)
            columns = (k, *(np.concatenate([x[i] for x in parts] or [[]]).astype(np.int64) for i in (1, 2)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["k", "cell", "n"])

        for piece in pieces(batches, "_text", 1 << 20):
            data, at = utf8(piece.column("_text"))
            of = [place[x] for x in piece.column("_declared").to_pylist()]
            for k, a, b in zip(of, at[:-1], at[1:], strict=True):
                if b - a > 2:
                    if k not in sums and len(sums) > 64:  # what a task holds is bounded
                        yield found()
                    sums.setdefault(k, np.zeros(CELLS, np.int64))[:] += np.bincount(_cells(data[a:b]), minlength=CELLS)
            sums.setdefault(len(place), np.zeros(CELLS, np.int64))[:256] += np.bincount(FOLD[data], minlength=256)
        yield found()

    total = in_tasks(chosen, task, "k long, cell long, n long").groupBy("k", "cell").agg(F.sum("n").alias("n"))
    found = np.zeros((len(names) + 1, CELLS), np.float32)
    for row in total.toLocalIterator():  # classes x cells at most
        found[row["k"], row["cell"]] = row["n"]
    byte = found[-1, :256].astype(np.float64) + 1e-3
    byte /= byte.sum()
    known = np.unique(FOLD)
    order = np.stack(np.meshgrid(known, known, known, indexing="ij"), axis=-1).reshape(-1, 3)
    cells = _cell(*order.astype(np.uint32).T)
    shuffled = np.bincount(cells, weights=byte[order].prod(axis=1), minlength=CELLS)
    for k in range(len(names)):
        own = found[k].astype(np.float64)
        found[k] = np.log((own + 0.05) / (own.sum() + 0.05 * CELLS))
    found[-1] = np.log((shuffled + 1e-9) / (shuffled + 1e-9).sum())
    return [*names, UNKNOWN], found


def likelihoods(rows: DataFrame, names: list[str], model: np.ndarray, keep: list[str], most: int = 200, reach: float = 150.0) -> DataFrame:
    """Columns `keep` of all rows, _size and _logs: log likelihood of the whole text by class.

    A row lists the classes within `reach` of its likeliest, so it does not widen with the
    number of classes: priors and declarations, which are counts, cannot make up for more.

    Neighbouring trigrams tell much the same, so a text counts for `most` of them at most,
    by its mean over all. _best is the likeliest class, null for a text without letters.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text", 1 << 20):
            data, at = utf8(piece.column("_text"))
            letters = np.concatenate([[0], np.cumsum(FOLD[data] != 0x20)])
            size = letters[at[1:]] - letters[at[:-1]]
            cells = _cells(data) if len(data) > 2 else np.zeros(0, np.int64)
            first = np.minimum(at[:-1], len(cells))
            last = np.clip(at[1:] - 2, first, len(cells))
            n, logs = last - first, np.zeros((piece.num_rows, len(names)))
            for k, log in enumerate(sent.value):
                sums = np.concatenate([[0], np.cumsum(log[cells], dtype=np.float64)])
                logs[:, k] = (sums[last] - sums[first]) / np.maximum(n, 1) * np.minimum(n, most)
            best = np.where(size > 0, logs.argmax(axis=1), -1)
            columns = [piece.column(name) for name in keep]
            row, k = np.nonzero(logs >= logs.max(axis=1, keepdims=True) - reach)
            inside = pa.StructArray.from_arrays([pa.array(k, pa.int32()), pa.array(logs[row, k])], ["k", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(piece.num_rows + 1)), pa.int32()), inside)
            best = pa.array([names[k] if k >= 0 else None for k in best], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(size), lists, best], [*keep, "_size", "_logs", "_best"])

    schema = rows.select(*keep).schema.add("_size", T.LongType()).add("_logs", T.ArrayType(T.StructType().add("k", T.IntegerType()).add("n", T.DoubleType()))).add("_best", T.StringType())
    return in_tasks(rows.select("_text", *keep), task, schema)


def _dense(column: pa.ListArray, classes: int, other: float = 0.0) -> np.ndarray:
    """A row's numbers by class, from a list of (k, n); `other` for classes not in it."""
    out = np.full((len(column), classes), other)
    pairs = column.flatten()
    row = np.repeat(np.arange(len(column)), pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))
    out[row, pairs.field("k").to_numpy(zero_copy_only=False)] = pairs.field("n").to_numpy(zero_copy_only=False)
    return out


def _log_shares(counts: np.ndarray, smooth: float, parent: np.ndarray) -> np.ndarray:
    """Log prior of each class from counts smoothed towards `parent`."""
    return np.log((counts + smooth * np.exp(parent)) / (counts.sum(axis=1, keepdims=True) + smooth))


def identify(rows: DataFrame, keep: list[str], sample: int = 4000, least: int = 1, smooth_host: float = 20.0, smooth_suffix: float = 50.0, most: int = 200, reach: float = 150.0) -> DataFrame:
    """Columns `keep` of `evidence(...)` rows with language, confidence and accepted.

    A row is accepted if its text has letters, its likeliest class is a language and that has
    more than half of the posterior. A text without letters (null, empty) has a language from
    its host and declaration alone and is not accepted. Hosts, suffixes and declarations that
    are null tell nothing of their own. An empty table gives no rows.
    """
    names, model = fit(rows, sample, least)
    scored = cut(likelihoods(rows, names, model, [*keep, "_declared", "_host", "_suffix"], most, reach))
    # of all rows: what the text makes likeliest, and what is declared with it
    known = F.when(F.col("_declared").isin(names[:-1]), F.col("_declared")).when(F.col("_declared").isNotNull(), F.lit(UNKNOWN))
    met = scored.filter("_best is not null").groupBy(known.alias("said"), "_best").count().collect()  # classes x classes
    n = {(row["said"], row["_best"]): row["count"] for row in met}
    at = {name: k for k, name in enumerate(names)}
    pairs = np.zeros((len(names) + 1, len(names)))  # the last row: nothing declared
    for (x, best), c in n.items():
        pairs[at[x] if x else -1, at[best]] = c
    rows_of, said = pairs.sum(axis=0), pairs[:-1].sum(axis=0)
    everything = np.log((rows_of + 1) / (rows_of.sum() + len(names)))
    chance = np.log((pairs + 0.5) / (said + 0.5 * len(names)))
    chance[-1] = 0

    # a host's or suffix's counts are lists of the classes it has
    k = F.array_position(F.array(*map(F.lit, names)), F.col("_best")).cast("int") - 1
    some = lambda n: F.collect_list(F.when(F.col("_best").isNotNull(), F.struct(k.alias("k"), F.col(n).alias("n"))))
    hosts = scored.groupBy("_host", "_suffix", "_best").agg(F.count("*").alias("n"))
    suffixes = hosts.groupBy("_suffix", "_best").agg(F.sum("n").alias("n")).groupBy(F.col("_suffix").alias("_of")).agg(some("n").alias("_wide"))
    met = hosts.groupBy("_host", "_suffix").agg(some("n").alias("_own")).join(suffixes, F.col("_suffix") == F.col("_of"))
    # written, so that the join below deals both sides anew and can split a large host
    prior = cut(met.select(F.col("_host").alias("_h"), F.col("_suffix").alias("_s"), "_own", "_wide"))
    joined = scored.join(prior, (F.col("_host") == F.col("_h")) & (F.col("_suffix") == F.col("_s")))
    joined = joined.select(*keep, "_size", "_logs", "_best", known.alias("_said"), "_own", "_wide")
    sent = rows.sparkSession.sparkContext.broadcast(chance)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 20) // len(names))
        for whole in batches:
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                wider = _log_shares(_dense(batch.column("_wide"), len(names)), smooth_suffix, everything)
                scores = _dense(batch.column("_logs"), len(names), -np.inf)
                scores += _log_shares(_dense(batch.column("_own"), len(names)), smooth_host, wider)
                scores += sent.value[[at[x] if x else -1 for x in batch.column("_said").to_pylist()]]
                top = scores.argmax(axis=1)
                confidence = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
                good = (batch.column("_size").to_numpy(zero_copy_only=False) > 0) & (top < len(names) - 1) & (confidence > 0.5)
                columns = [*(batch.column(name) for name in keep), batch.column("_best"), pa.array([names[k] for k in top], pa.string()), pa.array(confidence), pa.array(good)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "text_language", "language", "confidence", "accepted"])

    schema = rows.select(*keep).schema.add("text_language", T.StringType()).add("language", T.StringType()).add("confidence", T.DoubleType()).add("accepted", T.BooleanType())
    return in_tasks(joined, task, schema)


def of_documents(docs: DataFrame) -> DataFrame:
    """Evidence of documents: their text, the declared `lang`, and `source` as the host."""
    return evidence(docs, "text", "lang", "source")


def of_pages(pages: DataFrame) -> DataFrame:
    """Evidence of web pages: the text without markup, the html's lang, host and address suffix."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&[A-Za-z0-9#]{1,10};", " ")
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]+)", 1))
    found = pages.withColumns({"_plain": text, "_lang": F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1), "_name": host})
    return evidence(found.withColumn("_end", F.substring_index("_name", ".", -1)), "_plain", "_lang", "_name", "_end")


def accepted(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` whose language is known, each judged by its own text, language tag and source.

    Rows without a doc_id, or with that of another, are judged like all others.
    """
    mark = free(docs, "_row")
    named = docs.withColumn(mark, row_name("doc_id", "text", "lang", "source"))
    refused = identify(of_documents(named), [mark], **settings).filter("not accepted").select(mark)
    return without(named, refused, mark).drop(mark)


def op9(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(of_documents(docs).withColumn("declared", F.col("lang")), ["doc_id", "declared"])


def pages(spark, sf_dir: str) -> DataFrame:
    return identify(of_pages(table(spark, sf_dir, "pages")), ["page_id"])
