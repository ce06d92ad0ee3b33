"""WARC archives: written by tasks, read back in splits by boundary-chain verification.

A split of a file cannot know whether the magic `WARC/1.1` that it meets begins a record or is
part of a payload. So tasks take every magic as a candidate and emit where its record would
end, which is where the next one begins. Pointer jumping, inside each split and then over
splits, follows these pointers from the start of each file; only candidates on that chain
are records. The others are payload and are joined to the record that they lie in.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table
from tidemark.session import work_folder

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PLAIN32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + GAP


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits make 10 hex digits or 8 base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*groups)), PLAIN32, BASE32)


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", few: int = 10_000) -> None:
    """Write a record per row (page_id, url, html) to uncompressed archives in `path`.

    Of rows with equal payloads those with the largest page_id are responses, others are
    revisits without a payload that refer to it. A null html is an empty payload, a null url
    is left out, line ends in a url are dropped. Payloads that occur twice are broadcast if
    there are at most `few`, and joined otherwise.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    groups = rows.groupBy("digest", "bytes").agg(F.max("page_id").alias("_first"), F.count("*").alias("_rows"))
    twice = cut(groups.filter("_rows > 1").select(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes"), "_first"))
    small = twice.limit(few + 1).count() <= few
    joined = rows.join(F.broadcast(twice) if small else twice, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")), "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull(), F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    block = F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload").cast("string")))
    field = lambda title, value: F.concat(F.lit(f"{title}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.col("url").cast("string"), "[\\r\\n]", "")
    header = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        field("WARC-Record-ID", name("page_id")),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("X-Payload-Bytes", F.col("bytes").cast("string")),
        F.when(again, field("WARC-Refers-To", name("_first"))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(GAP),
    )
    joined.select(F.concat(header, block).alias("value")).write.option("lineSep", GAP).text(path)


def chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What lies between magics, in splits: (file, split, id, value); ids grow along a split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _field(title: str) -> Column:
    return F.nullif(F.regexp_extract("header", rf"(?i)(?:^|\r\n){title}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _placed(found: DataFrame) -> DataFrame:
    """`found` with `at`, where its magic begins in the file; the text before the first has none."""
    wide = F.col("size") + len(MAGIC)
    own = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    totals = found.groupBy(F.col("file").alias("_file"), F.col("split").alias("_split")).agg(F.sum(wide).alias("_total"))
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_file", "_split", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = found.withColumn("_inside", F.coalesce(F.sum(wide).over(own), F.lit(0)))
    met = inside.join(starts, (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    return met.withColumn("at", F.col("_before") + F.col("_inside") - len(MAGIC)).drop("_file", "_split", "_before", "_inside")


def _jumps(at: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For candidates in order: the index of the next (or their number, for none here) and that it leaves."""
    place = np.searchsorted(at, behind)
    there = (place < len(at)) & (behind > at)
    there[there] = at[place[there]] == behind[there]
    return np.where(there, place, len(at)), ~there


def _exits(key: tuple, part: pa.Table) -> pa.Table:
    """Where the chain from each candidate of a split leaves the split, by pointer jumping."""
    part = part.sort_by("at")
    at, behind = part.column("at").to_numpy(), part.column("behind").to_numpy()
    to, _ = _jumps(at, behind)
    out, to = np.append(behind, -1), np.append(to, len(at))
    while True:
        ahead = np.minimum(to, len(at))
        moves = ahead < len(at)
        if not moves.any():
            break
        out[moves] = out[ahead[moves]]
        to = np.where(moves, to[ahead], len(at))
    return pa.table([part.column("file"), part.column("at"), pa.array(out[:-1])], ["file", "at", "out"])


def _marks(key: tuple, part: pa.Table) -> pa.Table:
    """Which candidates of a split are on the chain from its entry, and the record each lies in."""
    part = part.sort_by("at")
    at, behind, entry = (part.column(name).to_numpy(zero_copy_only=False) for name in ("at", "behind", "entry"))
    to, _ = _jumps(at, behind)
    to, on = np.append(to, len(at)), np.append(entry, False)
    while (to < len(at)).any():
        on[to[on & (to < len(at))]] = True
        on[len(at)] = False
        to = np.append(to, len(at))[to]
    on = on[:-1]
    last = np.maximum.accumulate(np.where(on, np.arange(len(at)), -1))
    inside = np.where(last >= 0, at[last], -1)
    return pa.table([*(part.column(name) for name in ("file", "split", "at")), pa.array(on), pa.array(inside)], ["file", "split", "at", "record", "inside"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in `path`.

    (file, at, type, name, url, refers, digest, told, payload_bytes, payload_digest): `digest` and
    `told` (bytes) are what the header says of the payload, the last two what was read.
    """
    raw = chunks(spark, path).withColumn("header", F.substring_index("value", GAP, 1)).withColumn("size", F.octet_length("value"))
    length = F.when(_field("Content-Length").rlike("^[0-9]{1,15}$"), _field("Content-Length").cast("long"))
    head = F.octet_length("header") + len(GAP)
    body = raw.withColumns({"length": length, "head": head}).withColumn("whole", F.col("size") >= F.col("head") + F.col("length"))
    block = F.substring(F.col("value").cast("binary"), F.col("head") + 1, F.coalesce(F.col("length"), F.lit(0)).cast("int"))
    found = cut(
        body.withColumn("payload", F.when(F.col("whole"), _payload(block))).select(
            "file",
            "split",
            "id",
            "size",
            "length",
            "head",
            "whole",
            _field("WARC-Type").alias("type"),
            _field("WARC-Record-ID").alias("name"),
            _field("WARC-Target-URI").alias("url"),
            _field("WARC-Refers-To").alias("refers"),
            F.regexp_replace(_field("WARC-Payload-Digest"), "(?i)^sha1:", "").alias("digest"),
            _field("X-Payload-Bytes").cast("long").alias("told"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            base32_sha1(F.col("payload")).alias("payload_digest"),
        )
    )
    # candidates: where each begins and where its successor would
    placed = cut(_placed(found).filter("at >= 0"))
    behind = F.coalesce(F.col("at") + len(MAGIC) + F.col("head") + F.col("length") + len(GAP), F.lit(-1))
    candidates = placed.select("file", "split", "at", behind.alias("behind"))
    jumps = cut(candidates.groupBy("file", "split").applyInArrow(_exits, "file string, at long, out long"))
    entries = cut(candidates.groupBy("file").agg(F.min("at").alias("at")).filter("at = 0"))
    while True:  # twice as many splits each round
        step = jumps.select(F.col("file").alias("_file"), F.col("at").alias("_at"), "out")
        reached = entries.join(step, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at"))).select("file", F.col("out").alias("at"))
        reached = reached.join(candidates, ["file", "at"], "left_semi").join(entries, ["file", "at"], "left_anti")
        more = cut(reached)
        if more.isEmpty():
            break
        entries = cut(entries.union(more))
        ahead = jumps.select(F.col("file").alias("_file"), F.col("at").alias("_at"), F.col("out").alias("_out"))
        jumps = cut(jumps.join(ahead, (F.col("file") == F.col("_file")) & (F.col("out") == F.col("_at"))).select("file", "at", F.col("_out").alias("out")))
    flagged = candidates.join(entries.withColumn("entry", F.lit(True)), ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    marks = cut(flagged.groupBy("file", "split").applyInArrow(_marks, "file string, split long, at long, record boolean, inside long"))
    known = placed.join(marks.select("file", "at", "record", "inside"), ["file", "at"])
    good = known.filter("record")
    columns = ["file", "at", "type", "name", "url", "refers", "digest", "told", "payload_bytes", "payload_digest"]
    if good.filter("not whole").isEmpty():
        return good.select(columns)
    return good.filter("whole").select(columns).union(_joined(spark, known, marks).select(columns))


def _payload(block: Column) -> Column:
    """A block without its HTTP header."""
    head = F.octet_length(F.substring_index(block.cast("string"), GAP, 1)) + len(GAP)
    return F.substring(block, head + 1, F.greatest(F.octet_length(block) - head, F.lit(0)))


def _joined(spark: SparkSession, known: DataFrame, marks: DataFrame) -> DataFrame:
    """Records whose payload has the magic inside: their chunks, read again and joined."""
    splits = marks.groupBy(F.col("file").alias("_file"), F.col("split").alias("_split")).agg(F.max("inside").alias("_last"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("_file", "_split", F.max("_last").over(earlier).alias("_carried"))
    own = known.join(carried, (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split")))
    own = own.withColumn("of", F.when(F.col("inside") >= 0, F.col("inside")).otherwise(F.col("_carried"))).drop("_file", "_split", "_carried")
    torn = own.filter("record and not whole").select(F.col("file").alias("_file"), F.col("at").alias("_at"))
    parts = cut(own.join(torn, (F.col("file") == F.col("_file")) & (F.col("of") == F.col("_at")), "left_semi").drop("split", "id"))
    # another scan may split the files in another way, so places in a file name the chunks
    files = [row["file"] for row in parts.select("file").distinct().collect()]  # archives, not records
    again = cut(chunks(spark, files))
    spots = _placed(again.select("file", "split", "id", F.octet_length("value").alias("size"))).drop("size")
    values = again.join(spots.join(parts.select("file", "at", "of"), ["file", "at"]), ["file", "split", "id"])
    whole = values.groupBy(F.col("file").alias("_file"), F.col("of").alias("_of")).agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    whole = whole.select("_file", "_of", F.array_join(F.transform("parts", lambda x: x["value"]), MAGIC).alias("value"))
    met = parts.filter("record").drop("payload_bytes", "payload_digest").join(whole, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_of")))
    block = F.substring(F.col("value").cast("binary"), F.col("head") + 1, F.col("length").cast("int"))
    read = met.withColumn("payload", _payload(block))
    return read.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.col("payload")))


def _id(column: str) -> Column:
    return F.regexp_extract(column, "<urn:page:(-?[0-9]+)>", 1).cast("long")


def digest(found: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest (of the full payload), record_type, refers_to."""
    again = F.col("type") == "revisit"
    return found.select(
        F.when(F.col("name").rlike("[0-9]"), _id("name")).alias("page_id"),
        F.when(again, F.col("told")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(again, _id("refers")).alias("refers_to"),
    )


def op7(spark, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/archives-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "pages"), path)
    return digest(records(spark, path))
