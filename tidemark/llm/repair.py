"""Repair of the structure of conversations by the cheapest edits.

A conversation is well formed if its turns are an optional system turn and then pairs of user
and assistant, or nothing at all. Rows may be kept (K, 0), get another role (R, 2) or be
deleted (D, 3; blank and repeated rows must be), and empty turns may be inserted (I, 2); a row
without an end that stays costs 1 more. Of all cheapest repairs the one whose letters come
first in ASCII is taken.

It is found by dynamic programming over the rows and four states of what the turns so far can
be followed by. The least cost to the end, for each state, is a vector that a row turns into
the one before it. Going back, only the vectors at checkpoints a square root of the rows apart
are kept; going forward, the vectors of a block are computed again from the checkpoint behind
it, and the least letter whose cost is tight is emitted. A conversation of more rows than a
block is cut into such blocks, which are tasks of their own: a block is a matrix of least costs
between states, the checkpoints follow from the matrices, and the state in which a block is
entered from where each block leads.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, in_tasks, table
from tidemark.operators import scan

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
FAR = 1 << 60
#: States: nothing so far, after a system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant turn, whichever may follow, leads.
NEXT = (USER, USER, ASSISTANT, USER)
#: Where a turn leads by the initial of its role.
LEADS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs after the last row: what is left is to complete a pair.
END = (0, 4, 2, 0)

Row = tuple[str, str]  # initial of the role, fault
Vector = Sequence[int]


def before(row: Row, after: Vector) -> list[int]:
    """The least costs in front of a row, turns inserted there included, from those behind it."""
    initial, fault = row
    out = [3 + cost for cost in after]
    if fault in ("", "truncated"):
        leads, extra = LEADS.get(initial, {}), int(fault == "truncated")
        for state in range(4):
            out[state] = min(out[state], 2 + extra + after[NEXT[state]], extra + after[leads[state]] if state in leads else FAR)
    user, assistant = out[USER], out[ASSISTANT]
    out[USER], out[ASSISTANT] = min(user, 2 + assistant), min(assistant, 2 + user)
    return [min(out[START], 2 + out[USER]), min(out[SYSTEM], 2 + out[USER]), out[USER], out[ASSISTANT]]


def back(rows: Sequence[Row], after: Vector) -> Vector:
    for row in reversed(rows):
        after = before(row, after)
    return after


def walk(rows: Sequence[Row], after: Vector, state: int, last: bool) -> tuple[list[tuple[int, str, int]], int]:
    """(row, letter, state then) of each edit, and the state behind the rows; `last` completes the end.

    Vectors are kept a square root of the rows apart and computed again block by block.
    """
    wide = math.isqrt(len(rows)) + 1
    kept, vector = {}, after
    for block in range((len(rows) - 1) // wide, -1, -1):
        kept[block] = vector
        vector = back(rows[block * wide : (block + 1) * wide], vector)
    edits = []
    for block in range(len(kept)):
        first = block * wide
        vectors = [kept[block]]
        for row in reversed(rows[first : first + wide]):
            vectors.append(before(row, vectors[-1]))
        vectors.reverse()
        for k, row in enumerate(rows[first : first + wide]):
            here, behind = vectors[k], vectors[k + 1]
            extra, leads = int(row[1] == "truncated"), LEADS.get(row[0], {})
            stays = row[1] in ("", "truncated")
            while True:
                if 3 + behind[state] == here[state]:
                    letter = "D"
                elif 2 + here[NEXT[state]] == here[state]:
                    letter, state = "I", NEXT[state]
                elif stays and state in leads and extra + behind[leads[state]] == here[state]:
                    letter, state = "K", leads[state]
                else:
                    letter, state = "R", NEXT[state]
                edits.append((first + k, letter, state))
                if letter != "I":
                    break
    if last:
        while state in (SYSTEM, USER):
            state = NEXT[state]
            edits.append((len(rows), "I", state))
    return edits, state


def damaged(rows: DataFrame) -> DataFrame:
    """`conversations` with one in five rows spoilt by the checksum of `conv_id:turn`; a null is one space there and as role or text.

    Of 20 values, 0 drops the row (`_gone`), 1 empties its text, 2 takes its full stops, exclamation
    and question marks, 3 repeats it and 4 makes it a user's.
    """
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(named.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    spoilt = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("_gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1).cast("int"))).alias("_copy"),
    )
    return spoilt.drop("_copy")


def fault(text: Column, seen: Column) -> Column:
    """Blank, duplicate, truncated or nothing."""
    end = F.rtrim(text, F.lit(SPACES))
    found = F.when(end == "", "blank").when(seen, "duplicate")
    return found.when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")


#: What `repair` returns, next to conv_id and turn of the kind they have.
EDITS = "place long, step int, edit string, was string, role string, text string, fault string"
BLOCK = ["_group", "_block"]


def _edited(rows: Sequence[Row], after: Vector, state: int, last: bool, own: list[dict], first: int, conv: object) -> Iterator[dict]:
    """The rows of `repair` from those of a block."""
    step, place = 0, -1
    for k, letter, then in walk(rows, after, state, last)[0]:
        step = step + 1 if k == place else 0
        place = k
        out = {"conv_id": conv, "turn": None, "place": first + k, "step": step, "edit": letter, "was": None, "role": ROLE.get(then), "text": "", "fault": None}
        if letter != "I":
            out |= {"turn": own[k]["turn"], "was": own[k]["role"], "fault": rows[k][1], "text": own[k]["text"]}
        if letter == "K":
            out["role"] = own[k]["role"]
        if letter == "D":
            out["role"] = out["text"] = None
        yield out


def _small(schema: pa.Schema, rows: int = 512) -> object:
    """A task over rows sorted by conversation and order: all edits of each conversation."""

    def one(own: list[dict]) -> Iterator[dict]:
        conv = own[0]["conv_id"]
        own = [row for row in own if not row["_gone"]]
        if not own:
            yield {"conv_id": conv, "place": -1, "step": 0}
            return
        seen: set[tuple[str, bytes]] = set()
        parsed = []
        for row in own:
            key = (row["role"], hashlib.sha256(row["text"].encode()).digest())
            flaw = row["fault"] if row["fault"] == "blank" or key not in seen else "duplicate"
            seen.add(key)
            parsed.append((row["role"][:1], flaw))
        yield from _edited(parsed, END, START, True, own, 0, conv)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["_group"] != held[0]["_group"]:
                    out.extend(one(held))
                    held = []
                    if len(out) >= rows:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
                held.append(row)
        if held:
            out.extend(one(held))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return task


def _rows_of(own: pa.Table) -> list[Row]:
    return list(zip(own.column("_initial").to_pylist(), own.column("fault").to_pylist(), strict=True))


def _blocks(rows: DataFrame) -> DataFrame:
    """(group, block, after, state): the checkpoint behind each block and the state it is entered in."""
    narrow = cut(rows.select(*BLOCK, "_index", F.substring("role", 1, 1).alias("_initial"), "fault"))

    def matrix(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        """Least costs from each state in front of a block to each behind it."""
        parsed = _rows_of(own.sort_by("_index"))
        cost = [back(parsed, [0 if k == state else FAR for k in range(4)]) for state in range(4)]
        flat = [min(cost[state][k], FAR) for k in range(4) for state in range(4)]
        return pa.table({"_group": [key[0].as_py()], "_block": pa.array([key[1].as_py()], pa.int64()), "_cost": pa.array([flat], pa.list_(pa.int64()))})

    def checkpoints(own: pa.Table) -> pa.Table:
        """The vector behind each block of a conversation, from the last back."""
        own, vector, out = own.sort_by("_block"), list(END), []
        for flat in reversed(own.column("_cost").to_pylist()):
            out.append(vector)
            vector = [min(flat[4 * k + state] + vector[state] for state in range(4)) for k in range(4)]
        return pa.table({"_group": own.column("_group"), "_block": own.column("_block"), "_after": pa.array(out[::-1], pa.list_(pa.int64()))})

    def exits(own: pa.Table, known: pa.Table) -> pa.Table:
        """Where a block leads from each state."""
        parsed, after = _rows_of(own.sort_by("_index")), known.column("_after")[0].as_py()
        then = [walk(parsed, after, state, False)[1] if back(parsed, after)[state] < FAR else state for state in range(4)]
        return known.append_column("_then", pa.array([then], pa.list_(pa.int64())))

    def entries(own: pa.Table) -> pa.Table:
        """The state in which each block of a conversation is entered, from the first on."""
        own, state, out = own.sort_by("_block"), START, []
        for then in own.column("_then").to_pylist():
            out.append(state)
            state = then[state]
        return own.drop_columns(["_then"]).append_column("_state", pa.array(out, pa.int64())).append_column("_last", pa.array([k == len(out) - 1 for k in range(len(out))]))

    kind = "_group string, _block long, "
    costs = cut(narrow.groupBy(*BLOCK).applyInArrow(matrix, kind + "_cost array<long>"))
    known = costs.groupBy("_group").applyInArrow(checkpoints, kind + "_after array<long>")
    left = narrow.groupBy(*BLOCK).cogroup(known.groupBy(*BLOCK)).applyInArrow(exits, kind + "_after array<long>, _then array<long>")
    return left.groupBy("_group").applyInArrow(entries, kind + "_after array<long>, _state long, _last boolean")


def _large(rows: DataFrame, sizes: DataFrame, most: int, schema: pa.Schema, ddl: str) -> DataFrame:
    """All edits of conversations of more than one block, a block in a task."""
    digest = rows.withColumn("_digest", F.sha2("text", 256))
    placed = scan.numbered(digest, "_group", ["turn", "role", "_digest"], "_index").join(sizes, "_group")
    wide = F.greatest(F.lit(most), F.ceil(F.sqrt("_rows")))
    placed = cut(placed.withColumn("_block", F.floor(F.col("_index") / wide)))
    first = placed.groupBy(F.col("_group").alias("_g"), F.col("role").alias("_r"), F.col("_digest").alias("_d")).agg(F.min("_index").alias("_first"))
    same = (F.col("_group") == F.col("_g")) & (F.col("role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    seen = placed.join(first, same).drop("_g", "_r", "_d", "_digest")
    flawed = cut(seen.withColumn("fault", fault(F.col("text"), F.col("_index") > F.col("_first"))).withColumn("_initial", F.substring("role", 1, 1)).drop("_first", "_rows", "_gone"))

    def edits(own: pa.Table, known: pa.Table) -> pa.Table:
        own = own.sort_by("_index")
        after, state, last = (known.column(name)[0].as_py() for name in ("_after", "_state", "_last"))
        listed = own.to_pylist()
        return pa.Table.from_pylist(list(_edited(_rows_of(own), after, state, last, listed, listed[0]["_index"], listed[0]["conv_id"])), schema)

    return flawed.groupBy(*BLOCK).cogroup(_blocks(flawed).groupBy(*BLOCK)).applyInArrow(edits, ddl)


def repair(rows: DataFrame, most: int = 256) -> DataFrame:
    """A row for each edit: conv_id, place, step, edit, turn, was, role, text, fault.

    `rows` has conv_id, turn, role and text without nulls in the last two, and may have `_gone`: such rows
    only name a conversation, which has one row without an edit if nothing else names it. A
    conversation's rows are taken by turn, nulls first, then role and a digest of the text. Edits go by (`place`,
    `step`): place is that of the row, or the one in front of which a turn is inserted. `was`
    is the role before, `role` and `text` what the repaired conversation has (null if deleted).
    Repeated rows are duplicates. Null ids are a conversation of their own. Other columns of
    `rows` are left out. An empty table gives no rows.

    A conversation of at most `most` rows is repaired in one piece; of a longer one no task
    holds more rows than the greater of `most` and the square root of its rows, or more of its blocks than that root.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    if "_gone" not in rows.columns:
        rows = rows.withColumn("_gone", F.lit(False))
    rows = rows.select("conv_id", "turn", "role", "text", "_gone", named.alias("_group"))
    here, gone = rows.filter("not _gone"), rows.filter("_gone").select("conv_id", "_group", "_gone").distinct()
    sizes = cut(here.groupBy("_group").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > most))
    ids = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in ("conv_id", "turn"))
    ddl = f"{ids}, {EDITS}"
    frame = rows.sparkSession.createDataFrame([], ddl)
    schema = frame.toArrow().schema
    large = not sizes.isEmpty()
    small = here.join(sizes, "_group", "left_anti") if large else here
    marks = gone.join(sizes, "_group", "left_anti") if large else gone
    marked = small.withColumn("fault", fault(F.col("text"), F.lit(False))).unionByName(marks, allowMissingColumns=True)
    digest = F.sha2("text", 256)
    sorted_ = marked.repartition("_group").sortWithinPartitions("_group", "turn", "role", digest)
    out = in_tasks(sorted_, _small(schema), ddl)
    if large:
        long = here.join(sizes, "_group", "left_semi")
        out = out.unionByName(_large(long, sizes, most, schema, ddl))
    return out


def _summary(kind: pa.DataType) -> object:
    """A task over edits sorted by conversation and order: a row for each conversation."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        now: dict | None = None
        letters: list[str] = []
        hashed, turns, last, group = hashlib.sha256(), 0, None, None
        started = False

        def close() -> None:
            lo, hi = now.pop("_low"), now.pop("_high")
            out.append(now | {"gaps": hi - lo + 1 - turns if turns else 0, "audit": "".join(letters), "repaired_sha256": hashed.hexdigest()})

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["_group"] != group:
                    if now is not None:
                        close()
                    group, letters, hashed, turns, last, started = row["_group"], [], hashlib.sha256(), 0, None, False
                    now = {"conv_id": row["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "_low": None, "_high": None}
                letter = row["edit"]
                if letter is None:
                    continue
                letters.append(letter)
                now["cost"] += {"K": 0, "R": 2, "D": 3, "I": 2}[letter] + (letter in "KR" and row["fault"] == "truncated")
                if letter != "D":
                    hashed.update((f"\n{row['role']}:{row['text']}" if started else f"{row['role']}:{row['text']}").encode())
                    started = True
                if letter == "I":
                    continue
                if row["fault"]:
                    now[row["fault"]] += 1
                if last is not None and last + row["was"][:1] not in ("su", "ua", "au"):
                    now["illegal"] += 1
                last = row["was"][:1]
                if row["turn"] is not None:
                    turns += now["_high"] != row["turn"]
                    now["_low"] = row["turn"] if now["_low"] is None else now["_low"]
                    now["_high"] = row["turn"]
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    numbers = [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = pa.schema([("conv_id", kind), *numbers, ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return task


def summary(edits: DataFrame) -> DataFrame:
    """A row for each conversation: its faults, the cost, letters and digest of its repair.

    A digest is of all that a conversation says, in order, so one task reads a conversation's
    edits from first to last; it holds a batch of them and the letters, not the texts.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    in_order = edits.withColumn("_group", named).repartition("_group").sortWithinPartitions("_group", "place", "step")
    kind = edits.schema["conv_id"].dataType.simpleString()
    frame = edits.sparkSession.createDataFrame([], f"conv_id {kind}").toArrow().schema
    return in_tasks(
        in_order, _summary(frame.field("conv_id").type),
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )


def op13(spark, sf_dir: str) -> DataFrame:
    """Damage `conversations` and repair them: one row for each conversation.

    `damaged`, `repair` and `summary` say what becomes of nulls, repeated rows, empty tables and other columns.
    """
    return summary(repair(damaged(table(spark, sf_dir, "conversations"))))
