"""Links between documents whose word n-gram sets are alike, by adaptive multi-match prefixes.

Two sets with a Jaccard similarity of t or more share at least t * n members of each, so with
the members in one global order, rare ones first, the first n - t * n + l of each hold l shared
ones (the l-prefix). A longer prefix costs more lookups but lets only pairs through that share
more. Each document takes the l for which lookups and the verifications they lead to are
estimated cheapest; a pair must then share as many prefix members as the smaller l of the two.

Members that no other document has can be in no shared prefix and stand first in the order, so
they are only counted. What is left are lists of members with their frequencies, one for each
set that can reach the threshold with them. Sets with equal lists and sizes are one node.
Long posting lists are not paired: first their members meet one pivot each, and what that
connects is not compared again; the pairs left are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import among, bitmap, components, cut, hashed_words, in_tasks, pieces, table, utf8

#: Folded bytes: white space is 0, A-Z are lower case, a zero byte is an A, which nothing else is.
LETTERS = np.arange(256, dtype=np.uint8)
LETTERS[65:91] += 32
LETTERS[0] = 65
LETTERS[[9, 10, 11, 12, 13, 32]] = 0

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each value spread over all 64 bits."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sets(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, members, names): the distinct hashes of each text's shingles, and a hash of each set.

    A text of fewer words has one shingle of all of them, one without words none. A hash covers
    the number of its words.
    """
    data, rows = utf8(column)
    _, begins, ends, words = hashed_words(data, rows, LETTERS)
    words = mixed(words)
    row = np.searchsorted(rows, begins, side="right") - 1
    first = np.searchsorted(row, np.arange(len(rows)))  # of each row, and the end
    count = np.diff(first)
    wide = np.minimum(count, length)
    many = np.where(count > 0, count - wide + 1, 0)
    at = np.concatenate([[0], np.cumsum(many)])
    of = np.repeat(np.arange(len(count)), many)
    place = np.arange(at[-1]) - at[of] + first[of]
    hashes = wide[of].astype(np.uint64)
    for k in range(length):
        inside = k < wide[of]
        more = hashes * _STEP + words[np.minimum(place + k, max(0, len(words) - 1))] if len(words) else hashes
        hashes = np.where(inside, more, hashes)
    hashes = mixed(hashes)
    for a, b in zip(at[:-1], at[1:], strict=True):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    members, of = hashes[fresh], of[fresh]
    starts = np.searchsorted(of, np.arange(len(count) + 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(members ^ _MIX[0]))])
    names = mixed(sums[starts[1:]] - sums[starts[:-1]] + np.diff(starts).astype(np.uint64))
    return starts, members, names


def _named(text: str, length: int, most: int) -> object:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, most):
            starts, _, names = shingle_sets(batch.column(text), length)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(np.diff(starts)), pa.array(names.view(np.int64))], ["_id", "n", "set"])

    return task


def _packed(members: np.ndarray) -> bytes:
    """Sorted numbers as their differences, byte by byte, whose leading bytes compress to nothing."""
    return np.ascontiguousarray(np.diff(members, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(np.uint64).ravel())


POSTINGS = "part int, members binary, owners binary, sets binary"


def _postings(text: str, length: int, parts: int, most: int, bits: int, chosen: Broadcast | None = None) -> object:
    """A task that deals the leading `bits` of members, with their sets, to the part of the hash, many at a time.

    With `chosen`, sets whose bit is not set in it are left out.
    """

    def dealt(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        names = np.concatenate([x[2] for x in held])
        sizes = np.concatenate([np.diff(x[0]) for x in held])
        members = np.concatenate([x[1] for x in held]) >> np.uint64(64 - bits)
        _, first = np.unique(names, return_index=True)  # a set once, however many texts have it
        kept = np.zeros(len(names), bool)
        kept[first] = True
        if chosen is not None:
            kept &= among(chosen.value, names.view(np.int64))
        owner = np.repeat(np.arange(len(names), dtype=np.uint32), sizes)
        use = kept[owner]
        members, owner = members[use], owner[use]
        order = np.argsort(members, kind="stable")
        members, owner = members[order], owner[order]
        part = ((members << np.uint64(64 - bits) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(parts + 1))
        out: dict[str, list] = {"part": [], "members": [], "owners": [], "sets": []}
        for k in np.flatnonzero(np.diff(edges)):
            a, b = edges[k], edges[k + 1]
            seen, place = np.unique(owner[a:b], return_inverse=True)
            out["part"].append(int(k))
            out["members"].append(_packed(members[a:b]))
            out["owners"].append(place.astype(np.uint16 if len(seen) <= 1 << 16 else np.uint32).tobytes())
            out["sets"].append(names[seen].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out["part"], pa.int32()), *(pa.array(out[c], pa.binary()) for c in ("members", "owners", "sets"))], list(out))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, text, 1 << 21):
            held.append(shingle_sets(batch.column(text), length))
            size += len(held[-1][1])
            if size >= most:
                yield dealt(held)
                held, size = [], 0
        if size:
            yield dealt(held)

    return task


class _Shared:
    """Members met so far, each with the set it was first met in and whether a second came."""

    def __init__(self) -> None:
        self.members, self.sets, self.twice = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)

    def take(self, members: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The (member, set) that are now known to be shared, of those given and those held back."""
        order = np.argsort(members, kind="stable")
        members, sets = members[order], sets[order]
        starts = np.flatnonzero(np.concatenate([[True], members[1:] != members[:-1]]))
        fresh, many = members[starts], np.diff(np.append(starts, len(members)))
        at = np.searchsorted(self.members, fresh)
        known = np.zeros(len(fresh), bool)
        inside = at < len(self.members)
        known[inside] = self.members[at[inside]] == fresh[inside]
        late = at[known]
        late = late[~self.twice[late]]
        out = np.repeat(known | (many > 1), many)
        found = np.concatenate([members[out], self.members[late]]), np.concatenate([sets[out], self.sets[late]])
        self.twice[late] = True
        new = ~known
        where = at[new]
        self.members, self.sets, self.twice = (
            np.insert(a, where, b) for a, b in ((self.members, fresh[new]), (self.sets, sets[starts[new]]), (self.twice, many[new] > 1))
        )
        return found


CREDITS = "bucket int, sets binary, many binary"


def _summed(sets: list[np.ndarray], many: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(sets), return_inverse=True)
    return found, np.bincount(place, np.concatenate(many), len(found)).astype(np.int64)


def _credited(chunk: int) -> object:
    """A task over credits sorted by bucket: (set, many), the sum of each set's."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, sets, many, size = None, [], [], 0
        for batch in batches:
            columns = [batch.column(k) for k in range(3)]
            for k in range(batch.num_rows):
                if sets and columns[0][k].as_py() != bucket:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(sets, many)], ["set", "many"])
                    sets, many, size = [], [], 0
                bucket = columns[0][k].as_py()
                sets.append(np.frombuffer(columns[1][k].as_py(), np.int64))
                many.append(np.frombuffer(columns[2][k].as_py(), np.int64))
                size += len(sets[-1])
                if size > chunk:
                    one, total = _summed(sets, many)
                    sets, many, size = [one], [total], 0
        if sets:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(sets, many)], ["set", "many"])

    return task


def _shared(chunk: int, buckets: int) -> object:
    """A task over postings sorted by part: for sets, how many members more than one set has, together by bucket.

    Without buckets, a list of these members for each set.
    """

    def by_set(members: np.ndarray, sets: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(sets, kind="stable")
        members, sets = members[order], sets[order]
        starts = np.flatnonzero(np.concatenate([[True], sets[1:] != sets[:-1]])) if len(sets) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(sets))
        if buckets:
            found, many = sets[starts], ends - starts
            of = (found.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            own = [np.flatnonzero(of == k) for k in range(buckets)]
            kept = [k for k in range(buckets) if len(own[k])]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), *(pa.array([x[own[k]].astype(np.int64).tobytes() for k in kept], pa.binary()) for x in (found, many))], ["bucket", "sets", "many"])
            return
        for a in range(0, len(starts), 4096):
            b = min(len(starts), a + 4096)
            low, high = starts[a], ends[b - 1]
            offsets = np.append(starts[a:b], high) - low
            held = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(members[low:high].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(sets[starts[a:b]]), held], ["set", "members"])

    def opened(members: bytes, owners: bytes, sets: bytes) -> tuple[np.ndarray, np.ndarray]:
        names = np.frombuffer(sets, np.int64)
        return _unpacked(members), names[np.frombuffer(owners, np.uint16 if len(names) <= 1 << 16 else np.uint32)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part = _Shared(), None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if held:
                yield from by_set(*state.take(*(np.concatenate(x) for x in zip(*held, strict=True))))
            held, size = [], 0

        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for k in range(batch.num_rows):
                own = columns[0][k].as_py()
                if own != part:
                    yield from flush()
                    state, part = _Shared(), own
                held.append(opened(*(c[k].as_py() for c in columns[1:])))
                size += len(held[-1][0])
                if size >= chunk:
                    yield from flush()
        yield from flush()

    return task


def needed(n: Column, percent: int) -> Column:
    """The least number of members that a set of n shares with one that is alike."""
    return F.ceil(n * percent / 100).cast("long")


def alike(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _cores(docs: DataFrame, named: DataFrame, text: str, length: int, percent: int, each: int) -> DataFrame:
    """(set, n, core): sets that could be alike to another, with their shared members as (frequency, member), rare ones first.

    The shared members of all sets are counted first, by so many leading bits that one in 4,096
    is taken for shared when it is not. Only sets with enough of them are dealt out whole.
    """
    words = -(-int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // 6)  # and so about a shingle each
    sizes = named.filter("n > 0").groupBy(F.col("set").alias("_set")).agg(F.max("n").alias("n"))

    def dealt(parts: int, bits: int, kind: str, buckets: int = 0, chosen: Broadcast | None = None) -> DataFrame:
        postings = in_tasks(docs.select(text), _postings(text, length, parts, 1 << 21, bits, chosen), POSTINGS)
        return postings.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_shared(1 << 19, buckets), kind)

    enough = F.size("core") >= needed(F.col("n"), percent)
    buckets = max(1, -(-sizes.count() // (1 << 18)))
    credits = dealt(max(1, -(-words // each)), min(64, 13 + words.bit_length()), CREDITS, buckets)
    counts = credits.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_credited(1 << 21), "set long, many long")
    able = cut(counts.join(sizes, F.col("set") == F.col("_set")).filter(F.col("many") >= needed(F.col("n"), percent)).select("set", "n"))
    postings = able.agg(F.sum("n")).first()[0] or 0
    chosen = docs.sparkSession.sparkContext.broadcast(bitmap(able, "set"))
    lists = dealt(max(1, -(-postings // each)), 64, "set long, members array<long>", chosen=chosen)
    lists = lists.groupBy("set").agg(F.array_distinct(F.flatten(F.collect_list("members"))).alias("core"))
    lists = cut(lists.join(sizes, F.col("set") == F.col("_set")).select("set", "n", "core").filter(enough))
    flat = lists.select("set", "n", F.explode("core").alias("member"))
    often = flat.groupBy(F.col("member").alias("_member")).agg(F.count("*").alias("often")).filter("often > 1")
    met = flat.join(often, F.col("member") == F.col("_member"))
    return met.groupBy("set", "n").agg(F.sort_array(F.collect_list(F.struct("often", "member"))).alias("core")).filter(enough)


def _prefix(percent: int, longest: int, weight: float) -> Column:
    """The number of matches to ask for: of 1 to `longest`, the one with the least estimated cost.

    A lookup finds as many sets as have the member; a pair needs l of the matches to be
    verified, at a cost in proportion to the list.
    """
    spare = F.size("core") - needed(F.col("n"), percent)

    def cost(asked: Column) -> Column:
        prefix = F.slice("core", F.lit(1), (spare + asked).cast("int"))
        looked = F.aggregate(prefix, F.lit(0.0), lambda total, x: total + (x["often"] - 1))
        return looked * (1 + weight * F.size("core") / asked)

    choices = F.sequence(F.lit(1).cast("long"), F.least(F.lit(longest).cast("long"), needed(F.col("n"), percent)))
    return F.array_min(F.transform(choices, lambda asked: F.struct(cost(asked).alias("cost"), asked.alias("asked"))))["asked"]


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are alike."""
    for side in "ab":
        own = nodes.select(F.col("node").alias(f"_{side}"), F.col("n").alias(f"n{side}"), F.col("members").alias(f"m{side}"))
        pairs = pairs.join(own, F.col(side) == F.col(f"_{side}")).drop(f"_{side}")
    shared = F.size(F.array_intersect("ma", "mb"))
    return pairs.filter(alike(shared, F.col("na"), F.col("nb"), percent)).select("a", "b")


def _close(a: str, b: str, percent: int) -> Column:
    """Whether sizes allow sets to be alike."""
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _connected(nodes: DataFrame, postings: DataFrame, percent: int, hot: int, rounds: int) -> DataFrame | None:
    """(vertex, component) of the nodes that have links."""
    links, labels = None, None
    sides = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))

    def labelled() -> DataFrame:
        if labels is None:
            return postings.withColumn("comp", F.col("node"))
        return postings.join(labels, F.col("node") == F.col("vertex"), "left").withColumn("comp", F.coalesce("component", "node")).drop("vertex", "component")

    def add(found: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        found = cut(found)
        if found.isEmpty():
            return links, labels
        joined = found if links is None else links.unionByName(found)
        return joined, components(joined, "a", "b")

    for turn in range(rounds):
        rows = labelled()
        first = F.struct(F.col("spare") if turn == 0 else F.xxhash64("node", F.lit(turn)), "node")
        lists = rows.groupBy(F.col("member").alias("_member")).agg(
            F.count("*").alias("many"), F.min("comp").alias("least"), F.max("comp").alias("most"),
            F.min_by(F.struct(F.col("node").alias("node"), F.col("comp").alias("comp"), F.col("n").alias("n")), first).alias("pivot"),
        )
        lists = cut(lists.filter((F.col("many") > hot) & (F.col("least") != F.col("most"))).select("_member", "pivot.*").toDF("_member", "pivot", "pivot_comp", "pivot_n"))
        if lists.isEmpty():
            break
        met = rows.join(lists, F.col("member") == F.col("_member")).filter((F.col("comp") != F.col("pivot_comp")) & _close("n", "pivot_n", percent))
        links, labels = add(_verified(met.select(*sides("node", "pivot")).distinct(), nodes, percent))
    rows = labelled()
    held = rows.groupBy("member", "comp").agg(F.count("*").alias("many"))
    lists = held.groupBy(F.col("member").alias("_member")).agg(F.max_by("comp", F.struct("many", "comp")).alias("large"), F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds")
    rows = cut(rows.join(lists, F.col("member") == F.col("_member")).drop("_member"))
    one = rows.filter("comp <> large").select("member", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("asked").alias("ax"), F.col("rest").alias("rx"), F.col("comp").alias("cx"))
    other = rows.select(F.col("member").alias("_member"), F.col("node").alias("y"), F.col("n").alias("ny"), F.col("asked").alias("ay"), F.col("rest").alias("ry"), F.col("comp").alias("cy"), "large")
    apart = (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("large")) | (F.col("x") < F.col("y"))) & _close("nx", "ny", percent)
    # Of a pair that is alike the first l matches leave enough behind them, in both, to share what its sizes need.
    far = F.least("rx", "ry") + F.least("ax", "ay") >= F.ceil((F.col("nx") + F.col("ny")) * percent / (100 + percent))
    met = one.join(other, (F.col("member") == F.col("_member")) & apart & far)
    pairs = met.groupBy(*sides("x", "y")).agg(F.count("*").alias("shared"), F.min(F.least("ax", "ay")).alias("asked"))
    links, labels = add(_verified(pairs.filter("shared >= asked").select("a", "b"), nodes, percent))
    return labels


def classes(
    docs: DataFrame, named: DataFrame, text: str = "text", length: int = 5, percent: int = 80, longest: int = 8, weight: float = 0.005,
    hot: int = 32, rounds: int = 3, each: int = 1 << 21,
) -> DataFrame:
    """(set, n, label): sets that are linked to another have the same label as that; others are not listed.

    `named` has (set, n) of each text. A set is named by a 64-bit hash of its members, which are 64-bit hashes of shingles, and its size.
    """
    cores = cut(_cores(docs, named, text, length, percent, each))
    listed = F.transform("core", lambda x: x["member"])
    keyed = cores.withColumns({"members": listed, "_h": F.xxhash64(listed), "_g": F.hash(listed)})
    same = ["n", "_h", "_g"]
    nodes = cut(keyed.groupBy(*same).agg(F.min("set").alias("node"), F.count("*").alias("sets"), F.first("core").alias("core"), F.first("members").alias("members")))
    nodes = nodes.withColumn("asked", _prefix(percent, longest, weight)).withColumn("spare", F.col("n") - F.size("core"))
    prefix = F.slice("core", F.lit(1), (F.size("core") - needed(F.col("n"), percent) + F.col("asked")).cast("int"))
    rest = F.size("core") - F.col("_at") - 1
    postings = nodes.select("node", "n", "asked", "spare", "core", F.posexplode(prefix).alias("_at", "_x"))
    postings = cut(postings.select("node", "n", "asked", "spare", rest.cast("long").alias("rest"), "_x.member"))
    labels = _connected(nodes, postings, percent, hot, rounds)
    alone = (F.col("sets") > 1) & alike(F.size("members"), F.col("n"), F.col("n"), percent)
    known = nodes.select(*same, "node", alone.alias("_alone"))
    if labels is None:
        known = known.filter("_alone").withColumn("label", F.col("node"))
    else:
        known = known.join(labels, F.col("node") == F.col("vertex"), "left").filter("_alone or component is not null").withColumn("label", F.coalesce("component", "node"))
    return cut(keyed.select("set", *same).join(known, same).select("set", "n", "label"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 5, percent: int = 80, **settings) -> DataFrame:
    """One row per row of `docs`: its key, n_shingles and component_id, the least key that links lead to.

    Words are what white space separates, A-Z in lower case; a set has the distinct shingles of
    `length` words of the whole text. Fewer words are one shingle, a null text or one without words has
    none and is linked with nothing. Texts with equal sets are linked. Repeated rows, and rows
    that share a key, are rows of their own. Null keys are never the least; a component of only
    such rows has a null. An empty table gives no rows. Other columns take no part.
    """
    rows = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    named = cut(in_tasks(rows, _named("_text", length, 1 << 21), f"_id {docs.schema[key].dataType.simpleString()}, n long, set long"))
    found = classes(rows, named, "_text", length, percent, **settings).select(F.col("set").alias("_set"), F.col("n").alias("_n"), "label")
    known = named.join(found, (F.col("set") == F.col("_set")) & (F.col("n") == F.col("_n")), "left")
    # A label is a set's name, and a set without links is a class of its own.
    known = known.select("_id", "n", F.when(F.col("n") > 0, F.coalesce("label", "set")).alias("_class"), F.col("label").isNotNull().alias("_linked"))
    known = cut(known)
    least = cut(known.filter("n > 0").groupBy(F.col("_class").alias("_of"), F.col("_linked").alias("_is")).agg(F.min("_id").alias("_least")))
    out = known.join(least, (F.col("_class") == F.col("_of")) & (F.col("_linked") == F.col("_is")), "left")
    return out.select(F.col("_id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("_id")).alias("component_id"))


def op12(spark, sf_dir: str) -> DataFrame:
    """Documents by links of 5-word shingle sets with a similarity of 0.8 or more; `join` says what becomes of odd rows."""
    return join(table(spark, sf_dir, "documents"))
