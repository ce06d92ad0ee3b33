import heapq
import math
import random
from collections import Counter
from fractions import Fraction

import pytest

import corpus_pipeline
from tidemark.llm import mixing


def laid_out(weights, blocks, first=0, behind=1 << 62):
    return mixing.slots_between(mixing.plan(weights, blocks), first, behind)


def one_by_one(weights, blocks):
    """The schedule slot by slot from the first, with nothing known beforehand."""
    exact = {name: Fraction(weight) for name, weight in weights.items() if weight > 0}
    done, active, slot, phase = dict.fromkeys(exact, 0), sorted(exact), 0, 0
    while active:
        start, total = slot, sum(exact[name] for name in active)
        own = {name: exact[name] / total for name in active}
        went = dict.fromkeys(active, 0)
        while True:
            windows = {name: (math.floor(went[name] / w), math.ceil((went[name] + 1) / w)) for name, w in own.items()}
            deadline, name = min((d, name) for name, (r, d) in windows.items() if r <= slot - start)
            if done[name] >= blocks.get(name, 0):
                break
            yield name, done[name], phase, start + windows[name][0], start + deadline, slot
            done[name] += 1
            went[name] += 1
            slot += 1
        active = [name for name in active if done[name] < blocks.get(name, 0)]
        phase += 1


def test_ranges_of_slots_are_those_of_the_whole_schedule():
    rng = random.Random(3)
    for _ in range(300):
        names = [f"s{k}" for k in range(rng.randint(0, 9))]
        power = rng.choice([0, 1, 4, 9])
        weights = {name: rng.random() ** power for name in names}
        blocks = {name: rng.choice([0, 1, 2, rng.randint(0, 60)]) for name in names[rng.randint(0, 1) :]}
        whole = list(one_by_one(weights, blocks))
        assert list(laid_out(weights, blocks)) == list(mixing.phases(weights, blocks)) == whole
        each = rng.choice([1, 2, 3, 7, 20])
        assert [row for k in range(0, len(whole), each) for row in laid_out(weights, blocks, k, k + each)] == whole


def test_what_went_out_before_any_slot():
    parts = {"a": 1, "b": 999, "c": 37, "d": 410, "e": 410}
    went = Counter()
    for name, _, _, _, slot in mixing.course(parts):
        if slot % 7 == 0:
            assert mixing.gone(parts, sum(parts.values()), slot) == {n: went[n] for n in parts}
        went[name] += 1
        if slot == 4000:
            break


def test_the_driver_holds_phases_not_slots(spark):
    weights = {f"={k}": float(k + 1) for k in range(9)} | {"=thin": 1e-6}
    blocks = dict.fromkeys(weights, 10**12)
    planned = mixing.plan(weights, blocks)
    assert len(planned) <= len(weights) and sum(phase.slots for phase in planned) == 10**13
    far = list(mixing.slots_between(planned, 10**9, 10**9 + 50))
    assert [r[5] for r in far] == list(range(10**9, 10**9 + 50)) and all(r[3] <= r[5] < r[4] for r in far)
    some = {"=a": 2.0, "=b": 1.0, "=thin": 0.01}
    got = mixing._laid_out(spark, some, {"=a": 700, "=b": 500, "=thin": 90}, each=100).collect()
    assert sorted(map(tuple, got), key=lambda r: r[5]) == list(laid_out(some, {"=a": 700, "=b": 500, "=thin": 90}))


def test_edges(spark):
    docs = uneven(spark)
    only = mixing.interleave(docs, {"=rare": 1.0, "=absent": 1.0}, block=4)
    assert only.count() == docs.count() and only.filter("slot is not null").count() == 1
    assert mixing.interleave(docs, {}).filter("mixed or slot is not null").isEmpty()
    assert mixing.interleave(docs.limit(0), {"=hot": 1.0}).collect() == []
    assert mixing.arranged(docs.limit(0), {"=hot": 1.0}).collect() == []
    assert mixing.arranged(docs, {}).count() == docs.count()


def test_repeated_rows_have_a_place_each(spark):
    """A third of the rows are equal, more than one chunk of them; none is lost or doubled."""
    docs = spark.range(9000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "IF(id % 3 = 0, 'hot', 's') AS source", "1 AS _rows", "'x' AS _a").repartition(4)
    out = mixing.arranged(docs, {"=hot": 1.0, "=s": 1.0}).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, docs.collect()))
    seen = Counter()
    for k, r in enumerate(out[:4000]):
        seen[r["source"]] += 1
        assert abs(seen["hot"] - seen["s"]) <= 16


def uneven(spark):
    rows = [(k, f"s{k % 5}") for k in range(300)] + [(k, "hot") for k in range(300, 700)] + [(700, "rare"), (701, None), (None, "s1")]
    return spark.createDataFrame([(d, s, "t") for d, s in rows], "doc_id long, source string, slot string").repartition(4)


def test_a_source_that_runs_out_leaves_and_all_rows_stay(spark):
    docs = uneven(spark)
    weights = mixing.tempered(docs)
    out = mixing.arranged(docs, weights)
    assert out.schema == docs.schema
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, docs.collect()))
    rows = mixing.interleave(docs, weights).collect()
    assert len(rows) == docs.count()
    slots = {r["slot"]: (r["source"], r["block"], r["phase"], r["release"], r["deadline"]) for r in rows}
    assert sorted(slots) == list(range(len(slots))) and len(slots) == len({(r["source"], r["block"]) for r in rows})
    assert {r["phase"] for r in rows if r["mixed"]} == {0} and not all(r["mixed"] for r in rows)
    # the order of the rows that come out is that of their slots
    place = {(r["doc_id"], r["source"]): (r["slot"], r["place"]) for r in rows}
    order = [place[r["doc_id"], r["source"]] for r in out.collect()]
    assert order == sorted(order)


def test_the_pipeline_keeps_all_rows_of_uneven_sources(spark):
    docs = uneven(spark)
    assert dict(corpus_pipeline.STAGES)["mixing"](spark, docs, "").count() == docs.count()


@pytest.mark.parametrize("weights", [{"hot": 0.5} | {f"s{k}": 0.5 / 19 for k in range(19)}, {"most": 1.0, "thin": 1e-5}, {f"s{k}": (k + 1) ** 0.5 for k in range(7)}])
def test_the_given_weights_hold_over_many_periods(weights):
    slots = 100_000
    exact = {n: Fraction(w) for n, w in weights.items()}
    total = sum(exact.values())
    done, last = Counter(), None
    for name, block, phase, release, deadline, slot in laid_out(weights, dict.fromkeys(weights, slots)):
        if slot == slots:
            break
        assert phase == 0 and block == done[name] and release <= slot < deadline
        done[name] += 1
        last = slot
        if slot % 97 == 0 or slot == slots - 1:
            assert all(abs(done[n] - (slot + 1) * w / total) < 1 for n, w in exact.items())
    assert last == slots - 1


def test_each_phase_has_the_weights_of_the_sources_that_are_left():
    weights, blocks = {"a": 3.0, "b": 1.0, "c": 0.5, "d": 2.0}, {"a": 300, "b": 500, "c": 7}
    rows = list(laid_out(weights, blocks))
    assert Counter(r[0] for r in rows) == blocks and [r[5] for r in rows] == list(range(807))
    for phase in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == phase]
        left = {r[0] for r in rows if r[2] >= phase} | ({"d"} if phase == 0 else set())
        total, done = sum(weights[n] for n in left), Counter()
        for t, (name, _, _, release, deadline, slot) in enumerate(own):
            assert slot == own[0][5] + t and release <= slot < deadline
            done[name] += 1
            assert all(abs(done[n] - (t + 1) * weights[n] / total) < 1 for n in left)


def test_op6_follows_the_exact_weights(spark):
    found = mixing.op6(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sizes = {name: round(w * w) for name, w in mixing.tempered(docs).items()}
    times = {(n, b): (r, d, s) for n, b, _, r, d, s in laid_out(mixing.tempered(docs), {n: -(-k // 8) for n, k in sizes.items()})}
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert times["" if r["source"] is None else "=" + r["source"], r["block"]] == (r["release"], r["deadline"], r["slot"])
