import hashlib
import math
from collections import Counter

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import mixing
from tidemark.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def shard(doc: int, count: int = 16) -> int:
    draw = lambda s: -math.log((int(hashlib.md5(f"k{doc}:{s}".encode()).hexdigest()[:13], 16) + 1.0) / (16.0**13 + 1.0))
    return min(range(count), key=lambda s: (draw(s), s))


def check_order(rows):
    """The blocks of the sources come as the exact schedule of their root weights says."""
    sizes = Counter("" if r["source"] is None else "=" + r["source"] for r in rows)
    coming = iter(rows)
    for name, block, *_ in mixing.phases({k: n**0.5 for k, n in sizes.items()}, {k: -(-n // 8) for k, n in sizes.items()}):
        for _ in range(min(8, sizes[name] - 8 * block)):
            assert ("" if (r := next(coming))["source"] is None else "=" + r["source"]) == name
    assert next(coming, None) is None


def test_mixing_uneven_sources(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id < 9 THEN null ELSE concat('s', id % 4) END AS source")
    rows = dict(corpus_pipeline.STAGES)["mixing"](spark, docs.repartition(4), FOLDER).collect()
    assert len(rows) == 600 and len({r["doc_id"] for r in rows}) == 600
    check_order(rows)


def test_rows_that_share_a_doc_id_or_have_none_are_judged_by_their_texts(spark):
    docs = table(spark, FOLDER, "documents")
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(5).collect()]
    row = lambda doc, text, k=0: (doc, text, "en", "src0", k)
    rows = [row(7, texts[0]), row(7, texts[1]), row(7, texts[1]), row(None, texts[2]), row(None, texts[2], 1), row(None, texts[3]), row(3, texts[3]), row(7, "12 !!"), row(None, "--")]
    df = spark.createDataFrame(rows, docs.schema).selectExpr("*", "1 AS _hash", "2 AS _row", "3 AS _gone", "4 AS _mark")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs.selectExpr("*", "1 AS _hash", "2 AS _row", "3 AS _gone", "4 AS _mark").union(df), FOLDER)
    assert known.columns == df.columns
    kept = [r["text"] for r in known.filter("source = 'src0'").collect()]
    assert "12 !!" not in kept and "--" not in kept and kept.count(texts[1]) >= 2
    near = stages["simhash_near_dedup"](spark, df.filter("text not in ('12 !!', '--')"), FOLDER)
    assert near.columns == df.columns
    wanted = {texts[0], texts[1], texts[2], texts[3]}
    found = [(r["doc_id"], r["text"]) for r in near.collect()]
    assert sorted(t for _, t in found) == sorted(wanted) and (3, texts[3]) in found and (None, texts[2]) in found


def test_stages_one_by_one(spark):
    docs = table(spark, FOLDER, "documents")
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    stages = [f for _, f in corpus_pipeline.STAGES]
    out = []
    for stage in stages:
        docs = stage(spark, docs, FOLDER)
        out.append(docs.collect())
    rows = table(spark, FOLDER, "documents").collect()
    # clean text of a known language is never refused
    assert sorted(r["doc_id"] for r in out[0]) == sorted(r["doc_id"] for r in rows)
    kept = {doc for doc, _, least in brute.near_groups([(r["doc_id"], r["text"]) for r in out[0]]) if doc == least}
    assert sorted(r["doc_id"] for r in out[1]) == sorted(kept)
    bad = {x[0] for x in brute.contamination([(r["doc_id"], r["text"]) for r in out[1]], items) if x[-1]}
    assert bad and sorted(r["doc_id"] for r in out[2]) == sorted(kept - bad)
    assert sorted(map(repr, out[3])) == sorted(map(repr, out[2]))
    check_order(out[3])
    assert all(r["shard"] == shard(r["doc_id"]) for r in out[4])
    assert sorted(r["doc_id"] for r in out[4]) == sorted(r["doc_id"] for r in out[3])


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    docs = table(spark, FOLDER, "documents")
    assert rows.columns == [*docs.columns, "shard"]
    assert rows.join(docs, docs.columns, "left_semi").count() == rows.count() > 0
    assert rows.select("doc_id").distinct().count() == rows.count()


def test_odd_rows_go_through(spark, tmp_path):
    docs = table(spark, FOLDER, "documents").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, None, "en", "src1", 0), (9002, "", None, None, None), (9003, "12 !!", "xx", None, 5)], docs.schema)
    rows = docs.union(odd).union(odd)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, FOLDER)
    assert rows.filter("doc_id > 9000").isEmpty() and rows.count() > 0
    rows = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, FOLDER)
    assert rows.collect() == []
