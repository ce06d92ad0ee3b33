import hashlib

import pytest

from tidemark.llm import merkle
from tidemark.llm.common import table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree(nodes: list[str], fanout: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        base = at - at % fanout
        out.append(("".join(level[base:at]), "".join(level[at + 1 : base + fanout])))
        at //= fanout
    return out


def plain(rows: list, fanout: int) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names}
    top = tree([trees[g][-1][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for at, x in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            out.append((x[3], x[2], (*path(trees[g], at, fanout), *path(top, k, fanout)), trees[g][-1][0], top[-1][0]))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted(((r[0], r["leaf"], tuple(map(tuple, r["proof"])), r["subroot"], r["root"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fanout, height", [(2, 2), (3, 1), (2, 12)])
def test_manifest_of_the_table(spark, fanout, height):
    """Many small partitions in several rounds, siblings that are missing, and one partition."""
    docs = table(spark, FOLDER, "documents")
    assert found(merkle.manifest(docs, fanout=fanout, height=height)) == plain(docs.collect(), fanout)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, f"s{k}", lang, k, "x" * k) for k, lang in enumerate(["en", "en", "en", None, "", "ä", "é", "en", "en"])]
    rows += [(3, None, "en", None, None), (3, "", "en", None, ""), (None, None, None, None, None), (None, "a", "en", 5, "b"), (2, "s2", "en", 2, "xx"), (2, "s2", "en", 2, "xx")]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def test_nulls_ties_repeats_and_odd_columns(spark, odd):
    more = odd.selectExpr("*", "1 AS leaf", "2 AS _group", "3 AS root", "4 AS _node")
    assert found(merkle.manifest(more, height=1)) == plain(odd.collect(), 2)
    assert merkle.manifest(odd.limit(0)).collect() == []
    one = odd.limit(1)
    assert found(merkle.manifest(one)) == plain(one.collect(), 2)
    assert merkle.manifest(one).first()["proof"] == []


def test_a_proof_leads_to_the_root_and_no_other_leaf_does(spark, odd):
    rows = merkle.manifest(odd, height=1).withColumn("to", merkle.fold(merkle.F.col("leaf"), merkle.F.col("proof"))).collect()
    assert all(r["to"] == r["root"] for r in rows)
    rows = merkle.manifest(odd, height=1).withColumn("to", merkle.fold(merkle.F.lit("0" * 64), merkle.F.col("proof"))).collect()
    assert all(r["to"] != r["root"] for r in rows)


def test_tampered_rows_do_not_verify(spark):
    import zlib

    rows = merkle.op11(spark, FOLDER).collect()
    assert len(rows) == 200
    assert all(r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) for r in rows)
