import base64
import hashlib

from tidemark.llm import warc


def expected(rows: list[tuple]) -> list[tuple]:
    of: dict[bytes, list] = {}
    for page, _, html in rows:
        of.setdefault((html or "").encode(), []).append(page)
    out = []
    for data, pages in of.items():
        known = [p for p in pages if p is not None]
        first = max(known) if known else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out += [(p, len(data), digest, "response" if p == first else "revisit", None if p == first else first) for p in pages]
    return sorted(out, key=repr)


M = warc.MAGIC
INSIDE = M + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a/1", "x"),
    (2, "http://a/2", None),
    (3, None, ""),
    (4, "bad\r\nurl", M),
    (5, "http://a/5", "a" + INSIDE + M + "zz"),
    (6, "http://a/6", "x"),
    (7, "http://a/7", "é" * 50_000 + M * 3),
    (8, "http://a/8", INSIDE + INSIDE),
    (9, "http://a/9", "\r\n\r\n" + M + "Content-Length: 99999999999999\r\n\r\n"),
    (10, "http://a/10", "x"),
    (10, "http://a/10", "x"),
    (-4, "http://a/-4", "x"),
] + [(100 + k, f"http://b/{k}", f"p{k} " * 400 + (INSIDE if k % 3 == 0 else "")) for k in range(60)]


def round_trip(spark, rows, path, parts=1):
    frame = spark.createDataFrame([(p, u, h, "clash") for p, u, h in rows], "page_id long, url string, html string, digest string").coalesce(parts)
    warc.write(frame, path)
    return sorted(map(tuple, warc.digest(warc.records(spark, path)).collect()), key=repr)


def test_magic_inside_payloads(spark, tmp_path):
    assert round_trip(spark, ROWS, str(tmp_path / "one")) == expected(ROWS)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for size in (900, 5003, 30_011):  # splits that end anywhere, also within a magic
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            found = sorted(map(tuple, warc.digest(warc.records(spark, str(tmp_path / "one"))).collect()), key=repr)
            assert found == expected(ROWS)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_files_are_archives(spark, tmp_path):
    round_trip(spark, ROWS, str(tmp_path / "two"), 3)
    names = sorted(p for p in (tmp_path / "two").iterdir() if p.name.startswith("part"))
    seen = 0
    for name in names:
        data, at = name.read_bytes(), 0
        while at < len(data):
            head, _, rest = data[at:].partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            size = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            at, seen = at + len(head) + 8 + size, seen + 1
    assert seen == len(ROWS)


def test_edges(spark, tmp_path):
    assert round_trip(spark, [], str(tmp_path / "none")) == []
    rows = [(None, "u", "same"), (None, "u", "other"), (3, "u", "same")]
    found = round_trip(spark, rows, str(tmp_path / "nulls"))
    assert {x[:1] + x[3:] for x in found} == {(3, "response", None), (None, "response", None), (None, "revisit", 3)} and len(found) == 3
    (tmp_path / "cut").mkdir()
    whole = next(p for p in sorted((tmp_path / "nulls").iterdir()) if p.name.startswith("part")).read_bytes()
    (tmp_path / "cut" / "a.warc").write_bytes(b"junk" + whole)  # no record at the start: none is reachable
    assert warc.records(spark, str(tmp_path / "cut")).collect() == []
