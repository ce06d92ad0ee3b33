"""Queries of this package in SQL for DuckDB, by other means than the operators."""

from __future__ import annotations

TOP_K = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT q.vec_id AS query_id, q.parts AS asked, v.vec_id,
            CAST(coalesce(list_sum(list_transform(list_zip(q.parts, v.parts), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
        FROM (SELECT DISTINCT vec_id, parts FROM v WHERE vec_id % 100 = 0) q
        JOIN v ON q.vec_id <> v.vec_id AND len(q.parts) = len(v.parts))
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM pairs QUALIFY rank <= 10
"""

_FIVE_BYTES = ", ".join(f"to_base(CAST('0x' || substr(digest, {1 + 10 * k}, 10) AS BIGINT), 32, 8)" for k in range(4))

WARC = f"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest,
            max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
        FROM pages)
    SELECT page_id, strlen(payload) AS payload_bytes,
        translate(concat({_FIVE_BYTES}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM p
"""

_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

DECONTAMINATION = f"""
    WITH d AS (SELECT row_number() OVER () AS place, doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    sized AS (SELECT item, w, least(13, len(w)) AS size FROM i WHERE len(w) > 0),
    item_windows AS (
        SELECT DISTINCT item, size, array_to_string(w[k : k + size - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM sized)),
    doc_windows AS (
        SELECT place, k, size, array_to_string(w[k : k + size - 1], ' ') AS phrase
        FROM (SELECT place, w, size, unnest(range(1, len(w) - size + 2)) AS k
            FROM d CROSS JOIN (SELECT DISTINCT size FROM sized))),
    met AS (SELECT place, k, size, item FROM doc_windows JOIN item_windows USING (size, phrase)),
    hit AS (
        SELECT place, count(DISTINCT word) AS n_hit
        FROM (SELECT place, unnest(range(k, k + size)) AS word FROM met) GROUP BY place),
    found AS (
        SELECT place, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT place, item FROM met) GROUP BY place)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (place) LEFT JOIN found USING (place)
"""

def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII expression, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(crc, x) >> 1, (xor(crc, x) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST({bits} AS BIGINT[])), lambda crc, x: {step}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256(concat({', '.join(_field(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))}))"


MERKLE = f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
            CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(CAST(n_chars AS HUGEINT) + 1)')} ELSE {_leaf('n_chars')} END AS other
        FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
    nodes AS (
        SELECT lang, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY lang) AS many FROM placed
        UNION ALL
        SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(many) + 1) // 2
        FROM nodes WHERE many > 1 GROUP BY lang, level, pos // 2),
    subroots AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE many = 1),
    tops AS (
        SELECT 0 AS level, pos, subroot AS node, count(*) OVER () AS many FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(many) + 1) // 2
        FROM tops WHERE many > 1 GROUP BY level, pos // 2),
    paths AS (
        SELECT p.lang, p.pos, 0 AS tree, n.level, n.pos % 2 AS side, coalesce(n.node, '') AS node FROM (
            SELECT p.lang, p.pos, l.level, xor(p.pos >> l.level, 1) AS sibling FROM placed p
            JOIN (SELECT DISTINCT lang, level FROM nodes WHERE many > 1) l ON l.lang IS NOT DISTINCT FROM p.lang) p
        LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.level = p.level AND n.pos = p.sibling WHERE n.node IS NOT NULL
        UNION ALL
        SELECT p.lang, p.pos, 0, p.level, 2, '' FROM (
            SELECT p.lang, p.pos, l.level, xor(p.pos >> l.level, 1) AS sibling FROM placed p
            JOIN (SELECT DISTINCT lang, level FROM nodes WHERE many > 1) l ON l.lang IS NOT DISTINCT FROM p.lang) p
        WHERE NOT EXISTS (FROM nodes n WHERE n.lang IS NOT DISTINCT FROM p.lang AND n.level = p.level AND n.pos = p.sibling)
        UNION ALL
        SELECT p.lang, p.pos, 1, l.level, CASE WHEN t.node IS NULL THEN 2 ELSE t.pos % 2 END, coalesce(t.node, '')
        FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
        CROSS JOIN (SELECT DISTINCT level FROM tops WHERE many > 1) l
        LEFT JOIN tops t ON t.level = l.level AND t.pos = xor(s.pos >> l.level, 1)),
    proofs AS (
        SELECT lang, pos, string_agg(node, '' ORDER BY tree, level) AS proof, list(CAST(side AS VARCHAR) || node ORDER BY tree, level) AS steps
        FROM paths GROUP BY lang, pos),
    folded AS (
        SELECT doc_id, leaf, subroot, (SELECT node FROM tops WHERE many = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
            list_reduce(list_prepend(other, coalesce(steps, [])), lambda acc, x: sha256(CASE x[1]
                WHEN '0' THEN x[2:] || acc WHEN '1' THEN acc || x[2:] ELSE acc END)) AS folded_root
        FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
        LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos)
    SELECT *, folded_root = root AS verified FROM folded
"""

JACCARD = r"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS place, doc_id, coalesce(regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    s AS (
        SELECT DISTINCT place, array_to_string(w[k : k + 4], ' ') AS shingle
        FROM (SELECT place, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
    sized AS (SELECT place, count(*) AS n FROM s GROUP BY place),
    shared AS (SELECT a.place AS a, b.place AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.place <> b.place GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sized x ON x.place = a JOIN sized y ON y.place = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach AS (SELECT place AS a, place AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, found.component_id
    FROM d LEFT JOIN sized USING (place)
    JOIN (SELECT a AS place, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.place = b GROUP BY a) found USING (place)
"""

REPAIR = f"""
    WITH RECURSIVE spoilt AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
        FROM conversations),
    changed AS (
        SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM spoilt WHERE kind <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM changed),
    flawed AS (
        SELECT *, left(role, 1) AS c, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM placed),
    r AS (
        SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
        FROM flawed),
    many AS (SELECT conv_id, count(pos) AS n FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN r USING (conv_id) GROUP BY conv_id
        UNION SELECT NULL, (SELECT count(*) FROM r WHERE conv_id IS NULL) WHERE EXISTS (FROM conversations WHERE conv_id IS NULL)),
    -- From the end: the cheapest and least edits from each state (nothing, system, user, assistant).
    ways AS (
        SELECT conv_id, n AS pos, {{'cost': 0, 'audit': ''}} AS s0, {{'cost': 4, 'audit': 'II'}} AS s1, {{'cost': 2, 'audit': 'I'}} AS s2, {{'cost': 0, 'audit': ''}} AS s3
        FROM (SELECT conv_id, max(n) AS n FROM many GROUP BY conv_id)
        UNION ALL
        SELECT conv_id, pos, least(b0, i2) AS s0, least(b1, i2) AS s1, least(b2, i3) AS s2, least(b3, i2) AS s3 FROM (
            SELECT *, {{'cost': least(b2, {{'cost': b3.cost + 2, 'audit': 'I' || b3.audit}}).cost + 2, 'audit': 'I' || least(b2, {{'cost': b3.cost + 2, 'audit': 'I' || b3.audit}}).audit}} AS i2,
                {{'cost': least(b3, {{'cost': b2.cost + 2, 'audit': 'I' || b2.audit}}).cost + 2, 'audit': 'I' || least(b3, {{'cost': b2.cost + 2, 'audit': 'I' || b2.audit}}).audit}} AS i3
            FROM (
                SELECT w.conv_id, w.pos - 1 AS pos,
                    least({{'cost': w.s0.cost + 3, 'audit': 'D' || w.s0.audit}}, {{'cost': w.s2.cost + 2 + t, 'audit': 'R' || w.s2.audit}},
                        {{'cost': CASE c WHEN 's' THEN w.s1.cost + t WHEN 'u' THEN w.s2.cost + t ELSE 1000000000 END, 'audit': 'K' || CASE c WHEN 's' THEN w.s1.audit ELSE w.s2.audit END}}) AS b0,
                    least({{'cost': w.s1.cost + 3, 'audit': 'D' || w.s1.audit}}, {{'cost': w.s2.cost + 2 + t, 'audit': 'R' || w.s2.audit}},
                        {{'cost': CASE c WHEN 'u' THEN w.s2.cost + t ELSE 1000000000 END, 'audit': 'K' || w.s2.audit}}) AS b1,
                    least({{'cost': w.s2.cost + 3, 'audit': 'D' || w.s2.audit}}, {{'cost': w.s3.cost + 2 + t, 'audit': 'R' || w.s3.audit}},
                        {{'cost': CASE c WHEN 'a' THEN w.s3.cost + t ELSE 1000000000 END, 'audit': 'K' || w.s3.audit}}) AS b2,
                    least({{'cost': w.s3.cost + 3, 'audit': 'D' || w.s3.audit}}, {{'cost': w.s2.cost + 2 + t, 'audit': 'R' || w.s2.audit}},
                        {{'cost': CASE c WHEN 'u' THEN w.s2.cost + t ELSE 1000000000 END, 'audit': 'K' || w.s2.audit}}) AS b3
                FROM ways w JOIN (SELECT conv_id, pos, c, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 1 ELSE 1000000000 END AS t FROM r) x
                    ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.pos = w.pos))),
    best AS (SELECT conv_id, s0.cost AS cost, s0.audit AS audit FROM ways WHERE pos = 0),
    letters AS (
        SELECT conv_id, k, audit[k] AS letter, len(replace(audit[:k], 'I', '')) AS pos
        FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM best)),
    said AS (
        SELECT e.conv_id, k, CASE WHEN letter = 'K' THEN role END AS own, letter = 'K' AND c = 's' AS system, CASE WHEN letter = 'I' THEN '' ELSE text END AS text
        FROM letters e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.pos AND letter <> 'I' WHERE letter <> 'D'),
    spoken AS (
        SELECT conv_id, k, coalesce(own, CASE count(*) FILTER (NOT system) OVER (PARTITION BY conv_id ORDER BY k) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END) AS role, text
        FROM said),
    whole AS (SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY k) AS repaired FROM spoken GROUP BY conv_id),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
            count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
    SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM best b LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


def statements() -> dict[str, str]:
    return {
        "op1_bit_sliced_top_k": TOP_K,
        "op7_warc_round_trip": WARC,
        "op8_fm_index_decontamination": DECONTAMINATION,
        "op11_merkle_manifest": MERKLE,
        "op12_ngram_jaccard": JACCARD,
        "op13_conversation_repair": REPAIR,
    }
