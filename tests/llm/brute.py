"""The operators' results by the plainest means."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterable

import xxhash

LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def groups(n: int, linked: Callable[[int, int], bool]) -> list[int]:
    """For each of n things the least one that links lead to."""
    label = list(range(n))
    for i in range(n):
        for j in range(i):
            if label[i] != label[j] and linked(i, j):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def fingerprint(text: str | None, length: int = 4) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + length]) for k in range(max(1, len(words) - length + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows: list[tuple], most: int = 4) -> list[tuple]:
    """(doc_id, fingerprint, component_id) of rows (doc_id, text)."""
    prints = [fingerprint(text) for _, text in rows]
    label = groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= most)
    least: dict[int, int | None] = {}
    for (doc, _), k in zip(rows, label, strict=True):
        known = [x for x in (least.get(k), doc) if x is not None]
        least[k] = min(known) if known else None
    return [(doc, f"{p:016x}", least[k]) for (doc, _), p, k in zip(rows, prints, label, strict=True)]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    known: dict[tuple, set[str]] = {}
    for name, text in items:
        own = words(text)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            known.setdefault(tuple(own[k : k + window]), set()).add("" if name is None else str(name))
    sizes, out = {len(x) for x in known}, []
    for doc, text in docs:
        own, found = words(text), set()
        hit = [False] * len(own)
        for size in sizes:
            for k in range(len(own) - size + 1):
                names = known.get(tuple(own[k : k + size]))
                if names:
                    found |= names
                    hit[k : k + size] = [True] * size
        n = sum(hit)
        out.append((doc, len(own), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(own)))
    return out


def repeated(rows: list[tuple], length: int) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(data[k : k + length] for _, data in raw for k in range(len(data) - length + 1))
    out = []
    for doc, data in raw:
        gone = [False] * len(data)
        for k in range(len(data) - length + 1):
            if seen[data[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(x and not y for x, y in zip(gone, [False, *gone], strict=False))
        kept = bytes(b for b, x in zip(data, gone, strict=True) if not x)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def ordered(rows: Iterable) -> list[tuple]:
    return sorted((tuple(row) for row in rows), key=repr)
