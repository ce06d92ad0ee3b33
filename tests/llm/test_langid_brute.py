"""The posterior of language ID, added up row by row."""

import math
import random
from collections import Counter

import numpy as np

from tidemark.llm import langid


def fold(text: str | None) -> bytes:
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in (text or "").encode())


def cell(gram: bytes) -> int:
    return ((gram[0] << 16 | gram[1] << 8 | gram[2]) * 2654435761 & 0xFFFFFFFF) >> 17


def posterior(rows: list[tuple], host_weight: float, suffix_weight: float, most: int = 200) -> list[tuple]:
    """(id, language, confidence, accepted) of rows (id, text, declared, host, suffix)."""
    names = sorted({tag for _, _, tag, _, _ in rows if tag})
    grams = {name: Counter() for name in names}
    letters: Counter = Counter()
    for _, text, tag, _, _ in rows:
        if tag:
            data = fold(text)
            grams[tag].update(cell(data[k : k + 3]) for k in range(len(data) - 2))
            letters.update(data)
    size = langid.CELLS
    logs = {name: lambda c, own=own: math.log((own[c] + 0.05) / (sum(own.values()) + 0.05 * size)) for name, own in grams.items()}
    total = sum(letters.values()) + 256e-3
    known = [b for b in range(256) if fold(chr(b) if b < 128 else "")[:1] == bytes([b]) or b >= 128]
    chance = np.array([(letters[b] + 1e-3) / total for b in known])
    no_order = np.zeros(size)
    for a, pa in zip(known, chance, strict=True):
        codes = (np.add.outer(np.array(known, np.int64) << 8, np.array(known, np.int64)) | a << 16) * 2654435761 & 0xFFFFFFFF
        np.add.at(no_order, (codes >> 17).ravel(), pa * np.outer(chance, chance).ravel())
    no_order = (no_order + 1e-9) / (no_order + 1e-9).sum()
    classes = [*names, "und"]
    logs["und"] = lambda c: math.log(no_order[c])

    def alone(text):
        data = fold(text)
        at = [cell(data[k : k + 3]) for k in range(len(data) - 2)]
        return [sum(map(logs[name], at)) / max(1, len(at)) * min(len(at), most) for name in classes]

    scores = [alone(text) for _, text, _, _, _ in rows]
    worded = [bool(fold(text).strip()) for _, text, _, _, _ in rows]
    best = [classes[int(np.argmax(x))] if some else None for x, some in zip(scores, worded, strict=True)]
    met, said, everything = Counter(), Counter(), Counter()
    hosts, ends = Counter(), Counter()
    for (_, _, tag, host, end), name in zip(rows, best, strict=True):
        if name:
            everything[name] += 1
            hosts[host, end, name] += 1
            ends[end, name] += 1
            if tag:
                met[tag, name] += 1
                said[name] += 1
    n, out = len(classes), []
    for (row, _, tag, host, end), own, some in zip(rows, scores, worded, strict=True):
        final = []
        for name, score in zip(classes, own, strict=True):
            prior = (everything[name] + 1) / (sum(everything.values()) + n)
            prior = (ends[end, name] + suffix_weight * prior) / (sum(ends[end, x] for x in classes) + suffix_weight)
            prior = (hosts[host, end, name] + host_weight * prior) / (sum(hosts[host, end, x] for x in classes) + host_weight)
            tagged = math.log((met[tag, name] + 0.5) / (said[name] + 0.5 * n)) if tag else 0.0
            final.append(score + math.log(prior) + tagged)
        sure = 1 / sum(math.exp(x - max(final)) for x in final)
        name = classes[int(np.argmax(final))]
        out.append((row, name, sure, some and name != "und" and sure > 0.5))
    return out


def test_posterior_against_one_row_at_a_time(spark):
    draw = random.Random(12)
    words = {tag: ["".join(draw.choice(letters) for _ in range(draw.randrange(2, 6))) for _ in range(12)] for tag, letters in (("aa", "abcdefé"), ("bb", "cdefgh"), ("cc", "efghijß"))}
    rows = []
    for k in range(120):
        tag = draw.choice(["aa", "aa", "bb", "cc"])
        text = " ".join(draw.choice(words[tag if draw.random() < 0.8 else "bb"]) for _ in range(draw.choice([0, 1, 1, 2, 3, 8, 90])))
        declared = draw.choice([tag, tag, None, "bb"])
        rows.append((k, text, declared, f"h{draw.randrange(4)}" if draw.random() < 0.7 else tag, f"s{draw.randrange(2)}"))
    rows += [(200, None, "cc", "h1", "s0"), (201, "12 !?", None, "aa", "s1"), (202, "qzqz xjwv", None, "h0", "s0"), (203, "A", "aa", "h9", "s9")]
    frame = spark.createDataFrame(rows, "id long, text string, tag string, site string, ending string").repartition(4)
    found = langid.identify(langid.evidence(frame, "text", "tag", "site", "ending"), ["id"], smooth_host=3.0, smooth_suffix=7.0)
    found = {r["id"]: r for r in found.collect()}
    wanted = posterior(rows, 3.0, 7.0)
    assert len(found) == len(wanted)
    assert all(abs(found[row]["confidence"] - sure) < 2e-3 for row, _, sure, _ in wanted)
    clear = [(row, name, good) for row, name, sure, good in wanted if abs(sure - 0.5) > 0.01]
    assert len(clear) > 110 and [(row, found[row]["language"], found[row]["accepted"]) for row, _, _ in clear] == clear
    assert any(sure < 0.9 for _, _, sure, _ in wanted)


def test_rows_do_not_widen_with_the_classes(spark):
    """Classes far from the likeliest are not listed, and none of them would have changed a posterior."""
    draw = random.Random(5)
    rows = []
    for k in range(300):
        tag = "l" + "abcdefghijklmno"[k % 15]
        own = random.Random(tag)
        words = ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(15)]
        rows.append((k, " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 3, 60, 200]))), tag, f"h{k % 7}"))
    frame = langid.evidence(spark.createDataFrame(rows, "id long, text string, tag string, site string").repartition(3), "text", "tag", "site")
    names, model = langid.fit(frame)
    wide = {r["id"]: len(r["_logs"]) for r in langid.likelihoods(frame, names, model, ["id"]).collect()}
    long = [k for k, text, _, _ in rows if len(text) > 1000]
    assert len(names) == 16 and len(long) > 20 and all(wide[k] < 6 for k in long) and max(wide.values()) == 16
    near, all_ = ({r["id"]: r for r in langid.identify(frame, ["id"], reach=reach).collect()} for reach in (150.0, 1e9))
    assert len(near) == 300 and near.keys() == all_.keys()
    for k, row in near.items():
        assert (row["language"], row["accepted"]) == (all_[k]["language"], all_[k]["accepted"]) and abs(row["confidence"] - all_[k]["confidence"]) < 1e-12
