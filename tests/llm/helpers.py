"""Small inputs and brute-force versions."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa

from loomdex.llm import minhash
from loomdex.llm.common import blocks
from loomdex.llm.words import hashed_words, shingles


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def strange(spark, text: str, schema: str = ""):
    """Rows with nulls, empty and long texts, repeats, and columns that clash with inner names."""
    rows = [
        (1, text, "a", 0), (1, text, "a", 0), (2, None, "b", 1), (None, text + " more", None, None), (3, "", "c", 2),
        (4, "!!! ???", "d", 3), (5, "word " * 30_000, "e", 4), (6, "ünïcödé 漢字 🙂 " * 40, "f", 5), (None, None, None, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, mark string, row int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, mark string, row int")


def patchwork(seed: int, parts: list[str], other: str, rows: int, joiners: str = " "):
    """Texts glued from shared and random parts; some are null, some rows repeat."""
    r = random.Random(seed)
    out = []
    for i in range(rows):
        pieces = [r.choice(parts) if r.random() < 0.6 else "".join(r.choice(other) for _ in range(30)) for _ in range(r.randint(0, 12))]
        out.append((i // 2 if i % 7 else None, None if i % 11 == 0 else r.choice(joiners).join(pieces)))
    return out + out[:10]


def brute_bytes(rows, least):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + least] for i in range(len(data) - least + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - least + 1):
            if seen[data[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(1 for j in range(len(data)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((doc, len(data), len(data) - len(kept), runs, sha256(kept).hexdigest()))
    return Counter(out)


def brute_words(rows, least):
    split = [(float("inf") if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or ""), d) for d, t in rows]
    first = {}
    for doc, words, _ in split:
        for i in range(len(words) - least + 1):
            key = tuple(words[i : i + least])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, words, name in split:
        gone = [False] * len(words)
        for i in range(len(words) - least + 1):
            if first[tuple(words[i : i + least])] < doc:
                gone[i : i + least] = [True] * least
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((name, len(words), sum(gone), sha256(kept.encode()).hexdigest()))
    return Counter(out)


def classes_by_brute_force(rows):
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] or "" for r in rows])], names=["text"])
    _, _, data, at = next(blocks(batch, "text", 1 << 40))
    words, _, _, first = hashed_words(data, at)
    text, code, often, _ = shingles(words, first)
    cell = (code & np.uint64(minhash.CELLS - 1)).astype(int)
    n = np.bincount(cell, minlength=minhash.CELLS).astype(float)
    noise = (n.sum() - n) / (minhash.CELLS - 1)
    share = np.clip((n - noise) / len(rows), minhash.RARE, 1)
    weight = often * (1 + minhash.SPAN * np.log(share) / np.log(minhash.RARE))[cell]
    total = np.bincount(text, weight, minlength=len(rows))
    places: dict = {}
    for t, c, w in zip(text, code, weight):
        places.setdefault(c, []).append((t, w))
    common: dict = {}
    for found in places.values():
        for i, (a, x) in enumerate(found):
            for b, y in found[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + min(x, y)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), s in common.items():
        if s / (total[a] + total[b] - s) >= minhash.THRESHOLD:
            root[find(b)] = find(a)
    out: dict = {}
    for i in range(len(rows)):
        out.setdefault(find(i), []).append(i)
    return {frozenset(v) for v in out.values()}


def strings_cut(rows, least):
    """Texts without every byte that a repeated string of ``least`` bytes covers."""
    seen = Counter()
    for _, text in rows:
        data = text.encode()
        seen.update(data[i : i + least] for i in range(len(data) - least + 1))
    out = []
    for doc, text in rows:
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - least + 1):
            if seen[data[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        out.append((doc, bytes(x for x, g in zip(data, gone) if not g).decode("utf-8", "ignore")))
    return out


def covered(text, items, least=5, share=0.5):
    """Items whose words lie in common runs of ``least`` words with the text, to ``share`` at least."""
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    own = split(text)
    grams = {tuple(own[i : i + least]) for i in range(len(own) - least + 1)}
    out = set()
    for item, other in items:
        other = split(other)
        hit = {j for i in range(len(other) - least + 1) if tuple(other[i : i + least]) in grams for j in range(i, i + least)}
        if len(other) >= least and len(hit) >= share * len(other):
            out.add(item)
    return out
