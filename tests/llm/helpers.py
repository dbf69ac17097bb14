"""Brute-force references and hand-made tables for the training-data operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names the operators use inside.
CLASHING = ["key", "h", "p", "bits", "prefix", "bytes", "docs", "size", "rate", "target", "copies", "mix", "shard", "item_id", "w",
            "bad_id", "row_key", "fp", "root", "score", "predicted", "c0__", "part", "copy"]


def docs_frame(spark, rows, clashing=False):
    """rows: (doc_id, text, source); clashing: with columns of operators' inner names."""
    df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        for c in CLASHING:
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def edge_rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows."""
    base = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    return [
        (1, base, "a"), (2, base, "b"), (2, base, "b"), (3, base + " tail", None), (4, None, "a"), (5, "", "b"), (6, " \t\n ", "a"),
        (None, other, "c"), (None, other, "c"), (7, other, "c"), (8, "x " * 60_000, "a"), (9, "one", None), (10, "two words", "z"),
        (11, "é一\U0001F600 " * 20, "z"), (12, "x " * 60_000, "\U0001F600"), (13, "y" * 300_000, "b"),
    ]


def words(text):
    return WORD.findall(text or "")


def windows_removed(rows, n=13):
    """Per row: (n_words, kept words) by the definition; null ids after all others."""
    rank = lambda i: (i is None, i or 0)
    least = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            least[key] = min(least.get(key, rank(i)), rank(i))
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if least[tuple(w[k:k + n])] < rank(i):
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def simhash(text, n=3):
    import xxhash
    w = [bytes(x) for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    shingles = [b" ".join(w[k:k + n]) for k in range(max(1, len(w) - n + 1))] if w else []
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def components(nodes, linked):
    """node -> list of its component, by brute force over all pairs."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = list(nodes)
    for a in range(len(nodes)):
        for b in range(a):
            if linked(nodes[a], nodes[b]):
                parent[find(nodes[a])] = find(nodes[b])
    groups = defaultdict(list)
    for x in nodes:
        groups[find(x)].append(x)
    return {x: groups[find(x)] for x in nodes}


def leaks(rows, items, containment=0.8, n=5):
    # a text of fewer words is one shingle
    shingles = lambda t: {tuple(w[k:k + n]) for w in [words((t or "").lower())] if w for k in range(max(1, len(w) - n + 1))}
    bench = {i: shingles(t) for i, t in items}
    out = set()
    for d, t, *_ in rows:
        mine = shingles(t)
        for i, s in bench.items():
            if s and len(s & mine) >= containment * len(s) - 1e-9:
                out.add((d, i, len(s & mine), len(s)))
    return out
