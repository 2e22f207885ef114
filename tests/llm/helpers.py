"""Small documents, brute-force versions and comparisons."""

from __future__ import annotations

import random
import re

SEPARATORS = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SEPARATORS.split(text or "") if w]


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def components(nodes, links):
    label = {n: n for n in nodes}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return {n: find(n) for n in nodes}


def grams(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0
