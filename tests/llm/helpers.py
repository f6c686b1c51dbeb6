"""Rows that every operator must stand, and plain versions of words and shingles."""

from __future__ import annotations

import re
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
SENTENCE = "one two three four five six seven eight nine ten eleven twelve"
EDGES = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, SENTENCE, "en", None),
    (5, SENTENCE, "en", "b"), (5, SENTENCE, "en", "b"), (5, "another text under the same id", "en", "b"),
    (None, SENTENCE, None, None), (None, None, None, None), (6, LONG, "en", "b"), (7, LONG + " tail", "en", "b"),
    (8, "word", "en", "c"), (9, "word", "en", "c"), (10, "two words", "en", "c"), (11, "É" * 5000, "fr", "c"),
    (12, "nul \x00 byte and emoji \U0001f600 here", "en", "c"), (13, "\n".join([SENTENCE] * 9), "en", "c"),
]
#: Names that operators give to columns of their own.
CLASHING = ("score", "predicted", "kept", "node", "root", "bucket", "shard", "target", "size", "rule", "lines", "tkey", "key", "id")


def edge_docs(spark, rows=EDGES):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({"n_chars": F.length("text").cast("long"), **{c: F.lit(f"mine {c}") for c in CLASHING}})


def empty_docs(spark):
    return edge_docs(spark, [])


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def similar_pairs(sets):
    """Pairs of sets of similarity 0.75 or more, by counting shared members."""
    from collections import Counter, defaultdict

    holders, out = defaultdict(list), []
    for i, s in enumerate(sets):
        shared = Counter()
        for x in s:
            shared.update(holders[x])
            holders[x].append(i)
        out += [(j, i) for j, n in shared.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)]
    return out
