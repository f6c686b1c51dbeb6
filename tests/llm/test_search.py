"""Ranked search against a plain score of every document, bounds against exact maxima, rows of all kinds."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import EDGES, LONG, MIDDLE, edge_docs, empty_docs, table

from marketloom.llm import search


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top=50):
    """{item: [(rank, id, score)]} by the contract."""
    tf = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(c.values()) for _, c in tf]
    N, L = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in tf for t in c)
    out = {}
    for item, text in items:
        scores = []
        for (i, c), size in zip(tf, n, strict=True):
            if size:
                m = 100 - 50 + (50 * size * N) // L
                s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in {*terms(text)} if c[t])
                if s > 0:
                    scores.append((i, s))
        scores.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out[item] = [(r + 1, i, s) for r, (i, s) in enumerate(scores[:top])]
    return {k: v for k, v in out.items() if v}


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


ITEMS = [(1, "one two eleven"), (2, None), (3, ""), (4, "WORD word two"), (5, "w1 x3 x29999 w976"), (6, "nothing known here"), (None, "twelve text"),
         (7, LONG), (8, "\x00 nul É" + "É" * 4999), (9, "a-b_c")]


def test_edges(spark):
    items = spark.createDataFrame([(*x, "mine") for x in ITEMS], "item_id long, text string, score string")
    assert ranked(search.search_digest(edge_docs(spark), items)) == plain([(r[0], r[1]) for r in EDGES], ITEMS)
    assert search.search_digest(empty_docs(spark), items).collect() == []
    assert search.search_digest(edge_docs(spark), items.limit(0)).collect() == []
    assert search.search_digest(edge_docs(spark), items.filter("item_id in (2, 3)")).collect() == []


def test_repeated_items_answer_twice(spark):
    items = spark.createDataFrame([(1, "one two"), (1, "one two"), (1, "word")], "item_id long, text string")
    rows = search.search_digest(edge_docs(spark), items).collect()
    want = plain([(r[0], r[1]) for r in EDGES], [("a", "one two"), ("b", "one two"), ("c", "word")])
    assert len(rows) == sum(len(v) for v in want.values())


@pytest.fixture()
def small_shards(monkeypatch):
    monkeypatch.setattr(search, "SHARD_CHARS", 20_000)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "LONG_LIST", 3)
    monkeypatch.setattr(search, "PRIMING_SHARDS", 4)


def test_many_shards_with_priming_and_batches(spark, small_shards, monkeypatch):
    monkeypatch.setattr(search, "BATCH_CHARS", 3000)
    docs, items = table(spark, MIDDLE, "documents").repartition(5), table(spark, MIDDLE, "benchmark")
    index = search.build_index(docs)
    assert index.shards.count() > 2 * search.PRIMING_SHARDS
    got = ranked(search.search(index, items, top=7))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()], 7)


def local_shards(spark, small=True):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, MIDDLE, "documents").collect()]
    index = search.build_index(table(spark, MIDDLE, "documents"))
    shards = [search.Shard(r.asDict(), index.corpus) for r in index.shards.collect()]
    items = table(spark, MIDDLE, "benchmark").select("item_id", "text", "item_id").toDF("query", "text", "x").toArrow()
    return docs, index, shards, search._queries(items, index)


def test_bounds_hold_and_pairs_skip_more(spark):
    _, index, shards, q = local_shards(spark)
    frequent = set(index.corpus.frequent.tolist())
    assert len(frequent) == search.PAIR_TERMS
    exact = {True: 0, False: 0}
    used = 0
    for k in range(len(q)):
        here = slice(q.first[k], q.first[k + 1])
        scores = []
        for shard in shards:
            place = np.minimum(np.searchsorted(shard.terms, q.terms[here]), len(shard.terms) - 1)
            there = shard.terms[place] == q.terms[here]
            t, w = place[there], q.weights[here][there]
            at, score = shard.search(t, w, 1)
            scores += score.tolist()
            long = t[(shard.starts[t + 1] - shard.starts[t]) >= search.LONG_LIST].tolist()
            weight_of = dict(zip(t.tolist(), w.tolist(), strict=True))
            alone, paired = (shard.bounds(long, weight_of, p)[1] for p in (False, True))
            dense = np.zeros(shard.blocks * search.BLOCK, np.int64)
            for x in long:
                a, f = shard.postings(x)
                dense[a] += weight_of[x] * f
            assert (paired <= alone).all() and (dense.reshape(shard.blocks, -1).max(axis=1) <= paired[0]).all()
            used += int((paired[0] < alone[0]).sum())
        least = sorted(scores)[-min(10, len(scores))]
        for shard in shards:
            place = np.minimum(np.searchsorted(shard.terms, q.terms[here]), len(shard.terms) - 1)
            there = shard.terms[place] == q.terms[here]
            results = []
            for pairs in (True, False):
                shard.scored = 0
                at, score = shard.search(place[there], q.weights[here][there], least, pairs)
                exact[pairs] += shard.scored
                results.append((at.tolist(), score.tolist()))
            assert results[0] == results[1]
    assert used and exact[True] < exact[False]


def test_skipping_spares_most_of_the_work(spark):
    _, index, shards, q = local_shards(spark)
    with_threshold = without = 0
    for k in range(len(q)):
        here = slice(q.first[k], q.first[k + 1])
        for shard in shards:
            place = np.minimum(np.searchsorted(shard.terms, q.terms[here]), len(shard.terms) - 1)
            there = shard.terms[place] == q.terms[here]
            shard.scored = 0
            _, score = shard.search(place[there], q.weights[here][there], 1)
            without += shard.scored
            shard.scored = 0
            shard.search(place[there], q.weights[here][there], int(np.sort(score)[-min(len(score), 10)]) if len(score) else 1)
            with_threshold += shard.scored
    assert with_threshold < 0.7 * without


def test_packing():
    x = np.array([0, 1, 255, 256, 2 ** 32 - 1])
    assert (search.unplaned(search.planes(x)) == x).all() and not len(search.unplaned(search.planes(x[:0])))
