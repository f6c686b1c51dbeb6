import math
from collections import Counter

import pytest
from helpers import MIDDLE, SMALL, edge_docs, empty_docs, table, words

from marketloom.llm import lmscore as L
from marketloom.llm.hashing import Hasher


def exact(rows):
    """The scores on words themselves."""
    texts = [words(r["text"]) for r in rows]
    one = Counter(w for t in texts for w in t)
    two = Counter(p for t in texts for p in zip(t, t[1:], strict=False))
    total = sum(one.values())
    out = []
    for r, t in zip(rows, texts, strict=True):
        mine, pairs, score = Counter(t), Counter(zip(t, t[1:], strict=False)), 0.0
        for a, b in zip([None, *t], t, strict=False):
            left = two[a, b] - pairs[a, b]
            score += math.log(left / (one[a] - mine[a]) if left else (1 if a is None else 0.4) * (one[b] - mine[b] or 0.4) / max(total - len(t), 1))
        out.append((str(r["doc_id"]), len(t), score / len(t) if t else None))
    return out


def same(got, want):
    got = sorted(((str(r["doc_id"]), r["n_words"], r["log_score"]) for r in got), key=lambda x: str(x[:2]))
    want = sorted(want, key=lambda x: str(x[:2]))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    for (_, _, a), (_, _, b) in zip(got, want, strict=True):
        assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-9))


def test_against_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    same(L.score_documents(docs).collect(), exact(docs.collect()))


@pytest.mark.parametrize("frequent", [50, 100_000])
def test_buckets_and_frequent_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(L, "FREQUENT", frequent)
    monkeypatch.setattr(L, "CHUNK", 20_000)
    docs = table(spark, SMALL, "documents")
    same(L.score_documents(docs, bucket_pairs=5000).collect(), exact(docs.collect()))


def test_edges(spark):
    docs = edge_docs(spark).filter("doc_id IS NULL OR doc_id <> 5")
    same(L.score_documents(docs).collect(), exact(docs.collect()))
    five = edge_docs(spark).filter("doc_id = 5")
    assert [r["n_words"] for r in L.score_documents(five).orderBy("n_words").collect()] == [6, 12, 12]
    assert L.score_documents(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("bucket_pairs", [1000, L.BUCKET_PAIRS])
def test_words_share_no_count(spark, monkeypatch, bucket_pairs):
    """Among these words some agree in 21 bits of their hash; each is known only by itself."""
    monkeypatch.setattr(L, "CHUNK", 2000)
    names = [f"n{i}" for i in range(8000)]
    low = Hasher().words([" ".join(names)]).hashes % (1 << 21)
    by = {}
    for name, x in zip(names, low.tolist(), strict=True):
        by.setdefault(x, []).append(name)
    twins = [v for v in by.values() if len(v) > 1]
    assert len(twins) >= 5
    rows = [(i, f"alike {v[0]} here {v[0]} twice") for i, v in enumerate(twins)]
    rows += [(1000 + i, f"alike {v[1]} here") for i, v in enumerate(twins)]
    rows += [(5000 + i, f"{a} {b} alike") for i, (a, b) in enumerate(zip(names[:500], names[1:], strict=False))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = L.score_documents(docs, bucket_pairs=bucket_pairs).collect()
    want = {x[0]: x for x in exact(docs.collect())}
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["log_score"]) == (want[str(r["doc_id"])][1], pytest.approx(want[str(r["doc_id"])][2], abs=1e-9))


def test_all_words_of_the_middle_table(spark):
    docs = table(spark, MIDDLE, "documents")
    same(L.score_documents(docs).collect(), exact(docs.collect()))


def test_sums_of_a_bucket():
    import numpy as np

    r = np.random.default_rng(2)
    keys, counts = r.integers(0, 50, 2000).astype(np.uint64), r.integers(1, 9, 2000).astype(np.uint32)
    want = {k: int(counts[keys == k].sum()) for k in set(keys.tolist())}
    assert L._totals(keys, counts).tolist() == [want[k] for k in keys.tolist()]
    assert not len(L._totals(keys[:0], counts[:0]))
