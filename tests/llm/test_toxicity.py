import zlib

import numpy as np
import pytest
from helpers import edge_docs, empty_docs, table
from pyspark.sql import functions as F

from marketloom.llm import toxicity as T
from marketloom.llm.hashing import Hasher
from marketloom.llm.toxicnet import WINDOW, ToxicNet, Vocabulary, windows

WIDE = "/root/testdata/sf0.1"


def test_gradients_against_differences():
    w = Hasher().words(["some words of a text that is short", "other words ünd mörè characters in another text here"])
    v = Vocabulary(w)
    idx, _ = windows(w.first, v.ids, len(v))
    y = np.array([1.0, 0.0], np.float32)
    net = ToxicNet(3)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    used = np.unique(idx[idx < len(v)])
    _, g = net.gradients(v, idx, y, net.inputs(v)[np.append(used, len(v))])
    r = np.random.default_rng(1)
    for name in ("u0", "u1", "att", "out", "off", "x", "bias", "word", "gram", "start"):
        flat, grad = net.p[name].reshape(-1), g[name].reshape(-1)
        for at in r.choice(np.flatnonzero(grad), min(4, np.count_nonzero(grad)), replace=False):
            was, losses = flat[at], []
            for step in (1e-3, -1e-3):
                flat[at] = was + step
                losses.append(net.gradients(v, idx, y, net.inputs(v)[np.append(used, len(v))])[0])
            flat[at] = was
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(grad[at], rel=0.05, abs=2e-4), name


def test_windows_overlap_and_cover_all_words():
    texts = [" ".join(f"w{k}" for k in range(n)) for n in (0, 1, WINDOW, WINDOW + 1, 100, 1000)]
    w = Hasher().words(texts)
    v = Vocabulary(w)
    idx, text = windows(w.first, v.ids, len(v))
    for d, n in enumerate((0, 1, WINDOW, WINDOW + 1, 100, 1000)):
        own = idx[text == d]
        assert set(own[own < len(v)]) == set(v.ids[w.first[d]:w.first[d + 1]])
        assert len(own) == (0 if n == 0 else max(1, -(-(n - WINDOW) // 16) + 1))


def test_held_out_accuracy(spark):
    docs, labels = table(spark, WIDE, "documents"), table(spark, WIDE, "labels")
    got = T.toxicity_digest(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"])
    rank = got["score"].rank()
    yes = got["toxic"] == 1
    auc = (rank[yes].mean() - (yes.sum() + 1) / 2) / (~yes).sum()
    wrong = (got["predicted"] != got["toxic"])
    assert auc > 0.93 and wrong[~yes].mean() < 0.05 and wrong[yes].mean() < 0.3


def plain_scores(net, texts):
    """The network one number at a time: every window of every text, word by word, by its formulas."""
    import math

    import marketloom.llm.toxicnet as N

    p = {k: x.astype(float) for k, x in net.p.items()}
    sig = lambda x: 1 / (1 + math.exp(-x))
    out = []
    for text in texts:
        w = Hasher().words([text])
        v = Vocabulary(w)
        vectors = []
        for i in range(len(v)):
            grams = v.grams[v.gram_first[i]:v.gram_first[i + 1]]
            starts = [v.start_rows[i, k] for k in range(len(N.STARTS)) if v.has_start[i, k]]
            mean = lambda rows, t, dim: [sum(p[t][r][d] for r in rows) / len(rows) for d in range(dim)]
            vectors.append([*p["word"][v.word_rows[i]], *mean(grams, "gram", N.GRAM_DIM), *mean(starts, "start", N.START_DIM)])
        vectors.append([0.0] * N.DIM)
        n, best = len(v.ids), None
        begins = sorted({*range(0, max(n - N.WINDOW, 0) + 1, N.STEP), max(n - N.WINDOW, 0)}) if n else []
        for b in begins:
            ids = [*v.ids[b:b + N.WINDOW]]
            ids += [len(v)] * (N.WINDOW - len(ids))
            gates = [[sum(vectors[i][d] * p["x"][d][g] for d in range(N.DIM)) + p["bias"][g] for g in range(2 * N.G)] for i in ids]
            states = [[], []]
            for way, u in enumerate(("u0", "u1")):
                h = [0.0] * N.HIDDEN
                steps = range(N.WINDOW) if way == 0 else range(N.WINDOW - 1, -1, -1)
                line = [None] * N.WINDOW
                for t in steps:
                    x = gates[t][way * N.G:(way + 1) * N.G]
                    g = [sum(h[d] * p[u][d][k] for d in range(N.HIDDEN)) for k in range(N.G)]
                    new = []
                    for k in range(N.HIDDEN):
                        z, r = sig(x[k] + g[k]), sig(x[N.HIDDEN + k] + g[N.HIDDEN + k])
                        c = math.tanh(x[2 * N.HIDDEN + k] + r * g[2 * N.HIDDEN + k])
                        new.append(c + z * (h[k] - c))
                    h = line[t] = new
                states[way] = line
            whole = [[*a, *c] for a, c in zip(*states, strict=True)]
            e = [sum(a * b for a, b in zip(s, p["att"], strict=True)) for s, i in zip(whole, ids, strict=True) if i != len(v)]
            top = max(e)
            share = [math.exp(x - top) for x in e]
            pooled = [sum(a * s[d] for a, s in zip(share, whole, strict=False)) / sum(share) for d in range(2 * N.HIDDEN)]
            logit = sum(a * b for a, b in zip(pooled, p["out"], strict=True)) + p["off"][0]
            best = logit if best is None else max(best, logit)
        out.append(0.0 if best is None else sig(max(-60, min(60, p["line"][0] * best + p["line"][1]))))
    return out


def test_scores_against_a_plain_forward_pass(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    net = T.fit(docs, labels)
    texts = [r["text"] for r in docs.filter("length(text) < 900").orderBy("doc_id").limit(12).collect()]
    texts += ["", " \n", "ä", "one two", " ".join(f"w{i}" for i in range(WINDOW)), " ".join(f"w{i} É" for i in range(40))]
    assert T.score_texts(net, Hasher(), texts) == pytest.approx(plain_scores(net, texts), abs=2e-3)


def test_training_beats_its_first_guess(spark):
    """Log odds seed the network; what it learns after that ranks held-out texts better."""
    docs, labels = table(spark, WIDE, "documents"), table(spark, WIDE, "labels")
    net = T.fit(docs, labels)
    rows = docs.join(labels.filter("toxic IS NOT NULL"), "doc_id").filter(T.held_out(F.col("doc_id"))).select("text", "toxic").collect()
    w = Hasher().words([r["text"] for r in rows])
    v = Vocabulary(w)
    idx, text = windows(w.first, v.ids, len(v))

    def auc(logits):
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, text, logits)
        yes = np.array([r["toxic"] == 1 for r in rows])
        rank = np.empty(len(best))
        rank[np.argsort(best, kind="stable")] = np.arange(1, len(best) + 1)
        return (rank[yes].mean() - (yes.sum() + 1) / 2) / (~yes).sum()

    rough = ToxicNet(7)
    from marketloom.llm.hashing import words_of
    known = docs.join(labels.filter("toxic IS NOT NULL"), "doc_id").filter(~T.held_out(F.col("doc_id"))).orderBy("doc_id").limit(2000).select("text", "toxic").collect()
    kw = words_of([r["text"] for r in known])
    rough.prime(Vocabulary(kw), kw.first, np.array([r["toxic"] for r in known]), np.ones(len(known), bool))
    assert auc(net.window_logits(v, idx)) > auc(rough.first_guess(v, idx))


def test_the_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "train", lambda texts, labels, seed: seen.append((list(texts), labels.tolist())))
    rows = [(1, f"copy {i % 3}") for i in range(3000)] + [(i, "x" * 100 * i) for i in range(4, 20)] + [(3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 20)], "doc_id long, toxic int")
    T.fit(docs, labels)
    assert seen[0][0].count("copy 0") + seen[0][0].count("copy 1") + seen[0][0].count("copy 2") == (zlib.crc32(b"1") % 4 != 2)
    assert len(seen[0][0]) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in (1, *range(4, 20)))
    T.fit(docs, labels, max_bytes=2500)
    assert 0 < sum(map(len, seen[1][0])) <= 2500
    T.fit(docs, labels, per_label=2)
    assert len(seen[2][0]) <= 4


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    other = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, T.toxicity_digest(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_edges(spark):
    labels = spark.createDataFrame(
        [(4, 1, 1), (6, 0, 0), (8, 0, 0), (8, 0, 1), (None, 1, 1), (10, 1, None), (12, 0, 5)], "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    out = T.score_documents(docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count() and set(out.columns) == set(docs.columns)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["score"] == 0 for r in rows if not (r["text"] or "").strip())
    assert T.score_documents(empty_docs(spark), labels).collect() == []
    assert len({r["score"] for r in T.score_documents(docs, labels.limit(0)).collect()}) <= 2
