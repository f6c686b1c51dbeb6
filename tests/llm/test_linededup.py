import random

from helpers import MIDDLE, edge_docs, empty_docs, table

from marketloom.llm import linededup as D


def passage(name, n=70):
    return " ".join(f"{name}{i}" + ("." if i % 9 == 8 else "") for i in range(n)) + "."


def own(i, n=40):
    return " ".join(f"own{i}x{k}" + ("." if k % 8 == 7 else "") for k in range(n)) + "."


def test_passages_go_from_later_documents_only(spark):
    p, q = passage("p"), passage("q")
    rows = [(i, f"{own(i)}\n{own(i + 500)} {p if i % 2 else q} {own(i + 1000)}\n{own(i + 2000)}") for i in range(60)]
    rows += [(100, f"{q}\n{own(9000)}\n{p}"), (101, own(9001))]
    got = {r["doc_id"]: r for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        t = got[i]["text"]
        if i in (0, 1, 101):
            assert t == text
        elif i < 100:
            assert "p1 " not in t and "q1 " not in t and all(own(i + k) in t for k in (0, 500, 1000, 2000))
        else:
            assert t.split() == own(9000).split()
    assert got[2]["removed_words"] == 70 and got[0]["n_removed"] == 0


def test_short_lines_stay(spark):
    rows = [(i, f"Released under the MIT License.\n{own(i)}\nThe end.") for i in range(30)]
    assert {r["doc_id"]: r["text"] for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == dict(rows)


def test_patience_aligns_increasing_equal_lines():
    r = random.Random(3)
    for _ in range(300):
        a = [r.randrange(12) for _ in range(r.randrange(25))]
        b = [r.randrange(12) for _ in range(r.randrange(25))]
        if r.random() < 0.5:
            k = r.randrange(len(a) + 1)
            b = b[:5] + a[k:k + 8] + b[5:]
        pairs = D.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    same = list(range(50))
    assert D.patience(same, same) == [(i, i) for i in same]
    assert D.patience([1, 2, 3, 9, 4, 5], [1, 2, 3, 8, 8, 4, 5]) == [(0, 0), (1, 1), (2, 2), (4, 5), (5, 6)]


def test_nothing_repeated_is_left(spark):
    """After a pass, no later document holds a run of lines of an earlier one of 20 words or more,
    except where lines repeat within a document or cross, which alignment leaves."""
    docs = table(spark, MIDDLE, "documents")
    once = D.dedup_lines(docs.select("doc_id", "text"))
    twice = D.dedup_lines(once.select("doc_id", "text"))
    first, second = (x.selectExpr("sum(removed_words)").first()[0] for x in (once, twice))
    assert first > 0 and second <= 0.02 * first
    assert once.count() == docs.count()


def test_edges(spark):
    docs = edge_docs(spark)
    got = D.dedup_lines(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["text"] is None and by[2][0]["text"] == "" and by[3][0]["n_lines"] == 0
    assert len(by[None]) == 2 and sorted(r["n_removed"] for r in by[None]) == [0, 0]
    assert by[6][0]["n_removed"] == 0
    assert D.dedup_lines(empty_docs(spark)).collect() == []


def test_repeated_and_crossed_blocks_go():
    x, y, z, u, v, *p = range(100, 113)
    twelve = lambda b: [12] * len(b)
    p, q = p[:3], p[3:6]
    b = [u, *p, v]
    assert D.common_blocks([x, *p, y, *p, z], b, twelve(b)) == [(1, 4)]
    b = [x, *p, y, *p, z]
    assert D.common_blocks([u, *p, v], b, twelve(b)) == [(1, 4), (5, 8)]
    b = [u, *q, v, *p, x]
    assert D.common_blocks([*p, y, *q], b, twelve(b)) == [(1, 4), (5, 8)]
    b = [u, p[0], v, p[1]]
    assert D.common_blocks([*p], b, twelve(b)) == []


def test_common_blocks_against_brute_force():
    r = random.Random(5)
    for _ in range(500):
        size = [r.randrange(1, 14) for _ in range(8)]
        a, b = ([r.randrange(8) for _ in range(r.randrange(25))] for _ in range(2))
        runs = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + 1, len(a) + 1)}
        want = set()
        for i in range(len(b)):
            for j in range(i + 1, len(b) + 1):
                if sum(size[x] for x in b[i:j]) >= 20 and tuple(b[i:j]) in runs:
                    want.update(range(i, j))
        got = D.common_blocks(a, b, [size[x] for x in b])
        assert {k for lo, hi in got for k in range(lo, hi)} == want


def test_passages_of_lines_held_elsewhere_go(spark):
    """Every line of the passage stands in an earlier document by itself."""
    lines = [" ".join(f"l{k}x{i}" for i in range(12)) + "." for k in range(5)]
    rows = [(k, f"{own(k)}\n{line}\n{own(k + 50)}") for k, line in enumerate(lines)]
    short = [" ".join(f"s{k}x{i}" for i in range(3)) + "." for k in range(8)]
    rows += [(i, f"{own(i)}\n" + " ".join(lines) + f"\n{own(i + 50)}\n" + "\n".join(short)) for i in (100, 101, 102)]
    got = {r["doc_id"]: r for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["text"] == text for i, text in rows if i <= 100)
    for i in (101, 102):
        assert got[i]["removed_words"] == 60 + 24
        assert got[i]["text"].split() == (own(i) + " " + own(i + 50)).split()


def test_ranges_of_long_and_short_texts():
    """Equal ranges have equal hashes wherever they stand; none reaches into another text."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(7)
    texts = [[r.randrange(1, 6) for _ in range(n)] for n in (0, 3, 9, 70_000, 30)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5), pa.int64()), pa.array(range(5), pa.int64()), pa.array(texts, pa.list_(pa.int64())),
         pa.array([[x * 4 for x in t] for t in texts], pa.list_(pa.int32()))], ["doc_id", "tkey", "lines", "sizes"])
    want = []
    for t in texts:
        some = set()
        for i in range(len(t)):
            for j in range(i + 1, min(len(t), i + 5) + 1):
                n = 4 * sum(t[i:j])
                if n >= 20 and (n - 4 * t[j - 1] < 20 or n - 4 * t[i] < 20):
                    some.add(tuple(t[i:j]))
        want.append(some)
    for part in (batch, batch.slice(1)):
        got = next(D._ranges(20)(iter([part]))).column("ranges").to_pylist()
        assert [len(x) for x in got] == [len(x) for x in want[-len(got):]]
        assert len(set(np.concatenate(got).tolist())) == len(set().union(*want))
