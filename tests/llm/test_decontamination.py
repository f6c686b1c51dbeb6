import re
from collections import Counter

from helpers import MIDDLE, edge_docs, empty_docs, table

from marketloom.llm import decontamination as D


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(w):
    return Counter([tuple(w)]) if 0 < len(w) < 5 else Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def places(docs, items):
    """Every place of every document against every item that shares a shingle with it."""
    out = {}
    for i in items:
        iw = plain(i["text"])
        if not iw:
            continue
        g = grams(iw)
        for d in docs:
            dw = plain(d["text"])
            if not (g & (grams(dw) if len(iw) >= 5 else Counter(tuple(dw[k:k + len(iw)]) for k in range(len(dw))))):
                continue
            best = max((D.weighted_similarity(grams(dw[k:k + len(iw)]), g), -k) for k in range(len(dw)))
            if best[0] >= 0.75:
                out[d["doc_id"], i["item_id"]] = best[0]
    return out


def found(df):
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in df.collect()}


def test_against_brute_force(spark):
    docs, items = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "benchmark")
    got, want = found(D.contaminated(docs, items)), places(docs.collect(), items.collect())
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want if want[k] == 1)


def test_changed_words_are_found_where_a_run_is_left(spark):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(30 + 5 * i))) for i in range(20)]
    docs = []
    for i, text in items:
        w = text.split()
        w[len(w) // 4] = "changed"
        docs.append((i, " ".join([*(f"p{i}x{k}" for k in range(37 + i)), *w, *(f"q{i}x{k}" for k in range(91))])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got, want = found(D.contaminated(d, b)), places(d.collect(), b.collect())
    assert set(got) == set(want) and len(want) >= 15


def test_edges(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "two words"), (4, "word"), (None, "another text under the same id"), (3, "two words")],
        "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()}
    assert got == {(10, 3), (8, 4), (9, 4), (5, None)}
    assert D.contaminated(empty_docs(spark), items).collect() == []
    assert D.contaminated(docs, items.limit(0)).collect() == []


def test_blocks_guarantee_the_radius():
    import numpy as np

    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, (500, 2), dtype=np.uint64)
    b = a.copy()
    for row in b:
        for bit in r.choice(126, D.BLOCKS - D.AGREE, replace=False):
            row[bit // 63] ^= np.uint64(1) << np.uint64(1 + bit % 63)
    assert ((D.block_values(a) == D.block_values(b)).sum(1) >= D.AGREE).all()


def test_fingerprints_are_majorities():
    import numpy as np

    h = np.random.default_rng(2).integers(0, 1 << 63, 700, dtype=np.uint64)
    bits = D.feature_bits(h, 9)
    for length in (2, 9, 27, 300, 600):
        at = np.arange(0, 700 - length, 7)
        got = D.fingerprints(D.run_sums(bits, length), at, length)
        want = [bits[i:i + length - 1].sum(0, dtype=int) > (length - 1) // 2 for i in at]
        assert (np.unpackbits(got.astype(">u8").view(np.uint8), axis=1) == np.array(want)).all()


def test_changes_at_every_place_are_found(spark):
    """One word changed, at every place of items of 40, 46 and 60 words, and two at pairs of places."""
    items, docs = [], []
    for i, n in enumerate((40, 46, 60, 75)):
        text = [f"i{i}w{k}" for k in range(n)]
        items.append((i, " ".join(text)))
        for x, y in [(x, x) for x in range(n)] + [(x, y) for x in range(0, n, 3) for y in range(x + 1, n, 4) if n > 50]:
            w = list(text)
            w[x] = w[y] = f"c{x}x{y}"
            docs.append((len(docs), " ".join([*(f"p{k}" for k in range(len(docs) % 9)), *w, *(f"q{k}" for k in range(11))])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got, want = found(D.contaminated(d, b)), places(docs=d.collect(), items=b.collect())
    assert set(got) == set(want) and len(want) > 500
    middle = [x for x in want if x[0] in (18, 19, 20, 21)]
    assert len(middle) == 4


def test_windows_meet_what_verification_accepts():
    """Unchanged runs against every way to change, leave out or add up to three words."""
    from itertools import combinations

    for n in (1, 4, 5, 9, 12, 20, 33, 40, 61, 64):
        item = [f"w{k}" for k in range(n)]
        assert D.window_length(n) <= D.unchanged_run(n) <= n
        for k in (1, 2, 3) if n < 62 else (2,):
            for at in combinations(range(0, n, 1 if n < 34 or k == 1 else 3), k):
                changed = [f"c{i}" if i in at else w for i, w in enumerate(item)]
                fewer = [w for i, w in enumerate(item) if i not in at] + [f"c{i}" for i in at]
                more = [w for i, x in enumerate(item) for w in ([f"c{i}", x] if i in at else [x])][:n]
                for text in (changed, fewer, more):
                    if D.weighted_similarity(grams(text), grams(item)) >= D.MIN_SIMILARITY:
                        run = best = 0
                        for i, w in enumerate(text):
                            run = run + 1 if i and w[0] == "w" and text[i - 1][0] == "w" and int(w[1:]) == int(text[i - 1][1:]) + 1 else int(w[0] == "w")
                            best = max(best, run)
                        assert best >= D.unchanged_run(n)


def test_long_items(spark):
    """Items of 6,000 to 100,000 words, in documents that hold them whole, changed here and there, or in part."""
    def text(n, tag):
        return [f"{tag}{k * k % 100_003}x{k}" for k in range(n)]

    items = [(1, text(6000, "a")), (2, text(10_000, "b")), (3, text(100_000, "c")), (4, ["one", "two"] * 3000)]
    changed = [f"new{k}" if k % 400 == 7 else w for k, w in enumerate(items[2][1])]
    docs = [(1, ["before"] * 50 + items[0][1] + ["after"] * 9), (2, items[1][1]), (3, ["x"] + changed), (4, items[2][1][:30_000]),
            (5, ["y"] * 7 + ["one", "two"] * 3000), (6, text(20_000, "d")), (7, items[1][1][:9000] + ["z"] * 3)]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["start_word"], r["similarity"]) for r in D.contaminated(d, b).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (5, 4), (7, 2)}
    assert got[1, 1] == (50, 1.0) and got[2, 2] == (0, 1.0) and got[5, 4][1] == 1.0 and 0.75 < got[3, 3][1] < 1


def test_recall_over_random_changes(spark):
    """Passages with random changes, of items with and without repeated runs, against every place: what
    is similar enough is found, all of it."""
    import random

    rng, items, docs = random.Random(11), [], []
    for i in range(24):
        n = rng.randint(12, 90)
        words = [f"i{i}w{k}" for k in range(n)]
        if i % 3 == 0:  # a repeated run of four to eight words
            size = rng.randint(4, 8)
            a = rng.randrange(max(1, n - size))
            words += words[a:a + size]
        if i % 6 == 1:
            words = [f"i{i}r{rng.randrange(4)}" for _ in range(n)]
        items.append((i, " ".join(words)))
        for _ in range(25):
            w = list(words)
            for _ in range(rng.randint(0, 1 + n // 25)):
                at = rng.randrange(len(w))
                how = rng.randrange(3)
                w[at:at + 1] = [["changed"], [], ["added", w[at]]][how]
            docs.append((len(docs), " ".join([*(f"p{k}" for k in range(rng.randrange(40))), *w, *(f"q{k}" for k in range(rng.randrange(30)))])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got, want = found(D.contaminated(d, b)), places(d.collect(), b.collect())
    assert set(got) <= set(want) and len(want) > 300
    assert set(want) - set(got) == set()


def test_best_place_is_that_of_all_places():
    import random

    import numpy as np

    rng = random.Random(4)
    for _ in range(300):
        item = np.array([rng.randrange(6) for _ in range(rng.randint(1, 14))], np.uint64)
        words = np.array([rng.randrange(6) for _ in range(rng.randint(len(item), 30))], np.uint64)
        g = grams(item.tolist())
        size = min(5, len(item))
        part = lambda k: Counter(tuple(words[k + i:k + i + size].tolist()) for i in range(min(len(item), len(words) - k) - size + 1))
        ends = rng.random() < 0.5
        want = max((D.weighted_similarity(part(k), g), -k) for k in range(len(words) - (size if ends else len(item)) + 1))
        got = D.best_place(words, item, D.Counter(D._shingle_list(item, size)), ends)
        assert got == (want[0], -want[1])


def test_items_that_repeat_themselves():
    import numpy as np

    h = np.arange(1, 30, dtype=np.uint64)
    assert not D.repeats_itself(h) and D.repeats_itself(np.concatenate([h, h[3:7]])) and not D.repeats_itself(np.concatenate([h, h[3:6]]))
    assert D.window_length(60, True) == D.SHINGLE and D.window_length(3, True) == 3
