"""Spelling variants: the filter against all pairs, and rows of all kinds."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import EDGES, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketloom.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, least=7, count=2):
    """The contract, read word by word."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def got(df, **kw):
    rows = spelling.variant_groups(df, **kw).collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_edges(spark):
    rows = [(r[0], r[1]) for r in EDGES]
    assert got(edge_docs(spark)) == plain(rows)
    assert got(empty_docs(spark)) == set()


def test_chains_ties_and_odd_letters(spark):
    words = {"abcdefgh": 2000, "abcdefgi": 200, "abcdefxi": 20, "abcdeyxi": 2, "zbcdefgh": 3, "ÀBCDEFGHIJ": 4, "Àbcdefghij": 3, "×÷×÷×÷×": 30,
             "×÷×÷×÷": 9, "×÷×÷×÷×÷": 2, "mmmmmmmm": 40, "mmmmmmmmm": 400, "mmmmmmm": 3, "nearone": 20, "neartwo": 20, "nearxwo": 2, "neartwe": 20}
    rows = [(None, " ".join([w] * n)) for w, n in words.items()] + [(None, "É" * 3000), (None, "É" * 3001), (None, "É" * 3000), (7, "É" * 3001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = got(df)
    assert out == plain(rows)
    by = {r[0]: r for r in out}
    assert by["abcdefxi"][2] == "abcdefgh" and by["abcdeyxi"][1:3] == ("abcdefxi", "abcdefgh") and by["nearxwo"][1] == "neartwo"


@pytest.mark.parametrize("alphabet, size", [("ab", 9), ("abcdefé", 8), ("aàb", 12)])
def test_all_pairs_of_random_words(spark, alphabet, size):
    rng, words = random.Random(size), set()
    while len(words) < 400:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, size)))
        words.add(w)
        i = rng.randrange(len(w))
        words |= {x for x in (w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1:]) if len(x) >= 7}
    words = sorted(words)
    path = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = {(r["left"], r["right"]) for r in spelling.near_pairs(path).collect()}
    want = {frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1:] if one_edit(a, b)}
    assert {frozenset(p) for p in pairs} == want and len(pairs) == len(want)


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", min_size=4, max_size=12), st.integers(0, 11), st.sampled_from("abcé"), st.sampled_from("idr"), st.randoms())
def test_near_words_share_a_key(word, at, letter, how, rng):
    """Whatever the order of bigrams, of two near words one finds the other."""
    at %= len(word)
    other = {"i": word[:at] + letter + word[at:], "d": word[:at] + word[at + 1:], "r": word[:at] + letter + word[at + 1:]}[how]
    if other == word or len(other) < 4:
        return
    grams = sorted({*spelling.bigrams(word), *spelling.bigrams(other)})
    rng.shuffle(grams)
    order = {g: i for i, g in enumerate(grams)}
    a, b = sorted((word, other), key=lambda w: (spelling.prefix_of(w, order)[-1][0], w))
    asks = set(spelling.pivot_keys(a, spelling.pivots_of(spelling.prefix_of(a, order))))
    assert asks & set(spelling.prefix_keys(b, spelling.prefix_of(b, order)))


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(5)
    for _ in range(500):
        prefix = [(rng.randrange(50), i) for i in rng.sample(range(12), rng.randint(3, 8))]
        a, b = spelling.pivots_of(prefix)
        rank = {i: r for r, i in prefix}
        best = min(x + y for x, i in prefix for y, j in prefix if j >= i + 2)
        assert b >= a + 2 and rank[a] + rank[b] == best


def test_words_have_four_letters_at_least(spark):
    df = spark.createDataFrame([(2, "abcd abcd abce abce")], "doc_id long, text string")
    assert {r[0] for r in got(df, min_letters=4)} >= {"abcd"}
    with pytest.raises(ValueError):
        spelling.variant_groups(df, min_letters=3)


def test_keys_are_few(spark):
    """The lookup is selective: far fewer meetings than pairs of words."""
    words = spark.createDataFrame([(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}rd{chr(97 + i // 676)}s{i % 7 * 'x'}", 2) for i in range(3000)], "word string, n long")
    order = spelling.gram_order(words)
    assert len(order) <= 8100
    rows = words.mapInArrow(spelling._keys(spark.sparkContext.broadcast(order)), "key string, asks boolean, word string, n long, last int")
    per = rows.groupBy("key").agg(F.count_if("asks").alias("a"), F.count_if(~F.col("asks")).alias("b"))
    assert per.agg(F.sum(F.col("a") * F.col("b"))).first()[0] < 3000 * 2999 / 10
