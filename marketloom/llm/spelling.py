"""Spelling variants: words that differ by one letter, found by pivotal bigrams.

Bigrams are ordered by the number of words that hold them, rare ones first. A word's prefix is its
three rarest bigrams with their positions (and whatever ties with the third), its pivots are two
disjoint bigrams of the prefix with the smallest frequencies, chosen by dynamic programming. One
edit destroys at most one of two disjoint pivots, and the other one is in the prefix of the other
word, if that word's prefix reaches at least as far in the order; so pivots of each word are
looked up among the prefixes of the others.

Positions limit the lookup. An edit at or behind the second pivot leaves all up to the end of the
first one, an edit before the second pivot leaves all from its start. The rest, where the edit is,
has two halves, one of which is whole. So the key of a lookup is the length of the other word, the
kept side with the bigram at its edge, and one half of the rest: all of it must be equal. What
meets under a key is verified by the edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.store import stored

MIN_LETTERS = 7
MIN_COUNT = 2
TIMES = 10  # a form is so many times as frequent
NOISE = 31
PREFIX = 3  # bigrams of the prefix: two times one edit, and one

LETTERS = "[A-Za-zÀ-ÿ]"
_LOWER = {c: c + 32 for c in range(65, 91)}
HELD = 400_000  # distinct words that a task counts before it passes them on
LONG_TEXT = 1 << 22


def _lower(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def noisy(doc_id: str, run: str) -> str:
    """The run without one of its letters, if the hash of document and run says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(least: int):
    """Words of the texts of a task with their numbers of occurrences."""
    run_of = re.compile(f"{LETTERS}{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                found = run_of.findall(text) if len(text) <= LONG_TEXT else (m[0] for m in run_of.finditer(text))
                lowered: Counter = Counter()
                for x, n in Counter(found).items():
                    lowered[_lower(x)] += n
                for x, n in lowered.items():
                    word = noisy(doc_id or "", x)
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= HELD:
                    yield batch_of()
                    total.clear()
        yield batch_of()
    return run


def words_of(docs: DataFrame, id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of all texts with at least so many letters and occurrences."""
    rows = docs.select(F.col(id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_count(min_letters), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def bigrams(word: str) -> list[str]:
    return [word[i:i + 2] for i in range(len(word) - 1)]


def _count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            total.update(set(bigrams(word)))
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["gram", "n"])


def gram_order(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram, rare ones first. The alphabet has 90 letters, so 8,100 at most."""
    rows = words.select("word").mapInArrow(_count_bigrams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: i for i, r in enumerate(sorted(rows, key=lambda r: (r["n"], r["gram"])))}


def prefix_of(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, position) of the PREFIX rarest bigrams and of all that tie with the last of them."""
    grams = sorted((order[g], i) for i, g in enumerate(bigrams(word)))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    return [x for x in grams if x[0] <= last]


def pivots_of(prefix: list[tuple[int, int]]) -> tuple[int, int]:
    """Positions of two disjoint bigrams of the prefix whose ranks have the smallest sum.

    Over the bigrams by position: the best single one that ends before this one begins, and the
    best pair so far.
    """
    by_place = sorted((i, rank) for rank, i in prefix)
    best_pair, single, done = None, None, 0
    for i, rank in by_place:
        while by_place[done][0] <= i - 2:
            if single is None or by_place[done][1] < single[0]:
                single = by_place[done][1], by_place[done][0]
            done += 1
        if single is not None and (best_pair is None or single[0] + rank < best_pair[0]):
            best_pair = single[0] + rank, single[1], i
    return best_pair[1], best_pair[2]


def prefix_keys(word: str, prefix: list[tuple[int, int]]) -> Iterator[str]:
    """Keys under which a word is found: by each bigram of its prefix, the side up to it or from it
    on, with the near or the far half of the rest."""
    n = len(word)
    for _, p in prefix:
        h = (n - p - 2) // 2
        yield f"a{n}:{p}:{word[:p + 2 + h]}"
        yield f"b{n}:{p}:{word[:p + 2]}|{word[p + 2 + h:]}"
        h = p // 2
        yield f"c{n}:{p}:{word[h:]}"
        yield f"d{n}:{p}:{word[p:]}|{word[:h]}"


def pivot_keys(word: str, pivots: tuple[int, int]) -> Iterator[str]:
    """Keys under which a word looks for words of n letters that are near it."""
    size, (first, second) = len(word), pivots
    for n in (size - 1, size, size + 1):
        rest = n - first - 2
        if rest >= 0:
            h = rest // 2
            if first + 2 + h <= size:
                yield f"a{n}:{first}:{word[:first + 2 + h]}"
            if rest - h <= size - first - 2:
                yield f"b{n}:{first}:{word[:first + 2]}|{word[size - (rest - h):]}"
        p = n - (size - second)
        if p >= 0:
            h = p // 2
            if n - h <= size:
                yield f"c{n}:{p}:{word[size - (n - h):]}"
            if h <= second:
                yield f"d{n}:{p}:{word[second:]}|{word[:h]}"


def _keys(order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                out: list[list] = [[], [], [], [], []]
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    prefix = prefix_of(word, rank)
                    last = prefix[-1][0]
                    for asks, keys in ((False, set(prefix_keys(word, prefix))), (True, set(pivot_keys(word, pivots_of(prefix))))):
                        for k in keys:
                            for c, v in zip(out, (k, asks, word, n, last), strict=True):
                                c.append(v)
                kinds = (pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["key", "asks", "word", "n", "last"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """left, left_n, right, right_n: pairs of words of a stored table (word, n) that differ by one
    letter, each pair once."""
    order = words.sparkSession.sparkContext.broadcast(gram_order(words))
    keys = words.select("word", "n").mapInArrow(_keys(order), "key string, asks boolean, word string, n long, last int")
    keys = stored(keys.withColumn("key", F.xxhash64("key")), "variant-keys")
    asks = keys.filter("asks").select("key", F.col("word").alias("left"), F.col("n").alias("left_n"), F.col("last").alias("left_last"))
    held = keys.filter("not asks").select("key", F.col("word").alias("right"), F.col("n").alias("right_n"), F.col("last").alias("right_last"))
    # The word whose prefix reaches less far asks; of equal ones the smaller.
    once = F.struct("left_last", "left") < F.struct("right_last", "right")
    found = asks.join(held, "key").filter(once & (F.levenshtein("left", "right", 1) == 1))
    return found.select("left", "left_n", "right", "right_n").distinct()


def forms(pairs: DataFrame) -> DataFrame:
    """word, n_near, form, form_n for every word with a near one."""
    both = pairs.select(F.col("left").alias("word"), F.col("left_n").alias("n"), F.col("right").alias("near"), F.col("right_n").alias("near_n")).unionByName(
        pairs.select(F.col("right").alias("word"), F.col("right_n").alias("n"), F.col("left").alias("near"), F.col("left_n").alias("near_n")))
    best = both.groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    return best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))


def roots(form_of: DataFrame) -> DataFrame:
    """word, root for every row (word, form). Every step is TIMES as frequent, so that a chain has
    at most 19 steps and doubling ends after five rounds."""
    now = form_of.select("word", F.col("form").alias("root"))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variant_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words. Rows that repeat count each; a null id is an empty one in
    the hash. Runs of any length are words, the whole text is read, other columns aren't. Of near
    words that are equally frequent the form is the smallest in code-point order. An empty table
    gives no rows. ``min_letters`` is at least 4, which every word with two disjoint bigrams has.
    """
    if min_letters < 4:
        raise ValueError("words need at least 4 letters for two disjoint bigrams")
    words = stored(words_of(docs, id, text, min_letters, min_count), "words")
    near = stored(forms(near_pairs(words)), "variant-forms")
    root = roots(near.filter("form is not null").select("word", "form"))
    return words.join(near, "word", "left").join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def digest_sql() -> str:
    """DuckDB twin: CRC-32 byte by byte, near words by all deletions of a letter."""
    return f"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
run AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
one AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, x, count(*) AS n FROM run WHERE length(x) >= {MIN_LETTERS} GROUP BY 1, 2),
hashed AS (SELECT x, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(d || ':' || x)), '..'), lambda b: ('0x' || b)::BIGINT),
    lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM one, crc),
noisy AS (SELECT CASE WHEN h % {NOISE} = 0 THEN substr(x, 1, (h % length(x))::BIGINT) || substr(x, (h % length(x))::BIGINT + 2) ELSE x END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words) UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)),
best AS (SELECT near.word, count(*) AS n_near, first(near.other ORDER BY o.n DESC, encode(near.other)) AS other, max(o.n) AS other_n
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
form AS MATERIALIZED (SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {TIMES} * n THEN other END AS form,
  CASE WHEN other_n >= {TIMES} * n THEN other_n END AS form_n FROM words LEFT JOIN best ON words.word = best.word),
chain AS (SELECT word, word AS root, form AS next FROM form UNION ALL
  SELECT chain.word, form.word, form.form FROM chain JOIN form ON form.word = chain.next)
SELECT form.word, form.form, root, n, n_near, form_n FROM form JOIN chain ON chain.word = form.word AND next IS NULL"""
