"""Ranked lexical search: MaxScore over an index that stores joint maxima of term pairs.

The index is dealt by documents. A shard holds some megabytes of text: the postings of its terms,
the largest impact of each term, block maxima of the long lists (blocks of BLOCK documents), and
for every pair of the PAIR_TERMS most frequent terms of the corpus their intersection list: the
blocks where one document holds both, with the largest joint impact of such a document.

A search is carried out in every shard against all queries of a batch. A term alone is bounded by
its own maximum; two terms together by the larger of the two maxima and their joint maximum, which
is less than the sum of the two where no document is rich in both. Disjoint pairs are chosen per
query by what they save. Shards, then blocks and single documents, whose combined bound is below
the lowest score that is still among the best are skipped; rare terms are scored first, the long
lists only for the documents that are left. A few shards are searched beforehand, so that all
others begin with a threshold. Scores are exact integers, and nothing is left out that could rank.

Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.hashing import NOT_ALNUM, Hasher, chunks
from marketloom.llm.store import stored

TOP = 50
SHARD_CHARS = 2 << 20
SHARD_DOCS = 1 << 15
BLOCK = 128
LONG_LIST = 16  # shorter lists have no block maxima: they are scored first
PAIR_TERMS = 64
PRIMING_SHARDS = 16
BATCH_CHARS = 8 << 20  # characters of the queries that are searched at once
#: Fixed values of the score: how much of a document's length counts, in percent.
LENGTH_PERCENT = 50
SCALE = 1_000_000_000

INDEX = ("shard long, docs long, n_terms long, ids binary, nulls binary, lengths binary, terms binary, starts binary, at binary, tf binary, "
         "top binary, long_terms binary, long_top binary, pairs binary, pair_starts binary, pair_blocks binary, pair_top binary")


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, their terms with repeats, and the frequent terms with their weights."""

    documents: int
    terms: int
    frequent: np.ndarray  # sorted hashes
    weights: np.ndarray


def weight(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * np.asarray(df, np.float64) + 1))).astype(np.int64)


def length_norm(n: np.ndarray, corpus: Corpus) -> np.ndarray:
    return 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n.astype(np.int64) * corpus.documents) // max(1, corpus.terms)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (SCALE * tf) // (1000 * tf + 20 * m)


def _shard_ranges(texts: list) -> Iterator[tuple[int, int]]:
    for lo, hi in chunks(texts, SHARD_CHARS):
        for at in range(lo, hi, SHARD_DOCS):
            yield at, min(hi, at + SHARD_DOCS)


def _postings(hasher: Hasher, texts: list):
    """Per (term, document), sorted: term, document, occurrences; and the number of terms of each document."""
    w = hasher.words(texts)
    doc = np.repeat(np.arange(len(w.first) - 1, dtype=np.int64), w.counts)
    order = np.lexsort((doc, w.hashes))
    term, doc = w.hashes[order], doc[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return term[begin], doc[begin], np.diff(np.append(begin, len(term))), w.counts


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, df within a shard; under a null term the documents and the terms with repeats."""
    hasher = Hasher(NOT_ALNUM)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for lo, hi in _shard_ranges(texts):
            term, _, _, n = _postings(hasher, texts[lo:hi])
            starts = _starts(term)
            yield pa.RecordBatch.from_arrays([
                pa.array(term[starts[:-1]].view(np.int64)), pa.array(np.diff(starts)), pa.array(np.zeros(len(starts) - 1, np.int64))], ["term", "df", "total"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64())],
                                             ["term", "df", "total"])


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, so that the zeros of small ones lie together."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def _block_maxima(owner: np.ndarray, block: np.ndarray, value: np.ndarray, n: int, blocks: int) -> np.ndarray:
    out = np.zeros((n, blocks), np.int64)
    np.maximum.at(out, (owner, block), value)
    return out


def _pair_lists(corpus: Corpus, terms, starts, at, f, docs: int, blocks: int):
    """For pairs of frequent terms: number of the pair, bounds, blocks, largest joint impacts."""
    here = np.searchsorted(terms, corpus.frequent)
    there = (here < len(terms)) & (terms[np.minimum(here, max(0, len(terms) - 1))] == corpus.frequent) if len(terms) else np.zeros(len(corpus.frequent), bool)
    known = np.flatnonzero(there)
    dense = np.zeros((len(known), blocks * BLOCK), np.int64)
    for row, k in enumerate(known):
        a, b = starts[here[k]], starts[here[k] + 1]
        dense[row, at[a:b]] = corpus.weights[k] * f[a:b]
    pairs, bounds, where, joint = [], [0], [], []
    for i in range(len(known)):
        both = np.where((dense[i] > 0) & (dense[i + 1:] > 0), dense[i] + dense[i + 1:], 0).reshape(-1, blocks, BLOCK).max(axis=2, initial=0)
        for j in range(len(both)):
            block = np.flatnonzero(both[j])
            pairs.append(known[i] * PAIR_TERMS + known[i + 1 + j])
            where.append(block)
            joint.append(both[j][block])
            bounds.append(bounds[-1] + len(block))
    empty = np.zeros(0, np.int64)
    return np.array(pairs, np.int64), np.array(bounds), np.concatenate([empty, *where]), np.concatenate([empty, *joint])


def _index(corpus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known, shard = Hasher(NOT_ALNUM), corpus.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in _shard_ranges(texts):
                shard += 1
                yield _shard_row(hasher, known, shard, ids.slice(lo, hi - lo), texts[lo:hi])
    return run


def _shard_row(hasher, corpus: Corpus, shard: int, ids: pa.Array, texts: list) -> pa.RecordBatch:
    term, at, tf, n = _postings(hasher, texts)
    starts = _starts(term)
    terms, docs = term[starts[:-1]], len(n)
    blocks = max(1, -(-docs // BLOCK))
    f = impact(tf, length_norm(n, corpus)[at])
    top = np.maximum.reduceat(f, starts[:-1]) if len(f) else f
    long = np.flatnonzero(np.diff(starts) >= LONG_LIST)
    number = np.full(len(terms), -1)
    number[long] = np.arange(len(long))
    owner = np.repeat(number, np.diff(starts))
    some = owner >= 0
    long_top = _block_maxima(owner[some], at[some] // BLOCK, f[some], len(long), blocks)
    pairs, bounds, where, joint = _pair_lists(corpus, terms, starts, at, f, docs, blocks)
    begins = np.zeros(len(at), bool)  # documents are stored as steps, anew for every term
    begins[starts[:-1]] = True
    values = {"shard": shard, "docs": int((n > 0).sum()), "n_terms": int(n.sum()), "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes(),
              "nulls": np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(), "lengths": planes(n), "terms": terms.tobytes(),
              "starts": planes(np.diff(starts)), "at": planes(np.where(begins, at, np.diff(at, prepend=0))),
              "tf": planes(tf), "top": planes(top), "long_terms": planes(long), "long_top": planes(long_top.reshape(-1)), "pairs": planes(pairs),
              "pair_starts": planes(bounds), "pair_blocks": planes(where), "pair_top": planes(-(-joint >> 12))}  # rounded up: still bounds
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([values[c]], kinds[k]) for c, k in (x.split() for x in INDEX.split(", "))], [x.split()[0] for x in INDEX.split(", ")])


@dataclass
class Index:
    """Stored shards and document frequencies, and what is known of the corpus."""

    shards: DataFrame
    df: DataFrame
    corpus: Corpus


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text", pair_terms: int = PAIR_TERMS) -> Index:
    """Indexes every row of the table; texts are read twice and never shuffled."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = rows.select("text").mapInArrow(_term_counts, "term long, df long, total long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    counts = stored(counts, "document-frequencies")
    whole = counts.filter("term is null").first()
    n, total = (whole["df"], whole["total"]) if whole else (0, 0)
    df = counts.filter("term is not null").select("term", "df")
    frequent = sorted((r["term"] % (1 << 64), r["df"]) for r in df.orderBy(F.desc("df"), "term").limit(min(pair_terms, PAIR_TERMS)).collect())
    corpus = Corpus(n, total, np.array([t for t, _ in frequent], np.uint64), weight(n, [d for _, d in frequent]))
    known = docs.sparkSession.sparkContext.broadcast(corpus)
    return Index(stored(rows.mapInArrow(_index(known), INDEX), "search-index"), df, corpus)


# --- search -------------------------------------------------------------------------------------

class Shard:
    """Arrays of one stored shard."""

    def __init__(self, row: dict, corpus: Corpus):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.null = np.unpackbits(np.frombuffer(row["nulls"], np.uint8))[:len(self.ids)].astype(bool)
        self.norm = length_norm(unplaned(row["lengths"]), corpus)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(unplaned(row["starts"]))])
        self._at, self._tf = row["at"], row["tf"]
        self.top = unplaned(row["top"])
        self.blocks = max(1, -(-len(self.ids) // BLOCK))
        self.block_of = np.arange(len(self.ids)) // BLOCK
        self.long = unplaned(row["long_terms"])
        self.long_top = unplaned(row["long_top"]).reshape(len(self.long), self.blocks)
        self.pairs = {int(p): i for i, p in enumerate(unplaned(row["pairs"]))}
        self.pair_starts, self.pair_blocks = unplaned(row["pair_starts"]), unplaned(row["pair_blocks"])
        self.pair_top = unplaned(row["pair_top"]) << 12
        self.frequent = {int(t): k for k, t in enumerate(corpus.frequent)}
        self._lists: dict[int, tuple] = {}
        self.scored = 0

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a term, by its number; decoded once per shard."""
        if t not in self._lists:
            a, b = int(self.starts[t]), int(self.starts[t + 1])
            at = np.cumsum(self._slice(self._at, a, b))
            self._lists[t] = at, impact(self._slice(self._tf, a, b), self.norm[at])
        return self._lists[t]

    def _slice(self, raw: bytes, a: int, b: int) -> np.ndarray:
        part = np.frombuffer(raw, np.uint8).reshape(4, -1)[:, a:b]
        return np.ascontiguousarray(part.T).view("<u4").reshape(-1).astype(np.int64)

    def joint(self, a: int, b: int) -> np.ndarray | None:
        """Largest joint impacts by block of two frequent terms, by their numbers among those."""
        i = self.pairs.get(min(a, b) * PAIR_TERMS + max(a, b))
        if i is None:
            return None
        out = np.zeros(self.blocks, np.int64)
        lo, hi = self.pair_starts[i], self.pair_starts[i + 1]
        out[self.pair_blocks[lo:hi]] = self.pair_top[lo:hi]
        return out

    def bounds(self, terms: list[int], weights: dict[int, int], pairs: bool = True) -> tuple[list[int], np.ndarray]:
        """Long lists by falling bounds, and for each place the bound by block of all from there on.

        Disjoint pairs are chosen by what they save. A pair counts by its joint bound as long as both
        of its terms are to come, then the other one counts alone.
        """
        bound = {t: weights[t] * self.long_top[np.searchsorted(self.long, t)] for t in terms}
        order = sorted(terms, key=lambda t: (-int(bound[t].max(initial=0)), t))
        partner: dict[int, tuple[int, np.ndarray]] = {}
        if pairs:
            for _, a, b, together in sorted(self._gains(order, bound), key=lambda g: (-g[0], g[1], g[2])):
                if a not in partner and b not in partner:
                    partner[a], partner[b] = (b, together), (a, together)
        rest = np.zeros((len(order) + 1, self.blocks), np.int64)
        later: set[int] = set()
        for i in range(len(order) - 1, -1, -1):
            other, together = partner.get(order[i], (None, None))
            rest[i] = rest[i + 1] + (together - bound[other] if other in later else bound[order[i]])
            later.add(order[i])
        return order, rest

    def _gains(self, terms: list[int], bound: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """Pairs of frequent terms whose joint bound is less than the sum of their own, and what they save."""
        number = {t: k for t in terms if (k := self.frequent.get(int(self.terms[t]))) is not None}
        known = list(number)
        for i, a in enumerate(known):
            for b in known[i + 1:]:
                joint = self.joint(number[a], number[b])
                if joint is not None:
                    alone = bound[a] + bound[b]
                    together = np.minimum(alone, np.maximum(np.maximum(bound[a], bound[b]), joint))
                    if gain := int((alone - together).sum()):
                        yield gain, a, b, together

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int, pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Documents whose score is ``least`` or more, and their exact scores. ``terms`` are numbers
        in this shard."""
        weight_of = dict(zip(terms.tolist(), weights.tolist(), strict=True))
        lengths = self.starts[terms + 1] - self.starts[terms]
        score = np.zeros(len(self.ids), np.int64)
        for t in terms[lengths < LONG_LIST].tolist():
            at, f = self.postings(t)
            score[at] += weight_of[t] * f
            self.scored += len(at)
        order, rest = self.bounds(terms[lengths >= LONG_LIST].tolist(), weight_of, pairs)
        alive = np.flatnonzero(score + rest[0][self.block_of] >= least)
        for i, t in enumerate(order):
            if not len(alive):
                break
            at, f = self.postings(t)
            place = np.minimum(np.searchsorted(at, alive), len(at) - 1)
            hit = at[place] == alive
            score[alive[hit]] += weight_of[t] * f[place[hit]]
            self.scored += int(hit.sum())
            alive = alive[score[alive] + rest[i + 1][self.block_of[alive]] >= least]
        return alive, score[alive]


@dataclass(frozen=True)
class Queries:
    """Terms of a batch of queries: those of query q are terms[first[q]:first[q + 1]]."""

    numbers: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    first: np.ndarray
    least: np.ndarray  # lowest score that can still be among the best

    def __len__(self) -> int:
        return len(self.numbers)


def best_of(ids: np.ndarray, null: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Places of the best: by falling score, rising id, null ids last."""
    return np.lexsort((ids, null, -score))[:top]


def _search(queries, corpus, top: int, pairs: bool):
    """The best documents of a task's shards for every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = queries.value
        found: list = [None] * len(q)
        least = np.maximum(q.least, 1)
        for batch in batches:
            for i in range(batch.num_rows):
                _search_shard(Shard(batch.slice(i, 1).to_pylist()[0], corpus.value), q, found, least, top, pairs)
        for k in range(len(q)):
            if found[k] is not None:
                ids, null, score = found[k]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), q.numbers[k])), pa.array(ids, mask=null), pa.array(score)], ["query", "doc_id", "score"])
    return run


def _search_shard(shard: Shard, q: Queries, found: list, least: np.ndarray, top: int, pairs: bool) -> None:
    if not len(shard.terms) or not len(q.terms):
        return
    place = np.minimum(np.searchsorted(shard.terms, q.terms), len(shard.terms) - 1)
    there = shard.terms[place] == q.terms
    most = np.where(there, q.weights * shard.top[place], 0)
    bound = np.concatenate([[0], np.cumsum(most)])
    for k in np.flatnonzero(bound[q.first[1:]] - bound[q.first[:-1]] >= least):
        here = slice(q.first[k], q.first[k + 1])
        at, score = shard.search(place[here][there[here]], q.weights[here][there[here]], int(least[k]), pairs)
        if not len(at):
            continue
        new = shard.ids[at], shard.null[at], score
        if found[k] is not None:
            new = tuple(np.concatenate(x) for x in zip(found[k], new, strict=True))
        if len(new[0]) >= top:
            order = best_of(*new, top)
            new = tuple(x[order] for x in new)
            least[k] = max(least[k], new[2][-1])
        found[k] = new


def _batches_of(items: DataFrame, id: str, text: str) -> tuple[DataFrame, int]:
    """Queries with a number of their own, dealt to batches of about BATCH_CHARS characters."""
    rows = items.select(F.col(id).cast("long").alias("item_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    batches = max(1, -(-chars // BATCH_CHARS))
    number = F.monotonically_increasing_id()
    rows = stored(rows.withColumn("query", number), "search-queries")
    return rows.withColumn("batch", F.pmod(F.xxhash64("query"), F.lit(batches))), batches


def _queries(rows: pa.Table, index: Index) -> Queries:
    """Terms of a batch of queries, once each, with their weights; terms of no document are left out."""
    w = Hasher(NOT_ALNUM).words(rows.column("text").to_pylist())
    owner = np.repeat(np.arange(len(rows)), w.counts)
    pair = np.unique(np.stack([owner.astype(np.uint64), w.hashes], axis=1), axis=0) if len(owner) else np.zeros((0, 2), np.uint64)
    spark = index.df.sparkSession
    wanted = spark.createDataFrame(pa.table({"term": pa.array(np.unique(pair[:, 1]).view(np.int64))}))
    known = index.df.join(F.broadcast(wanted), "term").toArrow()  # no more rows than terms of the batch
    terms, df = known.column("term").to_numpy().view(np.uint64), known.column("df").to_numpy()
    order = np.argsort(terms)
    terms, weights = terms[order], weight(index.corpus.documents, df[order])
    at = np.minimum(np.searchsorted(terms, pair[:, 1]), max(0, len(terms) - 1))
    there = terms[at] == pair[:, 1] if len(terms) else np.zeros(len(pair), bool)
    owner = pair[there, 0].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))])
    return Queries(rows.column("query").to_numpy(), pair[there, 1], weights[at[there]] if len(terms) else np.zeros(0, np.int64), first, np.zeros(len(rows), np.int64))


def _run(index: Index, shards: DataFrame, queries: Queries, top: int, pairs: bool) -> DataFrame:
    sc = shards.sparkSession.sparkContext
    return shards.mapInArrow(_search(sc.broadcast(queries), sc.broadcast(index.corpus), top, pairs), "query long, doc_id long, score long")


def _ranked(rows: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy("query", *by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(index: Index, items: DataFrame, id: str = "item_id", text: str = "text", top: int = TOP, pairs: bool = True) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of every query, by falling score and rising
    id. Queries are handled in batches of bounded size, each against all shards."""
    rows, batches = _batches_of(items, id, text)
    n = index.shards.count()
    sample = index.shards.filter(F.pmod(F.xxhash64("shard"), F.lit(max(1, n // PRIMING_SHARDS))) == 0)
    out = None
    for batch in range(batches):
        queries = _queries(rows.filter(F.col("batch") == batch).select("query", "text").toArrow(), index)
        if not len(queries.terms):
            continue
        if n > 2 * PRIMING_SHARDS:
            # The worst of the best in some shards: whatever is less can't be among the best of all.
            first = _ranked(_run(index, sample, queries, top, pairs), top).filter(F.col("rank") == top).select("query", "score").toArrow()
            worst = dict(zip(first.column(0).to_pylist(), first.column(1).to_pylist(), strict=True))
            queries = Queries(queries.numbers, queries.terms, queries.weights, queries.first, np.array([worst.get(x, 0) for x in queries.numbers.tolist()], np.int64))
        best = stored(_run(index, index.shards, queries, top, pairs), "search-best")
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = rows.select("query", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    # Tasks are merged in two steps, so that no task gets the lists of all tasks for a query.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(32))
    merged = _ranked(_ranked(out.withColumn("part", part), top, "part").drop("rank"), top)
    return merged.join(rows.select("query", "item_id"), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item and rank: item_id, rank, doc_id, score.

    Null and empty texts have no terms: such documents are in no result, such items have none.
    Rows that repeat are documents and items of their own; a null doc_id comes after all others of
    the same score. Very long texts are shards of their own. Other columns are not read; without
    documents or items there are no rows.
    """
    return search(build_index(docs), items)


def digest_sql(top: int = TOP) -> str:
    """DuckDB twin: every document that shares a term is scored."""
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all({lower.format('text')}, '{word}')) AS term FROM documents),
tf AS MATERIALIZED (SELECT doc_id, term, count(*)::BIGINT AS tf FROM tok GROUP BY 1, 2),
doc AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM doc),
query AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all({lower.format('text')}, '{word}')) AS term FROM benchmark),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf WHERE term IN (SELECT term FROM query) GROUP BY 1),
weight AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, total),
norm AS MATERIALIZED (SELECT doc_id, {100 - LENGTH_PERCENT} + (({LENGTH_PERCENT} * n * docs) // terms) AS m FROM doc, total),
part AS MATERIALIZED (SELECT tf.doc_id, tf.term, w * (({SCALE} * tf) // (1000 * tf + 20 * m)) AS x FROM tf JOIN weight ON weight.term = tf.term JOIN norm ON norm.doc_id = tf.doc_id),
score AS (SELECT item_id, doc_id, sum(x)::BIGINT AS score FROM query JOIN part ON part.term = query.term GROUP BY 1, 2)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM score WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {top}"""
