"""Stupid-backoff language-model scores of documents against the rest of the corpus.

A word pair scores count(pair) / count(first word) if the pair occurs outside the document, else
0.4 * count(second word) / words; a word unknown elsewhere scores 0.4 * 0.4 / words. All counts
leave the scored document out, otherwise every pair would be known by itself.

Counts are kept by hash, none is bounded by a table. The distinct words and the distinct pairs of a
chunk of documents, counted within it, are dealt to buckets, as packed arrays, one row per chunk and
bucket. A bucket adds its rows up and sends totals back: to the chunk the totals of its words, and
the places and totals of those pairs that occur in other chunks too. Where the rows of a chunk meet
again, its documents are scored. So a word or a pair is in a bucket once per chunk, however frequent
it is; a bucket has a fixed number of entries, and is added up in narrow arrays. Pairs that make up a
large share of all (at most 8192 can) are counted beforehand and looked up where the text is read.
Words are compared by 64 bits of their hash at most, by 48 behind the bits of their bucket at least.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.hashing import Hasher, Words, chunks, mix
from marketloom.llm.neardup import runs
from marketloom.llm.store import stored

ALPHA = 0.4
FREQUENT = 4096  # a pair is frequent from this share of all pairs on: 1 / FREQUENT
BUCKET_PAIRS = 1 << 20
CHUNK = 4 << 20
SPREAD = 1_000_003  # rows of chunks are dealt by their number modulo this


def pairs_of(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first word and hash of every pair of neighbours in a text."""
    doc = np.repeat(np.arange(len(w.first) - 1), w.counts)
    at = np.flatnonzero(doc[1:] == doc[:-1])
    return at, mix(w.hashes[at] * np.uint64(0x9E3779B97F4A7C15) + w.hashes[at + 1])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of this task: all words (kind 0), and pairs that may be frequent (kind 1): a pair
    frequent in the corpus has half that share in chunks that hold half its places."""
    hasher, total, often = Hasher(), 0, {}
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for lo, hi in chunks(texts, CHUNK):
            w = hasher.words(texts[lo:hi])
            total += len(w.hashes)
            _, h = pairs_of(w)
            value, n = np.unique(h, return_counts=True)
            big = n * 2 * FREQUENT >= len(h)
            for x, c in zip(value[big].view(np.int64).tolist(), n[big].tolist(), strict=True):
                often[x] = often.get(x, 0) + c
    yield pa.RecordBatch.from_arrays([
        pa.array([0] + [1] * len(often), pa.int32()), pa.array([0, *often], pa.int64()),
        pa.array([total, *often.values()], pa.int64())], ["kind", "key", "n"])


def _count_known(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, keys = Hasher(), np.frombuffer(wanted.value, np.uint64)
        total = np.zeros(len(keys) + 1, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in chunks(texts, CHUNK):
                _, h = pairs_of(hasher.words(texts[lo:hi]))
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                total += np.bincount(np.where(keys[at] == h, at, len(keys)), minlength=len(keys) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(total[:-1])], ["key", "n"])
    return run


def _planes(x: np.ndarray, n: int) -> bytes:
    """The n low bytes of numbers, plane by plane, compressed where that is shorter."""
    raw = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()
    packed = len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)
    return b"\1" + packed if len(packed) < len(raw) else b"\0" + raw


def _unplaned(raw: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(raw[9:], int.from_bytes(raw[1:9], "little"), codec="zstd", asbytes=True) if raw[0] else raw[1:]
    rows = np.frombuffer(raw, np.uint8).reshape(n, -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, :n] = rows.T
    return out.view("<u8").reshape(-1).astype(np.uint64)


#: A chunk's own row (bucket < 0) has ids, nulls, words and order; rows of pairs have places, those of words don't.
ROWS = "bucket int, chunk long, ids binary, nulls binary, words binary, order binary, keys binary, counts binary, places binary, totals binary"
CHUNK_ROWS = "bucket int, chunk long, ids binary, nulls binary, words binary, order binary, counts binary, places binary, totals binary"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in rows], kinds[k]) for n, k in (x.split() for x in schema.split(", "))], _names(schema))


def _deal(known, bits: int):
    """Per chunk: a row of its own with the order of its words and the totals of the frequent pairs found,
    and for every bucket its distinct words and its distinct pairs, counted within the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        keys, totals = (np.frombuffer(x, t) for x, t in zip(known.value, (np.uint64, np.int64), strict=True))
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in chunks(texts, CHUNK):
                chunk += 1
                yield _batch(_chunk_rows(hasher, keys, totals, bits, chunk, texts[lo:hi], batch.column("doc_id").slice(lo, hi - lo)), ROWS)
    return run


def _chunk_rows(hasher, keys, totals, bits, chunk, texts, ids) -> list[dict]:
    w = hasher.words(texts)
    n = w.counts
    word, back, count = np.unique(w.hashes, return_inverse=True, return_counts=True)
    # Frequent words have small numbers, which pack well.
    rank = np.empty(len(word), np.int64)
    rank[_by_count(count)] = np.arange(len(word))
    at, h = pairs_of(w)
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    begin = np.flatnonzero(new)
    k = np.diff(np.append(begin, len(h)))
    h, at = h[begin], at[begin]  # a pair is named by the place of its first word where it stands first
    sure_at, sure = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys) and len(h):
        where = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        is_known = keys[where] == h
        sure_at, sure = at[is_known], totals[where[is_known]]
        h, at, k = (x[~is_known] for x in (h, at, k))
    rows = [{
        "bucket": -1 - chunk % SPREAD, "chunk": chunk, "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes(),
        "nulls": np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(), "words": n.astype(np.int64).tobytes(),
        "order": _planes(rank[back], 4), "keys": _planes(count, 4), "places": _planes(sure_at, 4), "totals": _planes(sure, 8)}]
    for x, y, bucket in _bucket_ranges(word, bits):
        rows.append({"bucket": (1 << bits) + bucket, "chunk": chunk, "keys": _tails(word[x:y], bits), "counts": _planes(count[x:y], 4)})
    for x, y, bucket in _bucket_ranges(h, bits):
        rows.append({"bucket": bucket, "chunk": chunk, "keys": _tails(h[x:y], bits), "counts": _planes(k[x:y], 4),
                     "places": _planes(at[x:y], 4)})
    return rows


def _by_count(count: np.ndarray) -> np.ndarray:
    return np.argsort(-count, kind="stable")


def _bucket_ranges(h: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of sorted hashes with the same first bits, and these bits."""
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for x, y in zip([0, *cut], [*cut, len(h)], strict=True):
        if x < y:
            yield int(x), int(y), int(bucket[x])


def _tails(h: np.ndarray, bits: int) -> bytes:
    """48 bits behind those of the bucket, as steps between sorted values."""
    return _planes(np.diff((h << np.uint64(bits)) >> np.uint64(16), prepend=np.uint64(0)), 6)


def _totals(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the counts of equal keys, for each of them."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = np.diff(keys[order]) != 0
    begin = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order], begin, dtype=np.int64)
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(sums, np.diff(np.append(begin, len(keys))))
    return out


def _join_bucket(bits: int):
    """Adds the words or the pairs of a bucket up. Per chunk: the totals of its words, or the places
    and totals of its pairs that occur elsewhere. Rows of the chunks themselves pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["bucket"]):
            bucket = table.column("bucket").to_numpy()
            for b in np.unique(bucket):
                part = table.filter(pa.array(bucket == b))
                if b < 0:
                    for i in range(part.num_rows):
                        r = part.slice(i, 1).to_pylist()[0]
                        yield _batch([r | {"counts": r["keys"]}], CHUNK_ROWS)
                    continue
                yield from _join_rows(part, int(b), int(b) >= 1 << bits)
    return run


def _join_rows(part: pa.Table, b: int, are_words: bool) -> Iterator[pa.RecordBatch]:
    """Packed rows are taken one by one, so that no more than the arrays of the bucket are held."""
    packed = (part.column(c) for c in ("keys", "counts"))
    keys, counts = (np.concatenate([f(_unplaned(x.as_py(), n)) for x in c]) for c, n, f in zip(
        packed, (6, 4), (np.cumsum, lambda x: x.astype(np.uint32)), strict=True))
    total, at = _totals(keys, counts), 0
    del keys
    for i in range(part.num_rows):
        places = part.column("places")[i].as_py()
        n = len(_unplaned(part.column("counts")[i].as_py(), 4))
        mine, held = total[at:at + n], counts[at:at + n]
        at += n
        row = {"bucket": b, "chunk": part.column("chunk")[i].as_py()}
        if are_words:
            yield _batch([row | {"totals": _planes(mine, 8)}], CHUNK_ROWS)
            continue
        some = np.flatnonzero(mine > held)
        if len(some):
            yield _batch([row | {"places": _planes(_unplaned(places, 4)[some], 4), "totals": _planes(mine[some], 8)}], CHUNK_ROWS)


def _score_chunks(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["chunk"]):
            chunk = table.column("chunk").to_numpy()
            for c in np.unique(chunk):
                yield _score_chunk(sorted(table.filter(pa.array(chunk == c)).to_pylist(), key=lambda r: r["bucket"]), words)
    return run


def _score_chunk(rows: list[dict], words: int) -> pa.RecordBatch:
    """Scores the documents of a chunk from its own row, which comes first, and those of the buckets."""
    own = rows[0]
    ids, n = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["words"], np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    totals = [_unplaned(r["totals"], 8).astype(np.int64) for r in rows[1:] if r["places"] is None]
    total = np.concatenate([np.zeros(0, np.int64), *totals])[_by_count(_unplaned(own["counts"], 4).astype(np.int64))]
    word = _unplaned(own["order"], 4).astype(np.int64)
    rest = total[word] - _held(doc, word, len(total))  # the word outside the document
    alone = np.where(rest > 0, np.log(np.maximum(rest, 1)), math.log(ALPHA)) - np.log(np.maximum(words - n, 1).astype(np.float64))[doc]
    # Pairs by the place of their first word; those that no bucket sent back occur in this chunk only.
    at = np.flatnonzero(doc[1:] == doc[:-1])
    _, pair, count = np.unique(word[at] * max(1, len(total)) + word[at + 1], return_inverse=True, return_counts=True)
    for r in rows:
        if r["places"] is not None:
            places = _unplaned(r["places"], 4).astype(np.int64)
            count[pair[np.searchsorted(at, places)]] = _unplaned(r["totals"], 8).astype(np.int64)
    left = count[pair] - _held(doc[at], pair, len(count))
    each = alone.copy()
    each[at + 1] = np.where(left > 0, np.log(np.maximum(left, 1)) - np.log(np.maximum(rest[at], 1)), alone[at + 1] + math.log(ALPHA))
    score = np.bincount(doc, each, len(n))
    null = np.unpackbits(np.frombuffer(own["nulls"], np.uint8))[:len(ids)].astype(bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, mask=null), pa.array(n), pa.array(score / np.maximum(n, 1), mask=n == 0)], ["doc_id", "n_words", "log_score"])


def _held(doc: np.ndarray, what: np.ndarray, kinds: int) -> np.ndarray:
    """How often the document of each place holds what stands there."""
    _, back, held = np.unique(doc * max(1, kinds) + what, return_inverse=True, return_counts=True)
    return held[back]


def score_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """One row per input row: doc_id, n_words, log_score (mean natural logarithm per word).

    Texts without words, null ones too, have 0 words and a null score. Repeated rows count each,
    and each is scored against the others; a null id is a value like others. In a corpus of one
    document nothing is known. Other columns are not read; an empty table gives no rows.
    """
    sc = docs.sparkSession.sparkContext
    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = stored(plain.select("text").mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "pair-counts")
    words = counts.filter("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Candidates by their sums; at most 2 * FREQUENT have the share.
    often = counts.filter(F.col("kind") == 1).filter(F.col("n") * 2 * FREQUENT >= words).select("key").toArrow().column("key").to_numpy()
    often = np.sort(often.view(np.uint64))
    totals = np.zeros(len(often), np.int64)
    if len(often):
        known = plain.select("text").mapInArrow(_count_known(sc.broadcast(often.tobytes())), "key long, n long").groupBy("key").agg(
            F.sum("n").alias("n")).toArrow()
        totals[np.searchsorted(often, known.column("key").to_numpy().view(np.uint64))] = known.column("n").to_numpy()
    bits = max(0, math.ceil(math.log2(max(1, words / bucket_pairs))))
    rows = plain.mapInArrow(_deal(sc.broadcast((often.tobytes(), totals.tobytes())), bits), ROWS)
    parts = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_join_bucket(bits), CHUNK_ROWS)
    return parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
        _score_chunks(words), "doc_id long, n_words long, log_score double").withColumnRenamed("doc_id", id)
