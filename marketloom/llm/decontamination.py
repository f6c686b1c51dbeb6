"""Benchmark decontamination by SimHash windows.

An item is known by the 126-bit SimHashes (over pairs of neighbouring words) of all its windows of
one length, taken from a fixed ladder of lengths; a document by those of its windows of the lengths
in use. A fingerprint has 6 blocks of 21 bits: any two within Hamming distance 4 share two blocks.
Which block values the benchmark has is kept as one bitmap per length and block, of a fixed size
however large the benchmark is; only document windows with two values in it leave the task, and
besides, once each, the stretches of words around them. Windows are joined with the item windows on
(length, block, value); those within the radius name a stretch, an item and a place. Words are joined
to them at last, and the weighted Jaccard similarity of 5-word shingles (by number of occurrences)
between the item and the words in its place decides. The radius is what the blocks guarantee.

Windows start at every word for lengths up to 8 and at every 4th word above; since the item side
has every start, an unchanged run of the window length plus 3 words meets a window with distance 0.
Windows are so short that every passage similar enough holds such a run, wherever its words are
changed, left out or added (``unchanged_run``). That needs an item without a repeated run of four
words; others have windows of one shingle, of which every similar passage holds one unchanged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.hashing import NOT_ALNUM, Hasher, chunks, mix, shingles
from marketloom.llm.store import stored

SHINGLE = 5
MIN_SIMILARITY = 0.75
BITS, BLOCKS, BLOCK_BITS = 128, 6, 21
AGREE = 2  # blocks that must agree
RADIUS = BLOCKS - AGREE  # differing bits in other blocks at most: all fingerprints so near are found
STRIDE, SHORT = 4, 8
CHUNK = 1 << 18
SLICE = 1 << 17  # words of a long text that are expanded to bits at once
KNOWN_ITEMS = 1000  # items whose shingle counts a task keeps


def ladder(top: int) -> list[int]:
    """Window lengths: 1 to 8, then each a third longer, up to ``top``."""
    out = list(range(1, SHORT + 1))
    while out[-1] * 4 // 3 <= top:
        out.append(out[-1] * 4 // 3)
    return [x for x in out if x <= top]


def unchanged_run(n_words: int) -> int:
    """Words of an item that stand in a row in any passage of its length that is similar enough.

    The item repeats no run of four words. Of n shingles each, similarity s leaves n * 2s / (1 + s) in common. A word changed, left out or
    added costs 4 shingles at least, so the common ones are in few runs; a run of m has m + 4 words.
    """
    n = n_words - SHINGLE + 1
    if n <= 1:
        return n_words
    lost = math.floor(n * (1 - MIN_SIMILARITY) / (1 + MIN_SIMILARITY) + 1e-9)
    return math.ceil((n - lost) / (1 + lost // (SHINGLE - 1))) + SHINGLE - 1


def window_length(n_words: int, repeats: bool = False) -> int:
    """Length of an item's windows; ``repeats``: it holds some run of four words twice."""
    if repeats:
        return min(n_words, SHINGLE)
    run = unchanged_run(n_words)
    return max(x for x in ladder(run) if x <= SHORT or x + STRIDE - 1 <= run)


def repeats_itself(hashes: np.ndarray) -> bool:
    if len(hashes) < SHINGLE:
        return False
    runs, _ = shingles(hashes, np.array([0, len(hashes)]), SHINGLE - 1)
    return len(np.unique(runs)) < len(runs)


def feature_bits(hashes: np.ndarray, length: int) -> np.ndarray:
    """128 bits, one per byte, of what windows of a length are made of: each word with the next
    one, or single words for windows of one word."""
    x = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]) if length > 1 else hashes
    pair = np.empty((len(x), 2), np.uint64)
    pair[:, 0], pair[:, 1] = x, mix(x ^ np.uint64(0x5851F42D4C957F2D))
    return np.unpackbits(pair.view(np.uint8), axis=1)


def run_sums(bits: np.ndarray, top: int) -> dict[int, np.ndarray]:
    """Set bits in runs of 1, 2, 4 ... rows, up to 128 (counts fit a byte) and ``top``."""
    out = {1: bits}
    while 2 * max(out) <= min(top, 128) and len(out[max(out)]) > max(out):
        n = max(out)
        out[2 * n] = out[n][:-n] + out[n][n:]
    return out


def fingerprints(sums: dict[int, np.ndarray], at: np.ndarray, length: int) -> np.ndarray:
    """SimHashes (two 64-bit numbers each) of the windows [at, at + length): a bit is set if most
    features have it set."""
    n = max(1, length - 1)
    ones, left, start = np.zeros((len(at), BITS), np.uint16 if n > 255 else np.uint8), n, at
    while left:
        k = max(x for x in sums if x <= left)
        ones += sums[k][start]
        start, left = start + k, left - k
    return np.packbits(ones > n // 2, axis=1).view(">u8").astype(np.uint64)


def block_values(prints: np.ndarray) -> np.ndarray:
    """(windows, blocks) values of 21 bits."""
    shifts = np.array([43, 22, 1], np.uint64)
    return ((prints[:, :, None] >> shifts) & np.uint64((1 << BLOCK_BITS) - 1)).reshape(-1, BLOCKS).astype(np.int64)


def _key(length: int, values: np.ndarray) -> np.ndarray:
    return (length << 24 | np.arange(values.shape[-1])) << BLOCK_BITS | values


#: An item has a row with its words (``offset`` is how far its place may shift), and rows of its windows, one for each block.
ITEM_ROWS = "item long, item_id long, n_words int, words binary, offset int, length int, key long, high long, low long"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}


def _batch(schema: str, **columns) -> pa.RecordBatch:
    """A batch of the schema; columns that aren't given are null."""
    n = max(len(c) for c in columns.values())
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], _TYPES[t]) if c in columns else pa.nulls(n, _TYPES[t]) for c, t in fields], [c for c, _ in fields])


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, item = Hasher(NOT_ALNUM), TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in chunks(texts, CHUNK):
            w = hasher.words(texts[lo:hi])
            for d in range(hi - lo):
                h = w.hashes[w.first[d]:w.first[d + 1]]
                if not len(h):
                    continue
                item += 1
                length = window_length(len(h), repeats_itself(h))
                yield _batch(ITEM_ROWS, item=[item], item_id=[ids[lo + d]], n_words=[len(h)], words=[h.tobytes()], offset=[shift(len(h))], length=[length])
                for base in range(0, len(h) - length + 1, SLICE // 8):
                    at = np.arange(base, min(base + SLICE // 8, len(h) - length + 1))
                    part = h[base:at[-1] + length]
                    prints = fingerprints(run_sums(feature_bits(part, length), length), at - base, length)
                    keys = _key(length, block_values(prints))
                    high, low = (np.repeat(x.view(np.int64), BLOCKS) for x in np.ascontiguousarray(prints.T))
                    n = keys.size
                    yield _batch(ITEM_ROWS, item=np.full(n, item), n_words=np.full(n, len(h)), offset=np.repeat(at, BLOCKS),
                                 length=np.full(n, length), key=keys.reshape(-1), high=high, low=low)


def bitmaps(items: DataFrame) -> dict[tuple[int, int], bytes]:
    """Per (length, block) the block values of the benchmark, 256 KB each; the ladder has about
    eight lengths per factor of ten, so this is bounded by the longest item, not by their number."""
    # The bitmap functions count from 1.
    parts = F.col("key").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) + 1
    rows = (
        items.select("length", (F.shiftright("key", BLOCK_BITS).bitwiseAND(F.lit((1 << 24) - 1))).alias("block"), parts.alias("v"))
        .groupBy("length", "block", F.bitmap_bucket_number("v").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))
    )
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in rows.toLocalIterator():
        whole = out.setdefault((r["length"], r["block"]), np.zeros((1 << BLOCK_BITS) // 8 + 4096, np.uint8))
        raw = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["part"] - 1) * len(raw)
        whole[at:at + len(raw)] = raw
    return {k: v.tobytes() for k, v in out.items()}


#: A stretch of a document has a row with its words, and rows of the windows found in it.
FOUND_ROWS = "stretch long, id long, from_word int, total int, words binary, at int, key long, high long, low long"


def longest_items(items: DataFrame) -> dict[int, int]:
    """Words of the longest item that uses windows of a length."""
    return {r["length"]: r["n"] for r in items.groupBy("length").agg(F.max("n_words").alias("n")).collect()}


def _document_rows(known, longest: dict[int, int]):
    """Windows with block values of the benchmark, and stretches of words around them that reach as
    far as the longest item of such windows. Stretches of a document that overlap are one, so that its
    words leave the task once at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = {k: np.frombuffer(v, np.uint8) for k, v in known.value.items()}
        lengths = sorted({k[0] for k in maps})
        hasher, stretch = Hasher(NOT_ALNUM), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in chunks(texts, CHUNK):
                w = hasher.words(texts[lo:hi])
                found = _found(w, maps, lengths) if len(w.hashes) and lengths else []
                if not found:
                    continue
                p, length, prints, values, hit = (np.concatenate(x) for x in zip(*found, strict=True))
                doc = np.searchsorted(w.first, p, "right") - 1
                reach = np.array([longest[n] + shift(longest[n]) for n in length.tolist()])
                a, z = np.maximum(w.first[doc], p - reach), np.minimum(w.first[doc + 1], p + length + reach)
                order = np.lexsort((a, doc))
                p, doc, a, z, values, hit, prints = (x[order] for x in (p, doc, a, z, values, hit, prints))
                of = np.empty(len(p), np.int64)
                begin = 0
                for i in range(len(p)):
                    if i == begin or a[i] > end or doc[i] != doc[begin]:
                        if i != begin:
                            yield _stretch(w, ids[lo + doc[begin]], stretch, a[begin], end, doc[begin])
                        stretch, begin, end = stretch + 1, i, z[i]
                    end = max(end, z[i])
                    of[i] = stretch
                yield _stretch(w, ids[lo + doc[begin]], stretch, a[begin], end, doc[begin])
                # All but one of the blocks: one of any two that agree is among them.
                row, block = np.nonzero(hit & (np.cumsum(hit, axis=1) >= AGREE))
                high, low = (x.view(np.int64)[row] for x in np.ascontiguousarray(prints.T))
                yield _batch(FOUND_ROWS, stretch=of[row], at=(p - w.first[doc])[row], key=values[row, block], high=high, low=low)
    return run


def _stretch(w, id, number: int, a: int, z: int, doc: int) -> pa.RecordBatch:
    return _batch(FOUND_ROWS, stretch=[number], id=[id], from_word=[int(a - w.first[doc])], total=[int(w.counts[doc])], words=[w.hashes[a:z].tobytes()])


def _found(w, maps, lengths: list[int]) -> list[tuple]:
    """Places, lengths, fingerprints, keys and known blocks of the windows with enough known blocks."""
    doc = np.repeat(np.arange(len(w.first) - 1), w.counts)
    place = np.arange(len(doc)) - w.first[doc]
    left = w.first[doc + 1] - np.arange(len(doc))
    out = []
    for base in range(0, len(doc), SLICE):
        cut, sums = slice(base, base + SLICE), {}
        for length in lengths:
            at = base + np.flatnonzero((left[cut] >= length) & (place[cut] % (1 if length <= SHORT else STRIDE) == 0))
            if not len(at):
                continue
            if (length > 1) not in sums:
                sums[length > 1] = run_sums(
                    feature_bits(w.hashes[base:base + SLICE + lengths[-1]], length), lengths[-1] if length > 1 else 1)
            prints = fingerprints(sums[length > 1], at - base, length)
            values = block_values(prints)
            hit = np.stack([maps[length, b][values[:, b] >> 3] >> (values[:, b] & 7).astype(np.uint8) & 1 for b in range(BLOCKS)], axis=1)
            some = np.flatnonzero(hit.sum(1) >= AGREE)
            if len(some):
                out.append((at[some], np.full(len(some), length), prints[some], _key(length, values[some]), hit[some].astype(bool)))
    return out


def shift(n_words: int) -> int:
    """How far the place of a similar passage may be from where one of its unchanged runs puts it: a
    word more or less before the run costs SHINGLE - 1 shingles."""
    lost = max(0, n_words - SHINGLE + 1) * (1 - MIN_SIMILARITY) / (1 + MIN_SIMILARITY)
    return int(lost / (SHINGLE - 1)) + 1


def _shingle_list(words: np.ndarray, size: int) -> list[bytes]:
    raw = words.tobytes()
    return [raw[8 * i:8 * (i + size)] for i in range(len(words) - size + 1)]


def best_place(words: np.ndarray, item: np.ndarray, theirs: Counter, ends: bool = True) -> tuple[float, int]:
    """Highest weighted similarity of an item with as many words in a row as it has, and the first
    place that has it; fewer words only where the document ``ends``. Counts follow the place step by step."""
    size = min(SHINGLE, len(item))
    runs, whole = _shingle_list(words, size), len(item) - size + 1
    mine = Counter(runs[:whole])
    both = sum((mine & theirs).values())
    held = min(whole, len(runs))
    best, at = (both / (held + whole - both) if held + whole - both else 0.0), 0
    for i in range(whole, len(runs) + (whole - 1 if ends else 0)):
        gone = runs[i - whole]
        both -= mine[gone] <= theirs[gone]
        mine[gone] -= 1
        if i < len(runs):
            mine[runs[i]] += 1
            both += mine[runs[i]] <= theirs[runs[i]]
        else:
            held -= 1
        if both / (held + whole - both) > best:
            best, at = both / (held + whole - both), i - whole + 1
    return best, at


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones."""
    both = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - both
    return both / whole if whole else 0.0


FOUND = "id long, item_id long, start_word int, similarity double"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, Counter] = {}
    for batch in batches:
        col = {n: batch.column(n) for n in batch.schema.names}
        out: list[tuple] = []
        for i in range(batch.num_rows):
            item, theirs = col["item"][i].as_py(), np.frombuffer(col["item_words"][i].as_py(), np.uint64)
            if item not in known:
                if len(known) >= KNOWN_ITEMS:
                    known.clear()
                known[item] = Counter(_shingle_list(theirs, min(SHINGLE, len(theirs))))
            s, at = best_place(np.frombuffer(col["words"][i].as_py(), np.uint64), theirs, known[item], col["ends"][i].as_py())
            if s >= MIN_SIMILARITY:
                out.append((col["id"][i].as_py(), col["item_id"][i].as_py(), col["first"][i].as_py() + at, s))
        if out:
            yield _batch(FOUND, **dict(zip(("id", "item_id", "start_word", "similarity"), zip(*out, strict=True), strict=True)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start_word,
    similarity (the best place, words counted from 0).

    Words are runs of ASCII letters, digits and other characters above ASCII, A-Z lower-cased.
    Null and empty texts and items have no words and match nothing; items of fewer than five words
    are one shingle and must stand as they are. Repeated rows give one result per id and item;
    a null id is a value like others. An empty table of either kind gives no rows. Texts and items are
    read whole, however long; other columns are not read.
    """
    spark = docs.sparkSession
    items = stored(benchmark.select(F.col(item_id).cast("long"), F.col(item_text)).mapInArrow(_item_rows, ITEM_ROWS), "items")
    item_windows, item_words = items.filter("key IS NOT NULL"), items.filter("words IS NOT NULL")
    known = spark.sparkContext.broadcast(bitmaps(item_windows))
    found = stored(docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        _document_rows(known, longest_items(item_words)), FOUND_ROWS), "document-windows")
    theirs = item_windows.select("item", "key", "offset", F.col("high").alias("item_high"), F.col("low").alias("item_low"))
    bits = F.bit_count(F.col("high").bitwiseXOR(F.col("item_high"))) + F.bit_count(F.col("low").bitwiseXOR(F.col("item_low")))
    near = found.filter("key IS NOT NULL").select("stretch", "at", "key", "high", "low").join(theirs, "key").filter(bits <= RADIUS).select(
        "stretch", "item", (F.col("at") - F.col("offset")).alias("start")).distinct()
    # The words in the item's place and next to it, of those of the stretch: 8 bytes each.
    first = F.greatest(F.col("start") - F.col("shift") - F.col("from_word"), F.lit(0))
    last = F.greatest(first, F.col("start") + F.col("n_words") + F.col("shift") - F.col("from_word"))
    places = near.join(found.filter("words IS NOT NULL").select("stretch", "id", "from_word", "total", "words"), "stretch").join(
        item_words.select("item", "item_id", "n_words", F.col("offset").alias("shift"), F.col("words").alias("item_words")), "item")
    hits = places.select("id", "item", "item_id", (F.col("from_word") + first).alias("first"), "item_words",
                         (F.col("start") + F.col("n_words") + F.col("shift") >= F.col("total")).alias("ends"), F.substring(F.col("words"), 8 * first + 1, 8 * (last - first)).alias("words")).mapInArrow(
        _verify, FOUND)
    return hits.groupBy("id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start_word")).alias("back"))).alias("best")).select(
        F.col("id").alias(id), "item_id", (-F.col("best.back")).alias("start_word"), F.col("best.similarity").alias("similarity"))
