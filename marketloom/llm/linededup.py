"""Line deduplication by pairwise alignment.

Lines are cut at newlines and after sentence ends, and compared by hashes of their words (A-Z
lower-cased). For every smallest range of lines with enough words, from each line on and up to each
line, the first document that holds it is known, and each later one is paired with it: a range of m
documents gives m - 1 pairs, never all. Any passage to delete consists of such ranges, so each part
of it has a partner, also where its single lines stand in still earlier documents. The lines of
a pair are aligned by patience diff: lines unique in both, in a longest run of increasing places,
are anchors; they grow over equal neighbours, and what lies between them is aligned likewise.
Aligned common blocks of enough words are deleted from the later document. So are runs of lines of
as many words that alignment leaves, because they stand twice in one of the two or in crossed order:
they are matched by the smallest ranges of lines with enough words, from every line on and up to it.

Only hashes of lines move between tasks; texts move once, to be cut.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.hashing import Hasher, Words, chunks, mix
from marketloom.llm.store import stored

BLOCK_WORDS = 20
ROOT = 0x9E3779B97F4A7C15  # of the polynomial over lines


def line_bounds(w: Words) -> np.ndarray:
    """First word of every line, and the number of words at the end."""
    n = len(w.starts)
    new = np.zeros(n + 1, bool)
    new[w.first] = True
    if n > 1:
        last = w.data[w.ends[:-1] - 1]
        breaks = np.zeros(len(w.data) + 1, np.int64)
        np.cumsum(w.data == 10, out=breaks[1:])
        new[1:n] |= (last == ord(".")) | (last == ord("!")) | (last == ord("?")) | (
            breaks[w.starts[1:]] != breaks[w.ends[:-1]])
    new[n] = True
    return np.flatnonzero(new)


def line_hashes(w: Words, bounds: np.ndarray) -> np.ndarray:
    if len(bounds) < 2:
        return np.zeros(0, np.uint64)
    place = np.arange(len(w.hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    return mix(np.add.reduceat(mix(w.hashes + mix(place.astype(np.uint64) + np.uint64(7))), bounds[:-1]))


LINES = "doc_id long, tkey long, lines array<long>, sizes array<int>"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for lo, hi in chunks(texts):
            w = hasher.words(texts[lo:hi])
            bounds = line_bounds(w)
            offsets = pa.array(np.searchsorted(bounds, w.first), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                pa.ListArray.from_arrays(offsets, pa.array(line_hashes(w, bounds).view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(np.diff(bounds).astype(np.int32)))],
                ["doc_id", "tkey", "lines", "sizes"])


def least_ranges(first: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends (lo, hi) of the smallest ranges of lines with ``least`` words, from every line on and up
    to every line, within texts that begin at ``first``. Every run of as many words consists of such
    ranges: those from its lines on, and the one up to its last line."""
    words = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=words[1:])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = np.arange(len(sizes))
    hi = np.searchsorted(words, words[:-1] + least)
    lo = np.searchsorted(words, words[1:] - least, "right") - 1
    on, upto = hi <= first[text + 1], lo >= first[text]
    return np.concatenate([line[on], lo[upto]]), np.concatenate([hi[on], line[upto] + 1])


def _ranges(least: int):
    """Hashes of the smallest ranges of lines with enough words, each once per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = (np.cumprod(np.full(1 << 16, x, np.uint64), dtype=np.uint64) for x in (ROOT, pow(ROOT, -1, 1 << 64)))
        for batch in batches:
            lines, sizes = (batch.column(c) for c in ("lines", "sizes"))
            n = sizes.value_lengths().to_numpy()
            first = np.concatenate(([0], np.cumsum(n)))
            h = mix(lines.flatten().to_numpy().view(np.uint64))
            lo, hi = least_ranges(first, sizes.flatten().to_numpy(), least)
            # A polynomial over the lines of each range, from running sums that begin anew in every
            # stretch of lines; a range has at most ``least`` lines.
            value = np.zeros(len(lo), np.uint64)
            step = len(up) - least
            part = lo // step
            for k in range(0, len(h), step):
                some = np.flatnonzero(part == k // step)
                m = len(x := h[k:k + len(up)])
                sums = np.zeros(m + 1, np.uint64)
                np.cumsum(x * up[:m], out=sums[1:])
                value[some] = mix((sums[hi[some] - k] - sums[lo[some] - k]) * down[lo[some] - k])
            doc = np.searchsorted(first, lo, "right") - 1
            order = np.lexsort((value, doc))
            value, doc = value[order], doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
            value, doc = value[new], doc[new]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("tkey"), pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(doc, np.arange(len(n) + 1)), pa.int32()), pa.array(value.view(np.int64)))],
                ["doc_id", "tkey", "ranges"])
    return run


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs whose second numbers increase; pairs are sorted by the first."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before[k] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        na, nb = Counter(a[i0:i1]), Counter(b[j0:j1])
        where = {x: j for j, x in enumerate(b[j0:j1], j0) if nb[x] == 1}
        anchors = _increasing([(i, where[x]) for i, x in enumerate(a[i0:i1], i0) if na[x] == 1 and x in where])
        if not anchors:
            continue
        pi, pj = i0, j0
        for i, j in anchors:
            # The part up to the anchor; equal lines before it are taken from its end.
            todo.append((pi, i + 1, pj, j + 1))
            pi, pj = i + 1, j + 1
        todo.append((pi, i1, pj, j1))
    return sorted(out)


def common_runs(a: list[int], b: list[int], sizes: list[int], least: int) -> np.ndarray:
    """Which lines of ``b`` are in a run of lines of ``a`` with at least ``least`` words."""
    size = dict(zip(b, sizes, strict=True))

    def ranges(x: list[int]):
        # Lines that b doesn't have are long, so that ranges over them are short; they match nothing.
        n = np.array([size.get(y, least) for y in x], np.int64)
        return zip(*(y.tolist() for y in least_ranges(np.array([0, len(x)]), n, least)), strict=True)

    held = {tuple(a[lo:hi]) for lo, hi in ranges(a)}
    gone = np.zeros(len(b), bool)
    for lo, hi in ranges(b):
        if tuple(b[lo:hi]) in held:
            gone[lo:hi] = True
    return gone


def common_blocks(a: list[int], b: list[int], sizes: list[int], least: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """Ranges of ``b`` that are common blocks with at least ``least`` words by ``sizes``: aligned
    ones, and runs of ``a`` that alignment leaves."""
    gone = np.zeros(len(b), bool)
    pairs = patience(a, b)
    k = 0
    while k < len(pairs):
        n = k + 1
        while n < len(pairs) and pairs[n][0] == pairs[n - 1][0] + 1 and pairs[n][1] == pairs[n - 1][1] + 1:
            n += 1
        lo, hi = pairs[k][1], pairs[n - 1][1] + 1
        if sum(sizes[lo:hi]) >= least:
            gone[lo:hi] = True
        k = n
    if not gone.all():
        gone |= common_runs(a, b, sizes, least)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
    return list(zip(edge[::2], edge[1::2], strict=True))


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n) for n in ("doc_id", "tkey", "lines", "sizes", "first_lines")}
            ids, keys, lo_, hi_ = [], [], [], []
            for i in range(batch.num_rows):
                blocks = common_blocks(col["first_lines"][i].as_py(), col["lines"][i].as_py(), col["sizes"][i].as_py(), least)
                for lo, hi in blocks:
                    ids.append(col["doc_id"][i].as_py())
                    keys.append(col["tkey"][i].as_py())
                    lo_.append(lo)
                    hi_.append(hi)
            if ids:
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(lo_, pa.int32()), pa.array(hi_, pa.int32())],
                    ["doc_id", "tkey", "lo", "hi"])
    return run


def repeated_blocks(docs: DataFrame, least: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Lines (doc_id, tkey, lines, sizes) of the documents and blocks (doc_id, tkey, lo, hi), ranges
    of lines to delete. A document is an id and a text (tkey, its hash); later is the larger pair."""
    lines = stored(docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").mapInArrow(_lines, LINES), "lines")
    known = lines.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "tkey"])
    known = stored(known, "known_lines")
    held = known.select("doc_id", "tkey", "lines", "sizes").mapInArrow(
        _ranges(least), "doc_id long, tkey long, ranges array<long>").select(
        F.struct("doc_id", "tkey").alias("d"), F.explode("ranges").alias("range"))
    first = held.groupBy("range").agg(F.min("d").alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Sorted joins at every size: the sides grow alike, and a hot range or document can be split.
    pairs = stored(held.hint("merge").join(first, "range").filter("d <> f").select("f", "d").distinct(), "pairs")
    earlier = pairs.select(F.col("f.doc_id").alias("doc_id"), F.col("f.tkey").alias("tkey"), "d").join(
        known.select("doc_id", "tkey", F.col("lines").alias("first_lines")).hint("merge"), ["doc_id", "tkey"]).select("d", "first_lines")
    both = earlier.select(F.col("d.doc_id").alias("doc_id"), F.col("d.tkey").alias("tkey"), "first_lines").join(
        known.hint("merge"), ["doc_id", "tkey"])
    blocks = both.select("doc_id", "tkey", "lines", "sizes", "first_lines").mapInArrow(
        _align(least), "doc_id long, tkey long, lo int, hi int")
    return lines, stored(blocks.distinct(), "blocks")


CUT = "text string, n_lines long, n_removed long, removed_words long"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        blocks = batch.column("blocks").to_pylist()
        out = []
        for lo, hi in chunks(texts):
            w = hasher.words(texts[lo:hi])
            bounds = line_bounds(w)
            at = np.searchsorted(bounds, w.first)
            for d in range(hi - lo):
                text, n = texts[lo + d], int(at[d + 1] - at[d])
                gone = np.zeros(n, bool)
                for x in blocks[lo + d] or ():
                    gone[x["lo"]:x["hi"]] = True
                words = 0
                if gone.any():
                    raw, kept, end = text.encode("utf-8", "replace"), [], 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    for a, z in zip(edge[::2], edge[1::2], strict=True):
                        i, j = bounds[at[d] + a], bounds[at[d] + z]
                        words += int(j - i)
                        kept.append(raw[end:w.starts[i] - w.base[d]])
                        # The gap behind goes too, unless it starts a new line.
                        end = w.ends[j - 1] - w.base[d]
                    kept.append(raw[end:])
                    text = b"".join(kept).decode("utf-8", "replace")
                out.append((text, n, int(gone.sum()), words))
        cut = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] not in ("text", "blocks")]
        names = [n for n in batch.schema.names if n not in ("text", "blocks")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(cut[0], pa.string()), *(pa.array(x, pa.int64()) for x in cut[1:])],
            [*names, "text", "n_lines", "n_removed", "removed_words"])


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: doc_id, text without the repeated blocks, n_lines, n_removed (lines)
    and removed_words.

    Null texts stay null with no lines; empty and blank texts have none. A document is its id and
    text: repeated rows are one document and are cut alike, of rows that share an id the one with
    the larger hash is later. Rows with a null id have no order; they are returned whole. Blocks
    under ``least`` words stay, so do lines of few words that many documents share by chance. Very
    long texts are aligned whole. Other columns are not read; an empty table gives no rows.
    """
    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    _, blocks = repeated_blocks(plain, least)
    cuts = blocks.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("lo", "hi")).alias("blocks"))
    rows = plain.withColumn("tkey", F.xxhash64("text")).hint("merge").join(cuts, ["doc_id", "tkey"], "left").select("doc_id", "text", "blocks")
    return rows.mapInArrow(_cut, f"doc_id long, {CUT}").withColumnRenamed("doc_id", id)
