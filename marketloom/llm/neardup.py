"""Near duplicates by a chosen-path set similarity join.

A document is the set of its 5-word shingles; equal sets are one node. Trees branch every node by
minwise tokens: at each tree node a few of a set's tokens are chosen by hash, and a set goes to
the child of each chosen token. Sets that meet in a small tree node are compared exhaustively by
their minwise tokens, and several trees repeat this. Tree nodes too large at the last level link
their sets without comparison. All this only gathers candidates: groups outside of which no link
is expected.

Links are then confirmed on the full sets, inside the groups. A group is cut into blocks of
bounded size; pairs that are connected already are skipped, so a group of near copies costs one
comparison each. For a group of several blocks, some of its sets (pivots) are compared in every
block, until each pair of sets is connected, or shared a block, or has a pivot: nothing is lost
and no task holds a group.

Recall: a pair of similarity 0.75 shares a tree node of the first level with probability 0.86, of
the second with 0.79, of the third with 0.75 and of the fourth with 0.72, or more, as each node has one
child at least. So it is missed by all 8 trees with probability 1e-7, 4e-6, 2e-5 and 4e-5 at most, as
large as the nodes around it make the trees deep. More similar pairs are
missed less. Both agree in fewer than 28 of 64 tokens with probability 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.components import components, split_join
from marketloom.llm.hashing import Hasher, chunks, distinct_sets, minhashes, mix, odd_numbers, set_keys, shingles
from marketloom.llm.store import stored

SHINGLE = 5
PERCENT = 75
TOKENS = 64
TREES = 8
FIRST_CHILDREN, CHILDREN = 2.0, 1.5  # expected common children of two sets at the threshold
DEPTH = 4
SMALL_NODE = 2048
MIN_AGREE = 28
BLOCK_SHINGLES = 2_000_000
FIRST_PIVOTS, PIVOTS = 16, 512


def document_sets(hasher: Hasher, texts) -> list[np.ndarray]:
    w = hasher.words(texts)
    return distinct_sets(*shingles(w.hashes, w.first, SHINGLE))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in chunks(texts):
            sets = document_sets(hasher, texts[lo:hi])
            n = np.array([len(x) for x in sets], np.int64)
            keys = set_keys(sets).view(np.int64)
            full = np.flatnonzero(n)
            tokens: list[bytes | None] = [None] * len(sets)
            sketches: list[bytes | None] = [None] * len(sets)
            if len(full):
                offsets = np.zeros(len(full) + 1, np.int64)
                np.cumsum(n[full], out=offsets[1:])
                rows = minhashes(np.concatenate([sets[i] for i in full]), offsets, TOKENS)
                for k, i in enumerate(full):
                    tokens[i], sketches[i] = rows[k].tobytes(), rows[k].astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays([
                ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(n),
                pa.array(keys, mask=n == 0), pa.array(tokens, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "node", "tokens", "sketch"])


def _chosen(parents: np.ndarray, share: float) -> np.ndarray:
    """Which tokens are chosen at each tree node, one at least: the same for all sets there."""
    places = odd_numbers(TOKENS, 5)
    drawn = (mix(parents[:, None] ^ places[None, :]) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return (drawn < share) | (drawn == drawn.min(1, keepdims=True))


def _children(parents: np.ndarray, tokens: np.ndarray, share: float):
    row, j = np.nonzero(_chosen(parents, share))
    token = tokens[row, j].astype(np.uint64)
    return row, mix(parents[row] * np.uint64(0x9E3779B97F4A7C15) + mix(token * np.uint64(TOKENS) + j.astype(np.uint64)))


def _tokens_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def _branch(share: float, first: bool):
    """Rows (node, path) of the children; at first from the roots of all trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                nodes = part.column("node").to_numpy()
                tokens = _tokens_of(part.column("tokens"))
                if first:
                    starts = [np.full(len(nodes), r, np.uint64) for r in odd_numbers(TREES, 6)]
                else:
                    starts = [part.column("path").to_numpy().view(np.uint64)]
                for parents in starts:
                    row, child = _children(parents, tokens, share)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[row]), pa.array(child.view(np.int64))], ["node", "path"])
    return run


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys from sorted batches; holds the open run only."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for v in values:
            new[1:] |= v[1:] != v[:-1]
        new[0] = last is not None and tuple(v[0] for v in values) != last
        last = tuple(v[-1] for v in values)
        cut = np.flatnonzero(new)
        if len(cut):
            head = [*held, batch.slice(0, cut[0])] if cut[0] else held
            if head:
                yield pa.Table.from_batches(head)
            if cut[-1] > cut[0]:
                yield pa.Table.from_batches([batch.slice(cut[0], cut[-1] - cut[0])])
            held = [batch.slice(cut[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for v in keys:
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(new))


def _link_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between sets of a small tree node that agree in enough tokens, from rows sorted by
    path. Up to 8 sets: every pair, for all tree nodes at once; else the edges of a spanning star."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for table in runs(batches, ["path"]):
        path, nodes = table.column("path").to_numpy(), table.column("node").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, TOKENS)
        bounds = _starts(path)
        size = np.diff(bounds)
        per_row = np.repeat(size, size)
        a, b = [], []
        for shift in range(1, min(8, int(size.max()))):
            left = np.flatnonzero((path[shift:] == path[:-shift]) & (per_row[shift:] <= 8))
            same = (sketch[left] == sketch[left + shift]).sum(1) >= MIN_AGREE
            a.append(nodes[left[same]])
            b.append(nodes[left[same] + shift])
        for lo, n in zip(bounds[:-1][size > 8], size[size > 8], strict=True):
            rows = sketch[lo:lo + n]
            near = np.stack([(rows == r).sum(1) >= MIN_AGREE for r in rows])
            label = np.arange(n, dtype=np.int32)
            while True:
                lower = np.where(near, label[None, :], np.int32(n)).min(1)
                if (lower == label).all():
                    break
                label = lower
            tied = np.flatnonzero(label != np.arange(n))
            a.append(nodes[lo + label[tied]])
            b.append(nodes[lo + tied])
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)


def candidate_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) between nodes that may be similar, from distinct sets (node, tokens, sketch)."""
    share = PERCENT / 100 * TOKENS
    rows = sets.select("node", "tokens").mapInArrow(_branch(FIRST_CHILDREN / share, True), "node long, path long")
    links = []
    for depth in range(1, DEPTH + 1):
        rows = stored(rows, "paths")
        met = stored(rows.groupBy("path").agg(
            F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n > 1"), "met")
        met = stored(split_join(rows, met, "path", "node"), "met")
        leaves = met.filter(F.col("n") <= SMALL_NODE).join(sets.select("node", "sketch"), "node")
        links.append(stored(
            leaves.select("path", "node", "sketch").repartition("path").sortWithinPartitions("path")
            .mapInArrow(_link_leaves, "a long, b long"), "links"))
        large = met.filter(F.col("n") > SMALL_NODE)
        if large.isEmpty():
            break
        if depth == DEPTH:
            links.append(large.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")))
        else:
            rows = large.select("node", "path").join(sets.select("node", "tokens"), "node").mapInArrow(
                _branch(CHILDREN / share, False), "node long, path long")
    out = links[0]
    for x in links[1:]:
        out = out.union(x)
    return out


def links_in_block(sets: list[np.ndarray], first: int, all_pairs: bool) -> list[tuple[int, int]]:
    """Confirmed links that connect what is similar. The first sets are compared with all others;
    the rest among themselves if ``all_pairs``. Pairs connected already are skipped."""
    m = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    label = np.arange(m)
    sketch = None
    if m > 16:
        offsets = np.zeros(m + 1, np.int64)
        np.cumsum(size, out=offsets[1:])
        sketch = minhashes(np.concatenate(sets), offsets, TOKENS)
    found = []
    for x in range(m if all_pairs else first):
        rest = np.arange(x + 1, m)
        rest = rest[(label[rest] != label[x])
                    & (100 * np.minimum(size[rest], size[x]) >= PERCENT * np.maximum(size[rest], size[x]))]
        if sketch is not None and len(rest):
            rest = rest[(sketch[rest] == sketch[x]).sum(1) >= MIN_AGREE]
        for y in rest:
            if label[y] == label[x]:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * both >= PERCENT * (size[x] + size[y] - both):
                found.append((x, int(y)))
                label[label == label[y]] = label[x]
    return found


def _confirm(all_pairs: bool):
    """Links (a, b) inside each block, from rows (grp, block, pivot, node, text) sorted so."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for table in runs(batches, ["grp", "block"]):
            grp, block = table.column("grp").to_numpy(), table.column("block").to_numpy()
            bounds = _starts(grp, block)
            a, b = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                part = table.slice(lo, hi - lo)
                texts, nodes = part.column("text").to_pylist(), part.column("node").to_numpy()
                pivot = part.column("pivot").to_numpy(zero_copy_only=False)
                sets: list[np.ndarray] = []
                for c, d in chunks(texts):
                    sets += document_sets(hasher, texts[c:d])
                # Rows that share an id but not the text have another key; a pivot may be here twice.
                own = set_keys(sets).view(np.int64) == nodes
                keep: dict[int, int] = {}
                for i in sorted(np.flatnonzero(own), key=lambda i: not pivot[i]):
                    keep.setdefault(int(nodes[i]), int(i))
                order = list(keep.values())
                for x, y in links_in_block([sets[i] for i in order], int(pivot[order].sum()) if order else 0, all_pairs):
                    a.append(nodes[order[x]])
                    b.append(nodes[order[y]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
    return run


def _in_blocks(rows: DataFrame, all_pairs: bool) -> DataFrame:
    return (rows.select("grp", "block", "pivot", "node", "text").repartition("grp", "block")
            .sortWithinPartitions("grp", "block").mapInArrow(_confirm(all_pairs), "a long, b long"))


def confirmed_links(docs: DataFrame, groups: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links (a, b) that connect all similar sets of each group.

    ``docs`` has doc_id and text; ``groups`` has node, grp, rep (a document of the set) and
    n_shingles.
    """
    blocks = groups.groupBy("grp").agg(F.ceil(F.sum("n_shingles") / block_shingles).cast("int").alias("n_blocks"))
    placed = stored(split_join(groups, blocks, "grp", "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")), "placed")
    # Texts are always dealt by id, never joined with a broadcast of the groups.
    rows = docs.select("doc_id", "text").hint("merge").join(
        placed.withColumnRenamed("rep", "_rep"), F.col("doc_id").eqNullSafe(F.col("_rep"))).select(
        "grp", "block", "n_blocks", F.lit(False).alias("pivot"), "node", "text")
    if placed.filter("n_blocks > 1").isEmpty():
        return stored(_in_blocks(rows, True), "links")
    links = stored(_in_blocks(rows.filter("n_blocks = 1"), True), "links")
    big = stored(rows.filter("n_blocks > 1"), "large_groups")
    done, found, count, first = None, None, FIRST_PIVOTS, True
    waiting = big.select("grp", "node", "n_blocks").distinct()
    while True:
        # So many pivots per group that wait longest; each goes to every block of the group.
        picked = stored(waiting.groupBy("grp", "n_blocks", F.pmod(F.xxhash64("node", F.lit(count)), F.lit(count)).alias("k"))
                        .agg(F.min("node").alias("node")), "pivots")
        texts = big.select("grp", "node", "text").join(picked.select("grp", "node", "n_blocks"), ["grp", "node"])
        spread = texts.select("grp", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"),
                              F.lit(True).alias("pivot"), "node", "text")
        new = stored(_in_blocks(big.drop("n_blocks").unionByName(spread), first), "links")
        found = new if found is None else found.union(new)
        done = picked.select("node") if done is None else done.union(picked.select("node"))
        comps = components(found)
        named = big.select("grp", "node", "n_blocks").distinct().join(comps, "node", "left").withColumn(
            "root", F.coalesce("root", "node"))
        named = stored(named, "named")
        most = named.groupBy("grp", "root").count().groupBy("grp").agg(F.max_by("root", "count").alias("main"))
        waiting = stored(split_join(named, most, "grp", "node").filter("root <> main").join(done, "node", "left_anti")
                         .select("grp", "node", "n_blocks"), "waiting")
        if waiting.isEmpty():
            return links.union(found)
        count, first = PIVOTS, False


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts without words (also null) have an empty set and no links; their component is their own
    id. Rows with a null id take part in links; their component is the smallest id in reach, null
    if there is none. Rows that repeat an id are rows of their own; ``kept`` holds for each row
    whose id is the component's. Very long texts are whole sets. Other columns are not read. An
    empty table gives no rows.
    """
    plain = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    features = stored(plain.mapInArrow(
        _features, "doc_id long, n_shingles long, node long, tokens binary, sketch binary"), "features")
    sets = stored(features.filter("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"),
        F.first("sketch").alias("sketch")), "sets")
    groups = components(candidate_links(sets)).withColumnRenamed("root", "grp")
    members = sets.select("node", "rep", "n_shingles").join(groups, "node")
    roots = components(confirmed_links(plain, members, block_shingles))
    smallest = roots.join(sets.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = split_join(roots, smallest, "root", "node").select("node", "component_id")
    # Stored, so that the join below deals both sides and can split a set with many copies.
    owner = stored(sets.select("node", "rep").join(linked, "node", "left").select(
        "node", F.coalesce("component_id", "rep").alias("component_id")), "owners")
    return features.select("doc_id", "n_shingles", "node").join(owner, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def digest_sql() -> str:
    """The same in SQL over documents: all pairs that share a shingle, and what is reachable."""
    return f"""
WITH RECURSIVE split_up AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
members AS (
  SELECT DISTINCT r, s FROM (SELECT r, unnest(CASE
    WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split_up)),
sizes AS (SELECT r, count(*) AS n FROM members GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM members a JOIN members b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT r, r AS q FROM split_up UNION SELECT reached.r, steps.y FROM reached JOIN steps ON reached.q = steps.x),
named AS (SELECT reached.r, min(d.doc_id) AS component_id FROM reached JOIN split_up d ON d.r = reached.q GROUP BY reached.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM split_up JOIN named USING (r) LEFT JOIN sizes USING (r)"""
