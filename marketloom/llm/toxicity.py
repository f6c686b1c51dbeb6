"""Toxicity scores of documents by a recurrent network over all overlapping windows.

The network learns on the driver from a bounded sample of labelled documents; scoring runs inside
tasks on whole texts, without a shuffle. A document's score is that of its highest window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.hashing import Hasher, chunks
from marketloom.llm.store import stored
from marketloom.llm.toxicnet import ToxicNet, Vocabulary, train, windows

#: Rows held out from learning, and the score from which a text counts as toxic.
HELD_OUT = (4, 2)
THRESHOLD = 0.3
#: Bounds of the sample: documents per label, the first by a hash of their id, one text each, and their bytes.
SAMPLE_PER_LABEL = 1000
SAMPLE_BYTES = 16 << 20
CHUNK = 1 << 18


def held_out(id: Column) -> Column:
    n, k = HELD_OUT
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % n == k, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, seed: int = 7, max_bytes: int = SAMPLE_BYTES) -> ToxicNet:
    """Network learned from at most ``per_label`` documents of each label that aren't held out.

    Labels other than 0 and 1 are no labels; an id with both is left out. An id with several texts gives
    one of them. Texts beyond ``max_bytes`` in all, in the order of their hashes, aren't used, however
    many rows share an id. Without documents of both labels, all scores are low and equal.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most")
    first = F.xxhash64("doc_id")
    sample = known.filter("toxic = 0").orderBy(first).limit(per_label).unionByName(
        known.filter("toxic = 1").orderBy(first).limit(per_label)).select("doc_id", "toxic")
    # At most 2 * per_label ids, so as many rows; partial minima keep a hot id from gathering in a task.
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").filter("text IS NOT NULL")
    one = stored(found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "sample")
    sizes = sorted(map(tuple, one.select(first, "doc_id", F.octet_length("text")).collect()))
    used, chosen = 0, []
    for _, doc_id, size in sizes:
        if used + size <= max_bytes:
            used += size
            chosen.append(doc_id)
    rows = one.filter(F.col("doc_id").isin(chosen)).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows]), seed)


def score_texts(net: ToxicNet, hasher: Hasher, texts: list[str | None]) -> np.ndarray:
    out = np.zeros(len(texts))
    for lo, hi in chunks(texts, CHUNK):
        w = hasher.words(texts[lo:hi])
        v = Vocabulary(w)
        idx, text = windows(w.first, v.ids, len(v))
        best = np.full(hi - lo, -np.inf)
        np.maximum.at(best, text, net.window_logits(v, idx))
        out[lo:hi] = net.text_scores(best)
    return out


def scorer(net: ToxicNet, spark):
    """A column function: score of a text, 0 for null, empty and blank ones."""
    shared = spark.sparkContext.broadcast({k: x.tobytes() for k, x in net.p.items()})
    shapes = {k: x.shape for k, x in net.p.items()}

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, hasher = ToxicNet(), Hasher()
        model.p = {k: np.frombuffer(x, np.float32).reshape(shapes[k]) for k, x in shared.value.items()}
        for texts in batches:
            yield pd.Series(score_texts(model, hasher, texts.tolist()))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The input rows with all columns, plus ``score`` (0 to 1) and ``predicted`` (1 from 0.3 on).

    Only the text enters a score. Null, empty and blank texts score 0; repeated rows score alike;
    an empty table gives no rows. Columns of the input named like the added ones are replaced.
    """
    score = scorer(fit(docs, labels), docs.sparkSession)
    return docs.withColumn("score", score(F.col(text))).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int"))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs.select("doc_id", "text"), labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
