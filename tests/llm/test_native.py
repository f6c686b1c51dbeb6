"""The operators on SQL functions: against their SQL, plain Python, and rows of all kinds."""

import random
import re
from collections import Counter

import pytest
from compare import differences, duck
from helpers import EDGES, LONG, MIDDLE, SENTENCE, SMALL, edge_docs, empty_docs, table
from pyspark.sql import functions as F

from marketloom.llm import licenses, mixing, quality, sharding
from marketloom.llm.queries import ORACLES, QUERIES
from marketloom.llm.sqlwords import LOWER, UPPER


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twins(spark, name, folder):
    assert differences(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) is None


DIGESTS = {"licenses": licenses.license_digest, "quality": quality.quality_digest, "mixing": mixing.mix_digest,
           "sharding": sharding.shard_digest}


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_edges(spark, name):
    docs = edge_docs(spark)
    rows = DIGESTS[name](docs).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(x[0] for x in EDGES)
    assert DIGESTS[name](empty_docs(spark)).collect() == []


def test_licenses(spark):
    rows = [
        (1, "Released under the MIT License."), (2, "under the mit license, UNDER THE MIT LICENSE"), (3, "mit license"),
        (4, "This work is licensed under the GNU General Public License, version 3."),
        (5, "GNU General Public License, version 3"), (6, "Licensed under the Apache License, Version 2.0; also CC-BY-NC"),
        (7, "a " * 5000 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        (8, "cc by\nnc"), (9, "ccé by nc"), (10, "license mit the under")]
    got = {r["doc_id"]: r for r in licenses.license_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pick = lambda i: (got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"], got[i]["labels"])
    assert pick(1) == (1, 1, 1, "mit", "mit") and got[1]["score"] == 1
    assert pick(2) == (2, 0, 4, "mit", "mit")
    assert pick(3) == (0, None, None, "", "") and pick(10)[0] == 0
    assert pick(4) == (0, None, None, "", "gpl-3") and got[4]["score"] == 1
    assert pick(5)[4] == "" or got[5]["score"] < 1
    assert pick(6) == (2, 3, 9, "apache-2,cc-by-nc", "apache-2,cc-by-nc")
    assert pick(7)[4] in ("", "mit") and got[7]["n_words"] == 5016
    assert pick(8) == (1, 0, 0, "cc-by-nc", "cc-by-nc") and pick(9)[0] == 0


def plain_scan(text, templates=licenses.TEMPLATES, min_score=licenses.MIN_SCORE):
    """Every template at every place."""
    w = [x for x in re.split(licenses.GAP, (text or "").translate(str.maketrans(UPPER, LOWER))) if x]
    out = []
    for t in templates:
        key = t.key.split()
        for i in range(len(w) - len(key) + 1):
            o = i - t.key_at
            if w[i:i + len(key)] == key:
                score = sum(0 <= o + k < len(w) and w[o + k] == x for k, x in enumerate(t.words)) / len(t.words)
                if score >= min_score:
                    out.append((t.label, t.base, o, score))
    return sorted(out)


def test_licenses_against_every_place(spark, monkeypatch):
    """Whole, cut off, altered and repeated notices, among words that other templates hold too."""
    rng, texts = random.Random(5), [None, "", "of the license", LONG + " licensed under cc by nc 4 0"]
    common = sorted({x for t in licenses.TEMPLATES for x in t.words})
    for t in licenses.TEMPLATES * 3:
        w = t.words
        cut = w[rng.randint(0, len(w) // 2):] if rng.random() < 0.4 else w[:rng.randint(len(w) // 2, len(w))]
        altered = [x if rng.random() < 0.9 else rng.choice(common) for x in cut]
        noise = [rng.choice(common) for _ in range(rng.randint(0, 60))]
        texts.append(" ".join([*noise, *altered, *noise[::-1], *(w * rng.randint(0, 3))]).upper())
    want = [plain_scan(x) for x in texts]
    assert sum(map(len, want)) > 150 and sum(0 < s < 1 for x in want for *_, s in x) > 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rarest in (licenses.RAREST, 0):  # the words that every file looks up; the rest is found by the key words
        monkeypatch.setattr(licenses, "RAREST", rarest)
        got = {r["doc_id"]: sorted(tuple(f) for f in r["found"]) for r in licenses.scan_licenses(docs).collect()}
        assert got == dict(enumerate(want))


def test_rarest_words_come_first(spark):
    docs = spark.createDataFrame([(i, "license of the" if i else "license mozilla") for i in range(9)], "doc_id long, text string")
    table = licenses.template_table(spark, licenses.TEMPLATES)
    ranked = licenses.rarest_first(licenses.document_frequencies(docs, table)).first()["ranked"]
    assert ranked[-4:] == ["mozilla", "of", "the", "license"] and len(ranked) == len({x for t in licenses.TEMPLATES for x in t.words})


def repeated(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    return len({p for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)})


def test_repeated_words(spark):
    texts = [None, "", SENTENCE, f"{SENTENCE} {SENTENCE}", " ".join(["a"] * 8), " ".join(["a"] * 9), " ".join(["a"] * 50),
             f"{SENTENCE} x {SENTENCE[4:]}", LONG, LONG + " " + LONG, " ".join(f"{i % 11}" for i in range(300))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.features(df).collect()}
    assert got == {i: repeated(t) for i, t in enumerate(texts)}


def test_fences_follow_the_group(spark):
    """Two sources with other habits: what is usual in one is rejected in the other."""
    def text(i, symbols):
        return " ".join(f"w{i}x{k}" + ("#" if k < symbols else "") for k in range(40))

    rows = [(i, text(i, 2 + i % 3), "en", "plain") for i in range(300)] + [(1000 + i, text(i, 36 + i % 3), "en", "code") for i in range(300)]
    rows += [(5000, text(7, 37), "en", "plain"), (5001, text(8, 37), "en", "code")]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[5000]["kept"] and got[5000]["reason"] == "symbol_share" and got[5001]["kept"]
    assert sum(not r["kept"] for r in got.values()) == 1


def test_fences_on_documents(spark):
    """Groups of the given documents have fences of their own, and every feature rejects something."""
    rows = quality.judge(table(spark, "/root/testdata/sf0.1", "documents"), min_group=40).toPandas()
    assert rows["fences"].notna().all()
    groups = rows.assign(f=[tuple(sorted(f.items())) for f in rows["fences"]]).groupby(["lang", "source"], dropna=False)["f"].agg(["nunique", "first"])
    assert (groups["nunique"] == 1).all() and groups["first"].nunique() > 0.5 * len(groups)
    for name in quality.FENCES:
        fences = {dict(f)[name] for f in groups["first"]}
        assert len(fences) > 3 and rows["reason"].fillna("").str.contains(name).any(), name
    fine = rows[~rows["base_failed"]]
    assert 0.8 < fine["kept"].mean() < 1


def test_fences_come_from_the_group_alone(spark):
    """The same document is kept or rejected by what is usual around it: no fixed cutoff."""
    def text(i, dup):
        return "\n".join([f"line {i} {k} with several words in it" for k in range(12 - dup)] + ["a line that is repeated here"] * (dup + 1))

    rows = [(i, text(i, 0), "en", "plain") for i in range(200)] + [(1000 + i, text(i, 8), "en", "lists") for i in range(200)]
    rows += [(5000, text(5000, 4), "en", "plain"), (5001, text(5001, 4), "en", "lists")]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect() if not r["base_failed"]}
    if 5000 in got:
        assert "dup_line_share" in got[5000]["reason"] and got[5001]["kept"]


def test_sketch_merges_and_bounds_the_error(spark):
    df = spark.range(1, 20001).select((F.col("id") % 7).alias("g"), (F.col("id") / 1000.0).alias("x"))
    values = {"f": F.col("x")}
    whole = quality.sketch(df, values, ())
    merged = quality.sketch(df, values, ("g",)).groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    q = quality.quantiles(merged, (), {"q1": 0.25, "q3": 0.75}).first()
    assert q["q1"] == pytest.approx(5, rel=0.021) and q["q3"] == pytest.approx(15, rel=0.021)


def test_mix_targets_and_copies(spark):
    docs = table(spark, MIDDLE, "documents")
    plan = mixing.plan_mix(docs).toPandas()
    per = plan.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert per["target"].sum() == pytest.approx(per["size"].sum())
    assert (per["target"] <= 3 * per["size"] + 1e-6).all() and (plan["taken"] <= 3 * plan["size"]).all()
    assert abs(per["taken"].sum() / per["target"].sum() - 1) < 0.1
    assert mixing.plan_mix(docs).exceptAll(mixing.plan_mix(docs)).isEmpty()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = {r["doc_id"]: r["n_copies"] for r in plan.to_dict("records") if r["n_copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_rows_of_one_id_have_coins_of_their_own(spark):
    """Null ids, one id for all rows, and rows that are equal: words taken come near the targets, and agree on a rerun."""
    for ids, text in (("null", "concat('w ', cast(id as string), repeat(' x', 8))"), ("7", "concat('w ', cast(id as string), repeat(' x', 8))"), ("null", "repeat('w ', 10)")):
        docs = spark.range(4000).selectExpr(f"cast({ids} as long) as doc_id", f"{text} as text", "if(id % 2 = 0, 'a', 'b') as source", "'mine' as _row", "1 as _coin")
        per = mixing.plan_mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
        assert len(per) == 2 and all(abs(r["taken"] / r["target"] - 1) < 0.1 for r in per)
        assert mixing.plan_mix(docs).exceptAll(mixing.plan_mix(docs)).isEmpty()
        mixed = mixing.mix(docs)
        assert mixed.columns == docs.columns
        words = {r["source"]: 10 * r["count"] for r in mixed.groupBy("source").count().collect()}
        assert all(abs(words[r["source"]] / r["target"] - 1) < 0.1 for r in per)


CLASHES = ("_key", "_entry", "_bucket", "_shard", "_mix_source", "_mix_rate", "_mix_copy", "_row", "row", "key", "bytes", "entry", "bucket", "_coin", "_source", "_rate", "_twin", "_own")


def test_names_of_helper_columns_may_occur(spark):
    docs = table(spark, SMALL, "documents").withColumns({c: F.lit(f"mine {c}") for c in CLASHES})
    mixed, shards = mixing.mix(docs), sharding.shard(docs, 3000)
    assert mixed.columns == docs.columns and shards.columns == [*docs.columns, "shard", "shard_bytes"]
    for out in (mixed, shards):
        assert all(r[c] == f"mine {c}" for r in out.limit(50).collect() for c in CLASHES)
    assert shards.drop("shard", "shard_bytes").exceptAll(docs).isEmpty()


@pytest.mark.parametrize("limit", [3000, 40_000])
def test_a_large_directory_is_joined_with_keys_only(spark, limit):
    docs = table(spark, MIDDLE, "documents")
    want = sharding.shard(docs, limit)
    got = sharding.shard(docs, limit, broadcast_entries=0)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_a_small_source_is_full_and_its_excess_shared(spark):
    rows = [(i, "w " * 10, "en", f"s{i % 3}") for i in range(300)] + [(999, "w " * 5, "en", None)]
    t = {r["source"]: r["target"] for r in mixing.source_targets(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
            "source", "cast(size(split(trim(text), ' ')) as long) as size")).collect()}
    assert t[None] == 15 and t["s0"] == pytest.approx((3005 - 15) / 6) and t["s2"] == pytest.approx((3005 - 15) / 2)


@pytest.mark.parametrize("limit", [3000, 40_000, 10 ** 9])
def test_shards_fit(spark, limit):
    docs = table(spark, MIDDLE, "documents")
    out = sharding.shard(docs, limit).toPandas()
    assert len(out) == docs.count()
    per = out.groupby("shard").agg(bytes=("shard_bytes", "sum"), rows=("doc_id", "count"))
    assert ((per["bytes"] <= limit) | (per["rows"] == 1)).all()
    names = sorted(per.index)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    # A bucket only splits if it has to: two neighbours would not fit together.
    half = out.assign(parent=out["shard"].str[:-1]).groupby("parent")["shard_bytes"].sum()
    assert (half[[n[:-1] for n in names if n]] > 0).all()
    for n in names:
        if n:
            assert out[out["shard"].str.startswith(n[:-1])]["shard_bytes"].sum() > limit
    assert differences(sharding.shard_digest(docs, limit), duck(MIDDLE), sharding.digest_sql(limit, 24)) is None


def test_rows_of_one_id_are_told_apart(spark):
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    per = sharding.shard(docs.repartition(4), 5000).groupBy("shard").agg(F.sum("shard_bytes").alias("b")).collect()
    assert sum(r["b"] for r in per) == 200_000 and max(r["b"] for r in per) <= 5000
