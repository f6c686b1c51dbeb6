import corpus_pipeline as P
import pytest
from helpers import EDGES, SMALL, edge_docs, empty_docs, shingles, similar_pairs, table
from test_decontamination import places

from marketloom.llm import sharding


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's result, written and read again as the runner does."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, out = table(spark, SMALL, "documents"), {}
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{k}")
        docs = out[name] = spark.read.parquet(f"{folder}/{k}")
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(spark, stages):
    columns = table(spark, SMALL, "documents").columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(stages[n].columns == columns for n, _ in P.STAGES[:-1])
    assert stages["sharding"].columns[:len(columns)] == columns


def test_stages_against_brute_force(spark, stages):
    rows = stages["toxicity"].orderBy("doc_id").collect()
    sets = [shingles(r["text"]) for r in rows]
    dropped, label = set(), list(range(len(rows)))
    for a, b in sorted(similar_pairs(sets)):
        x, y = label[a], label[b]
        label = [min(x, y) if v in (x, y) else v for v in label]
    dropped = {rows[i]["doc_id"] for i, v in enumerate(label) if v != i}
    assert ids(stages["near_duplicates"]) == sorted(r["doc_id"] for r in rows if r["doc_id"] not in dropped)
    leaks = {d for d, _ in places(stages["near_duplicates"].collect(), table(spark, SMALL, "benchmark").collect())}
    assert ids(stages["decontamination"]) == sorted(set(ids(stages["near_duplicates"])) - leaks)
    assert set(ids(stages["mixing"])) <= set(ids(stages["decontamination"]))
    assert ids(stages["sharding"]) == ids(stages["mixing"])


def test_run_gives_what_the_stages_give(spark, stages):
    out = P.run(spark, SMALL)
    assert ids(out) == ids(stages["sharding"]) and P.ORACLE_SQL is None


def test_edges(spark):
    docs, none = edge_docs(spark), empty_docs(spark)
    for _, stage in P.STAGES:
        assert stage(spark, none, SMALL).collect() == []
    kept = P.drop_near_duplicates(spark, docs, SMALL)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["1", "2", "3", "4", "5", "6", "8", "10", "11", "12", "13", "None"])
    assert P.drop_contaminated(spark, docs, SMALL).count() == len(EDGES)
    assert sharding.shard(P.mix_sources(spark, docs, SMALL), 100).count() > 0
