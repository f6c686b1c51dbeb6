"""The command line over a few raw files, its exit statuses, scan modes and the export's manifest."""

import pytest

from marketloom.__main__ import main
from marketloom.plans.graph import damaged_files, export_graph, load_ontology, read_manifest
from marketloom.sources import bronze as B


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "reason.dat").write_text("1|A|a\n2|B|b\n")
    (folder / "income_band.dat").write_text("1|0|10\n")
    return folder


def test_load_and_profile(spark, raw, tmp_path, capsys):
    wh = str(tmp_path / "wh")
    assert main(["load", wh, str(raw), "reason", "income_band"]) == 0
    assert "reason: success, 2 rows" in capsys.readouterr().out
    assert main(["load", wh, str(raw), "reason", "nope"]) == 2 and "nope" in capsys.readouterr().err
    assert main(["profile", str(raw), "reason", "income_band"]) == 0 and main(["profile", str(raw), "item"]) == 1
    (raw / "reason.dat").write_text("1|A\n")
    assert main(["load", wh, str(raw), "reason"]) == 1
    assert main(["daily", wh, str(raw)]) == 1 and "failed" in capsys.readouterr().out
    with pytest.raises(SystemExit) as wrong:
        main(["nothing"])
    assert wrong.value.code == 2


def test_quarantine(spark, raw, wh):
    (raw / "reason.dat").write_text("1|A|a\n" * 98 + "x|y\n\n")
    with pytest.raises(Exception, match="expected 3 fields"):
        B.load_table(wh, str(raw), "reason")
    with pytest.raises(ValueError, match="2 of 100 lines"):
        B.load_table(wh, str(raw), "reason", mode="quarantine")
    assert not wh.exists("bronze", "reason")
    done = B.load_table(wh, str(raw), "reason", mode="quarantine", max_bad_share=0.02)
    assert done.rows_loaded == 98 == wh.read("bronze", "reason").count()
    bad = wh.read("bronze", "reason__bad_lines").collect()
    assert sorted((r["line"], r["fields"]) for r in bad) == [("", 1), ("x|y", 2)] and all(r["file"].endswith("reason.dat") for r in bad)
    with pytest.raises(ValueError, match="unknown mode"):
        B.read_bronze(spark, str(raw), "reason", "skip")


def test_export_files_are_bounded_ordered_and_checked(spark, tmp_path):
    onto = load_ontology()
    nodes = spark.range(1, 2501).selectExpr("id AS node_id", "'Reason' AS class_name", "id AS source_sk", "'n' AS natural_id", "'l' AS label", "'{}' AS properties")
    edges = spark.createDataFrame([], "from_node_id long, to_node_id long, relationship_name string, properties string")
    path = str(tmp_path / "out")
    assert {(r["kind"], r["name"]): r["n"] for r in export_graph(nodes, edges, onto, path, "full", node_batch=300).collect()} == {("nodes", "Reason"): 2500}
    files = sorted(read_manifest(spark, path).collect(), key=lambda r: r["first"])
    assert max(r["rows"] for r in files) <= 300 and sum(r["rows"] for r in files) == 2500
    assert all(a["last"] < b["first"] for a, b in zip(files, files[1:], strict=False))
    assert damaged_files(spark, path).count() == 0
    victim = tmp_path / "out" / "nodes" / "Reason" / files[0]["file"]
    victim.write_text(victim.read_text().replace('"l"', '"x"', 1))
    crc = victim.with_name(f".{victim.name}.crc")
    if crc.exists():
        crc.unlink()
    assert [r["file"] for r in damaged_files(spark, path).collect()] == [files[0]["file"]]
