import pytest

from marketloom.plans.ops import load_stats_frame
from marketloom.sources import bronze as B
from marketloom.sources import sinks as S
from marketloom.specs import TABLES


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "reason.dat").write_text('1|AA|"q"x\n2||\n')
    (tmp_path / "income_band.dat").write_text("1|0|10\n2|11|20\n")
    return tmp_path


def test_scan(spark, folder):
    rows = sorted(map(tuple, B.read_bronze(spark, str(folder), "reason").collect()))
    assert rows == [("1", "AA", '"q"x'), ("2", None, None)]


@pytest.mark.parametrize("line", ["3|x", "3|x|y|z", ""])
def test_wrong_field_count_aborts(spark, folder, wh, line):
    B.load_bronze(wh, str(folder), ["reason"], on_error="raise")
    (folder / "reason.dat").write_text(f"1|a|b\n{line}\n")
    stats = B.load_bronze(wh, str(folder), ["reason", "income_band"])
    assert [s.status for s in stats] == ["failed"]  # stops at the first failure
    assert wh.read("bronze", "reason").count() == 2  # the old table is still there
    assert not wh.exists("bronze", "income_band")


def test_load_stats(spark, folder, wh):
    stats = B.load_bronze(wh, str(folder), ["income_band", "reason"])
    assert [(s.table_name, s.rows_loaded, s.bytes_loaded, s.status) for s in stats] == [
        ("income_band", 2, 15, "success"), ("reason", 2, 14, "success")]
    assert B.tables_loaded(stats) == 2
    frame = load_stats_frame(spark, 7, stats)
    assert frame.filter("run_id = 7 and rows_loaded = 2 and error_message is null").count() == 2
    (folder / "income_band.dat").write_text("5|1|1\n")  # full refresh
    B.load_bronze(wh, str(folder), ["income_band"])
    assert [tuple(r) for r in wh.read("bronze", "income_band").collect()] == [("5", "1", "1")]


def test_partial_load_counts(spark, folder, wh):
    stats = B.load_bronze(wh, str(folder), ["reason", "item", "income_band"])
    assert [s.status for s in stats] == ["success", "failed"]
    assert (B.tables_loaded(stats), B.tables_loaded(stats, in_daily_run=True)) == (1, 0)
    assert stats[1].rows_loaded == 0 and stats[1].error_message


def test_unknown_table(wh, folder):
    with pytest.raises(ValueError, match="unknown table"):
        B.load_bronze(wh, str(folder), ["nope"])


def test_profile(spark, folder):
    (folder / "ship_mode.dat").write_text("1|2|3|4|5|6\n1|2|3\n")
    (folder / "store.dat").write_text("")
    rows = {r.table_name: r for r in B.profile_files(spark, str(folder)).collect()}
    assert len(rows) == len(TABLES)
    assert (rows["reason"].status, rows["reason"].rows, rows["reason"].size_bytes) == ("OK", 2, 14)
    assert (rows["ship_mode"].status, rows["ship_mode"].min_cols, rows["ship_mode"].max_cols) == ("MISMATCH", 3, 6)
    assert (rows["store"].status, rows["item"].status) == ("MISMATCH", "MISSING")
    issues = B.profile_issues(B.profile_files(spark, str(folder))).first()
    assert (issues.files, issues.issues) == (25, 23)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None, '"'), ("2", "a b", None)], B.bronze_schema("reason"))
    B.write_raw(df, str(tmp_path / "raw"), "reason")
    assert sorted(B.read_bronze(spark, str(tmp_path / "raw"), "reason").collect()) == sorted(df.collect())


def test_merge_and_insert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, S.merge_by_key(old, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, S.insert_missing(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "C")]
    twice = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "k int, v string, s int")
    merged = S.merge_by_key(old.withColumn("s", old.k * 0), twice, ["k"], seq="s")
    assert sorted(tuple(r)[:2] for r in merged.collect()) == [(1, "a"), (2, "y")]


def test_warehouse_snapshots(spark, wh):
    for n in range(4):
        wh.write(spark.range(n + 1), "gold", "t")
    assert wh.read("gold", "t").count() == 4
    wh.write(wh.read("gold", "t").filter("id > 1"), "gold", "t")  # reads the table it replaces
    assert wh.read("gold", "t").count() == 2
    assert sum(n.startswith("v-") for n in wh.files.names(wh.path("gold", "t"))) == 2
    assert wh.tables("gold") == ["t"] and wh.register_views("gold") == ["gold_t"]
    with pytest.raises(ValueError, match="unknown layer"):
        wh.path("copper", "t")
    with pytest.raises(FileNotFoundError):
        wh.read("gold", "u")
