"""Bronze: pipe-delimited text files, read as all-text tables and loaded by full refresh."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.specs import TABLES, bronze_schema, spec_of
from marketloom.warehouse import Warehouse

# --- fixed values: the file format ------------------------------------------------------------
DELIMITER = "|"
# --- end of fixed values ----------------------------------------------------------------------
#: Columns of numbers as text have few repeats that lie close together: larger pages and a higher level find more of them.
TEXT_PAGES = {"parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(4 << 20), "parquet.page.row.count.limit": "200000"}


@dataclass(frozen=True)
class LoadStats:
    table_name: str
    started_at: datetime
    ended_at: datetime
    rows_loaded: int
    bytes_loaded: int
    duration_s: float
    status: str
    error_message: str | None = None
    null_keys: int | None = None  # of the table's key, counted in the write


def file_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{spec_of(table).file}"


def read_bronze(spark: SparkSession, folder: str, table: str, mode: str = "abort") -> DataFrame:
    """Scan one raw file: no header, empty field is NULL, quotes are data.

    A line with another number of fields than the table has columns, a blank line too, stops the
    job, whichever columns are read; with ``mode="quarantine"`` it is left out (see ``bad_lines``).
    """
    if mode not in ("abort", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}; known: abort, quarantine")
    names = spec_of(table).columns
    # A line is split in a step of its own, at an escaped character, which needs no pattern. ``get`` has no code that raises for
    # a place outside the array: with that code the step of a wide table was too long for the JVM to compile.
    fields = F.col("_split")
    checked = F.when(F.size(fields) == len(names), fields).otherwise(F.raise_error(F.concat(
        F.lit(f"{table}: expected {len(names)} fields, found "), F.size(fields).cast("string"), F.lit(" in line: "), "value")))
    lines = spark.read.text(file_path(folder, table)).select("value", F.split("value", f"\\{DELIMITER}", -1).alias("_split"))
    if mode == "quarantine":
        lines = lines.filter(F.size(fields) == len(names))
    lines = lines.select(checked.alias("_fields"))
    value = lambda i: F.get("_fields", F.lit(i))
    return lines.select(*[F.when(value(i) != "", value(i)).alias(c) for i, c in enumerate(names)])


def bad_lines(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """file, line, fields: the lines with another number of fields than the table has columns. A blank
    line has one field."""
    fields = F.size(F.split("value", f"[{DELIMITER}]", -1))
    lines = spark.read.text(file_path(folder, table)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), fields.alias("fields"))
    return lines.filter(F.col("fields") != len(spec_of(table).columns))


def write_raw(df: DataFrame, folder: str, table: str, compression: str = "none", lines_per_file: int = 0) -> None:
    """Write an all-text frame in the raw file format (a folder of part files). A compressed file is read by
    one task, so give it a bound of lines (0: none). Gzip is of level 4: the usual 6 takes twice the time and saves little."""
    line = F.concat_ws(DELIMITER, *[F.coalesce(F.col(c), F.lit("")) for c in spec_of(table).columns])
    df.select(line.alias("value")).write.mode("error").option("maxRecordsPerFile", lines_per_file).option(
        "zlib.compress.level", "FOUR").text(file_path(folder, table), compression=compression)


def check_tables(tables: list[str] | None) -> list[str]:
    """The tables to load; unknown names are an error."""
    chosen = list(tables or TABLES)
    unknown = [t for t in chosen if t not in TABLES]
    if unknown:
        raise ValueError(f"unknown table(s): {', '.join(unknown)}; known: {', '.join(TABLES)}")
    return chosen


def load_table(wh: Warehouse, folder: str, table: str, mode: str = "abort", max_bad_share: float = 0.01) -> LoadStats:
    """Replace one Bronze table; a bad line leaves the old table in place. Rows and missing keys are
    counted in the write.

    With ``mode="quarantine"`` bad lines become the table ``<table>__bad_lines``; more of them than
    ``max_bad_share`` of all lines fail the load, and the old table stays.
    """
    started, clock = datetime.now(timezone.utc), time.perf_counter()
    size = wh.size_bytes(file_path(folder, table))
    key = spec_of(table).pk
    counted = {"null_keys": F.count_if(F.col(key).isNull())} if key else {}
    if mode == "quarantine":
        bad = wh.write(bad_lines(wh.spark, folder, table), "bronze", f"{table}__bad_lines").rows
        lines = wh.spark.read.text(file_path(folder, table)).count() if bad else 0
        if bad > max_bad_share * lines:
            raise ValueError(f"{table}: {bad} of {lines} lines don't have {len(spec_of(table).columns)} fields")
    done = wh.write(read_bronze(wh.spark, folder, table, mode), "bronze", table, metrics=counted, options=TEXT_PAGES)
    return LoadStats(table, started, datetime.now(timezone.utc), done.rows, size, time.perf_counter() - clock, "success",
                     null_keys=done.metrics.get("null_keys", 0) if key else None)


def failed_load(table: str, started: datetime, exc: Exception) -> LoadStats:
    return LoadStats(table, started, datetime.now(timezone.utc), 0, 0, 0.0, "failed", f"{type(exc).__name__}: {exc}")


def load_bronze(
    wh: Warehouse, folder: str, tables: list[str] | None = None, on_error: str = "stop", threads: int = 1
) -> list[LoadStats]:
    """Load tables; the first failure is recorded and no further load begins.

    Tables are begun in order, ``threads`` of them next to each other; loads that had begun before
    another one failed are ended and recorded.
    """
    chosen = check_tables(tables)
    done: dict[str, LoadStats] = {}
    failed = Event()

    def load(table: str) -> None:
        if failed.is_set():
            return
        started = datetime.now(timezone.utc)
        try:
            done[table] = load_table(wh, folder, table)
        except Exception as exc:  # recorded, then reported by the caller
            failed.set()
            if on_error == "raise":
                raise
            done[table] = failed_load(table, started, exc)

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(inheritable_thread_target(wh.spark)(load), chosen))
    return [done[t] for t in chosen if t in done]


def tables_loaded(stats: list[LoadStats], in_daily_run: bool = False) -> int:
    """Tables counted as loaded; the daily run reports 0 once any load failed."""
    good = sum(s.status == "success" for s in stats)
    return 0 if in_daily_run and good < len(stats) else good


def profile_files(spark: SparkSession, folder: str, tables: list[str] | None = None) -> DataFrame:
    """Size, rows and field count of each raw file against the declared column count.

    Status is OK, MISMATCH (some line has another field count, or the file is empty) or MISSING.
    All files are read in one scan over all lines.
    """
    chosen = check_tables(tables)
    wh = Warehouse(spark, folder)
    present = [t for t in chosen if wh.files.exists(file_path(folder, t))]
    declared = spark.createDataFrame(
        [(t, spec_of(t).file, len(spec_of(t).columns), t in present,
          wh.size_bytes(file_path(folder, t)) if t in present else 0) for t in chosen],
        "table_name string, file string, decl_cols int, is_present boolean, size_bytes bigint",
    )
    lines = spark.createDataFrame([], "file string, rows bigint, min_cols int, max_cols int")
    if present:
        text = spark.read.format("text").load([file_path(folder, t) for t in present])
        fields = F.size(F.split("value", r"\|", -1))
        lines = (
            text.select(
                F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.dat)", 1).alias("file"),
                F.when(F.col("value") == "", 0).otherwise(fields).alias("n"),
            )
            .groupBy("file")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("min_cols"),
                 F.max("n").alias("max_cols"))
        )
    ok = (F.col("min_cols") == F.col("decl_cols")) & (F.col("max_cols") == F.col("decl_cols"))
    return declared.join(lines, "file", "left").select(
        "table_name", "file", "size_bytes",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("min_cols", F.lit(0)).alias("min_cols"),
        F.coalesce("max_cols", F.lit(0)).alias("max_cols"),
        "decl_cols",
        F.when(~F.col("is_present"), "MISSING")
        .when(F.coalesce(ok, F.lit(False)), "OK").otherwise("MISMATCH").alias("status"),
    )


def profile_issues(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("status") != "OK").alias("issues")
    )
