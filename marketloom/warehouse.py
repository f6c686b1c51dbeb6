"""Layered Parquet warehouse: <root>/<layer>/<name>/<snapshot>.

A table is what its newest commit says. Commits are small files with consecutive numbers in
``_commits``; each lists the folders of the table. A commit is made by creating the file with the next
number, which fails if another writer was faster; the writer then reads the newer commit and
adds to that. So no commit is lost, readers see whole commits only, and a job may read the table that
it replaces. Only folders that an older commit listed and newer ones don't are ever deleted: a folder
that is still being written is never touched, and no clock is trusted. No data is renamed.

A replaced table keeps its last snapshots. A log table is a list of batches: appending a batch whose
name is listed already changes nothing, so an append may be repeated. Many small batches are merged.

A Silver table holds clean and rejected rows in the same files. ``dim_item`` names the clean rows,
``dim_item__anomalies`` the rejected ones with their raw text and reasons.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.files import Files
from marketloom.session import new_folder
from marketloom.specs import SILVER_NAMES, TABLES, bronze_schema, silver_schema

ANOMALIES = "__anomalies"
LAYERS = ("bronze", "silver", "gold", "graph", "ops")
#: Columns of tables that lie in buckets; readers don't see them.
VERSION, BUCKET, ROW_HASH = "_version", "_bucket", "_row_hash"
KEEP_COMMITS = 10
#: Of tables: a warehouse writes all its layers, and Snappy takes a good deal more. Pages of version 2 keep whole
#: numbers as differences of few bits. A column with more distinct values than fit a small dictionary is written without one: looking
#: each value up in a large one takes longer than all else of a write, and saved nothing on the facts of the test bed.
PARQUET = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.dictionary.page.size": str(32 << 10)}
MERGE_BATCHES = 64  # a log of more batches is merged
REMEMBERED = 1000  # names of merged batches that are still known


@dataclass(frozen=True)
class Commit:
    """Folders of a table, newest first, with the batch each holds (none for a snapshot); batches that
    were merged, and folders that the next merge may delete."""

    number: int = 0
    folders: tuple[tuple[str, str], ...] = ()
    merged: tuple[str, ...] = ()
    stale: tuple[str, ...] = ()

    def text(self) -> str:
        lines = [f"folder\t{f}\t{b}" for f, b in self.folders]
        return "\n".join(lines + [f"merged\t{b}" for b in self.merged] + [f"stale\t{f}" for f in self.stale])

    @staticmethod
    def parse(number: int, text: str) -> "Commit":
        rows = [line.split("\t") for line in text.split("\n")]
        return Commit(number, tuple((r[1], r[2]) for r in rows if r[0] == "folder"),
                      tuple(r[1] for r in rows if r[0] == "merged"), tuple(r[1] for r in rows if r[0] == "stale"))

    def holds(self, batch: str) -> bool:
        return batch in self.merged or any(b == batch for _, b in self.folders)


@dataclass(frozen=True)
class Written:
    """A written table: its folder, its rows and what else was counted while they were written."""

    path: str
    rows: int
    metrics: Mapping[str, object] = field(default_factory=dict)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.files = Files(spark)

    # -- names ---------------------------------------------------------------------------------
    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; known: {', '.join(LAYERS)}")
        return f"{self.root}/{layer}/{name}"

    def snapshot_path(self, layer: str, name: str) -> str:
        """Folder of the current snapshot."""
        found = self.folders(layer, name)
        if not found:
            raise FileNotFoundError(f"no table {layer}.{name} in {self.root}")
        return found[0]

    def folders(self, layer: str, name: str) -> list[str]:
        """Folders of a table by its newest commit."""
        return [f"{self.path(layer, name)}/{f}" for f, _ in self.newest(layer, name).folders]

    def newest(self, layer: str, name: str) -> Commit:
        """What a table consists of; nothing if there is none."""
        commit = self._newest(self.path(layer, name))
        return commit if not commit.folders or commit.folders[0][1] else replace(commit, folders=commit.folders[:1])

    def exists(self, layer: str, name: str) -> bool:
        return bool(self._newest(self.path(layer, name)).folders)

    def tables(self, layer: str) -> list[str]:
        names = [n for n in self.files.names(f"{self.root}/{layer}") if self.exists(layer, n)]
        return sorted(names + [n + ANOMALIES for n in names if self._is_split(layer, n)])

    def _is_split(self, layer: str, name: str) -> bool:
        """Whether the table holds clean and rejected rows."""
        return layer == "silver" and name in SILVER_NAMES

    # -- data ----------------------------------------------------------------------------------
    def read(self, layer: str, name: str) -> DataFrame:
        table = name.removesuffix(ANOMALIES)
        if not self._is_split(layer, table):
            if layer == "bronze" and name in TABLES:
                return self.spark.read.schema(bronze_schema(name)).parquet(self.snapshot_path(layer, name))
            return self.read_folders(self.path(layer, name), [f for f, _ in self.newest(layer, name).folders])
        raw, clean = SILVER_NAMES[table], silver_schema(SILVER_NAMES[table])
        schema = T.StructType([
            *clean.fields, T.StructField("raw", bronze_schema(raw)),
            T.StructField("anomaly_reasons", T.ArrayType(T.StringType())), T.StructField("is_anomaly", T.BooleanType())])
        rows = self.spark.read.schema(schema).parquet(self.snapshot_path(layer, table))
        if table == name:
            return rows.filter(~F.col("is_anomaly")).select(*clean.names)
        return rows.filter(F.col("is_anomaly")).select("raw.*", "anomaly_reasons")

    def read_folders(self, base: str, folders: Sequence[str], hidden: bool = False) -> DataFrame:
        """Some folders of a table as one frame, with its partition columns."""
        if not folders:
            raise FileNotFoundError(f"no table at {base}")
        if not folders[0].startswith(f"{VERSION}="):
            return self.spark.read.parquet(*[f"{base}/{f}" for f in folders])
        rows = self.spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
        return rows.drop(VERSION) if hidden else rows.drop(VERSION, BUCKET, ROW_HASH)

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """The frame, written once to the shared scratch folder."""
        path = new_folder(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write(
        self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), metrics: Mapping[str, Column] | None = None,
        sort_by: Sequence[str] = (), options: Mapping[str, str] | None = None,
    ) -> Written:
        """Replace a whole table. Its rows, and the aggregates in ``metrics``, are counted while it is
        written: nothing is read again for them.

        With ``sort_by`` the table is dealt in ranges of these columns and sorted by them in every file
        (NULL first). Readers of a key range skip files and row groups, and an aggregate by the first
        column shuffles about a row per key. Further columns split a value that many rows hold. It
        costs a shuffle of the rows, and a first pass over them that finds the ranges. ``options`` are those
        of the Parquet writer.
        """
        if sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*partition_by, *sort_by)
        base = self.path(layer, name)
        snapshot = f"v-{uuid.uuid4().hex}"
        observed = Observation()
        writer = df.observe(observed, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()]).write.mode("error").options(
            **PARQUET, **(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.parquet(f"{base}/{snapshot}")
        except Exception:
            self.files.delete(f"{base}/{snapshot}")
            raise
        found = dict(observed.get)
        self._switch(base, snapshot)
        return Written(f"{base}/{snapshot}", found.pop("rows", 0), found)

    def write_parts(self, parts: Mapping[str, DataFrame], layer: str, name: str, column: str, threads: int = 4) -> Written:
        """Replace a whole table that comes as a frame per value of ``column``, with the layout that
        ``write`` gives it by ``partition_by``. That one sorts the rows of every task by the column, which takes
        memory (or disk) for all of them; here each frame goes to its folder as it comes."""
        base, snapshot = self.path(layer, name), f"v-{uuid.uuid4().hex}"

        def put(part: tuple[str, DataFrame]) -> int:
            value, df = part
            observed = Observation()
            df.drop(column).observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("error").options(**PARQUET).parquet(
                f"{base}/{snapshot}/{column}={value}")
            return observed.get["rows"]

        try:
            with ThreadPoolExecutor(threads) as pool:
                rows = sum(pool.map(inheritable_thread_target(self.spark)(put), parts.items()))
        except Exception:
            self.files.delete(f"{base}/{snapshot}")
            raise
        self._switch(base, snapshot)
        return Written(f"{base}/{snapshot}", rows)

    def append(self, df: DataFrame, layer: str, name: str, batch: str | None = None) -> bool:
        """Add rows to a log-like table as a batch. A batch of a name that was added already, by this
        or another writer, is left out; then the answer is False."""
        base, batch, folder = self.path(layer, name), batch or uuid.uuid4().hex, f"b-{uuid.uuid4().hex}"
        if self._newest(base).holds(batch):
            return False
        df.write.mode("error").parquet(f"{base}/{folder}")
        commit = self.commit(base, lambda old: None if old.holds(batch) else replace(old, folders=((folder, batch), *old.folders)))
        if commit is None:
            self.files.delete(f"{base}/{folder}")
            return False
        if len(commit.folders) > MERGE_BATCHES:
            self._merge(base, commit)
        return True

    def next_number(self, name: str) -> int:
        """1, 2, 3, … over all writers of the warehouse, whatever their clocks say."""
        return self.commit(f"{self.root}/numbers/{name}", lambda old: old).number

    def register_views(self, *layers: str) -> list[str]:
        """Temp views ``<layer>_<table>`` for SQL users."""
        made = []
        for layer in layers or LAYERS:
            for name in self.tables(layer):
                self.read(layer, name).createOrReplaceTempView(f"{layer}_{name}")
                made.append(f"{layer}_{name}")
        return made

    # -- commits ---------------------------------------------------------------------------------
    def size_bytes(self, path: str) -> int:
        return self.files.size(path)

    def _newest(self, base: str) -> Commit:
        """The newest commit; commits that vanish while they are looked for are older ones."""
        while True:
            numbers = [n for n in self.files.names(f"{base}/_commits") if n.isdigit()]
            if not numbers:
                return Commit()
            text = self.files.read(f"{base}/_commits/{numbers[-1]}")
            if text is not None:
                return Commit.parse(int(numbers[-1]), text)

    def commit(self, base: str, change) -> Commit | None:
        """Add the commit that ``change`` makes of the newest one, again if another writer was faster;
        None if it makes none."""
        while True:
            old = self._newest(base)
            new = change(old)
            if new is None:
                return None
            new = replace(new, number=old.number + 1)
            if self.files.create_new(f"{base}/_commits/{new.number:020d}", new.text()):
                self.files.delete(f"{base}/_commits/{new.number - KEEP_COMMITS:020d}")
                return new

    def _switch(self, base: str, snapshot: str) -> None:
        dropped: list[str] = []

        def change(old: Commit) -> Commit:
            names = [snapshot, *(f for f, _ in old.folders if f != snapshot)]
            dropped[:] = names[self.keep:]
            return Commit(folders=tuple((n, "") for n in names[:self.keep]))

        self.commit(base, change)
        for name in dropped:
            self.files.delete(f"{base}/{name}")

    def _merge(self, base: str, seen: Commit) -> None:
        """One folder in place of many; those are deleted by the next merge, when no reader of the old
        commit is left."""
        folder, parts = f"b-{uuid.uuid4().hex}", dict(seen.folders)
        self.spark.read.parquet(*[f"{base}/{f}" for f in parts]).coalesce(1).write.mode("error").parquet(f"{base}/{folder}")
        gone: list[str] = []

        def change(old: Commit) -> Commit | None:
            if not set(parts) <= {f for f, _ in old.folders}:
                return None  # merged by another writer
            gone[:] = old.stale
            left = tuple(x for x in old.folders if x[0] not in parts)
            return Commit(folders=(*left, (folder, folder)), merged=(*parts.values(), *old.merged)[:REMEMBERED], stale=tuple(parts))

        if self.commit(base, change) is None:
            gone = [folder]
        for name in gone:
            self.files.delete(f"{base}/{name}")
