"""Session helpers: the shared folder for intermediate tables, and a local test session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables of this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without the setting
    gets a temporary folder of its own.
    """
    app = spark.sparkContext.applicationId
    if app in _LOCAL_SCRATCH:
        return _LOCAL_SCRATCH[app]
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/marketloom/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_SCRATCH.setdefault(app, tempfile.mkdtemp(prefix="marketloom-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written once to the shared folder, lineage cut."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(
            spark.conf.get("spark.checkpoint.dir", None) or f"{scratch_root(spark)}/checkpoints"
        )
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Small tables are still read by all cores.
        .config("spark.sql.files.minPartitionNum", str(2 * int(cores) if str(cores).isdigit() else 16))
        # The JVM never compiles a method above 8000 bytes of bytecode; wide Silver projections
        # run faster as split methods than as one huge one that is interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Tables of a daily run are built next to each other, each in a pool of its own.
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
