"""Session defaults and the folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}

# State needs RocksDB for event-time timers; ledger times are UTC throughout.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cpus: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session for tests and bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> None:
    """Session settings that results depend on: UTC, and a state store with timers."""
    for key in ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(key, SETTINGS[key])


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir``. Only a local session may fall back to a temporary folder, one per
    application: on a cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="ledgerline-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_folder(spark: SparkSession) -> str:
    """A fresh folder name under the work folder."""
    return f"{work_dir(spark)}/stored/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the work folder and read back.

    Cuts the lineage of iterative operators. Unlike cached blocks the files outlive any executor,
    and the planner knows their size.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that a finished step of this package wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
