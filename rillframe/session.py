"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITION_BYTES = 128 * 1024 * 1024
MAX_PARTITIONS = 50_000
_BYTES: dict[str, int] = {}
_SETTLED: list[str] = []


def local_session(cpus: int = 8, memory: str = "12g", shared: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rillframe")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def fit_shuffles(spark: SparkSession, folder: str) -> None:
    """Start shuffles with enough partitions for the tables in ``folder``.

    Adaptive plans merge partitions that turn out small but cannot split one
    that does not fit into memory, so the start is sized by the bytes on disk.
    Only file lengths are read, once per folder.
    """
    if folder not in _BYTES:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        _BYTES[folder] = files.agg(F.sum("length")).collect()[0][0] or 0
    wanted = min(MAX_PARTITIONS, -(-_BYTES[folder] // PARTITION_BYTES))
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    else:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def pin(spark: SparkSession) -> SparkSession:
    """Fix the settings that results depend on: zone, strict casts, adaptive plans."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder;
    on a cluster a missing setting is an error, since a machine-local folder
    would be lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rillframe-"))
    return context.getCheckpointDir()


def exists(spark: SparkSession, address: str) -> bool:
    """Whether a file or folder is there, on whatever file system the address names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(address)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def remove(spark: SparkSession, address: str) -> None:
    """Delete a file or folder with all that is in it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(address)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def own(address: str) -> str:
    """Enter a folder of this process for ``forget``; gives it back."""
    _SETTLED.append(address)
    return address


def forget(spark: SparkSession) -> None:
    """Delete what this process has written to the shared folder; results that still read it must be written before."""
    while _SETTLED:
        remove(spark, _SETTLED.pop())


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``: write it once to the shared folder and read it back.

    A lost executor then re-reads files instead of recomputing all earlier
    steps, and the planner knows the size of the result.
    """
    path = own(f"{shared_dir(df.sparkSession)}/settled/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
