"""The folder that all executors share: tables that cut lineage, and files of bytes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillframe.llm.words import U, mix
from rillframe.session import own, settled, shared_dir

TASK_BYTES = 32 * 1024 * 1024
MARK_BITS, MARK_KEYS = 1 << 23, 1 << 19  # of a file of marks
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

__all__ = ["settled", "released", "shared_dir", "new_folder", "put", "get", "parts_for", "lean", "few", "among", "free", "wrapped", "unwrapped"]


def released(df: DataFrame) -> DataFrame:
    """``settled``, and what was shuffled for it leaves the disk as soon as it is written.

    Without that, it stays until the driver happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return settled(df)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def new_folder(spark: SparkSession, kind: str) -> str:
    """The address of a folder of its own in the shared folder; it need not exist yet."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def _place(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address) if urlparse(address).scheme else (fs.LocalFileSystem(), address)


def put(address: str, pieces) -> None:
    """Write a file as a whole: under another name first, so that a task that is run again leaves no half file."""
    system, path = _place(address)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for piece in pieces:
            out.write(piece)
    system.move(own, path)


def get(address: str) -> pa.Buffer:
    """The bytes of a file, mapped into memory where the file system allows it."""
    system, path = _place(address)
    if isinstance(system, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with system.open_input_file(path) as file:
        return file.read_buffer()


def parts_for(df: DataFrame, column: str = "text", per_task: int = TASK_BYTES) -> int:
    """Tasks for a shuffle of ``df``: one for each ``per_task`` bytes of ``column``, as many as the session's at least."""
    total = df.agg(F.sum(F.octet_length(column))).collect()[0][0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / per_task))


def lean(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, whatever else the table has.

    Texts are long, and a batch for Python lies outside the heap in whole: where the session still has Spark's own
    10,000 rows for a batch, it gets BATCH_ROWS.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == "10000":
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    return df.select(*[F.col(f"`{c}`") for c in columns])


def few(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df``, a written table of a few numbers a row, marked for broadcast if it has ``rows`` at most."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _marks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = mix(keys.view(U))
    return mixed & U(MARK_BITS - 1), mixed >> U(32) & U(MARK_BITS - 1)


def among(df: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column``, a hash, is among that of ``wanted``, a written table, and one in 70 of the others at most.

    Nothing is shuffled but the hashes of ``wanted``: two bits of each are marked in files of the shared folder, which
    every task maps into memory.
    """
    spark, folder = df.sparkSession, own(new_folder(df.sparkSession, "marks"))
    files = max(1, math.ceil(wanted.count() / MARK_KEYS))

    def mark(frame: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(MARK_BITS, bool)
        for at in _marks(frame[column].to_numpy(np.int64)):
            flags[at] = True
        put(f"{folder}/{frame['file'].iloc[0]}", [np.packbits(flags).tobytes()])
        return frame[["file"]].head(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(get(f"{folder}/{k}"), np.uint8) for k in range(files)]
        for batch in batches:
            keys = batch.column(column).to_numpy()
            keep = np.zeros(len(keys), bool)
            for k in np.unique(keys % files).tolist():
                mine = np.flatnonzero(keys % files == k)
                one, two = ((held[k][at >> U(3)] >> (U(7) - (at & U(7))).astype(np.uint8)) & 1 for at in _marks(keys[mine]))
                keep[mine] = (one & two).astype(bool)
            yield batch.filter(pa.array(keep))

    # a row for each file, so that one without a hash is written too
    asked = wanted.select(column, F.pmod(column, F.lit(files)).cast("long").alias("file")).union(spark.range(files).select(F.lit(0).cast("long"), "id"))
    asked.groupBy("file").applyInPandas(mark, "file long").count()
    return df.mapInArrow(run, df.schema)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from all columns of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def wrapped(df: DataFrame, *shown: str) -> DataFrame:
    """The columns ``shown``, and all others inside one column ``row``: nothing that is added can take their names."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in shown]
    return df.select(*[F.col(f"`{c}`") for c in shown], F.struct(*others or [F.lit(None).cast("int").alias("none")]).alias("row"))


def unwrapped(df: DataFrame, columns: list[str], *shown: str) -> DataFrame:
    """The columns of a wrapped table again."""
    return df.select(*[F.col(f"`{c}`") if c in shown else F.col("row").getField(c).alias(c) for c in columns])
