"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillframe.functions.values import draw
from rillframe.plans import Lineup
from rillframe.session import exists, remove


def counter(spark: SparkSession, rows_per_batch: int = 1000) -> DataFrame:
    """1, 2, 3, ... without end, at most ``rows_per_batch`` per micro-batch."""
    rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    return rows.select((F.col("value") + 1).alias("x"), "timestamp")


def random_numbers(spark: SparkSession, bound: int, seed: int, rows_per_batch: int = 1000) -> DataFrame:
    """Whole numbers in [0, bound) without end; the same seed gives the same numbers."""
    rows = counter(spark, rows_per_batch)
    return rows.select("x", draw(F.col("x"), bound, seed).alias("draw"))


def landing(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000,
            names: str = "*.parquet") -> DataFrame:
    """Files that outside writers push into a folder.

    ``files_per_batch`` bounds each micro-batch: a slow consumer leaves files
    waiting in the folder instead of filling memory.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("pathGlobFilter", names).parquet(folder)


def table_files(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of them; it must be there."""
    files = spark.read.schema(schema).parquet(path).inputFiles()
    name = path.rstrip("/").rpartition("/")
    if len(files) == 1 and files[0].rstrip("/").rpartition("/")[2] == name[2]:
        return landing(spark, name[0], schema, files_per_batch, names=name[2])
    return landing(spark, path, schema, files_per_batch)


def timed(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Event time for watermarks, which need a timestamp with zone."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def sourced(stream: DataFrame, name: str = "_file") -> DataFrame:
    """A stream of files with the file of each row."""
    return stream.select("*", F.col("_metadata.file_path").alias(name))


class Bounded:
    """A place that outside writers push rows into, of which the newest ``n`` wait at most: older ones are dropped.

    Every push numbers its rows on from those before and enters their numbers in a manifest; every take enters up to where
    it has read. What waits are the rows behind the last take, the newest ``n`` of them; what is older and was not
    taken is evicted, and counted. Files that hold only such rows are deleted by ``evict``.
    """

    def __init__(self, folder: str, rows: T.StructType, order: list[str], n: int):
        self.data, self.pushes, self.takes = f"{folder}/data", f"{folder}/pushes", f"{folder}/takes"
        self.rows, self.order, self.n = rows, order, n

    def _entries(self, spark: SparkSession, folder: str) -> list:
        """(number, first, end) of the pushes, or (number, start, end) of the takes, in order."""
        if not exists(spark, folder):
            return []
        return sorted(tuple(r) for r in spark.read.parquet(folder).select("number", "first", "end").collect())

    def _enter(self, spark: SparkSession, folder: str, number: int, first: int, end: int) -> None:
        entry = spark.createDataFrame([(number, first, end)], "number bigint, first bigint, end bigint")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{folder}/entry={number}")

    def push(self, df: DataFrame) -> None:
        """Append rows, in ``order``; readers see them once they are in the manifest."""
        spark = df.sparkSession
        before = self._entries(spark, self.pushes)
        number, first = len(before), before[-1][2] if before else 0
        placed = Lineup.of(df.select(*self.rows.names), [], self.order).numbered("_seq").rows()
        path = f"{self.data}/push={number}"
        placed.withColumn("_seq", F.col("_seq") + first).write.mode("overwrite").parquet(path)
        self._enter(spark, self.pushes, number, first, first + spark.read.schema("_seq bigint").parquet(path).count())

    def _window(self, spark: SparkSession) -> tuple[int, int, int]:
        """Up to where was taken, where what waits begins, and where it ends."""
        pushes, takes = self._entries(spark, self.pushes), self._entries(spark, self.takes)
        end, taken = pushes[-1][2] if pushes else 0, takes[-1][2] if takes else 0
        return taken, max(taken, end - self.n), end

    def waiting(self, spark: SparkSession) -> DataFrame:
        """The rows that wait, with their number in ``_seq``. Only the pushes that have some are read."""
        _, start, end = self._window(spark)
        schema = T.StructType([*self.rows.fields, T.StructField("_seq", T.LongType())])
        paths = [f"{self.data}/push={number}" for number, first, last in self._entries(spark, self.pushes) if last > start and first < last]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths).filter(F.col("_seq").between(start, end - 1))

    def take(self, spark: SparkSession) -> DataFrame:
        """All that waits; it does not wait any more."""
        _, start, end = self._window(spark)
        rows = self.waiting(spark)
        self._enter(spark, self.takes, len(self._entries(spark, self.takes)), start, end)
        return rows

    def evicted(self, spark: SparkSession) -> int:
        """How many rows were dropped so far: before takes, and before what waits now."""
        taken, start, _ = self._window(spark)
        ends = [0, *(end for _, _, end in self._entries(spark, self.takes))]
        return start - taken + sum(first - end for end, (_, first, _) in zip(ends, self._entries(spark, self.takes)))

    def evict(self, spark: SparkSession) -> None:
        """Delete the files that hold nothing that waits; rows that a take gave out must have been used."""
        _, start, _ = self._window(spark)
        for number, _, last in self._entries(spark, self.pushes):
            if last <= start:
                remove(spark, f"{self.data}/push={number}")
