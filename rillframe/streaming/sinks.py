"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rillframe.session import exists

COMMIT = "rows bigint"


def _nothing(*_) -> None:
    return None


class AcknowledgedSink:
    """A sink that confirms every micro-batch before the next one starts.

    A batch is written to a folder of its own, replacing what a failed try left
    there, and is then entered in a commit table. A batch that comes again after
    a restart is skipped if it was committed. Readers see committed batches only.
    """

    def __init__(self, folder: str, on_init: Callable = _nothing, on_ack: Callable = _nothing,
                 on_complete: Callable = _nothing, on_failure: Callable = _nothing):
        self.data, self.commits, self.checkpoint = f"{folder}/data", f"{folder}/commits", f"{folder}/checkpoint"
        self.on_init, self.on_ack = on_init, on_ack
        self.on_complete, self.on_failure = on_complete, on_failure

    def start(self, spark: SparkSession) -> None:
        self.on_init()

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = f"{self.commits}/batch_id={batch_id}"
        if exists(spark, f"{done}/_SUCCESS"):  # one look, however many batches there were
            return
        path = f"{self.data}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path).count()
        spark.createDataFrame([(rows,)], COMMIT).coalesce(1).write.mode("overwrite").parquet(done)
        self.on_ack(batch_id, rows)

    def run(self, stream: DataFrame) -> None:
        """Take all that is available now, then complete."""
        self.start(stream.sparkSession)
        query = (stream.writeStream.foreachBatch(self.write).option("checkpointLocation", self.checkpoint)
                 .trigger(availableNow=True).start())
        try:
            query.awaitTermination()
        except Exception as failure:
            self.on_failure(failure)
            raise
        self.on_complete()

    def committed_ids(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{COMMIT}, batch_id bigint").parquet(self.commits)

    def committed(self, spark: SparkSession, schema: str) -> DataFrame:
        """Rows of confirmed batches; none, if no batch came."""
        if not exists(spark, self.commits):
            return spark.createDataFrame([], f"{schema}, batch_id bigint")
        rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(self.data)
        ids = self.committed_ids(spark).select("batch_id").distinct()
        return rows.join(ids, "batch_id", "left_semi")


class ReplayedSink:
    """A sink for a source that is built anew from its beginning after a fault.

    Every micro-batch writes its rows to a folder of its own and then enters the files that they came from, and how many
    rows of each, in a commit log. A source that is read again comes without checkpoint, so it brings all files again, in
    any grouping; rows of files that are in the log are skipped. A batch that failed has no entry: its rows are
    read again, and what it wrote is never seen. Streams bring the file of each row in ``SOURCE``, see ``ingest.sourced``.
    """

    SOURCE = "_file"

    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.data, self.log, self.schema = folder, f"{folder}/data", f"{folder}/log", schema

    def seen(self, spark: SparkSession) -> DataFrame:
        """(attempt, number, file, rows) of the commit log."""
        schema = f"{self.SOURCE} string, rows bigint, attempt int, number bigint"
        return spark.read.schema(schema).parquet(self.log) if exists(spark, self.log) else spark.createDataFrame([], schema)

    def write(self, batch: DataFrame, attempt: int, number: int) -> None:
        spark, place = batch.sparkSession, f"attempt={attempt}/number={number}"
        if exists(spark, f"{self.log}/{place}/_SUCCESS"):
            return
        fresh = batch.join(self.seen(spark).select(self.SOURCE).distinct(), self.SOURCE, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{self.data}/{place}")
        held = T.StructType([*self.schema.fields, T.StructField(self.SOURCE, T.StringType())])
        files = spark.read.schema(held).parquet(f"{self.data}/{place}").groupBy(self.SOURCE).agg(F.count(F.lit(1)).alias("rows"))
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.log}/{place}")

    def run(self, spark: SparkSession, source: Callable[[], DataFrame], attempts: int = 3,
            handed: Callable[[DataFrame, int, int], None] = _nothing) -> int:
        """Read the source to its end; after a fault build it anew, ``attempts`` times in all. The number of attempts.

        ``handed`` is called with every micro-batch before it is written.
        """
        first = 1 + (self.seen(spark).agg(F.max("attempt")).collect()[0][0] or 0)
        for attempt in range(first, first + attempts):

            def take(batch: DataFrame, number: int, attempt: int = attempt) -> None:
                handed(batch, attempt, number)
                self.write(batch, attempt, number)

            query = (source().writeStream.foreachBatch(take).option("checkpointLocation", f"{self.folder}/checkpoint/{attempt}")
                     .trigger(availableNow=True).start())
            try:
                query.awaitTermination()
                return attempt - first + 1
            except StreamingQueryException:
                if attempt == first + attempts - 1:
                    raise

    def committed(self, spark: SparkSession) -> DataFrame:
        """The rows of batches that are in the log."""
        held = T.StructType([*self.schema.fields, T.StructField(self.SOURCE, T.StringType()), T.StructField("attempt", T.IntegerType()), T.StructField("number", T.LongType())])
        if not exists(spark, self.log):
            return spark.createDataFrame([], self.schema)
        done = self.seen(spark).select("attempt", "number").distinct()
        return spark.read.schema(held).parquet(self.data).join(done, ["attempt", "number"], "left_semi").select(*self.schema.names)


def to_all(*consumers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Every micro-batch to every consumer; it is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for consumer in consumers:
                consumer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def land(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Append all that is available now to a folder of files, exactly once."""
    (stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def landed(stream: DataFrame, folder: str) -> DataFrame:
    """All rows that are available now, landed exactly once below ``folder``; no rows, if none came."""
    land(stream, f"{folder}/rows", f"{folder}/checkpoint")
    spark = stream.sparkSession
    if not exists(spark, f"{folder}/rows"):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def each(stream: DataFrame, consumer: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a consumer per micro-batch until stopped."""
    return stream.writeStream.foreachBatch(consumer).option("checkpointLocation", checkpoint).start()
