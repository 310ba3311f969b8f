"""Scans that every micro-batch brings up to date, whatever order the rows come in.

Rows lie in cells: a day and a bucket of keys. A cell holds its rows in order with what they come to since the start
of their day (see ``operators.steps``). Beside the cells stands the carry table: for each key and day what the whole day
comes to. A micro-batch writes the cells that its rows fall into anew, as a version of its own, with their carries,
and then enters both in a commit table; a late row so costs its day and no other. A reader takes the latest committed
version of each cell and composes in front of each day what the days before come to, from the carry table. No row is
late, nothing waits for a watermark, and no state is held between micro-batches but files.

A batch that comes again is skipped if it was committed, and else written anew over what a failed try has left. Days
are dates or whole numbers. Versions that later ones replaced stay until ``vacuum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillframe.operators import steps
from rillframe.operators.steps import Step
from rillframe.session import exists, remove

VERSION, BUCKET = "_version", "_bucket"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


class Carried:
    """A running value over rows in ``order`` within ``by``; ``day`` is a column that never falls along the order.

    ``rows`` is the schema of the rows that will come.
    """

    def __init__(self, folder: str, rows: T.StructType, by: list[str], order: list[str], day: str, step: Step, buckets: int = 1):
        self.cells, self.carries, self.commits, self.checkpoint = (f"{folder}/{x}" for x in ("cells", "carries", "commits", "checkpoint"))
        self.rows, self.by, self.order, self.day, self.step, self.buckets = rows, by, order, day, step, buckets
        if not isinstance(rows[day].dataType, (T.DateType, T.IntegralType)):
            raise TypeError("a day is a date or a whole number")

    def _held(self, spark: SparkSession) -> T.StructType:
        """Rows with their composed descriptions."""
        fields = self.step.lifted(spark.createDataFrame([], self.rows)).schema.fields
        return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])

    def current(self, spark: SparkSession) -> dict[tuple, int]:
        """The latest version of each cell (day, bucket): as many entries as there are cells, not rows."""
        if not exists(spark, self.commits):
            return {}
        schema = T.StructType([self.rows[self.day], T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])
        found = spark.read.schema(schema).parquet(self.commits).groupBy(self.day, BUCKET).agg(F.max(VERSION).alias(VERSION))
        return {(r[0], r[1]): r[2] for r in found.collect()}

    def _read(self, spark: SparkSession, root: str, schema: T.StructType, cells: dict[tuple, int]) -> DataFrame:
        """The files of some cells, and of no others."""
        if not cells:
            return spark.createDataFrame([], schema)
        paths = [f"{root}/{VERSION}={v}/{self.day}={NULL_DAY if d is None else d}/{BUCKET}={b}" for (d, b), v in cells.items()]
        return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)

    def write(self, batch: DataFrame, version: int) -> None:
        """Take a micro-batch in: only the cells that its rows fall into are read and written."""
        spark = batch.sparkSession
        done = f"{self.commits}/{VERSION}={version}"
        if exists(spark, f"{done}/_SUCCESS"):
            return
        schema, plain = self._held(spark), self.rows.names
        bucket = F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int") if self.by else F.lit(0)
        new = batch.select(*plain).withColumn(BUCKET, bucket).persist()
        try:
            touched = {(r[0], r[1]) for r in new.select(self.day, BUCKET).distinct().collect()}
            known = {cell: v for cell, v in self.current(spark).items() if cell in touched}
            rows = new.unionByName(self._read(spark, self.cells, schema, known).select(*plain, BUCKET))
            local = steps.composed(rows, [self.day, BUCKET, *self.by], self.order, self.step).withColumn(VERSION, F.lit(version).cast("bigint"))
            if touched:
                local.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION, self.day, BUCKET).parquet(self.cells)
                written = self._read(spark, self.cells, schema, dict.fromkeys(touched, version))
                totals = steps.totals_of(written, [VERSION, self.day, BUCKET, *self.by], self.order, self.step)
                totals.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION, self.day, BUCKET).parquet(self.carries)
        finally:
            new.unpersist()
        entry = T.StructType([self.rows[self.day], T.StructField(BUCKET, T.IntegerType())])
        spark.createDataFrame(list(touched), entry).coalesce(1).write.mode("overwrite").parquet(done)

    def run(self, stream: DataFrame) -> Carried:
        """Take all that is available now."""
        (stream.writeStream.foreachBatch(self.write).option("checkpointLocation", self.checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        return self

    def totals(self, spark: SparkSession) -> DataFrame:
        """(by, day, descriptions): what each key's day comes to, from the carry table alone."""
        held = self._held(spark)
        schema = T.StructType([*[held[c] for c in self.by], *[held[c] for c in self.step.names], held[self.day], held[BUCKET], held[VERSION]])
        return self._read(spark, self.carries, schema, self.current(spark)).drop(BUCKET, VERSION)

    def _behind(self, spark: SparkSession, cells: dict[tuple, int]) -> DataFrame:
        local = self._read(spark, self.cells, self._held(spark), cells).drop(BUCKET, VERSION)
        carries = steps.before(self.totals(spark), self.by, self.day, self.step)
        return steps.behind(local, carries, [*self.by, self.day], self.step)

    def composed(self, spark: SparkSession) -> DataFrame:
        """All rows so far with the descriptions of all that stands before them."""
        return self._behind(spark, self.current(spark))

    def result(self, spark: SparkSession, name: str = "running", place: str = "place") -> DataFrame:
        """All rows so far with their running value and place, as the scan of the table gives them."""
        return self._named(self.composed(spark), name, place)

    def changes(self, spark: SparkSession, version: int, name: str = "running", place: str = "place") -> DataFrame:
        """What a micro-batch emits: the rows of the cells that it touched, as they stand now."""
        return self._named(self._behind(spark, {c: v for c, v in self.current(spark).items() if v == version}), name, place)

    def _named(self, rows: DataFrame, name: str, place: str) -> DataFrame:
        return rows.withColumns({name: self.step.result(), place: F.col(steps.PLACE)}).drop(*self.step.names)

    def vacuum(self, spark: SparkSession) -> None:
        """Delete the versions of cells that later ones have replaced."""
        schema = T.StructType([self.rows[self.day], T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])
        if not exists(spark, self.commits):
            return
        latest = self.current(spark)
        for day, bucket, version in spark.read.schema(schema).parquet(self.commits).collect():
            if latest[day, bucket] != version:
                for root in (self.cells, self.carries):
                    remove(spark, f"{root}/{VERSION}={version}/{self.day}={NULL_DAY if day is None else day}/{BUCKET}={bucket}")
