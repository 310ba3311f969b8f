"""Streams whose result is complete when their input has ended, whatever the order of the rows.

Nothing waits for a watermark, so no row is late. What can be added up is kept in parts, one for each micro-batch; a
batch that comes again replaces its part. Operators that need the order of all rows are kept in days with carries, see
``carried``; what is open at the end of such a scan (a short batch, the last value of a grid) comes out when the input
has ended.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillframe.operators import segments
from rillframe.operators.steps import Step
from rillframe.session import exists


class Bursts:
    """Merged events of each busy period: ``by`` holds the key and the period."""

    def __init__(self, folder: str, by: list[str], description: str):
        self.parts, self.checkpoint = f"{folder}/parts", f"{folder}/checkpoint"
        self.by, self.description = by, description
        self.schema = None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Combined inside the batch: a row for each period in it."""
        parts = segments.burst_parts(batch, self.by, self.description)
        parts.write.mode("overwrite").parquet(f"{self.parts}/batch_id={batch_id}")

    def run(self, stream: DataFrame) -> None:
        """Take all that is available now."""
        self.schema = stream.select(*self.by, self.description).schema
        query = (stream.writeStream.foreachBatch(self.write).option("checkpointLocation", self.checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    def result(self, spark: SparkSession) -> DataFrame:
        """Every period that had an event, the last one too."""
        if exists(spark, self.parts):
            parts = spark.read.parquet(self.parts).drop("batch_id")
        else:
            parts = segments.burst_parts(spark.createDataFrame([], self.schema), self.by, self.description)
        return segments.told(segments.add_parts(parts, self.by), self.by)


LATEST = "_latest"


def latest(value: Column) -> Step:
    """The last value that is not NULL, a whole number: the table of last values that a gap is filled from."""

    def combine(one: dict, two: dict) -> dict:
        return {"_known": one["_known"] | two["_known"], LATEST: np.where(two["_known"], two[LATEST], one[LATEST])}

    return Step({"_known": value.isNotNull(), LATEST: F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))}, combine,
                lambda s: F.when(s["_known"], s[LATEST]))


def batches(rows: DataFrame, by: list[str], place: str, size: int, value: str, ended: bool, name: str = "batch") -> DataFrame:
    """Batches of ``size`` of rows whose ``place`` counts from 1; an open last batch comes out when the input has ended."""
    number = F.floor((F.col(place) - 1) / size).cast("bigint").alias(name)
    items = F.array_sort(F.collect_list(F.struct(place, F.col(value).alias("_value"))))
    made = rows.groupBy(*by, number).agg(F.count("*").alias("size"), F.transform(items, lambda item: item["_value"]).alias("items"))
    return made if ended else made.filter(F.col("size") == size)
