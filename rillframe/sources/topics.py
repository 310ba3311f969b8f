"""Topics: many producers append, every consumer reads everything."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MESSAGE = "seq bigint, msg string, producer string"


def gather(producers: dict[str, DataFrame]) -> DataFrame:
    """The messages (seq, msg) of all producers, each named."""
    named = [df.select("seq", "msg").withColumn("producer", F.lit(name)) for name, df in producers.items()]
    return reduce(DataFrame.unionByName, named)


def consume(topic: DataFrame, consumers: dict[str, Column]) -> DataFrame:
    """Every message once per consumer, in one pass over the topic."""
    views = F.array(*[F.struct(F.lit(n).alias("consumer"), view.alias("value")) for n, view in consumers.items()])
    return topic.select("producer", "seq", F.inline(views))


def publish(df: DataFrame, folder: str, producer: str) -> None:
    """Append messages (seq, msg) to a topic folder; producers may come and go."""
    df.select("seq", "msg").withColumn("producer", F.lit(producer)).write.mode("append").parquet(folder)


def subscribe(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The topic as a stream. A consumer is one streaming query with its own checkpoint."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
