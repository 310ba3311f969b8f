"""Queries that run as streams over the given tables until nothing is left to read.

Every one writes below the shared folder, with a checkpoint of its own. Results are complete when the input ends: rows
may come in any order and in any number of micro-batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rillframe.catalogue import BAD, HOUR, IN_ORDER, query
from rillframe.functions import values
from rillframe.session import STATE_STORE, own, shared_dir
from rillframe.sources import topics
from rillframe.sources.tables import SCHEMAS, table
from rillframe.operators import rates, steps
from rillframe.streaming import closed, ingest, sinks
from rillframe.streaming.carried import Carried


def _stream(spark, folder, name):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return ingest.table_files(spark, f"{folder}/{name}.parquet", SCHEMAS[name])


def _place(spark):
    return own(f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}")


def _events(spark, folder):
    rows = _stream(spark, folder, "events")
    return rows.select("event_id", "ts", "user_id", "event_type", values.cents(F.col("value")).alias("v"),
                       F.get_json_object("props", "$.k").cast("int").alias("k"))


@query
def ingest_files(spark, folder):
    landed = sinks.landed(_stream(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), _place(spark))
    return landed.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@query
def ack_sink(spark, folder):
    stream = _stream(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    sink = sinks.AcknowledgedSink(_place(spark))
    sink.run(stream)
    rows = sink.committed(spark, "o_orderkey bigint, o_orderstatus string")
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@query
def pubsub_stream(spark, folder):
    place = _place(spark)
    names = {"nation": ("n_nationkey", "n_name"), "region": ("r_regionkey", "r_name"), "part": ("p_partkey", "p_name")}
    for producer, (key, name) in names.items():
        rows = table(spark, folder, producer).select(F.col(key).cast("bigint").alias("seq"), F.col(name).alias("msg"))
        topics.publish(rows, f"{place}/topic", producer)
    views = {"text": F.col("msg"), "size": F.length("msg").cast("string")}
    for consumer, view in views.items():
        seen = topics.consume(topics.subscribe(spark, f"{place}/topic"), {consumer: view})
        sinks.land(seen, f"{place}/seen/{consumer}", f"{place}/checkpoint/{consumer}")
    schema = "producer string, seq bigint, consumer string, value string"
    return spark.read.schema(schema).parquet(*[f"{place}/seen/{c}" for c in views])


@query
def conflate_stream(spark, folder):
    days = _events(spark, folder).withColumn("day", values.day(F.col("ts")))
    bursts = closed.Bursts(_place(spark), ["user_id", "day"], "event_type")
    bursts.run(days)
    return bursts.result(spark).select("user_id", F.col("day").cast("string").alias("day"), "description", "instances")


def _carried(spark, folder, step, extra=()):
    """The events as a stream into a scan by user that is kept by days."""
    rows = _events(spark, folder).withColumn("day", values.day(F.col("ts"))).select("user_id", "day", *IN_ORDER, *extra)
    made = Carried(_place(spark), rows.schema, ["user_id"], IN_ORDER, "day", step)
    return made.run(rows)


@query
def scan_stream(spark, folder):
    out = _carried(spark, folder, steps.total(F.col("v")), ["v"]).result(spark)
    return steps.with_seed(out, ["user_id"], "running", 0).select("user_id", "place", "event_id", "running")


@query
def split_stream(spark, folder):
    opens = steps.total((F.col("event_type") == "signup").cast("bigint"))
    out = _carried(spark, folder, opens, ["event_type"]).result(spark, "segment")
    return out.groupBy("user_id", "segment").agg(F.count_if(F.col("event_type") != "signup").alias("rows"))


@query
def restart_stream(spark, folder):
    made = _carried(spark, folder, steps.restarted(F.expr(BAD), F.col("v")), ["v", "k"])
    rows = made.composed(spark).filter(~F.expr(BAD))
    return rows.select("user_id", "event_id", F.col("_epoch").alias("epoch"), F.col("_sum").alias("running"))


@query
def batch_stream(spark, folder):
    out = _carried(spark, folder, steps.total(F.lit(0))).result(spark)
    return closed.batches(out, ["user_id"], "place", 10, "event_id", ended=True).select(
        "user_id", "batch", "size", F.concat_ws(",", F.col("items").cast("array<string>")).alias("ids"))


@query
def throttle_stream(spark, folder):
    made = _carried(spark, folder, steps.spaced(values.micros(F.col("ts")), HOUR))
    return made.result(spark, "release").select("user_id", "event_id", "release")


@query
def extrapolate_stream(spark, folder):
    made = _carried(spark, folder, closed.latest(F.col("v")), ["v"])
    days = made.totals(spark).select("user_id", "day", closed.LATEST)
    out = rates.expand(days, ["user_id"], ["day"], F.unix_date("day"), F.col(closed.LATEST))
    return out.withColumn("day", F.date_from_unix_date(F.col("tick").cast("int")).cast("string")).drop("tick", "since")


WAITING = 500  # rows of the bounded landing place


@query
def bounded_landing(spark, folder):
    """Events pushed in four parts, taken after two of them and at the end; the oldest beyond the bound are dropped."""
    rows = table(spark, folder, "events").select("event_id", "ts")
    made = ingest.Bounded(_place(spark), rows.schema, IN_ORDER, WAITING)
    taken = []
    for part in range(4):
        made.push(rows.filter(F.floor((F.dayofmonth("ts") - 1) / 8) == part))
        if part % 2:
            out = made.take(spark)
            taken.append(out.select(F.lit(part // 2).alias("take"), "event_id", F.lit(made.evicted(spark)).cast("bigint").alias("evicted")))
    return taken[0].unionByName(taken[1])


@query
def replay_stream(spark, folder):
    """Orders in four files, one a micro-batch; the first try breaks off in mid-stream and the source is read again."""
    place = _place(spark)
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    rows.repartition(4, F.hash("o_orderkey")).write.parquet(f"{place}/in")
    sink = sinks.ReplayedSink(f"{place}/out", rows.schema)

    def fault(batch, attempt, number):
        if attempt == 1 and number == 2:
            raise RuntimeError("the source breaks off")

    sink.run(spark, lambda: ingest.sourced(ingest.landing(spark, f"{place}/in", "o_orderkey bigint, o_orderstatus string", 1)), handed=fault)
    return sink.committed(spark).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
