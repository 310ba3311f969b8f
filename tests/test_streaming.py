"""Streams give what the table operators give, over several micro-batches and after restarts."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rillframe.catalogue import events
from rillframe.sources import topics
from rillframe.streaming import ingest, sinks

EVENTS = "/root/testdata/sf0.001"
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, v bigint, k int, day date, event_type string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(scope="module")
def rows(spark):
    """A few users' events."""
    return events(spark, EVENTS).filter("user_id < 6").persist()


@pytest.fixture(scope="module")
def files(spark, rows, tmp_path_factory):
    """The events as three files that arrive in time order, rows inside shuffled."""
    folder = str(tmp_path_factory.mktemp("landing"))
    for a, b in ((1, 10), (10, 20), (20, 32)):
        part = rows.filter(F.dayofmonth("ts") >= a).filter(F.dayofmonth("ts") < b).orderBy(F.hash("event_id"))
        part.select(*[c.strip().split()[0] for c in SCHEMA.split(",")]).coalesce(1).write.mode("append").parquet(folder)
    return folder


def bag(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


# Sources and sinks


def test_landing_takes_few_files_at_a_time(spark, files, rows, tmp_path):
    sizes = []
    sinks.each(ingest.landing(spark, files, SCHEMA, 1), lambda df, _: sizes.append(df.count()),
               str(tmp_path)).processAllAvailable()
    for query in spark.streams.active:
        query.stop()
    assert len(sizes) == 3 and sum(sizes) == rows.count()


def test_endless_sources(spark, tmp_path):
    seen, drawn = [], []
    plus = sinks.each(ingest.counter(spark, 50), lambda df, i: i < 2 and seen.extend(r.x for r in df.collect()),
                      f"{tmp_path}/a")
    dice = sinks.each(ingest.random_numbers(spark, 6, 1, 50),
                      lambda df, i: i < 2 and drawn.extend(r.draw for r in df.collect()), f"{tmp_path}/b")
    until = time.monotonic() + 120
    while len(seen) < 100 or len(drawn) < 100:
        assert time.monotonic() < until
        time.sleep(0.05)
        assert plus.exception() is None and dice.exception() is None
    plus.stop(), dice.stop()
    assert sorted(seen) == list(range(1, 101))
    assert set(drawn) == set(range(6))


def test_acknowledged_sink_survives_a_failure(spark, files, rows, tmp_path):
    told = []

    class Flaky(sinks.AcknowledgedSink):
        broken = True

        def write(self, batch, batch_id):
            if batch_id == 1 and Flaky.broken:
                batch.write.mode("overwrite").parquet(f"{self.data}/batch_id={batch_id}")  # landed, never confirmed
                raise RuntimeError("lost")
            super().write(batch, batch_id)

    sink = Flaky(str(tmp_path), lambda: told.append("init"), lambda i, n: told.append(i),
                 lambda: told.append("complete"), lambda failure: told.append("failure"))
    data = ingest.landing(spark, files, SCHEMA, 1).select("event_id")
    with pytest.raises(Exception, match="lost"):
        sink.run(data)
    assert told == ["init", 0, "failure"]
    half = sink.committed(spark, "event_id bigint").count()
    Flaky.broken = False
    sink.run(data)
    assert told[3:] == ["init", 1, 2, "complete"]
    done = sink.committed(spark, "event_id bigint")
    assert half < done.count() == rows.count() == done.distinct().count()
    sink.write(rows.select("event_id"), 2)  # a batch that comes again is skipped
    assert sink.committed(spark, "event_id bigint").count() == rows.count()


def test_two_consumers_get_every_row(spark, files, rows, tmp_path):
    one, two = [], []
    both = sinks.to_all(lambda df, _: one.append(df.count()), lambda df, _: two.append(df.filter("v > 0").count()))
    sinks.each(ingest.landing(spark, files, SCHEMA), both, str(tmp_path)).processAllAvailable()
    for query in spark.streams.active:
        query.stop()
    assert sum(one) == rows.count() and sum(two) == rows.filter("v > 0").count()


def test_topic_with_late_producer_and_late_consumer(spark, tmp_path):
    def send(producer, *texts):
        messages = spark.createDataFrame(list(enumerate(texts)), "seq bigint, msg string")
        topics.publish(messages, f"{tmp_path}/topic", producer)

    def read(name, view):
        seen = topics.consume(topics.subscribe(spark, f"{tmp_path}/topic"), {name: view})
        sinks.land(seen, f"{tmp_path}/{name}", f"{tmp_path}/at/{name}")
        return sorted(r.value for r in spark.read.parquet(f"{tmp_path}/{name}").collect())

    nations = [r.n_name for r in spark.read.parquet(f"{EVENTS}/nation.parquet").collect()]
    send("early", *nations[:11])
    send("second", *nations[11:13])
    assert read("text", F.col("msg")) == sorted(nations[:13])
    send("late", *nations[13:])
    assert read("text", F.col("msg")) == sorted(nations)
    assert read("size", F.length("msg").cast("string")) == sorted(str(len(n)) for n in nations)


# Complete results whatever the order of the files


def as_folder(spark, name, folder, parts):
    """A given table as a folder of files whose rows are in no order."""
    table = spark.read.parquet(f"{EVENTS}/{name}.parquet")
    table.repartition(parts, F.hash(*table.columns)).write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("per_batch", [1, 1000])
def test_streams_of_shuffled_files_lose_nothing(spark, tmp_path, monkeypatch, per_batch):
    for name in ("events", "orders"):
        as_folder(spark, name, str(tmp_path), 4)
    monkeypatch.setattr(ingest.table_files, "__defaults__", (per_batch,))
    queries = entry.queries()
    for stream_name, table_name in (("conflate_stream", "conflate"), ("scan_stream", "scan_user"), ("restart_stream", "restart_scan"),
                                    ("batch_stream", "batch_n"), ("throttle_stream", "throttle"), ("extrapolate_stream", "extrapolate")):
        got, want = queries[stream_name](spark, str(tmp_path)), queries[table_name](spark, EVENTS)
        assert bag(got.fillna(-1), *sorted(got.columns)) == bag(want.fillna(-1), *sorted(want.columns))
    for name in ("ingest_files", "ack_sink"):
        assert bag(queries[name](spark, str(tmp_path)), "o_orderstatus", "rows", "keys") == bag(queries[name](spark, EVENTS), "o_orderstatus", "rows", "keys")


def test_streams_of_empty_tables(spark, tmp_path):
    for name in ("events", "orders"):
        spark.read.parquet(f"{EVENTS}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("conflate_stream", "scan_stream", "split_stream", "restart_stream", "batch_stream", "throttle_stream", "extrapolate_stream", "ingest_files", "ack_sink"):
        assert entry.queries()[name](spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        entry.queries()["ingest_files"](spark, f"{tmp_path}/nowhere")


def test_a_sink_without_batches_is_empty(spark, tmp_path):
    assert sinks.AcknowledgedSink(f"{tmp_path}/none").committed(spark, "x int").count() == 0
