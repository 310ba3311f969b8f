"""Keyed files, calls with retries, bounded landing places, sources that are read again, loops that use up their pairs."""

import random
import time
import warnings

import pytest
from pyspark.sql import functions as F

from rillframe.operators import enrich, feedback
from rillframe.sources import keyed
from rillframe.streaming import ingest, sinks

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("file_rows", [100, 1_000_000])
def test_look_ups_in_a_keyed_file(spark, monkeypatch, file_rows):
    monkeypatch.setattr(keyed, "BLOCK", 16)
    rows = [(k * 3 - 500, f"välue {k}" if k % 7 else "") for k in range(1000)] + [(None, "x"), (10**15, None), (-(2**62), "low"), (2**62 + 1, "high")]
    file = keyed.write(spark.createDataFrame(rows, "k bigint, v string").repartition(5), "k", "v", file_rows)
    assert (len(file.paths) > 5) == (file_rows == 100)
    held = {k: v for k, v in rows if k is not None and v is not None}
    asked = [*held, 0, 1, None, -(2**63), 2**63 - 1, 10**15, 2**62]
    assert file.find(asked) == [held.get(k) for k in asked]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(asked)], "i int, k bigint").repartition(3)
    found = enrich.look_up(df, "k", file, "found", parallelism=3, rows=7)
    assert {(r.i, r.k, r.found) for r in found.collect()} == {(i, k, held.get(k)) for i, k in enumerate(asked)}
    nothing = keyed.write(spark.createDataFrame([], "k bigint, v string"), "k", "v")
    assert nothing.find([1, None]) == [None, None] and {r.found for r in enrich.look_up(df, "k", nothing, "found").collect()} == {None}


def test_calls_are_tried_again(spark):
    tries = []

    def flaky(x):
        tries.append(x)
        if len(tries) == 1:
            raise OSError("lost")
        if len(tries) == 2:
            time.sleep(5)
        return x * 2

    assert enrich.reliable(flaky, tries=3, seconds=0.5)(21) == 42 and len(tries) == 3
    with pytest.raises(TimeoutError):
        enrich.reliable(lambda: time.sleep(5), tries=2, seconds=0.1)()
    with pytest.raises(ZeroDivisionError):
        enrich.reliable(lambda: 1 // 0, tries=2)()


def test_a_bounded_place_drops_its_oldest_rows(spark, tmp_path):
    """Against a plain list: pushes of any size, takes in between."""
    draw = random.Random(2)
    rows = spark.range(0).select(F.col("id").cast("int").alias("x")).schema
    made = ingest.Bounded(str(tmp_path), rows, ["x"], 10)
    waiting, lost, last = [], 0, 0
    for step in range(9):
        if step % 4 == 3:
            assert sorted(r.x for r in made.take(spark).collect()) == waiting
            waiting = []
        else:
            size = draw.choice([0, 1, 4, 9, 25])
            made.push(spark.createDataFrame([(last + i,) for i in range(size)], rows))
            waiting += range(last, last + size)
            last += size
            lost += max(0, len(waiting) - 10)
            waiting = waiting[-10:]
        assert sorted(r.x for r in made.waiting(spark).collect()) == waiting and made.evicted(spark) == lost
    made.evict(spark)
    assert sorted(r.x for r in made.waiting(spark).collect()) == waiting
    assert ingest.Bounded(f"{tmp_path}/none", rows, ["x"], 3).take(spark).count() == 0


def test_a_source_that_is_read_again_gives_every_row_once(spark, tmp_path):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_orderstatus")
    orders.repartition(4, F.hash("o_orderkey")).write.parquet(f"{tmp_path}/in")
    sink = sinks.ReplayedSink(f"{tmp_path}/out", orders.schema)
    handed, files = [], iter([1, 2, 4])

    def source():  # the files are grouped otherwise in each attempt
        return ingest.sourced(ingest.landing(spark, f"{tmp_path}/in", "o_orderkey bigint, o_orderstatus string", next(files)))

    def fault(batch, attempt, number):
        handed.append((attempt, number))
        if (attempt, number) in {(1, 1), (2, 1)}:
            batch.write.mode("overwrite").parquet(f"{sink.data}/attempt={attempt}/number={number}")  # written, never committed
            raise RuntimeError("gone")

    assert sink.run(spark, source, attempts=3, handed=fault) == 3
    assert handed == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]
    assert sorted(map(tuple, sink.committed(spark).collect())) == sorted(map(tuple, orders.collect()))
    rows = {r.attempt: r.rows for r in sink.seen(spark).groupBy("attempt").agg(F.sum("rows").alias("rows")).collect()}
    assert set(rows) == {1, 2, 3} and all(rows.values()) and sum(rows.values()) == orders.count()
    with pytest.raises(Exception, match="always"):
        def broken(*_):
            raise RuntimeError("always")
        sinks.ReplayedSink(f"{tmp_path}/bad", orders.schema).run(spark, lambda: ingest.sourced(ingest.landing(spark, f"{tmp_path}/in", "o_orderkey bigint, o_orderstatus string")), 2, broken)


def test_hops_use_every_pair_once(spark, monkeypatch):
    """Against a plain search; the pairs left over shrink from round to round."""
    draw = random.Random(3)
    edges = [(draw.randrange(40), draw.randrange(60)) for _ in range(120)] + [(0, k) for k in range(20)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    kept = []
    real = feedback.settled
    monkeypatch.setattr(feedback, "settled", lambda x: (lambda y: (kept.append(y.count()) if "_left" in y.columns else None, y)[1])(real(x)))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        found = feedback.hop_distance(df, "a", "b", spark.createDataFrame([(0,), (0,)], "node bigint"), 50).collect()
    want, fresh, hops = {("a", 0): 0}, [("a", 0)], 0
    while fresh:
        hops += 1
        near = {("b", y) if kind == "a" else ("a", x) for kind, node in fresh for x, y in edges if node == (x if kind == "a" else y)}
        fresh = [n for n in near if n not in want]
        want |= dict.fromkeys(fresh, hops)
    assert {(r.kind, r.node): r.hops for r in found} == want
    assert kept == sorted(kept, reverse=True) and kept[-1] < kept[0]
