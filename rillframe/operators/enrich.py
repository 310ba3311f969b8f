"""Lookups and calls per row."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from queue import Empty, Queue
from threading import Thread

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.sources.keyed import Keyed


def duty_roster(spark, people: list[tuple[str, str]]) -> DataFrame:
    """A table (idx, engineer, email) from a list."""
    rows = [(i, name, email) for i, (name, email) in enumerate(people)]
    return spark.createDataFrame(rows, "idx int, engineer string, email string")


def on_call(df: DataFrame, roster: DataFrame, when: Column) -> DataFrame:
    """Add the engineer on duty: the epoch day modulo the size of the roster.

    A roster of any length; the planner chooses the join by its size.
    """
    size = roster.count()
    if not size:
        raise ValueError("a roster has one person at least")
    duty = df.withColumn("idx", F.pmod(F.unix_date(F.to_date(when)), F.lit(size)))
    return duty.join(roster, "idx").drop("idx")


def map_async(df: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType,
              parallelism: int | None = None, rows: int = 1000) -> DataFrame:
    """Call an outside service for pieces of a task's rows, several calls in flight, replies in order.

    ``parallelism`` bounds the calls that a task waits for at a time (one
    without it); rows stay in the partitions they are in. A piece has ``rows``
    rows at most, so a task holds parallelism x rows of them.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = (frame.iloc[k:k + rows] for frame in frames for k in range(0, len(frame), rows))
        yield from _answers(pieces, call, parallelism or 1)

    return df.mapInPandas(run, schema)


def _answers(pieces: Iterator, call: Callable, parallelism: int) -> Iterator:
    """What ``call`` says to each piece, in order; as many calls as ``parallelism`` at a time."""
    waiting: deque = deque()
    with ThreadPoolExecutor(parallelism) as pool:
        for piece in pieces:
            if len(waiting) >= parallelism:
                yield waiting.popleft().result()
            waiting.append(pool.submit(call, piece))
        while waiting:
            yield waiting.popleft().result()


def reliable(call: Callable, tries: int = 3, seconds: float = 30.0) -> Callable:
    """``call`` with a time limit for each try; a try that fails or takes longer is made again, the last one counts."""

    def run(*given):
        for left in reversed(range(tries)):
            answer: Queue = Queue()

            def attempt(answer=answer):
                try:
                    answer.put((True, call(*given)))
                except Exception as failure:  # handed on to the caller below
                    answer.put((False, failure))

            Thread(target=attempt, daemon=True).start()
            try:
                fine, found = answer.get(timeout=seconds)
            except Empty:
                fine, found = False, TimeoutError(f"no answer in {seconds} seconds")
            if fine:
                return found
            if not left:
                raise found

    return run


def look_up(df: DataFrame, key: str, file: Keyed, name: str, parallelism: int = 8, rows: int = 1000,
            tries: int = 3, seconds: float = 30.0) -> DataFrame:
    """Add the value that a keyed file has for ``key``, None if it has none: several look-ups of a task in flight.

    Rows stay in order in their partitions. What goes to a task is the list of the files, not what they hold.
    """
    find, names = reliable(file.find, tries, seconds), [*df.columns, name]
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def call(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find(batch.column(key).cast(pa.int64()).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _answers((b.slice(k, rows) for b in batches for k in range(0, b.num_rows, rows)), call, parallelism)

    return df.mapInArrow(run, schema)


def notify(df: DataFrame, email: Column, description: Column, at: Column, instances: Column) -> DataFrame:
    """One nested notification per event."""
    event = F.struct(description.alias("description"), at.alias("date"), instances.alias("instances"))
    return df.select(email.alias("email"), event.alias("event"))
