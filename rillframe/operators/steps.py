"""Scans and folds whose step is any associative composition.

What a row does to a running value is a function, described by a few numbers, and two such functions one after
another are again one of that kind: x -> a x + b, x -> max(x + a, b), "start again at b". Descriptions compose in any
grouping, so a group too long for one task is cut into slices (see ``plans.slices``): each slice is composed on its
own, a prefix over the slices' totals says what comes before each, and that is composed in front of its rows. Inside a
task the prefix is taken by doubling over whole Arrow batches, for all groups of a batch at once; what is held is a
batch and one description.

Descriptions are numbers or booleans without NULLs. Rows move once; where slices are needed, their composed rows are
written to the shared folder first, so that a lost executor costs tasks and not the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rillframe.plans import match_keys
from rillframe.plans.slices import SLICE, add_slices
from rillframe.session import settled

Parts = dict[str, np.ndarray]
PLACE = "_at"


@dataclass(frozen=True)
class Step:
    """``lift`` describes the function of a row, ``combine`` composes two arrays of descriptions, the first one first,
    and ``value`` is what a composed description makes of the seed."""

    lift: dict[str, Column]
    combine: Callable[[Parts, Parts], Parts]
    value: Callable[[dict[str, Column]], Column]

    @property
    def names(self) -> list[str]:
        return [*self.lift, PLACE]

    def lifted(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.lift | {PLACE: F.lit(1).cast("bigint")})

    def composing(self) -> Callable[[Parts, Parts], Parts]:
        """``combine``, with the rows counted too; a function of its own, for it goes to the tasks."""
        combine = self.combine
        return lambda a, b: combine(a, b) | {PLACE: a[PLACE] + b[PLACE]}

    def result(self) -> Column:
        return self.value({n: F.col(n) for n in self.lift})


def affine(a: Column, b: Column, seed: int, modulus: int) -> Step:
    """x -> a x + b modulo ``modulus``, from ``seed`` on; ``modulus`` is below 2**31."""
    if not 0 < modulus < 1 << 31:
        raise ValueError("a modulus is between 1 and 2**31")

    def combine(one: Parts, two: Parts) -> Parts:
        return {"_a": one["_a"] * two["_a"] % modulus, "_b": (two["_a"] * one["_b"] + two["_b"]) % modulus}

    lift = {"_a": F.pmod(a.cast("bigint"), F.lit(modulus)), "_b": F.pmod(b.cast("bigint"), F.lit(modulus))}
    return Step(lift, combine, lambda s: (s["_a"] * F.lit(seed % modulus).cast("bigint") + s["_b"]) % modulus)


def total(value: Column, seed: int = 0) -> Step:
    """x -> x + value; a NULL value changes nothing."""
    return Step({"_sum": F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))}, lambda one, two: {"_sum": one["_sum"] + two["_sum"]},
                lambda s: s["_sum"] + F.lit(seed).cast("bigint"))


def spaced(arrival: Column, gap: int) -> Step:
    """x -> max(x + gap, arrival): when a row leaves that comes at ``arrival`` and waits ``gap`` after the one before."""

    def combine(one: Parts, two: Parts) -> Parts:
        return {"_gap": one["_gap"] + two["_gap"], "_out": np.maximum(one["_out"] + two["_gap"], two["_out"])}

    return Step({"_gap": F.lit(gap).cast("bigint"), "_out": arrival.cast("bigint")}, combine, lambda s: s["_out"])


def restarted(bad: Column, value: Column) -> Step:
    """A sum that starts again behind every faulty row: ``_epoch`` counts those, the value is the sum since the last."""
    faulty = F.coalesce(bad, F.lit(False)).cast("bigint")
    own = F.when(faulty == 1, F.lit(0).cast("bigint")).otherwise(F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint")))

    def combine(one: Parts, two: Parts) -> Parts:
        return {"_epoch": one["_epoch"] + two["_epoch"], "_sum": np.where(two["_epoch"] > 0, 0, one["_sum"]) + two["_sum"]}

    return Step({"_epoch": faulty, "_sum": own}, combine, lambda s: s["_sum"])


def _news(batch: pa.RecordBatch, by: list[str], before: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which rows start a group, and the key of the last row. NULL keys are keys."""
    new = np.zeros(batch.num_rows, bool)
    for name in by:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    new[0] = before is None or before != tuple(batch.column(n)[0].as_py() for n in by)
    return new, tuple(batch.column(n)[-1].as_py() for n in by)


def _prefixes(parts: Parts, new: np.ndarray, combine) -> Parts:
    """Inclusive prefixes inside each group by doubling: after a pass every row covers twice as many rows."""
    start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    reach = 1
    while reach < len(new):
        at = np.flatnonzero(np.arange(len(new)) - reach >= start)
        if not len(at):
            break
        made = combine({n: x[at - reach] for n, x in parts.items()}, {n: x[at] for n, x in parts.items()})
        parts = {n: x.copy() for n, x in parts.items()}
        for n, x in made.items():
            parts[n][at] = x
        reach *= 2
    return parts


def _scanned(df: DataFrame, by: list[str], step: Step) -> DataFrame:
    """``df``, whose partitions hold whole groups in order, with the step's columns composed within each group."""
    names, kinds = step.names, {f.name: f.dataType for f in df.schema.fields}
    columns, schema, combine = df.columns, T.StructType(df.schema.fields), step.composing()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new, after = _news(batch, by, key)
            parts = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            if not new[0]:  # the group goes on: what it came to stands in front
                parts = {n: np.concatenate([last[n], x]) for n, x in parts.items()}
                parts = {n: x[1:] for n, x in _prefixes(parts, np.concatenate([[True], new]), combine).items()}
            else:
                parts = _prefixes(parts, new, combine)
            key, last = after, {n: x[-1:] for n, x in parts.items()}
            made = [pa.array(parts[c]).cast(batch.schema.field(c).type) if c in parts else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(made, names=columns)

    if any(kinds[n].typeName() in ("string", "binary", "decimal") for n in names):
        raise TypeError("a step's descriptions are numbers or booleans")
    return df.mapInArrow(run, schema)


def _laid(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Whole groups in order inside partitions; without ``by`` all in one, so only for few rows."""
    spread = df.repartition(*[F.col(c) for c in by]) if by else df.coalesce(1)
    return spread.sortWithinPartitions(*by, *order)


def before(totals: DataFrame, by: list[str], at: str, step: Step) -> DataFrame:
    """For each part ``at`` of a group what the group's earlier parts come to; the first part of a group is absent."""
    scanned = _scanned(_laid(totals.select(*by, at, *step.names), by, [at]), by, step)
    window = F.struct(*step.names)
    earlier = F.lag(window).over(Window.partitionBy(*by).orderBy(at))
    return scanned.select(*by, at, earlier.alias("_before")).where("_before IS NOT NULL").select(*by, at, "_before.*")


def behind(rows: DataFrame, carries: DataFrame, on: list[str], step: Step) -> DataFrame:
    """``rows`` with the carry of their part composed in front, where there is one."""
    held = {n: f"_of{n}" for n in step.names}
    joined = match_keys(rows, carries.withColumnsRenamed(held), on, "left")
    columns, names, combine = rows.columns, step.names, step.composing()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            known = batch.column(held[PLACE]).is_valid().to_numpy(zero_copy_only=False)
            front = {n: batch.column(held[n]).filter(pa.array(known)).to_numpy(zero_copy_only=False) for n in names}
            made = combine(front, {n: x[known] for n, x in own.items()})
            own = {n: x.copy() for n, x in own.items()}
            for n, x in made.items():
                own[n][known] = x
            yield pa.RecordBatch.from_arrays([pa.array(own[c]).cast(batch.schema.field(c).type) if c in own else batch.column(c) for c in columns], names=columns)

    return joined.mapInArrow(run, rows.schema)


def totals_of(rows: DataFrame, by: list[str], order: list[str], step: Step) -> DataFrame:
    """The description of each whole group, from rows whose descriptions are composed; combined before the shuffle."""
    last = F.max_by(F.struct(*step.names), F.struct(*order)).alias("_last")
    return rows.groupBy(*by).agg(last).select(*by, "_last.*")


def composed(df: DataFrame, by: list[str], order: list[str], step: Step) -> DataFrame:
    """``df`` with the columns of ``step``: for each row what all rows of its group up to it come to."""
    rows, sliced = add_slices(step.lifted(df), by, order)
    if not sliced:
        return _scanned(_laid(rows, by, order), by, step)
    parts = [*by, SLICE]
    local = settled(_scanned(_laid(rows, parts, order), parts, step))
    totals = settled(totals_of(local, parts, order, step))
    return behind(local, settled(before(totals, by, SLICE, step)), parts, step).drop(SLICE)


def scan(df: DataFrame, by: list[str], order: list[str], step: Step, name: str = "running", place: str = "place") -> DataFrame:
    """The running value of a step and the place of each row, which counts from 1; n rows give n."""
    rows = composed(df, by, order, step).withColumns({name: step.result(), place: F.col(PLACE)})
    return rows.drop(*step.names)


def fold(df: DataFrame, by: list[str], order: list[str], step: Step, name: str = "value") -> DataFrame:
    """What all rows of each group in order make of the seed; one row for each group, none for a table without rows."""
    rows, sliced = add_slices(step.lifted(df).select(*dict.fromkeys([*by, *order]), *step.names), by, order)
    parts = [*by, SLICE] if sliced else by
    totals = totals_of(_scanned(_laid(rows, parts, order), parts, step), parts, order, step)
    if sliced:
        totals = totals_of(_scanned(_laid(settled(totals), by, [SLICE]), by, step), by, [SLICE], step)
    return totals.where(F.col(PLACE) > 0).select(*by, step.result().alias(name))


def with_seed(rows: DataFrame, by: list[str], name: str, seed, place: str = "place") -> DataFrame:
    """A scan with its seed as an extra row at place 0 of each group, made from the group's first row."""
    others = [c for c in rows.columns if c not in (*by, name, place)]
    kinds = {c: rows.schema[c].dataType for c in rows.columns}
    row = F.struct(*[F.col(c) for c in (place, name, *others)])
    empty = F.struct(F.lit(0).cast(kinds[place]).alias(place), F.lit(seed).cast(kinds[name]).alias(name), *[F.lit(None).cast(kinds[c]).alias(c) for c in others])
    both = F.when(F.col(place) == 1, F.array(empty, row)).otherwise(F.array(row))
    return rows.select(*by, F.explode(both).alias("_row")).select(*by, "_row.*")
