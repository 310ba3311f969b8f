"""Running values over an explicit order, without one task per group.

A table has no order, so every ordered operator names one: ``by`` groups the
rows (no columns: the whole table) and ``order`` is unique within a group. A
group too long for one task is cut into slices (see ``slices``). The slices are
totalled first, combined before the shuffle; a prefix over the totals gives one
carry row per slice, which goes in front of the rows of its slice. The window
over a slice then starts from the carry, and no join is needed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillframe.plans.keys import match_keys
from rillframe.plans.slices import SLICE, add_slices

REAL = "_real"


@dataclass(frozen=True)
class Run:
    """A running aggregate that can be continued from a carried value."""

    kind: str
    value: Column

    def over(self, value: Column, window) -> Column:
        if self.kind == "last":
            return F.last(value, ignorenulls=True).over(window)
        return _AGGREGATES[self.kind](value).over(window)

    def total(self, order: list[str]) -> Column:
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), F.struct(*order)))
        return _AGGREGATES[self.kind](self.value)


_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}
#: Aggregates that combine before a shuffle, by name.
KINDS = _AGGREGATES | {"count": F.count}


def sum_run(value: Column) -> Run:
    return Run("sum", value)


def count_run() -> Run:
    return Run("sum", F.lit(1).cast("bigint"))


def max_run(value: Column) -> Run:
    return Run("max", value)


def min_run(value: Column) -> Run:
    return Run("min", value)


def last_run(value: Column) -> Run:
    """The latest value that is not NULL."""
    return Run("last", value)


@dataclass(frozen=True)
class Lineup:
    """Rows in a declared order."""

    frame: DataFrame
    by: list[str]
    order: list[str]
    sliced: bool

    @classmethod
    def of(cls, df: DataFrame, by: list[str], order: list[str]) -> Lineup:
        frame, sliced = add_slices(df, list(by), list(order))
        return cls(frame, list(by), list(order), sliced)

    @property
    def _parts(self) -> list[str]:
        return [*self.by, SLICE] if self.sliced else self.by

    def rows(self) -> DataFrame:
        return self.frame.drop(SLICE)

    def map(self, fn) -> Lineup:
        """Change or drop rows; key and order columns must stay as they are."""
        return replace(self, frame=fn(self.frame))

    def within(self, *extra: str) -> Lineup:
        """The same rows, grouped by further columns; the slices are kept."""
        return replace(self, by=[*self.by, *extra])

    def running(self, **runs: Run) -> Lineup:
        """Add one running value per row, the row itself included."""
        return self._run(0, runs)

    def preceding(self, **runs: Run) -> Lineup:
        """Add one running value per row over the rows before it."""
        return self._run(-1, runs)

    def _run(self, end: int, runs: dict[str, Run]) -> Lineup:
        window = Window.partitionBy(*self._parts).rowsBetween(Window.unboundedPreceding, end)
        if not self.sliced:
            values = {name: run.over(run.value, window.orderBy(*self.order)) for name, run in runs.items()}
            return replace(self, frame=self.frame.withColumns(values))
        held = {name: f"_of_{name}" for name in runs}
        rows = self.frame.withColumns({REAL: F.lit(True)} | {held[n]: run.value for n, run in runs.items()})
        # carries are spread like the window's partitions, so rows that are spread so already stay
        carried = self._carries(runs).repartition(*self._parts).withColumnsRenamed(held).withColumn(REAL, F.lit(False))
        both = rows.unionByName(carried, allowMissingColumns=True)
        ordered = window.orderBy(REAL, *self.order)
        values = {name: run.over(F.col(held[name]), ordered) for name, run in runs.items()}
        return replace(self, frame=both.withColumns(values).filter(REAL).drop(REAL, *held.values()))

    def _carries(self, runs: dict[str, Run]) -> DataFrame:
        """What the earlier slices of a group come to, one row per slice."""
        totals = self._long().groupBy(*self._parts).agg(*[run.total(self.order).alias(n) for n, run in runs.items()])
        before = Window.partitionBy(*self.by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(*self._parts, *[run.over(F.col(n), before).alias(n) for n, run in runs.items()])

    def numbered(self, name: str) -> Lineup:
        """Add the 0-based place of each row in its group."""
        return self.running(**{name: count_run()}).map(lambda df: df.withColumn(name, F.col(name) - 1))

    def sized(self, name: str) -> Lineup:
        """Add the number of rows in each row's group."""
        if not self.by:
            whole = self.frame.agg(F.count(F.lit(1)).alias("rows")).scalar()
            return replace(self, frame=self.frame.withColumn(name, whole))
        local = self.frame.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*self._parts)))
        if not self.sliced:
            return replace(self, frame=local)
        # one row per group that has slices, or per part of one after ``within``: the planner looks at the size
        whole = self._long().groupBy(*self.by).agg(F.count(F.lit(1)).alias("_whole"))
        size = F.when(F.col(SLICE) > 0, F.col("_whole")).otherwise(F.col(name))
        joined = match_keys(local, whole, self.by, "left").withColumn(name, size).drop("_whole")
        return replace(self, frame=joined)

    def _long(self) -> DataFrame:
        return self.frame.filter(F.col(SLICE) > 0) if self.by else self.frame
