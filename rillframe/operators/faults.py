"""What happens to a stream at a faulty row.

``bad`` marks the row on which a stream would fail. Cuts look up the first
faulty place of each group, which combines before the shuffle, and compare
every row with it; no group is gathered in one task for that. The places are
written first, so that the planner knows their size: few are broadcast and the
rows stay where they are, many are joined with a shuffle that splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillframe.plans import Lineup, match_keys, sum_run
from rillframe.session import settled


def first_faults(df: DataFrame, by: list[str], order: list[str], bad: Column) -> DataFrame:
    """The first faulty place of each group that has one; groups without are absent."""
    place = F.min(F.struct(*order)).alias("_fault")
    found = df.filter(bad).groupBy(*by).agg(place).filter("_fault is not null")
    return settled(found) if by else found


def _before(df: DataFrame, by: list[str], order: list[str], cuts: DataFrame) -> DataFrame:
    if not by:
        only = cuts.scalar()
        return df.filter(only.isNull() | (F.struct(*order) < only))
    joined = match_keys(df, cuts, by, "left")
    return joined.filter(F.col("_fault").isNull() | (F.struct(*order) < F.col("_fault"))).drop("_fault")


def stop(df: DataFrame, by: list[str], order: list[str], bad: Column) -> DataFrame:
    """The rows before the first faulty one of their group."""
    return _before(df, by, order, first_faults(df, by, order, bad))


def recover(df: DataFrame, by: list[str], order: list[str], bad: Column, sentinel: dict[str, Column]) -> DataFrame:
    """The rows before the first fault, then one sentinel row in its place.

    ``sentinel`` gives the values of the sentinel row; key and order columns are
    those of the fault, other columns are NULL. ``recovered`` marks the row.
    """
    cuts = first_faults(df, by, order, bad)
    places = {c: F.col("_fault")[c] for c in order}
    rows = {c: F.lit(None) for c in df.columns} | {c: F.col(c) for c in by} | places | sentinel
    ends = cuts.select(*[rows[c].cast(df.schema[c].dataType).alias(c) for c in df.columns])
    good = _before(df, by, order, cuts).withColumn("recovered", F.lit(False))
    return good.unionByName(ends.withColumn("recovered", F.lit(True)))


def recover_with(df: DataFrame, by: list[str], order: list[str], bad: Column, fallbacks: list[DataFrame]) -> DataFrame:
    """The rows before the first fault, then a whole replacement stream.

    ``fallbacks`` are tried in turn, keyed like the rows: a group that failed
    gets its rows of the first one, a group that failed there too those of the
    second, and so on. A fault in the last one fails the job. ``attempt`` is 0
    for the original rows.
    """
    failed = first_faults(df, by, order, bad)
    out = _before(df, by, order, failed).withColumn("attempt", F.lit(0))
    for attempt, fallback in enumerate(fallbacks, start=1):
        if by:
            rows = match_keys(fallback, failed.select(*by), by, "left_semi")
        else:
            rows = fallback.filter(failed.scalar().isNotNull())
        if attempt == len(fallbacks):
            text = F.raise_error(F.lit("all replacements failed"))
            rows = rows.filter(F.when(bad, text).otherwise(F.lit(True)))
        else:
            failed = first_faults(rows, by, order, bad)
            rows = _before(rows, by, order, failed)
        out = out.unionByName(rows.withColumn("attempt", F.lit(attempt)))
    return out


def resume(df: DataFrame, bad: Column) -> DataFrame:
    """Faulty rows are skipped."""
    return df.filter(~F.coalesce(bad, F.lit(False)))


def quarantine(df: DataFrame, bad: Column) -> DataFrame:
    """The rows that ``resume`` skips."""
    return df.filter(bad)


def restart_scan(df: DataFrame, by: list[str], order: list[str], bad: Column, value: Column,
                 name: str = "running") -> DataFrame:
    """A running sum that skips faulty rows and starts again after each of them."""
    faulty = F.coalesce(bad, F.lit(False))
    line = Lineup.of(df, by, order).running(epoch=sum_run(faulty.cast("bigint")))
    line = line.map(lambda rows: rows.filter(~faulty)).within("epoch")
    return line.running(**{name: sum_run(value)}).rows()


def replay_dedupe(df: DataFrame, key: list[str], attempt: str) -> DataFrame:
    """One row per key, the earliest attempt; copies are dropped inside the map tasks first.

    Of several rows with a key in the same attempt any stays: they are taken for one row that was written twice.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(attempt))
    return df.withColumn("_copy", rank).filter("_copy = 1").drop("_copy")
