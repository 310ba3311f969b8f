"""Side results of a flow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F


def counted(flow: Callable[[DataFrame], DataFrame], **measures: Column):
    """A flow that also counts its output: gives the rows and an Observation.

    The Observation is filled by the first action over the rows; a failed
    action fills nothing.
    """

    def run(df: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation()
        return df.transform(flow).observe(seen, F.count(F.lit(1)).alias("count"),
                                          *[c.alias(n) for n, c in measures.items()]), seen

    return run


def traced(df: DataFrame, column: str) -> tuple[DataFrame, Observation]:
    """Count, minimum and maximum of the rows that pass; no printing per row."""
    return counted(lambda rows: rows, low=F.min(column), high=F.max(column))(df)


def drain(df: DataFrame) -> None:
    """Run a plan and drop its rows."""
    df.write.format("noop").mode("overwrite").save()
