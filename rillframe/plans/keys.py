"""Joins on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def match_keys(left: DataFrame, right: DataFrame, by: list[str], how: str) -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; keeps the left key columns."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") if c in by else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    out = left.join(renamed, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_{c}" for c in by])
