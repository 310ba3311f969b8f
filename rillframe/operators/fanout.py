"""Fan-out: several consumers of one table, and dealing rows to lanes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillframe.functions.text import is_lower
from rillframe.operators.combine import labelled
from rillframe.plans import Lineup


def balance(df: DataFrame, order: list[str], lanes: int, lane: str = "lane") -> DataFrame:
    """Every row to exactly one of ``lanes`` lanes, dealt in turn."""
    dealt = Lineup.of(df, [], order).numbered(lane).rows()
    return dealt.withColumn(lane, F.col(lane) % lanes)


def balance_mxn(inputs: list[DataFrame], order: list[str], lanes: int, lane: str = "lane") -> DataFrame:
    """Several inputs merged, then dealt over any number of lanes."""
    return balance(labelled(*inputs), [*order, "src"], lanes, lane)


def lane_counts(df: DataFrame, lane: str = "lane", **sums: Column) -> DataFrame:
    totals = [F.sum(c).alias(n) for n, c in sums.items()]
    return df.groupBy(lane).agg(F.count(F.lit(1)).alias("rows"), *totals)


def copies(df: DataFrame, outlets: dict[str, Column], name: str = "outlet") -> DataFrame:
    """Every row to each outlet whose condition it meets, in one pass over the table.

    A row goes to none, one or several outlets; the conditions are independent.
    """
    hits = [F.when(condition, F.lit(outlet)) for outlet, condition in outlets.items()]
    return df.withColumn(name, F.explode(F.array_compact(F.array(*hits))))


def both(df: DataFrame, by: list[str], **consumers: Column) -> DataFrame:
    """Several aggregating consumers of every row: one scan, one aggregate."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in consumers.items()])


def flag(df: DataFrame, key: str, suspicious: Column) -> tuple[DataFrame, DataFrame]:
    """All rows, and the keys alone of the suspicious ones."""
    return df, df.filter(suspicious).select(key)


def word_sink(df: DataFrame, word: str, by: list[str] = (), short: int = 5) -> DataFrame:
    """Short words and words in lower case, counted in one pass."""
    return df.groupBy(*by).agg(
        F.count_if(F.length(word) < short).alias("short_words"),
        F.count_if(is_lower(F.col(word))).alias("lower_words"),
    )
