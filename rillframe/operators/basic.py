"""Row-wise operators, limits, cuts and single-value sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.functions.values import draw

from rillframe.plans import Lineup, match_keys
from rillframe.plans.lineup import KINDS
from rillframe.session import settled

FIRST_ROWS = 100_000
_PLAIN = (T.IntegralType, T.FractionalType, T.StringType, T.BooleanType, T.DateType)


def compose(*flows: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """One flow out of several; Catalyst fuses their projections."""

    def run(df: DataFrame) -> DataFrame:
        for flow in flows:
            df = df.transform(flow)
        return df

    return run


def mapped(name: str, value: Column) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn(name, value)


def take(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows: each task keeps n, the result is merged."""
    return df.orderBy(*order).limit(n)


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return _has_order(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.AtomicType | T.NullType) and not isinstance(kind, T.VariantType)


def drop(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """All rows but the first n: exactly n go, NULLs come first, of rows that share a place the least in all columns.

    For a small n the n-th place is looked up first by one job and the table is filtered
    against it, so no row moves; rows that share that place are counted by another, and
    dropped from in the same way by all columns. Rows that are equal in every
    column are made again as often as they stay, so no task gets them all; only
    where a column has no order (a map) they go through one. Beyond a small n
    the rows are numbered.
    """
    if n <= 0:
        return df
    if n > FIRST_ROWS:
        return Lineup.of(df, [], order).numbered("_place").rows().filter(F.col("_place") >= n).drop("_place")
    firsts = take(df.select(*order), n, order).groupBy(*order).agg(F.count(F.lit(1)).alias("_rows"))
    found = firsts.orderBy(*[F.desc(c) for c in order]).limit(1).collect()  # the n-th place, and how many of the first n share it
    if not found:
        return df
    gone = found[0]["_rows"]
    place = F.struct(*order)  # compares NULLs as the sort does
    kinds = [df.schema[c].dataType for c in order]
    if all(isinstance(k, _PLAIN) for k in kinds):
        last = F.struct(*[F.lit(v).cast(kind).alias(c) for c, v, kind in zip(order, found[0], kinds)])
    else:  # times are read differently in Python, so they stay in the plan
        last = take(df.select(*order), n, order).agg(F.max(place).alias("last")).scalar()
    after, same = place > last, place == last
    if len(order) == 1 and isinstance(kinds[0], _PLAIN) and found[0][0] is not None:  # plain comparisons reach the scan
        after, same = F.col(order[0]) > F.lit(found[0][0]).cast(kinds[0]), F.col(order[0]) == F.lit(found[0][0]).cast(kinds[0])
    ties = df.filter(same)
    spare = ties.count() - gone
    rest = df.filter(after)
    if spare <= 0:
        return rest
    ordered = [f.name for f in df.schema.fields if _has_order(f.dataType)]
    more = [c for c in ordered if c not in order]
    if more and gone:
        left = drop(ties, gone, [*order, *more])
    elif not gone:
        left = ties
    elif len(ordered) < len(df.columns):
        left = ties.limit(spare)
    else:
        left = df.sparkSession.range(spare).select().crossJoin(F.broadcast(ties.limit(1)))
    return rest.unionByName(left)


def ends(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """First and last value of each group; no sort, combined before the shuffle."""
    place = F.struct(*order)
    firsts = F.min_by(value, place).alias("first")
    lasts = F.max_by(value, place).alias("last")
    return df.groupBy(*by).agg(firsts, lasts)


def fold(df: DataFrame, seed, value: Column, name: str, by: list[str] = (), kind: str = "sum") -> DataFrame:
    """A seeded sum, max, min or count: a table without rows gives the seed."""
    total = KINDS[kind](value)
    if kind in ("max", "min"):
        total = (F.greatest if kind == "max" else F.least)(total, F.lit(seed))
    else:
        total = F.coalesce(total, F.lit(0)) + F.lit(seed)
    return df.groupBy(*by).agg(total.cast("bigint").alias(name))


def reduce(df: DataFrame, by: list[str] = (), strict: bool = False, **totals: Column) -> DataFrame:
    """An unseeded aggregate: NULL over a table without rows, or an error if strict."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in totals.items()])
    if strict and not by:
        filled = F.when(F.col("_rows") > 0, F.lit(True)).otherwise(F.raise_error(F.lit("reduce of no rows")))
        out = out.filter(filled)
    return out.drop("_rows")


def cut_at(df: DataFrame, limits: DataFrame, at: str, limit: str, by: list[str] = ()) -> DataFrame:
    """Rows before the limit of their stream; a stream without a limit is whole.

    ``limits`` has one row per stream, or a single row for all when ``by`` is
    empty, which is read as a scalar. Limits per stream are written first: the
    planner then knows whether they are few enough to broadcast, and the rows
    need not move. Otherwise the join shuffles and skewed streams are split.
    """
    if not by:
        only = limits.agg(F.max(limit).alias("limit")).scalar()
        return df.filter(only.isNull() | (F.col(at) < only))
    joined = match_keys(df, settled(limits.select(*by, F.col(limit).alias("_limit"))), list(by), "left")
    return joined.filter(F.col("_limit").isNull() | (F.col(at) < F.col("_limit"))).drop("_limit")


def reject_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job on a NULL in any of the columns."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in {c}"))).otherwise(F.lit(True))
    return df.filter(whole)


def reject_ties(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Fail the job if two rows of a group share a place: ordered operators need an order that is unique."""
    places = df.groupBy(*by, *order).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    found = places.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    text = F.lit(f"{', '.join(order)} is not unique")
    return df.filter(F.when(found > 0, F.raise_error(text)).otherwise(F.lit(True)))


def random_draws(df: DataFrame, key: str, bound: int, seed: int, name: str = "draw") -> DataFrame:
    """Pseudo-random whole numbers in [0, bound), one per row, repeatable."""
    return df.withColumn(name, draw(F.col(key), bound, seed))
