"""Fan-in: merge, concat, preferred merge, positional zip."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillframe.plans import Lineup
from rillframe.plans.slices import SLICE, cut_points, slices_at, surveys, up_to, whole_slices


def merge(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(DataFrame.unionByName, inputs)


def labelled(*inputs: DataFrame, name: str = "src") -> DataFrame:
    return merge(*[df.withColumn(name, F.lit(i)) for i, df in enumerate(inputs)])


def concat(inputs: list[DataFrame], order: list[str], place: str = "place") -> DataFrame:
    """The first input, then the second, and so on; ``place`` numbers the result from 0."""
    return Lineup.of(labelled(*inputs), [], ["src", *order]).numbered(place).rows()


def merge_preferred(preferred: DataFrame, others: list[DataFrame], ready: list[str], order: list[str],
                    place: str = "place") -> DataFrame:
    """Where several inputs have rows ready, those of the preferred one come first.

    ``ready`` names the columns that say when a row is available (a day, say);
    ``place`` numbers the rows inside it from 0.
    """
    both = labelled(preferred, merge(*others), name="rank")
    return Lineup.of(both, ready, ["rank", *order]).numbered(place).rows()


def zip_same(df: DataFrame, **values: Column) -> DataFrame:
    """Two flows over one source, zipped again: a projection, no join."""
    return df.select("*", *[v.alias(n) for n, v in values.items()])


def zip_by_place(*inputs: tuple[DataFrame, list[str]], place: str = "place") -> DataFrame:
    """The i-th row with the i-th row, as long as the shortest input.

    Each input comes with the columns that order it. Column names must differ between the inputs. One job surveys all
    inputs, and what surely lies behind the shortest input's length is filtered out at the scan. A second one counts
    the slices of what is left (the directory: where each slice's places begin), so that slices past the shortest
    input do not move either and a row's place is known from its slice. Places are dense, so the joins are free of skew.
    """
    known = surveys(list(inputs))
    shortest = min(s.rows for s in known)
    sliced = []
    for (df, order), own in zip(inputs, known):
        kept = up_to(df, order[0], own.holding(shortest)) if own.rows > shortest else df
        levels = cut_points(kept, order, shortest, whole_slices(df, shortest), own.first(shortest))
        sliced.append((slices_at(kept, levels), list(order), len(levels) == 1 and not levels[0][2], own.rows))
    listed = [df.select(F.lit(i).alias("_input"), SLICE) for i, (df, _, _, _) in enumerate(sliced)]
    directory = reduce(DataFrame.union, listed).groupBy("_input", SLICE).count().collect()
    numbered = []
    for i, (df, order, plain, rows) in enumerate(sliced):
        sizes = {r[SLICE]: r["count"] for r in directory if r["_input"] == i}
        starts, before = {}, 0
        for number in sorted(sizes):
            starts[number], before = before, before + sizes[number]
        if plain and starts:  # slices are numbered from 1 on
            last = max(n for n, start in starts.items() if start < shortest or n == min(starts))
            begin = F.array(*[F.lit(starts.get(n, 0)).cast("bigint") for n in range(1, last + 1)])[F.col(SLICE) - 1]
            own = F.row_number().over(Window.partitionBy(SLICE).orderBy(*order)) - 1
            out = df.filter(F.col(SLICE) <= last).withColumn(place, begin + own).drop(SLICE)
        else:
            out = Lineup(df, [], order, True).numbered(place).rows()
        numbered.append(out.filter(F.col(place) < shortest) if rows > shortest else out)
    return reduce(lambda a, b: a.join(b, place), numbered)


def max_of(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Row-wise maximum; NULL where any of the columns is NULL."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.withColumn(name, F.when(known, F.greatest(*columns)))
