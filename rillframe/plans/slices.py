"""Split long ordered groups into slices of bounded size.

A slice is a number that never decreases along the declared order. Any such
number gives right results; the cut points are chosen from quantiles of the
data so that no slice holds much more than ``rillframe.sliceRows`` rows. Cut
points are constants of the plan, so a recomputed task always agrees with the
one it replaces.

Where one value of an order column alone fills a whole slice, that value gets a
slice of its own, which is cut further by the next column. Texts are cut by their
leading bytes; where texts that agree in these fill a slice, the frequent ones of
them are ranked, and a text that alone fills a slice is cut by the next column too.

How many rows a whole table has and how they spread comes from one job (``survey``).
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.functions.values import micros
from rillframe.plans.keys import match_keys

SLICE = "_slice"
SLICE_ROWS = 4_000_000
MAX_HOT_KEYS = 100_000
MAX_SAMPLE = 1 << 19
SPREAD_ROWS = 10_000  # a whole table is spread over all cores from so many rows for each on
SAMPLES_PER_SLICE = 32
SAMPLES_PER_KEY = 256
TEXT_BYTES = 6  # bytes of a text in one axis: whole numbers that a double holds exactly
TEXT_AXES = 8
EXACT = float(2**53)
QUANTILES = 32  # marks of each partition in a survey
ACCURACY = 256  # their ranks are right up to this part of the partition

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)
_REAL = (T.FloatType, T.DoubleType)


def slice_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("rillframe.sliceRows", str(SLICE_ROWS)))


def axes(df: DataFrame, name: str) -> list:
    """The order column as doubles that rise with it, the first one first; NULL sorts first, NaN last.

    A text is cut by its leading bytes, a few in each axis. Times without zone need none here: they are counted from
    their own days, so a session zone with daylight saving changes nothing.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        data = col.cast("binary")
        parts = [F.substring(data, 1 + TEXT_BYTES * i, TEXT_BYTES) for i in range(TEXT_AXES)]
        numbers = [F.conv(F.rpad(F.hex(p), 2 * TEXT_BYTES, "0"), 16, 10) for p in parts]
        return [F.coalesce(n.cast("double"), F.lit(float("-inf"))) for n in numbers]
    if isinstance(kind, T.DateType):
        col = F.unix_date(col)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        col = micros(col) if isinstance(kind, T.TimestampNTZType) else F.unix_micros(col)
    elif isinstance(kind, _REAL):
        col = F.nanvl(col, F.lit(float("inf")))
    elif not isinstance(kind, (T.NumericType, T.BooleanType)):
        raise TypeError(f"order column {name} must be a number, text, date or timestamp, not {kind.simpleString()}")
    return [F.coalesce(col.cast("double"), F.lit(float("-inf")))]


def hot_keys(df: DataFrame, by: list[str], rows: int) -> tuple[DataFrame | None, int]:
    """Keys with more than about ``rows`` rows, and about how many rows they hold together.

    Keys are counted in a sample that holds some 256 rows of any such key; a
    key judged wrongly costs balance, never a result. At most MAX_HOT_KEYS of
    the largest keys are returned, so the table is small enough to broadcast; a
    key left out holds fewer rows than 1/MAX_HOT_KEYS of the table.
    """
    fraction = min(1.0, SAMPLES_PER_KEY / rows)
    keys = df.select(*by) if fraction == 1.0 else df.select(*by).sample(fraction, seed=17)
    counts = (
        keys.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows * fraction)
        .orderBy(F.desc("_rows"), *by)
        .limit(MAX_HOT_KEYS)
        .collect()
    )
    if not counts:
        return None, 0
    hot = [tuple(r[c] for c in by) for r in counts]
    schema = T.StructType([df.schema[c] for c in by])
    return df.sparkSession.createDataFrame(hot, schema), int(sum(r["_rows"] for r in counts) / fraction)


@dataclass(frozen=True)
class Survey:
    """How many rows a table has, and how the first axis of its order is spread.

    ``marks`` are quantiles of each partition: (value, rank, rows), the value has about ``rank`` parts of the
    partition's rows at or below it, up to one in ACCURACY.
    """

    rows: int
    marks: list[tuple[float, float, int]]

    def cuts(self, slices: int) -> list[float]:
        """Values at which as many slices are about equally long; one comes twice if it fills a slice."""
        weighed = sorted((v, n / QUANTILES) for v, rank, n in self.marks if rank > 0)
        out, seen, wanted = [], 0.0, 1
        for value, weight in weighed:
            seen += weight
            while wanted < slices and seen >= wanted * self.rows / slices:
                out.append(value)
                wanted += 1
        return out

    def holding(self, rows: int) -> float:
        """A value with at least so many rows at or below it, whatever the error of the marks."""
        sure: dict[float, float] = {}
        last: dict[int, float] = {}
        for part, (v, rank, n) in sorted(enumerate(self.marks), key=lambda x: x[1][0]):
            own = (rank - 1 / ACCURACY) * n - 1
            part //= QUANTILES + 1
            sure[v] = sure.get(v, 0.0) + max(0.0, own - last.get(part, 0.0))
            last[part] = max(own, last.get(part, 0.0))
        seen = 0.0
        for value, more in sure.items():
            seen += more
            if seen >= rows:
                return value
        return math.inf


    def first(self, rows: int) -> Survey:
        """The survey of about the first so many rows."""
        last = self.holding(rows)
        kept = [(v, rank, n) for v, rank, n in self.marks if v <= last]
        return Survey(max(rows, 1) if rows < self.rows else self.rows, kept)


def up_to(df: DataFrame, name: str, value: float) -> DataFrame:
    """The rows whose first axis in an order that starts with column ``name`` is ``value`` at most; NULL comes first.

    Where a double says a value of the column exactly, the filter is on the column itself and reaches the scan.
    """
    if math.isinf(value):
        return df if value > 0 else df.filter(F.col(name).isNull())
    if isinstance(df.schema[name].dataType, T.IntegralType) and abs(value) < EXACT:
        return df.filter(F.col(name).isNull() | (F.col(name) <= F.lit(int(value))))
    return df.filter(axes(df, name)[0] <= value)


def surveys(inputs: list[tuple[DataFrame, list[str]]]) -> list[Survey]:
    """Of several tables from one job: each partition is counted and its quantiles taken where it lies."""
    ranks = [k / QUANTILES for k in range(QUANTILES + 1)]
    spread = F.percentile_approx("_axis", ranks, ACCURACY)
    listed = [df.select(F.lit(i).alias("_input"), listed_axes(df, order)[0][1].alias("_axis")) for i, (df, order) in enumerate(inputs)]
    found = reduce(DataFrame.union, listed).groupBy("_input", F.spark_partition_id().alias("_part")).agg(F.count("*").alias("n"), spread.alias("marks")).collect()
    own = [[r for r in found if r["_input"] == i] for i in range(len(inputs))]
    return [Survey(sum(r["n"] for r in rows), [(v, k, r["n"]) for r in rows for v, k in zip(r["marks"], ranks)]) for rows in own]


def survey(df: DataFrame, order: list[str]) -> Survey:
    return surveys([(df, order)])[0]


Level = tuple[Column, list[float], list[int]]


def cut_points(df: DataFrame, order: list[str], rows: int, slices: int, known: Survey | None = None) -> list[Level]:
    """Per axis: its value, its splits, and the buckets to be cut further by the next axis.

    If the table has been surveyed and no value of the first axis is frequent, that says all. Otherwise a sample is
    brought to the driver: about SAMPLES_PER_SLICE times ``slices`` rows of a few numbers, half a million at most.
    """
    if known is not None:
        marks = known.cuts(slices)
        if len(set(marks)) == len(marks):
            return [(listed_axes(df, order)[0][1], sorted({v for v in marks if math.isfinite(v)}), [])]
    fraction = min(1.0, min(MAX_SAMPLE, SAMPLES_PER_SLICE * slices) / max(rows, 1))
    sample = df if fraction == 1.0 else df.sample(fraction, seed=17)
    step, levels, order = 0, [], list(order)
    while order:
        listed = listed_axes(df, order)
        points = [tuple(r) for r in sample.select(*[value.alias(f"a{i}") for i, (_, value) in enumerate(listed)]).collect()]
        step = step or max(1, len(points) // slices)
        inside = F.lit(True)
        for i, (name, value) in enumerate(listed):
            marks = sorted(p[i] for p in points)[step::step]
            heavy = sorted(v for v, times in Counter(marks).items() if times > 1 and _isolates(df, name, v))
            splits = sorted({v for v in marks if math.isfinite(v)} | {math.nextafter(v, math.inf) for v in heavy})
            levels.append((value, splits, [bisect_right(splits, v) for v in heavy]))
            if not heavy:
                return levels
            own = set(heavy)
            points = [p for p in points if p[i] in own]
            inside = inside & value.isin(heavy)
        text = listed[-1][0]
        order = order[order.index(text) + 1:]
        if not order or not isinstance(df.schema[text].dataType, (T.StringType, T.BinaryType)):
            return levels
        # what is left agrees in the leading bytes of a text: the texts that fill a slice get ranks, and are cut further
        hot = [r[0] for r in sample.filter(inside).groupBy(text).agg(F.count("*").alias("_n")).filter(F.col("_n") > step).orderBy(text).collect()]
        if not hot:
            return levels
        ranks = [float(2 * i + 1) for i in range(len(hot))]
        splits = sorted({*ranks, *(math.nextafter(r, math.inf) for r in ranks)})
        levels.append((ranked(F.col(text), hot), splits, [bisect_right(splits, r) for r in ranks]))
        sample = sample.filter(inside & F.col(text).isin(hot))
    return levels


def ranked(text: Column, hot: list) -> Column:
    """Twice the number of hot texts before a text, and one more for such a text itself: rises with the text."""
    out = F.lit(0.0)
    for h in hot:
        out = out + F.when(text > F.lit(h), 2.0).when(text == F.lit(h), 1.0).otherwise(0.0)
    return out


def listed_axes(df: DataFrame, order: list[str]) -> list[tuple]:
    """Every axis with its column's name, up to those of the first text."""
    listed = []
    for name in order:
        own = axes(df, name)
        listed += [(name, value) for value in own]
        if len(own) > 1:
            break
    return listed


def _isolates(df: DataFrame, name: str, value: float) -> bool:
    """Whether one double stands for exactly one value of the column."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return math.isfinite(value)  # for these bytes; the next axis has the bytes behind them
    return math.isfinite(value) and (isinstance(kind, _REAL) or (isinstance(kind, _WHOLE) and abs(value) < EXACT))


def _bucketed(df: DataFrame, value, splits: list[float], out: str) -> DataFrame:
    if not splits:
        return df.withColumn(out, F.lit(0.0))
    cut = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="_axis", outputCol=out, handleInvalid="keep")
    return cut.transform(df.withColumn("_axis", value)).drop("_axis")


def add_slices(df: DataFrame, by: list[str], order: list[str]) -> tuple[DataFrame, bool]:
    """Add the slice column where a group is too long for one task.

    Without ``by`` the whole table is one group and is always sliced. Returns
    the frame and whether it has slices. Rows of short groups are in slice 0,
    rows of sliced groups in slices from 1 on.
    """
    limit = slice_rows(df)
    if not by:
        known = survey(df, order)
        return slices_at(df, cut_points(df, order, known.rows, whole_slices(df, known.rows), known)), True
    hot, rows = hot_keys(df, by, limit)
    if hot is None:
        return df, False
    long_rows = match_keys(df, F.broadcast(hot), by, "left_semi")
    levels = cut_points(long_rows, order, rows, max(2, math.ceil(rows / limit)))
    sliced = match_keys(slices_at(df, levels), F.broadcast(hot.withColumn("_hot", F.lit(True))), by, "left")
    return sliced.select(*df.columns, F.when(F.col("_hot"), F.col(SLICE)).otherwise(F.lit(0).cast("bigint")).alias(SLICE)), True


def whole_slices(df: DataFrame, rows: int) -> int:
    """How many slices a table of so many rows is cut into."""
    spread = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / SPREAD_ROWS))
    return max(2, spread, math.ceil(rows / slice_rows(df)))


def slices_at(df: DataFrame, levels: list[Level]) -> DataFrame:
    """Add the slice column, from 1 on."""
    sliced, number, inside = df, F.lit(0).cast("bigint"), F.lit(True)
    for i, (value, splits, heavy) in enumerate(levels):
        sliced = _bucketed(sliced, F.when(inside, value).otherwise(F.lit(float("-inf"))) if i else value, splits, f"_cut{i}")
        number = number * (len(splits) + 2) + F.when(inside, F.col(f"_cut{i}").cast("bigint")).otherwise(F.lit(0))
        inside = inside & F.col(f"_cut{i}").isin([float(b) for b in heavy])
    return sliced.select(*df.columns, (number + 1).alias(SLICE))
