"""Rate shaping, bounded buffers and filling of time grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillframe.plans import Lineup, last_run, max_run
from rillframe.plans.slices import slice_rows

# Up to this many rows per group, each map task keeps the first rows itself.
GROUP_LIMIT = 100
SALTS = 64  # tasks that merge what the map tasks kept of one group, before one merges theirs
GAP = 10_000


def throttle(df: DataFrame, by: list[str], order: list[str], arrival: Column, n: int, per: int,
             name: str = "release") -> DataFrame:
    """Release at most n rows per ``per`` micros, evenly spaced and in order.

    Row i leaves at max(arrival i, release i-1 + c) with c = per / n, which is
    i*c plus the running maximum of arrival j - j*c. All is counted in n-ths of
    a micro, and a release is rounded up to whole micros at the end only.
    """
    part = lambda x: x.cast("decimal(20,0)") * F.lit(n).cast("decimal(18,0)")
    spent = F.col("_i").cast("decimal(18,0)") * F.lit(per).cast("decimal(20,0)")
    line = Lineup.of(df, by, order).numbered("_i")
    line = line.running(_lead=max_run(part(arrival) - spent))
    released = F.expr(f"`_at` div {n}") + (F.expr(f"`_at` % {n}") > 0).cast("bigint")
    rows = line.rows().withColumn("_at", spent + F.col("_lead"))
    return rows.withColumn(name, released.cast("bigint")).drop("_i", "_lead", "_at")


def _nearest(df: DataFrame, by: list[str], order: list[str], n: int, last: bool) -> DataFrame:
    if n <= GROUP_LIMIT:
        sort = [F.desc(c) if last else F.asc(c) for c in order]
        # the map tasks of a salt share a merging task, so a hot group is merged by SALTS tasks and then by one
        rows = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        for keys in ([*by, "_salt"], by):
            rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
            rows = rows.withColumn("_n", rank).filter(F.col("_n") <= n).drop("_n")
        return rows.drop("_salt")
    line = Lineup.of(df, by, order).numbered("_n")
    if last:
        return line.sized("_all").rows().filter(F.col("_n") >= F.col("_all") - n).drop("_n", "_all")
    return line.rows().filter(F.col("_n") < n).drop("_n")


def shed(df: DataFrame, by: list[str], order: list[str], n: int, policy: str) -> DataFrame:
    """What is left in a buffer of n rows per group when nothing is taken out meanwhile.

    Policies on overflow: ``drop_head`` the oldest row goes, ``drop_tail`` the
    newest buffered row goes, ``drop_new`` the arriving row goes, ``drop_buffer``
    all buffered rows go, ``backpressure`` nothing is lost, ``fail`` the job fails.
    """
    if policy == "backpressure":
        return df
    if policy == "drop_head":
        return _nearest(df, by, order, n, last=True)
    if policy == "drop_new":
        return _nearest(df, by, order, n, last=False)
    if policy == "fail":
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
        most = sizes.agg(F.max("_rows").alias("most")).scalar()
        text = F.lit(f"buffer of {n} rows overflows")
        return df.filter(F.when(most > n, F.raise_error(text)).otherwise(F.lit(True)))
    line = Lineup.of(df, by, order).numbered("_n").sized("_all")
    if policy == "drop_tail":
        kept = (F.col("_n") < n - 1) | (F.col("_n") == F.col("_all") - 1)
    elif policy == "drop_buffer":
        kept = F.col("_n") >= F.floor((F.col("_all") - 1) / n) * n
    else:
        raise ValueError(f"unknown policy {policy}")
    return line.rows().filter(kept).drop("_n", "_all")


def extrapolate(df: DataFrame, by: list[str], order: list[str], tick: Column, value: Column,
                name: str = "value") -> DataFrame:
    """Fill a grid of whole-number ticks from each group's first to its last.

    Gives ``tick``, the last real value in ``name``, ``since`` (ticks since that
    value) and ``synthetic``. Rows are first reduced to the last one per tick,
    combined before the shuffle. Every row then fills the gap before it from the
    row that precedes it; the grid is never joined. A group has at most one row
    per tick of the time span, so it is checked for long groups only where the
    span allows them. A NULL tick has no place on the grid and fails the job. A
    long gap is opened in two steps, so no array holds more than GAP ticks.
    """
    at = F.when(tick.isNull(), F.raise_error(F.lit("a tick is NULL")).cast("bigint")).otherwise(tick.cast("bigint"))
    latest = df.groupBy(*by, at.alias("_at")).agg(F.max_by(value, F.struct(*order)).alias(name))
    ends = df.agg(F.min(at).alias("first"), F.max(at).alias("last")).collect()[0]
    real = F.struct(F.col("_at").alias("tick"), F.col(name).alias("value"))
    if by and ends["first"] is not None and ends["last"] - ends["first"] < slice_rows(df):
        line = Lineup(latest, by, ["_at"], sliced=False)
    else:
        line = Lineup.of(latest, by, ["_at"])
    rows = line.preceding(_previous=last_run(real)).rows()
    start = F.coalesce(F.col("_previous.tick") + 1, F.col("_at"))
    blocks = rows.select("*", F.explode(F.sequence(start, F.col("_at"), F.lit(GAP).cast("bigint"))).alias("_block"))
    block = F.sequence(F.col("_block"), F.least(F.col("_block") + GAP - 1, F.col("_at")))
    ticks = blocks.select("*", F.explode(block).alias("tick"))
    synthetic = F.col("tick") < F.col("_at")
    return ticks.select(
        *by, "tick",
        F.when(synthetic, F.col("_previous.value")).otherwise(F.col(name)).alias(name),
        F.when(synthetic, F.col("tick") - F.col("_previous.tick")).otherwise(F.lit(0)).alias("since"),
        synthetic.alias("synthetic"),
    )


def fill_forward(df: DataFrame, by: list[str], order: list[str], tick: Column, value: Column,
                 name: str = "value") -> DataFrame:
    """The grid with the last value repeated."""
    return extrapolate(df, by, order, tick, value, name).drop("since", "synthetic")


def expand(df: DataFrame, by: list[str], order: list[str], tick: Column, value: Column,
           name: str = "value") -> DataFrame:
    """The grid counting up from the last real value."""
    return extrapolate(df, by, order, tick, value, name).withColumn(name, F.col(name) + F.col("since"))
