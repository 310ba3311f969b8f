"""Groups, segments, batches and merged bursts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rillframe.plans import Lineup, count_run, sum_run
from rillframe.plans.lineup import KINDS, Run

# The text of a merged event.
BEFORE_COUNT = "You have "
AFTER_COUNT = " events that require your attention"


def key_limit(df: DataFrame, key: str, limit: int) -> Column:
    """True while ``key`` has at most ``limit`` distinct values; more fail the job.

    No more than limit + 1 keys are looked at together.
    """
    seen = df.select(key).distinct().limit(limit + 1).agg(F.count(F.lit(1)).alias("_keys")).scalar()
    text = F.lit(f"more than {limit} groups of {key}")
    return F.when(seen > limit, F.raise_error(text)).otherwise(F.lit(True))


def group_fold(df: DataFrame, key: str, max_groups: int | None = None, **folds: Column) -> DataFrame:
    """One folded row per group, at most ``max_groups`` of them."""
    out = df.groupBy(key).agg(*[c.alias(n) for n, c in folds.items()])
    if max_groups is None:
        return out
    return out.filter(key_limit(df, key, max_groups))


def merge_groups(df: DataFrame, key: Column, value: Column, name: str, kind: str = "sum") -> DataFrame:
    """Reduce inside each group, then reduce the groups to one row: sum, max, min or count."""
    inside = df.groupBy(key.alias("_key")).agg(KINDS[kind](value).alias("_part"))
    return inside.agg(KINDS["sum" if kind == "count" else kind](F.col("_part")).alias(name))


def split_when(df: DataFrame, by: list[str], order: list[str], opens: Column, name: str = "segment") -> DataFrame:
    """Number the segments of each group; a row that meets ``opens`` starts the next one.

    Rows before the first opener are in segment 0. The opening row belongs to
    the segment it opens and is marked in ``opener``.
    """
    opener = F.coalesce(opens, F.lit(False))
    marked = df.withColumn("opener", opener)
    return Lineup.of(marked, by, order).running(**{name: sum_run(F.col("opener").cast("bigint"))}).rows()


def batches(df: DataFrame, by: list[str], order: list[str], size: int, value: str, name: str = "batch") -> DataFrame:
    """Consecutive values in batches of ``size``; the last batch of a group may be short."""
    placed = Lineup.of(df.select(*dict.fromkeys([*by, *order, value])), by, order).numbered("_place").rows()
    batch = F.floor(F.col("_place") / size).cast("bigint").alias(name)
    items = F.array_sort(F.collect_list(F.struct("_place", F.col(value).alias("_value"))))
    return placed.groupBy(*by, batch).agg(
        F.count(F.lit(1)).alias("size"),
        F.transform(items, lambda item: item["_value"]).alias("items"),
    )


def burst_parts(df: DataFrame, by: list[str], description: str, instances: Column | None = None,
                at: Column | None = None) -> DataFrame:
    """What is known of the events of each busy period so far; parts of a period can be added up."""
    count = F.lit(1).cast("bigint") if instances is None else instances
    date = [] if at is None else [F.max(at).alias("date")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("events"), F.sum(count).alias("instances"),
                               F.min(description).alias("own"), *date)


def add_parts(parts: DataFrame, by: list[str]) -> DataFrame:
    date = [F.max("date").alias("date")] if "date" in parts.columns else []
    return parts.groupBy(*by).agg(F.sum("events").alias("events"), F.sum("instances").alias("instances"),
                                  F.min("own").alias("own"), *date)


def _merged_text(instances: Column) -> Column:
    return F.concat(F.lit(BEFORE_COUNT), instances, F.lit(AFTER_COUNT))


def told(parts: DataFrame, by: list[str], merge: Callable[[Column], Column] = _merged_text) -> DataFrame:
    """The merged event of each period: a lone event keeps its description, others get ``merge`` of their number."""
    text = F.when(F.col("events") == 1, F.col("own")).otherwise(merge(F.col("instances")))
    date = ["date"] if "date" in parts.columns else []
    return parts.select(*by, text.alias("description"), "instances", *date)


def conflate(df: DataFrame, by: list[str], description: str, instances: Column | None = None,
             at: Column | None = None, merge: Callable[[Column], Column] = _merged_text) -> DataFrame:
    """Merge the events of a busy period; a lone event keeps its own description.

    ``by`` holds the key and the period. With ``at`` the result has a ``date``: the time of the period's last event,
    which for a lone event is its own. ``merge`` words a merged event from its number of instances. Everything
    combines before the shuffle.
    """
    return told(burst_parts(df, by, description, instances, at), by, merge)


def flat_map_concat(df: DataFrame, values: Column, name: str, place: str = "pos") -> DataFrame:
    """Expand every row; ``place`` keeps the order inside one row's expansion."""
    return df.select("*", F.posexplode(values).alias(place, name))


def flat_map_merge(df: DataFrame, values: Column, name: str) -> DataFrame:
    """Expand every row; the result is a bag."""
    return df.select("*", F.explode(values).alias(name))


def _seeded(kind: str, running: Column, seed) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(running, F.lit(0)) + F.lit(seed)
    if kind == "last":
        return F.coalesce(running, F.lit(seed))
    return (F.greatest if kind == "max" else F.least)(running, F.lit(seed))


def scan(df: DataFrame, by: list[str], order: list[str], value: Column, name: str = "running", seed: int | None = 0,
         place: str = "place", kind: str = "sum") -> DataFrame:
    """Running sum, max, min, last value or count, with the seed as an extra row at place 0 of each group.

    NULL values change nothing. A seed of None stands for no value: max, min and last then start as NULL.

    n rows give n + 1. The seed row carries the key columns only and is made
    from the first row of the group, so the table is read once; without ``by``
    it is there even if the table has no rows.
    """
    run = sum_run(value.isNotNull().cast("bigint")) if kind == "count" else Run(kind, value)
    line = Lineup.of(df, by, order).running(_run=run, _place=count_run())
    row = F.struct(F.col("_place").alias(place), _seeded(kind, F.col("_run"), seed).cast("bigint").alias(name),
                   *[F.col(c) for c in df.columns if c not in by])
    empty = F.struct(F.lit(0).cast("bigint").alias(place), F.lit(seed).cast("bigint").alias(name),
                     *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns if c not in by])
    if by:
        both = F.when(F.col("_place") == 1, F.array(empty, row)).otherwise(F.array(row))
        return line.rows().select(*by, F.explode(both).alias("_row")).select(*by, "_row.*")
    first = df.sparkSession.range(1).select(empty.alias("_row")).select("_row.*")
    return line.rows().select(row.alias("_row")).select("_row.*").unionByName(first)
