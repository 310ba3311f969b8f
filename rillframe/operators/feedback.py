"""Feedback loops with a bound, as rounds of joins."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from rillframe.session import settled


def iterate(seed: DataFrame, step: Callable[[DataFrame, int], DataFrame], key: list[str], max_rounds: int) -> DataFrame:
    """Feed each round's new rows into the next, until none are new or the bound is reached.

    ``step`` gets the rows that were new in the round before. Every round is
    written to the shared folder, so lineage does not grow and a lost executor
    costs one round at most. ``round`` is 0 for the seed. Where the bound ends
    the loop while rows are still new, a warning says that there may be more.
    """
    fresh = settled(seed.dropDuplicates(key).withColumn("round", F.lit(0)))
    reached = fresh
    for number in range(1, max_rounds + 1):
        found = step(fresh, number).select(*key).distinct()
        fresh = settled(found.join(reached.select(*key), key, "left_anti").withColumn("round", F.lit(number)))
        if fresh.isEmpty():
            return reached
        reached = reached.unionByName(fresh)
    warnings.warn(f"stopped after {max_rounds} rounds with new rows in the last one", stacklevel=2)
    return reached


def hop_distance(edges: DataFrame, left: str, right: str, start: DataFrame, max_rounds: int) -> DataFrame:
    """Least number of hops from the start nodes over edges between two kinds of node.

    ``start`` has the column ``node`` with keys of the ``left`` kind. Gives ``kind``, ``node`` and ``hops``. A round
    joins the nodes that are new with the pairs that no round has used so far, and uses those up: every pair is
    followed once, what is left shrinks from round to round, and a node that is reached already is never looked at
    again from that side. Rounds are written, so a lost executor costs one.
    """
    open_pairs = settled(edges.select(F.col(left).alias("_left"), F.col(right).alias("_right")).distinct())
    sides = {left: ("_left", "_right", right), right: ("_right", "_left", left)}
    fresh = {left: settled(start.select("node").distinct())}
    reached = {left: fresh[left], right: fresh[left].limit(0)}
    out = fresh[left].select(F.lit(left).alias("kind"), "node", F.lit(0).alias("hops"))
    kind = left
    for number in range(1, max_rounds + 1):
        here, there, other = sides[kind]
        marked = settled(open_pairs.join(fresh[kind].select(F.col("node").alias(here), F.lit(True).alias("_used")), here, "left"))
        found = marked.filter("_used").select(F.col(there).alias("node")).distinct()
        new = settled(found.join(reached[other], "node", "left_anti"))
        if new.isEmpty():
            return out
        out = out.unionByName(new.select(F.lit(other).alias("kind"), "node", F.lit(number).alias("hops")))
        reached[other] = reached[other].unionByName(new)
        open_pairs, fresh, kind = marked.filter("_used IS NULL").drop("_used"), {other: new}, other
    warnings.warn(f"stopped after {max_rounds} rounds with new rows in the last one", stacklevel=2)
    return out
