"""Connected groups of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillframe.llm.store import released


def components(links: DataFrame) -> DataFrame:
    """(id, component) for the ids in links (a, b): the smallest id reachable. Null ends and loops count for nothing.

    Each round every id joins its smallest neighbour if that is smaller, and links then run between the ids joined
    to; a star of any size is gone after one round, a chain halves at least. Rounds end when no link is left, after
    about log2 of the longest path; each is written, so a lost executor costs one round. Nothing comes to the
    driver but a count.
    """
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    edges = released(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    joined = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = released(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to")).select("id", F.least("id", "to").alias("to")))
        # an id joins one that may itself join a smaller one: follow once more, which keeps all on paths downwards
        after = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        step = released(step.join(after, "to").select("id", F.least("to", "next").alias("to")))
        if joined is None:
            joined = step
        else:
            joined = released(joined.withColumnRenamed("to", "mid").join(
                step.select(F.col("id").alias("mid"), "to"), "mid", "left").select("id", F.coalesce("to", "mid").alias("to")))
        left = step.select(F.col("id").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("id").alias("b"), F.col("to").alias("y"))
        moved = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = released(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if joined is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return joined.select("id", F.col("to").alias("component"))
