"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``points``; every shard owns the arcs that end at its ``nodes`` virtual nodes, and a row belongs to the
arc that its hash falls into. A shard takes rows of its own arcs up to its capacity; rows beyond that go on clockwise
to the next virtual node whose shard has room. With ``slack`` 0 the capacities are the exact quotas, so row counts
are at most one apart (the law ``rows``); with more slack fewer rows leave their arc and no shard exceeds
(1 + slack) times the mean. Growing by a shard moves the rows of the new shard's arcs and those at the brim.

Only column expressions run over rows. A shard is known from the row's rank in its arc: counts of points, summed
up within each arc, and a row number within the point. The plan that says where the ranks of an arc go has an entry
for each arc, ``shards * nodes``, whatever the size of the table; it is made on the driver from as many counts.

Key of a row is its doc_id and text, so only rows that are equal in both share a place; these are interchangeable.
Null texts are empty (size 1), null ids hash like any other value. An empty table has no shards filled. The result
has the columns below only, so names in the input do not clash.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rillframe.llm.store import lean, settled

NODES = 64
ROWS_PER_POINT = 20_000
LEAST_POINTS = 1 << 16


def nodes_of(shards: int, nodes: int, points: int) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node in clockwise order; a taken point passes a node on to the next."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for k in range(nodes):
            at = int.from_bytes(hashlib.blake2b(f"{shard}/{k}".encode(), digest_size=8).digest()) * points >> 64
            while at in taken:
                at = (at + 1) % points
            taken[at] = shard
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [math.ceil((1 + slack) * rows / shards)] * shards


def spill(owners: list[int], counts: list[int], room: list[int]) -> list[list[tuple[int, int]]]:
    """For each arc, which shards take how many of its rows, in order of rank. Own arcs are served first."""
    room = list(room)
    taken: list[list[tuple[int, int]]] = []
    for owner, count in zip(owners, counts):
        own = min(count, room[owner])
        room[owner] -= own
        taken.append([(owner, own)] if own else [])
    for arc, count in enumerate(counts):
        left = count - sum(n for _, n in taken[arc])
        for step in range(1, len(owners) + 1):
            if not left:
                break
            shard = owners[(arc + step) % len(owners)]
            more = min(left, room[shard])
            if more:
                room[shard] -= more
                left -= more
                taken[arc].append((shard, more))
    return taken


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def shard(docs: DataFrame, shards: int = 8, slack: float = 0.0, nodes: int = NODES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; slots of a shard count from 0."""
    points = max(LEAST_POINTS, 1 << math.ceil(math.log2(docs.count() / ROWS_PER_POINT + 1)))
    rows = settled(lean(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(_text()) + 1).cast("long").alias("size"),
        F.crc32(_text()).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("_hash"),
    ).withColumn("_point", F.shiftrightunsigned("_hash", 64 - points.bit_length() + 1)))

    ring = nodes_of(shards, nodes, points)
    counted = settled(rows.groupBy("_point").agg(F.count("*").alias("_n")).join(_arcs(docs.sparkSession, ring, points), "_point"))
    totals = {r["_arc"]: r["n"] for r in counted.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    counts = [totals.get(arc, 0) for arc in range(len(ring))]
    owners = [owner for _, owner in ring]
    plan = _plan(docs.sparkSession, spill(owners, counts, capacities(sum(counts), shards, slack)))

    clockwise = Window.partitionBy("_arc").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    places = counted.withColumn("_before", F.coalesce(F.sum("_n").over(clockwise), F.lit(0))).join(plan, "_arc")
    within = Window.partitionBy("_point").orderBy("_hash", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(places.select("_point", "_before", "_parts"), "_point")
    rank = F.col("_before") + F.col("_rank")
    ranked = ranked.withColumn("_rank", rank).withColumn("_part", F.filter("_parts", lambda part: F.col("_rank") < part["end"])[0])
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows" if slack <= 0 else "bounded").alias("law"), F.col("_part.shard").alias("shard"),
        (F.col("_rank") + F.col("_part.shift")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def _arcs(spark: SparkSession, ring: list[tuple[int, int]], points: int) -> DataFrame:
    """(_point, _arc, _order): the arc of every point. Points behind the last node come first in the first arc."""
    ends = [at for at, _ in ring]
    spans = [(arc, low + 1, end) for arc, (low, end) in enumerate(zip([-1, *ends], ends))]
    if ends[-1] < points - 1:
        spans.append((0, ends[-1] + 1, points - 1))
    listed = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({a}, {b}L, {c}L)" for a, b, c in spans) + " AS t(_arc, _low, _end)")
    point = F.explode(F.sequence("_low", "_end"))
    order = F.when((F.col("_arc") == 0) & (F.col("_point") > ends[0]), F.col("_point") - points).otherwise(F.col("_point"))
    return listed.select("_arc", point.alias("_point")).withColumn("_order", order)


def _plan(spark: SparkSession, taken: list[list[tuple[int, int]]]) -> DataFrame:
    """(_arc, _parts): of the ranks of an arc below ``end``, the shard, and what to add for the slot there."""
    filled: dict[int, int] = {}
    rows = []
    for arc, parts in enumerate(taken):
        start = 0
        for shard, count in parts:
            rows.append(f"({arc}, {start + count}L, {shard}, {filled.get(shard, 0) - start}L)")
            filled[shard] = filled.get(shard, 0) + count
            start += count
    made = spark.sql("SELECT * FROM VALUES " + ", ".join(rows or ["(-1, 0L, 0, 0L)"]) + " AS t(_arc, end, shard, shift)")
    return made.groupBy("_arc").agg(F.sort_array(F.collect_list(F.struct("end", "shard", "shift"))).alias("_parts"))
