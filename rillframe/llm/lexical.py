"""Ranked search by terms in pipelined term partitions.

Every term belongs to one owner, by how many documents hold it: the first owner has the rarest terms. Items travel in
bundles. A bundle carries for each of its items sparse accumulators, the documents that have a score so far, and visits
the owners one after another; at an owner it meets the postings of the owner's terms in a cogroup and adds their
integer contributions. Behind the last owner the best documents are selected. Documents are dealt into blocks of about
``BLOCK``, and a bundle visits an owner once for each block, so a term that a third of all documents hold, or a long item,
is shared by as many tasks as there are blocks.

What is dropped on the way cannot be among the results. After each owner the ``k``-th best score of an item so far,
over all blocks, is a floor: scores only grow. What the owners ahead can add to any document is bounded by the greatest
contribution of each term. A document whose score and bound together stay below the floor goes; once the bound alone
is below the floor no document without a score is taken up any more. Each stage is a written table.

Scores: a term in df of N documents weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); a document with n of all L terms has
m = 75 + 25 n N div L; a term that stands tf times adds w ((10**9 tf) div (1000 tf + 12 m)), once for each time the item has
it. N counts documents with a term. Ties go to the smaller doc_id.

Null and empty texts have no terms. Rows are documents of their own, also if they repeat; a null doc_id comes after
all others. Rows of one item_id are one item, a null item_id is an item too. Items without a term, and documents
without a score above 0, have no rows. Other columns do not pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rillframe.llm.store import few, lean, settled
from rillframe.llm.terms import terms
from rillframe.llm.words import Texts, distinct, owners, slices

SHARES = (1000, 100, 10)  # an owner's terms stand in one of so many documents at most; the last owner has the rest
BLOCK = 8192  # documents
BUNDLE = 256  # items
POSTINGS = "row long, id long, n long, term string, tf long"
STATE = "bundle int, block int, item string, rows binary, ids binary, scores binary, best array<long>"
FOUND = "item string, row long, id long, score long"


def postings(texts: DataFrame) -> DataFrame:
    """(row, id, n, term, tf) for (row, id, text): a row for each term of a text, and one with the term "" for each text.

    n counts the text's terms with repeats.
    """
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("term", pa.string()), ("tf", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, starts, ends, edges = terms(Texts(batch.column("text")))
            words, which = distinct(data, starts, ends)
            pairs, tf = np.unique(owners(edges) * len(words) + which, return_counts=True)
            all_rows = np.arange(batch.num_rows)
            rows = pa.array(np.concatenate([all_rows, pairs // max(len(words), 1)]))
            found = pa.concat_arrays([pa.array([""] * batch.num_rows, pa.large_string()), words.cast(pa.large_string()).take(pa.array(pairs % max(len(words), 1)))])
            n = pa.array(np.diff(edges).astype(np.int64)).take(rows)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(rows), batch.column("id").take(rows), n, found.cast(pa.string()),
                                              pa.array(np.concatenate([np.zeros(batch.num_rows, np.int64), tf]))], schema=schema)

    return texts.mapInArrow(run, POSTINGS)


def asked_of(items: DataFrame) -> DataFrame:
    """(item, term, qtf): the terms of each item; item is the item_id as text, empty if it is null."""
    keyed = lean(items, "item_id", "text").select(F.lit(0).cast("long").alias("row"), F.col("item_id").cast("long").alias("id"), "text")
    named = postings(keyed).where("term <> ''").select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("item"), "term", "tf")
    return named.groupBy("item", "term").agg(F.sum("tf").alias("qtf"))


def _rate(count: int, length: int) -> Column:
    """What a term adds for each unit of its weight, in a document of n terms."""
    return F.expr(f"(1000000000 * tf) div (1000 * tf + 12 * (75 + (25 * n * {count}L) div {length}L))")


def weights(hits: DataFrame, count: int, length: int) -> DataFrame:
    """(term, t, w, most, owner) of the terms that weigh anything: a number, the weight, and the greatest contribution."""
    share = F.lit(len(SHARES))
    for k in reversed(range(len(SHARES))):
        share = F.when(F.col("df") * SHARES[k] <= count, k).otherwise(share)
    by_term = hits.where("term <> ''").groupBy("term").agg(F.count("*").alias("df"), F.max(_rate(count, length)).alias("rate"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * count + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = by_term.withColumn("w", weight).where("w > 0").withColumn("most", F.col("w") * F.col("rate"))
    return weighed.select("term", F.monotonically_increasing_id().alias("t"), "w", "most", share.cast("int").alias("owner"))


def _added(left: dict, by_term: dict, postings: tuple, new: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The accumulators of an item after an owner: rows, ids and scores."""
    own = [np.frombuffer(left[c] or b"", np.int64) for c in ("rows", "ids", "scores")]
    parts = [own]
    for term in left["terms"]:
        span = by_term.get(term["t"])
        if span:
            rows, ids, values = (x[slice(*span)] for x in postings)
            parts.append([rows, ids, values * term["qtf"]])
    rows, ids, scores = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(rows, kind="stable")
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.flatnonzero(np.diff(rows, prepend=rows[:1] - 1)) if len(rows) else np.zeros(0, np.int64)
    rows, ids, scores = rows[first], ids[first], np.add.reduceat(scores, first) if len(first) else scores
    if not new:
        keep = np.isin(rows, own[0])
        rows, ids, scores = rows[keep], ids[keep], scores[keep]
    return rows, ids, scores


def _met(left: pa.Table, right: pa.Table) -> Iterator[tuple]:
    """Each item of a bundle with its accumulators after the owner's postings of a block, without what cannot be found."""
    t = right["t"].to_numpy()
    order = np.argsort(t, kind="stable")
    t = t[order]
    postings = tuple(right[c].to_numpy()[order] for c in ("row", "id", "value"))
    edges = np.flatnonzero(np.diff(t, prepend=t[:1] - 1, append=t[-1:] + 1)).tolist() if len(t) else []
    by_term = {int(t[a]): (a, b) for a, b in zip(edges, edges[1:])}
    for item in left.to_pylist():
        rows, ids, scores = _added(item, by_term, postings, item["ahead"] >= item["floor"])
        keep = scores + item["after"] >= item["floor"]
        yield item, rows[keep], ids[keep], scores[keep]


def _visit(k: int):
    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for item, rows, ids, scores in _met(left, right):
            best = np.sort(scores)[-k:].tolist()
            made.append({"bundle": item["bundle"], "block": item["block"], "item": item["item"], "rows": rows.tobytes(),
                         "ids": ids.tobytes(), "scores": scores.tobytes(), "best": best})
        return pa.Table.from_pylist(made, pa.schema([("bundle", pa.int32()), ("block", pa.int32()), ("item", pa.string()), ("rows", pa.binary()),
                                                     ("ids", pa.binary()), ("scores", pa.binary()), ("best", pa.list_(pa.int64()))]))

    return visit


def _select(k: int):
    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for item, rows, ids, scores in _met(left, right):
            top = np.lexsort((rows, ids, rows < 0, -scores))[:k]
            top = top[scores[top] > 0]
            parts.append(([item["item"]] * len(top), rows[top], ids[top], scores[top]))
        columns = [[x for p in parts for x in p[0]], *(np.concatenate([p[c] for p in parts] or [np.zeros(0, np.int64)]) for c in (1, 2, 3))]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 3))], names=["item", "row", "id", "score"])

    return select


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    asked = settled(asked_of(items))
    wanted = settled(asked.select("term").union(asked.sparkSession.createDataFrame([("",)], "term string")).distinct())
    # a row's number is below 0 if it has no doc_id; the written table fixes the numbers
    number = F.monotonically_increasing_id()
    keyed = lean(docs, "doc_id", "text").select(F.when(F.col("doc_id").isNull(), -1 - number).otherwise(number).alias("row"),
                                                F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), "text")
    hits = settled(postings(keyed).join(few(wanted), "term"))
    count, length = hits.where("term = '' AND n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weighed = settled(weights(hits, max(count, 1), max(length, 1)))
    blocks, bundles = max(1, math.ceil(count / BLOCK)), max(1, math.ceil(asked.select("item").distinct().count() / BUNDLE))

    known = settled(asked.join(weighed, "term").withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int")))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    state, found = None, None
    for owner in range(len(SHARES) + 1):
        ahead, after = (F.sum(F.when(F.col("owner") >= o, F.col("qtf") * F.col("most")).otherwise(0)).alias(n) for o, n in ((owner, "ahead"), (owner + 1, "after")))
        own = F.collect_list(F.when(F.col("owner") == owner, F.struct("t", "qtf"))).alias("terms")
        bundle = known.groupBy("item", "bundle").agg(own, ahead, after).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        if state is None:
            none = F.lit(None).cast("binary")
            left = bundle.withColumns({"rows": none, "ids": none, "scores": none, "floor": F.lit(0).cast("long")})
        else:
            floors = few(settled(_floors(state, k)))
            left = bundle.join(state.drop("best"), ["item", "bundle", "block"], "left").join(floors, "item", "left").withColumn("floor", F.coalesce("floor", F.lit(0)))
        here = known.where(F.col("owner") == owner).select("bundle", "term", "t", "w").distinct()
        right = hits.join(few(settled(here)), "term").select("bundle", block.alias("block"), "t", "row", "id", (F.col("w") * _rate(max(count, 1), max(length, 1))).alias("value"))
        both = left.groupBy("bundle", "block").cogroup(right.groupBy("bundle", "block"))
        if owner < len(SHARES):
            state = settled(both.applyInArrow(_visit(k), STATE))
        else:
            found = both.applyInArrow(_select(k), FOUND)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("row") < 0, "id", "row")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        F.when(F.col("item") != "", F.col("item").cast("long")).alias("item_id"), "rank", F.when(F.col("row") >= 0, F.col("id")).alias("doc_id"), "score")


def _floors(state: DataFrame, k: int) -> DataFrame:
    """(item, floor): the k-th best score of each item so far, 0 if it has fewer."""
    best = state.select("item", F.explode("best").alias("score"))
    place = Window.partitionBy("item").orderBy(F.desc("score"))
    top = best.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k)
    return top.groupBy("item").agg(F.when(F.count("*") == k, F.min("score")).otherwise(0).cast("long").alias("floor"))
