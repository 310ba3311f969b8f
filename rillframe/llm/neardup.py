"""Near-duplicate documents by an inverted join on the coordinates of MinHash signatures.

A document is the set of its word shingles (words [^ \\t-\\r]+, A-Z lower-cased); a text with fewer words than a
shingle is one shingle as a whole, one without words is empty and linked with nothing. Documents are linked if their
Jaccard similarity reaches ``percent``; links are confirmed on the full sets. Steps:

1. Equal sets are one class from here on, however many documents there are. A class has a signature of ``COORDINATES``
   minima.
2. Classes are posted under their coordinate-value pairs. A pair that only one class has is dropped. Two signatures
   with ``MATCHES`` equal coordinates share one of the rarest COORDINATES - MATCHES + 1 pairs of each (prefix); the
   other, longer lists are skipped and their collisions counted from the signatures.
3. Each class is held against the most central class of its lists that matches, its hub. That settles a large group
   of copies in as many pairs as it has members. Here and in 4, candidates are compared by sketches, the low byte of
   each coordinate: a pair that matches in full matches there too.
4. What is left are the lists whose classes are not all connected by then (open lists). Classes of a list of ``PAIRS``
   at most are paired. The longer open lists with the same most central class are put together; of such a circle all
   classes outside its largest group are held against all its classes, in blocks that ship each class a few times,
   whatever the number of pairs, and send on only links that join groups of the block. Sketches meet first, texts
   only of classes that match one of another group.

What is on disk: sets are never written or sent. A text travels to where it is compared, its set is made there; texts
that nobody asked for stay where they are, however many are asked for. What a step has shuffled goes when it is written.

No list, group or number of partners is cut. A link is missed only if its signatures agree in fewer than MATCHES of
COORDINATES coordinates: at similarity 0.8 one in 50,000, fewer above. Shingles are 61-bit hashes: two different
shingles meet at ``size`` of 2**61 bases at most.

Rows with a null text are empty. Rows that repeat a doc_id are one node of the result, null ids are left out of minima
and belong to whatever their text belongs to; where all ids are null so is component_id. Other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillframe.llm.links import components
from rillframe.llm.store import among, few, free, lean, released
from rillframe.llm.words import BASE, CODES, U, Texts, mix, slices, spans, unpacked, windows

COORDINATES, MATCHES = 64, 36
PREFIX = COORDINATES - MATCHES + 1
BLOCK = 1 << 18  # shingles of one side of a block
ROWS = 1 << 10  # sketches of one side of a block
BROADCAST = 200_000  # rows that ask for a text which are broadcast
PAIRS = 4  # classes of a list that are paired as rows
LOWER = np.arange(256, dtype=np.uint8) + 32 * np.isin(np.arange(256), np.arange(65, 91)).astype(np.uint8)
FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=U) * BASE) | U(1)
MASKS = mix(FACTORS)


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, one text after another, and where each begins."""
    texts = Texts(column)
    starts, ends, edges = texts.words()
    words = spans(LOWER[texts.data], starts, ends)
    hashes, _, rows = windows(words, edges, size)
    short = np.flatnonzero((np.diff(edges) > 0) & (np.diff(edges) < size))
    whole = spans(words, edges[short], edges[short + 1])
    hashes, rows = np.concatenate([hashes, whole]), np.concatenate([rows, short])
    _, first = np.unique(mix(hashes + rows.astype(U) * CODES[0]), return_index=True)
    order = first[np.lexsort((hashes[first], rows[first]))]
    return hashes[order], np.searchsorted(rows[order], np.arange(texts.rows + 1))


def _classes(hashes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have shingles, and a 64-bit name of each one's set."""
    filled = np.flatnonzero(np.diff(edges))
    at = edges[filled]
    if not len(at):
        return filled, np.zeros(0, np.int64)
    one, two = np.add.reduceat(mix(hashes), at), np.add.reduceat(mix(hashes ^ BASE), at)
    return filled, mix(one + mix(two + np.diff(edges)[filled].astype(U) * BASE)).view(np.int64)


def signed(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, key, n_shingles, class, signature, sketch) of every row; class is null and signature and sketch are empty for empty sets.

    The sketch has the low byte of each coordinate.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.int64()), ("signature", pa.list_(pa.int32())), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, edges = shingles(batch.column("text"), size)
            filled, names = _classes(hashes, edges)
            n = len(edges) - 1
            missing = np.ones(n, bool)
            missing[filled] = False
            classes = np.zeros(n, np.int64)
            classes[filled] = names
            minima = np.zeros((len(filled), COORDINATES), np.uint32)
            if len(filled):
                for k in range(COORDINATES):
                    minima[:, k] = np.minimum.reduceat(((hashes ^ MASKS[k]) * FACTORS[k]) >> U(32), edges[filled])
            ends = np.concatenate([[0], np.cumsum(~missing)]) * COORDINATES
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(minima.ravel().view(np.int32)))
            low = pa.py_buffer(minima.astype(np.uint8).tobytes())
            sketches = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), low])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("key"), pa.array(np.diff(edges)),
                                              pa.array(classes, mask=missing), lists, sketches], schema=schema)

    keyed = lean(docs, "doc_id", "text").withColumn("key", F.xxhash64("doc_id", "text"))
    return keyed.mapInArrow(run, "doc_id long, key long, n_shingles long, class long, signature array<int>, sketch binary")


def posted(classes: DataFrame) -> DataFrame:
    """(token, class, central): prefix lists, and how many collisions the class has over all its coordinates."""
    tokens = classes.select("class", F.posexplode("signature").alias("k", "v"))
    tokens = tokens.select("class", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long") + F.lit(1 << 31)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    own = Window.partitionBy("class")
    ranked = tokens.join(shared, "token").withColumn("rank", F.row_number().over(own.orderBy("n", "token")))
    ranked = ranked.withColumn("alone", F.lit(COORDINATES) - F.count("*").over(own)).withColumn("central", F.sum("n").over(own))
    return ranked.where(F.col("rank") + F.col("alone") <= PREFIX).select("token", "class", "central")


def _sketches(column: pa.Array) -> np.ndarray:
    return unpacked(column.cast(pa.large_binary()), np.uint8)[0].reshape(-1, COORDINATES)


def matching(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree in MATCHES coordinates at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array((_sketches(batch.column("one")) == _sketches(batch.column("two"))).sum(1) >= MATCHES)
            yield batch.filter(keep).select(["a", "b"])

    one = classes.select(F.col("class").alias("a"), F.col("sketch").alias("one"))
    two = classes.select(F.col("class").alias("b"), F.col("sketch").alias("two"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``, a written table, with the text of each ``key``; only texts that are wanted are shuffled, a few others apart."""
    keyed = lean(docs, "doc_id", "text").withColumn("key", F.xxhash64("doc_id", "text")).select("key", "text")
    small = few(wanted, BROADCAST)
    return (keyed if small is not wanted else among(keyed, wanted, "key")).join(small, "key")


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The text of a travels to that of b; what one b gets is dealt into parts of about BLOCK shingles, each with the text of b ahead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = lead = None
        for batch in slices(batches):
            hashes, edges = shingles(batch.column("text"), size)
            a, b = batch.column("class").to_pylist(), batch.column("hub").to_pylist()
            found = []
            for i, first in enumerate(batch.column("lead").to_pylist()):
                own = hashes[edges[i]:edges[i + 1]]
                if first:
                    hub, lead = b[i], own.copy()
                elif b[i] != hub:
                    raise ValueError(f"no text ahead of those held against {b[i]}")
                elif _linked(own, lead, percent):
                    found.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in found], pa.int64()) for x in (a, b)], names=["a", "b"])

    sized = pairs.join(classes.select(F.col("class").alias("a"), "key", "n"), "a")
    parts = sized.groupBy("b").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts"))
    members = sized.join(parts, "b").select("key", F.col("a").alias("class"), F.col("b").alias("hub"),
                                            F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part"), F.lit(False).alias("lead"))
    leads = parts.join(classes.select(F.col("class").alias("b"), "key"), "b")
    leads = leads.select("key", F.col("b").alias("class"), F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("lead"))
    placed = _texts(docs, released(members.union(leads))).repartition("hub", "part").sortWithinPartitions("hub", "part", F.desc("lead"))
    return placed.select("hub", "class", "lead", "text").mapInArrow(run, "a long, b long")


def _meeting(members: DataFrame, weight: str, block: int) -> DataFrame:
    """``members`` (hub, class, group and more) in blocks (hub, row, column) in which all classes of different groups of a hub meet.

    The classes outside the largest group of a hub are its pivots. All classes are dealt into rows, the pivots into
    columns of about ``block`` of ``weight``; a row and a column meet in a block.
    """
    by_group = members.groupBy("hub", "group").agg(F.sum(weight).alias("n"))
    sizes = by_group.groupBy("hub").agg(F.sum("n").alias("all"), F.max(F.struct("n", "group")).alias("top"), F.count("*").alias("groups")).where("groups > 1")
    blocks = released(sizes.select("hub", F.col("top.group").alias("top"), F.ceil(F.col("all") / block).cast("int").alias("rows"),
                                  F.ceil((F.col("all") - F.col("top.n")) / block).cast("int").alias("columns")))
    dealt = members.join(blocks, "hub").withColumn("deal", F.xxhash64("class"))
    row, column = F.pmod("deal", "rows").cast("int"), F.pmod("deal", "columns").cast("int")
    seen = dealt.withColumn("row", row).withColumn("column", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).withColumn("pivot", F.lit(False))
    far = dealt.where(F.col("group") != F.col("top"))
    far = far.withColumn("column", column).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("pivot", F.lit(True))
    names = [*members.columns, "row", "column", "pivot"]
    return seen.select(names).union(far.select(names))


def _block(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Each class of a block once, as a pivot if it is one, its sketches and groups."""
    frame = frame.sort_values(["class", "pivot"]).drop_duplicates("class", keep="last").reset_index(drop=True)
    sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(-1, COORDINATES)
    return frame, sketches, pd.factorize(frame["group"])[0]


def _close(frame: pd.DataFrame) -> pd.DataFrame:
    """The classes of a block that match one of another group."""
    frame, sketches, group = _block(frame)
    near = np.zeros(len(frame), bool)
    for p in np.flatnonzero(frame["pivot"]).tolist():
        found = ((sketches == sketches[p]).sum(1) >= MATCHES) & (group != group[p])
        near |= found
        near[p] |= found.any()
    return frame.loc[near, ["hub", "class", "group"]]


def _joined(frame: pd.DataFrame, size: int, percent: int) -> pd.DataFrame:
    """Links of a block between its pivots and all its classes, as few as connect the same groups."""
    frame, sketches, group = _block(frame)
    values, edges = shingles(pa.array(frame["text"], pa.large_string()), size)
    sizes = np.diff(edges)
    sets, owner = [values[a:b] for a, b in zip(edges, edges[1:])], np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    links = []
    for p in np.flatnonzero(frame["pivot"]).tolist():
        if not (((sketches == sketches[p]).sum(1) >= MATCHES) & (group != group[p])).any():
            continue
        low, high = np.searchsorted(values, sets[p], "left"), np.searchsorted(values, sets[p], "right")
        at = np.arange((high - low).sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)
        both = np.bincount(owner[at], minlength=len(sets))
        near = np.flatnonzero(100 * both >= percent * (sizes + sizes[p] - both))
        for other in near[np.unique(group[near], return_index=True)[1]].tolist():
            if group[other] != group[p]:
                links.append((frame["class"][p], frame["class"][other]))
                group[group == group[p]] = group[other]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def within_circles(docs: DataFrame, members: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between classes of a circle that are in different groups.

    ``members``: (hub, class, group). Sketches are compared first; only the texts of classes that match one of another
    group are held against each other.
    """
    known = members.join(classes.select("class", "sketch"), "class").withColumn("one", F.lit(1))
    close = _meeting(known, "one", ROWS).groupBy("hub", "row", "column").applyInPandas(_close, "hub long, class long, group long")
    close = released(close.distinct())
    wanted = released(_meeting(close.join(classes.select("class", "key", "n", "sketch"), "class"), "n", BLOCK))
    return _texts(docs, wanted).groupBy("hub", "row", "column").applyInPandas(lambda f: _joined(f, size, percent), "a long, b long")


def links_of(docs: DataFrame, marked: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links between classes that connect all that are connected."""
    classes = released(marked.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("key"), F.any_value("signature").alias("signature"),
                                                                              F.any_value("sketch").alias("sketch"), F.any_value("n_shingles").alias("n")))
    posts = released(posted(classes))
    hubs = released(posts.groupBy("token").agg(F.max(F.struct("central", "class")).alias("hub")))
    tried = posts.join(hubs, "token").where("class <> hub.class").select(F.col("class").alias("a"), F.col("hub.class").alias("b")).distinct()
    near = released(matching(tried, classes))
    central = posts.select(F.col("class").alias("b"), "central").distinct()
    chosen = near.join(central, "b").groupBy("a").agg(F.max(F.struct("central", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    chosen = released(chosen)
    star = released(confirmed(docs, chosen, classes, size, percent))
    return star.union(_rest(docs, posts, hubs, components(star), classes, size, percent))


def _rest(docs: DataFrame, posts: DataFrame, hubs: DataFrame, groups: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between classes of a list that are in different groups so far."""
    listed = posts.join(groups.select(F.col("id").alias("class"), "component"), "class", "left")
    listed = released(listed.select("token", "class", F.coalesce("component", "class").alias("group")))
    kinds = listed.groupBy("token").agg(F.count("*").alias("n"), F.min("group").alias("least"), F.max("group").alias("most"))
    open_lists = released(listed.join(kinds.where("least <> most").select("token", "n"), "token"))
    short = open_lists.where(F.col("n") <= PAIRS)
    other = short.select("token", F.col("class").alias("b"), F.col("group").alias("other"))
    pairs = short.join(other, "token").where((F.col("class") < F.col("b")) & (F.col("group") != F.col("other")))
    near = released(matching(pairs.select(F.col("class").alias("a"), "b").distinct(), classes))
    members = open_lists.where(F.col("n") > PAIRS).join(hubs, "token").select(F.col("hub.class").alias("hub"), "class", "group").distinct()
    members = released(members)
    return released(confirmed(docs, near, classes, size, percent)).union(released(within_circles(docs, members, classes, size, percent)))


def _members(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, key, n_shingles, group) and more of every row; the group of an empty text is null."""
    marked = released(signed(docs, size))
    groups = components(links_of(docs, marked, size, percent))
    rows = marked.drop("signature", "sketch").join(groups.select(F.col("id").alias("class"), "component"), "class", "left")
    return rows.withColumn("group", F.coalesce("component", "class"))


def grouped(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept) of every row; component_id is the smallest doc_id reachable."""
    rows = _members(docs, size, percent)
    first = rows.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("first"))
    found = rows.join(first, "group", "left").withColumn("component_id", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("first")))
    return found.select("doc_id", "key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their group, one of each group; all columns.

    First is the row of the least doc_id, nulls last, of equal ids that of the least key; of rows equal in doc_id and
    text any. Rows without words are in no group and all stay.
    """
    keys = _members(docs, size, percent).groupBy("group", "key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "n")).alias("first")
    chosen = released(keys.where("group IS NOT NULL").groupBy("group").agg(first).select(F.col("first.key").alias("_key"), F.col("first.n").alias("n"))
                     .union(keys.where("group IS NULL").select("key", F.lit(1).cast("long"))))
    own = free(docs, "_key")[0]
    chosen = chosen.withColumnRenamed("_key", own)
    keyed = docs.withColumn(own, F.xxhash64("doc_id", "text"))
    found = keyed.join(few(chosen.where("n = 1").select(own)), own, "left_semi")
    repeated = chosen.where("n > 1").select(own)
    if not repeated.isEmpty():  # only rows that repeat as a whole are shuffled
        found = found.unionByName(keyed.join(few(repeated), own, "left_semi").dropDuplicates([own]))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
