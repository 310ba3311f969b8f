"""Repeated byte strings of a fixed length, found by grouping suffixes by hashes, a minimizer first.

Every suffix of every text is a candidate, cut at ``length`` bytes (its window). Windows are not ordered: in place of
their leading bytes the digits are hashes, and windows are grouped by equality of them. A group that has one member
after a digit is done; the groups left after the last digit are exactly the repeated windows.

* First digit: the window's least ``GRAM``-byte string, by hash, the first of equals, and where it stands. Equal
  windows have equal ones. Neighbouring windows mostly share it, so a text's windows come in runs of about 185, and
  a run is one row: all suffixes take part, at 1/185 of the rows.
* Runs whose digit no other run has are done. The next digit is all the bytes of a run: runs that are equal as a
  whole are repeated as a whole, however many there are, and one stands for them from here on.
* What is left are runs that agree in the digit only, at the edges of repeated passages. Their next digit is the 300
  bytes around the least string that all windows of a part of the run share; parts alone in it are done.
* The last digit is the window itself, for the suffixes of the parts that are left.

Digits are Rabin-Karp hashes modulo the prime 2**61 - 1, so two different windows are taken for equal at ``length`` of
2**61 bases at most (about 1e-16) if they reach the last digit together. Matches never cross texts. A null text is empty; a text shorter than a window loses nothing;
rows that repeat remove each other. Columns of the input named like a result are replaced, others pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rillframe.llm.store import few, free, lean, settled
from rillframe.llm.words import CODES, U, Rolling, Texts, mix, owners, slices

LENGTH = 400
GRAM = 32
FACTORS = dict(zip((1, 2, 4, 8, 16), mix(np.arange(1, 6, dtype=U)) | U(1)))
PARTS = 4  # parts of a run by how far its windows begin before the digit
RUNS = "key long, at long, count int, ahead int, digit long, whole long, " + ", ".join(f"part{j} long" for j in range(PARTS))
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
RESULTS = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "spans": SPAN, "kept": T.BinaryType()}


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    count = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    full[:len(values)] = values
    blocks = full.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1:width - 1 + count])


def _grams(data: np.ndarray) -> np.ndarray:
    """A number for each string of GRAM bytes, made by doubling; what shares one is told apart by later digits."""
    made, width = CODES[data], 1
    while width < GRAM:
        made = made[:-width] * FACTORS[width] + made[width:]
        width *= 2
    return mix(made)


def _runs(texts: Texts, length: int) -> list[np.ndarray] | None:
    """Row, first byte, windows, distance to the digit, digit, whole, and parts (with a mask) of each run."""
    size = len(texts.data)
    fits = np.flatnonzero(np.diff(texts.edges) >= length)
    if not len(fits):
        return None
    rolling = Rolling(CODES[texts.data])
    grams = _grams(texts.data)
    anchors = _least((grams & ~U(0xFFFFFFFF)) | np.arange(len(grams), dtype=U), length - GRAM + 1) & U(0xFFFFFFFF)
    valid = np.zeros(size + 1, np.int8)
    valid[texts.edges[fits]] += 1
    valid[texts.edges[fits + 1] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(valid))
    anchor = anchors[starts].astype(np.int64)
    row = np.searchsorted(texts.edges, starts, side="right") - 1
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    low, count = starts[new], np.diff(new, append=len(starts))
    anchor, row = anchor[new], row[new]
    ahead = anchor - low  # of the first window; the last one's is ahead - count + 1
    whole = mix(rolling.spans(low, low + count - 1 + length) + ahead.astype(U) * CODES[1])
    step = length // PARTS
    parts = []
    for j in range(PARTS):
        has = (ahead >= j * step) & (ahead - count + 1 < (j + 1) * step)
        begin = np.where(has, anchor - j * step, 0)
        parts.append((rolling.spans(begin, np.where(has, begin + length - step, 0)), has))
    return [row, low - texts.edges[row], count, ahead, grams[anchor], whole, parts]


def runs(docs: DataFrame, length: int) -> DataFrame:
    """All windows of all texts as runs, with their digits."""
    names = ["key", "at", "count", "ahead", "digit", "whole", *(f"part{j}" for j in range(PARTS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = _runs(Texts(batch.column("text")), length)
            if found is not None:
                row, at, count, ahead, digit, whole, parts = found
                key = batch.column("key").to_numpy()[row]
                columns = [pa.array(key), pa.array(at), pa.array(count.astype(np.int32)), pa.array(ahead.astype(np.int32)),
                           pa.array(digit.view(np.int64)), pa.array(whole.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(v.view(np.int64), mask=~has) for v, has in parts], names=names)

    return lean(docs, "key", "text").mapInArrow(run, RUNS)


def _windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(window, key, at, open): the last digit of the suffixes in the parts of runs that are left."""
    step = length // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            rolling = Rolling(CODES[texts.data])
            left = batch.column("left")
            row = owners(np.concatenate([[0], np.cumsum(left.value_lengths().to_numpy())]))
            at, count, ahead, part, is_open = (f.to_numpy(zero_copy_only=False) for f in left.flatten().flatten())
            # windows of the run that begin part * step to (part + 1) * step - 1 bytes before the digit
            first = at + np.maximum(0, ahead - (part + 1) * step + 1)
            last = at + np.minimum(count - 1, ahead - part * step)
            many = np.maximum(last - first + 1, 0)
            begin = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            base = texts.edges[np.repeat(row, many)]
            hashes = rolling.spans(base + begin, base + begin + length)
            keys = batch.column("key").to_numpy()[np.repeat(row, many)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(keys), pa.array(begin), pa.array(np.repeat(is_open, many))],
                                             names=["window", "key", "at", "open"])

    by_key = wanted.groupBy("key").agg(F.collect_list(F.struct("at", "count", "ahead", "part", "open")).alias("left"))
    # a row that repeats is open in none of its runs, so one of its copies is enough here
    found = docs.select("key", "text").join(few(settled(by_key), 100_000), "key").dropDuplicates(["key"])
    return found.mapInArrow(run, "window long, key long, at long, open boolean")


def repeated(docs: DataFrame, length: int) -> DataFrame:
    """(key, start, end): byte spans that repeated windows cover, overlapping; ``docs`` has key and text."""
    made = settled(runs(docs, length))
    common = settled(made.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit"))
    hits = settled(made.join(few(common, 2_000_000), "digit"))
    columns = ["key", "at", "count", "ahead", *(f"part{j}" for j in range(PARTS))]
    kinds = settled(hits.groupBy("digit", "whole").agg(F.count("*").alias("n"), F.min(F.struct(*columns)).alias("one")))
    full = hits.join(kinds.where("n > 1").select("digit", "whole"), ["digit", "whole"], "left_semi")
    full = full.select("key", F.col("at").alias("start"), (F.col("at") + F.col("count") - 1 + length).alias("end"))

    several = kinds.groupBy("digit").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    edge = kinds.join(several.select("digit"), "digit").select("one.*", (F.col("n") == 1).alias("open"))
    parted = edge.select("key", "at", "count", "ahead", "open", F.posexplode(F.array(*[f"part{j}" for j in range(PARTS)])).alias("part", "value"))
    parted = settled(parted.where("value IS NOT NULL"))
    alike = parted.groupBy("part", "value").agg(F.count("*").alias("n"), F.max("open").alias("any")).where("n > 1 AND any")
    left = parted.join(alike.select("part", "value"), ["part", "value"], "left_semi")
    last = settled(_windows(docs, left, length))
    twice = last.groupBy("window").agg(F.count("*").alias("n"), F.max("open").alias("any")).where("n > 1 AND any").select("window")
    single = last.where("open").join(twice, "window", "left_semi").select("key", F.col("at").alias("start"), (F.col("at") + length).alias("end"))
    return full.union(single)


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with n_bytes, n_removed, spans (maximal removed byte spans) and kept (the remaining bytes)."""
    plain = [f for f in docs.schema.fields if f.name.lower() not in RESULTS]
    own, held = free(docs, "_key", "_marks")
    keyed = lean(docs, *[f.name for f in plain]).withColumn(own, F.xxhash64("doc_id", "text"))
    marks = repeated(lean(docs, "doc_id", "text").select(F.xxhash64("doc_id", "text").alias("key"), "text"), length)
    marks = settled(marks.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    # only texts that lose something are moved to their marks, unless the list of their keys is long
    hit = marks.select(F.col("key").alias(own))
    moved = keyed.join(few(hit), own, "left_semi").join(marks.select(F.col("key").alias(own), F.col("spans").alias(held)), own)
    left = keyed.join(few(hit), own, "left_anti").withColumn(held, F.lit(None).cast(marks.schema["spans"].dataType))
    joined = moved.unionByName(left).drop(own)
    arrow = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            marks = batch.column(held).fill_null([]) if batch.column(held).null_count else batch.column(held)
            row = owners(np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy())]))
            start, end = (f.to_numpy() + texts.edges[row] for f in marks.flatten().flatten())
            size = len(texts.data)
            # the flag of a row's bytes changes at its marks only, so sums over the slice stay within rows
            change = np.bincount(start, minlength=size + 1)[:size + 1] - np.bincount(end, minlength=size + 1)[:size + 1]
            covered = np.cumsum(change)[:size] > 0
            low, high, first = texts.parts(covered)
            spans, kept = [], []
            for r, (a, b) in enumerate(zip(texts.edges.tolist(), texts.edges[1:].tolist())):
                own = slice(first[r], first[r + 1])
                spans.append([{"start": s - a, "end": e - a} for s, e in zip(low[own].tolist(), high[own].tolist())])
                kept.append(texts.data[a:b][~covered[a:b]].tobytes())
            made = [np.diff(texts.edges), texts.per_row(covered), spans, kept]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in plain] + [pa.array(x, t) for x, t in zip(made, arrow)], names=[*(f.name for f in plain), *RESULTS])

    return joined.mapInArrow(run, T.StructType(plain + [T.StructField(k, v) for k, v in RESULTS.items()]))
