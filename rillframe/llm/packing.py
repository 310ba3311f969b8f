"""Documents packed into sequences of a fixed number of tokens by the sum-of-squares rule.

A document is its ids and an end id. Only documents longer than a sequence are cut, into pieces of the full length
and a rest. Pieces are dealt at random, by a number stored with them, into groups of about ``GROUP``; each group is
packed by one task: every piece goes where the sum over all gaps of the squared number of open bins with that gap
becomes smallest, which keeps bins of every gap at hand. Larger pieces go first. A random group has the lengths of
the whole, so what is lost is a few open bins for each group: no piece crosses a sequence, none is dropped.

A null text is empty and gives its end id alone; every row gives its own pieces, also if it repeats. Extra columns
of the input do not pass; the packed table has one row for each piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rillframe.llm.bpe import encoder
from rillframe.llm.store import lean, settled
from rillframe.llm.words import slices

LENGTH = 4096
GROUP = 25_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, deal int"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """One row for each piece: its place in its document, a checksum of its ids, and a number to deal it by."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("deal", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, count = encoder(tokenizer).encode, np.array([end_id], "<u4"), 0
        for batch in slices(batches):
            rows = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids = np.concatenate([ids, end]).astype("<u4")
                for k, at in enumerate(range(0, len(ids), length)):
                    part = ids[at:at + length]
                    crc = zlib.crc32(part.tobytes())
                    rows.append((key, k, at, len(part), crc, zlib.crc32(count.to_bytes(8, "little"), crc) & 0x7FFFFFFF))
                    count += 1
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return lean(docs, "doc_id", "text").mapInArrow(run, PIECES)


def place(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each size, in the order given: the sum-of-squares rule.

    A bin whose gap goes from h to h - s changes the sum of squares by 2 * (N[h-s] - N[h] + 1) for N bins of each
    gap, a new bin by 2 * N[length-s] + 1; full bins do not count. Ties go to the smallest gap, a new bin last.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    count = np.zeros(length + 1, np.int64)  # open bins by gap
    held: list[list[int]] = [[] for _ in range(length + 1)]
    made = 0
    for i, s in enumerate(sizes.tolist()):
        if s == length:
            bins[i], made = made, made + 1
            continue
        own, after = count[s:length], count[:length - s]
        change = 2 * (after - own + 1)
        change[0] = 1 - 2 * own[0]  # the bin becomes full
        change[own == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        if change[best] <= 2 * count[length - s] + 1:
            gap = best + s
            bin_ = held[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_ = length, made
            made += 1
        bins[i], offsets[i] = bin_, length - gap
        if gap > s:
            held[gap - s].append(bin_)
            count[gap - s] += 1
    return bins, offsets


def pack(made: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Pieces with sequence_id and offset. ``made`` should be a written table, so that a task run again sees the same."""
    groups = max(1, round(made.count() / group))

    def one(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("deal", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = place(table["length"].to_numpy(), length)
        own = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return own.append_column("sequence_id", pa.array(bins * groups + key[0].as_py())).append_column("offset", pa.array(offsets))

    dealt = made.withColumn("_group", (F.col("deal") % groups).cast("int"))
    return dealt.groupBy("_group").applyInArrow(one, PACKED)


def packed(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    return pack(settled(pieces(docs, tokenizer, end_id, length)), length, group)
