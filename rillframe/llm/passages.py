"""Passages of words that an earlier document has too, found by Rabin-Karp hashes of every window.

A window is ``length`` consecutive words [^ \\t-\\r]+ of one document. Every window of every text is hashed with a
rolling polynomial and Spark brings equal hashes together: a task sends each hash once, with the smallest of its
documents that have it, packed by range of hash, so a passage that a third of all documents share arrives once per
block of texts. The ranges say which windows also start in a document with a smaller doc_id; those hashes go back to
their documents, where the windows merge into maximal removal intervals. Windows are judged on the input, not on
what is left.

A word is a 64-bit hash, a window a polynomial of its words' hashes modulo the prime 2**61 - 1: two different windows
meet at ``length`` of 2**61 bases at most, among n windows at most about n * n * length / 2**62 pairs are expected to.
Null texts have no words; texts shorter than a window lose none. Rows with equal doc_id are one document: none of
them removes from another. A null doc_id comes after all others, and rows without one do not remove from each other;
each has its own hashes sent back, by a hash of its text. Columns of the input that are named like a result
are replaced, others pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.llm.store import free, lean, parts_for, settled
from rillframe.llm.words import CODES, U, Texts, mix, slices, spans, windows

LENGTH = 50
BLOCK_BYTES = 4 << 20  # text whose windows are gathered before they are sent
TURNS = 8  # parts of a range that its task compares one after another
RANGES = 32  # hash ranges at least; as many as the session has shuffle partitions, more for more than 32 MB of text each
PACKED = "range int, kind int, docs binary, counts binary, hashes binary"
NAMED, NAMELESS, KNOWN, KNOWN_NAMELESS = range(4)  # windows of rows with a doc_id and without, and such as are to go
RESULTS = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_text": T.StringType(),
           "intervals": T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))}


def _hashed(batch: pa.RecordBatch, length: int) -> tuple:
    """Word spans with their row edges; hash, first word and row of each window."""
    texts = Texts(batch.column("text"))
    starts, ends, edges = texts.words()
    return texts, starts, ends, edges, *windows(spans(texts.data, starts, ends), edges, length)


def _owners(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The doc_id of each row, or its key where that is null, and whether it is."""
    nameless = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    ids = batch.column("doc_id").cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return np.where(nameless, batch.column("key").to_numpy(), ids), nameless


def _packed(kind: int, docs: np.ndarray, hashes: np.ndarray, group: np.ndarray) -> Iterator[tuple]:
    """Rows of PACKED for each value of ``group``: the documents, how many hashes each has, and those."""
    order = np.lexsort((docs, group))
    docs, hashes, group = docs[order], hashes[order], group[order]
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else []
    for a, b in zip(edges, edges[1:]):
        own, counts = np.unique(docs[a:b], return_counts=True)
        yield int(group[a]), kind, _short(own, True), _short(counts, False), hashes[a:b].tobytes()


def _short(values: np.ndarray, rising: bool) -> bytes:
    """Numbers in as few bytes each as they need, the first byte says how many; rising ones as differences."""
    values = values.astype(np.int64).view(U)
    steps = np.diff(values) if rising else values
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(steps) or int(steps.max()) < 1 << 8 * w)
    return bytes([width]) + (values[:1].tobytes() if rising else b"") + steps.astype(f"<u{width}").tobytes()


def _long(data: bytes, rising: bool) -> np.ndarray:
    head = 1 + 8 * rising
    steps = np.frombuffer(data, f"<u{data[0]}", offset=head).astype(U)
    if not rising:
        return steps.view(np.int64)
    return np.cumsum(np.concatenate([np.frombuffer(data, U, 1, 1), steps])).view(np.int64)


def _later(docs: np.ndarray, nameless: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by hash and document, which rows then are the first of their hash, and which come after its first document."""
    order = np.lexsort((docs, nameless, hashes))
    docs, nameless, hashes = docs[order], nameless[order], hashes[order]
    new = np.diff(hashes, prepend=~hashes[:1]) != 0 if len(hashes) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    count = np.diff(start, append=len(hashes))
    later = np.where(nameless, ~np.repeat(nameless[start], count), docs > np.repeat(docs[start], count))
    return order, new, later


def _sent(length: int, ranges: int):
    """For mapInArrow: a block's hashes by range, each with its first document, and what is known in the block.

    Of rows without a doc_id each one sends its hashes, unless the block has a document with an id for them.
    """
    schema = pa.schema([("range", pa.int32()), ("kind", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])

    def rows(held: list) -> Iterator[pa.RecordBatch]:
        docs, nameless, hashes = (np.concatenate(x) for x in zip(*held))
        order, new, later = _later(docs, nameless, hashes)
        docs, nameless, hashes = docs[order], nameless[order], hashes[order]
        fresh = new.copy()  # a window that a text repeats goes once
        fresh[1:] |= (docs[1:] != docs[:-1]) | (nameless[1:] != nameless[:-1])
        by_hash = ((hashes >> U(32)) * U(ranges) >> U(32)).astype(np.int64)
        by_doc = (mix(docs.astype(U)) % U(ranges)).astype(np.int64)
        for kind, wanted, group in ((NAMED, new & ~nameless, by_hash), (NAMELESS, fresh & nameless & ~later, by_hash),
                                    (KNOWN, fresh & later & ~nameless, by_doc), (KNOWN_NAMELESS, fresh & later & nameless, by_doc)):
            for row in _packed(kind, docs[wanted], hashes[wanted], group[wanted]):
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            texts, _, _, _, hashes, _, owner = _hashed(batch, length)
            docs, nameless = _owners(batch)
            held.append((docs[owner], nameless[owner], hashes))
            size += len(texts.data)
            if size >= BLOCK_BYTES:
                yield from rows(held)
                held, size = [], 0
        if held:
            yield from rows(held)

    return run


def _unpacked(frame: pd.DataFrame, turn: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each window in packed rows; of one turn, if it is given."""
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for ids, counts, data in zip(frame["docs"], frame["counts"], frame["hashes"]):
        own, data = np.repeat(_long(ids, True), _long(counts, False)), np.frombuffer(data, U)
        keep = slice(None) if turn is None else data % U(TURNS) == U(turn)
        docs.append(own[keep])
        hashes.append(data[keep])
    return np.concatenate(docs), np.concatenate(hashes)


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """One range: the hashes of each document that a document with a smaller id has too."""
    found = {False: [_unpacked(frame[frame["kind"] == KNOWN])], True: [_unpacked(frame[frame["kind"] == KNOWN_NAMELESS])]}
    named, nameless = frame[frame["kind"] == NAMED], frame[frame["kind"] == NAMELESS]
    for turn in range(TURNS):
        parts = [_unpacked(named, turn), _unpacked(nameless, turn)]
        docs, hashes = (np.concatenate(x) for x in zip(*parts))
        missing = np.arange(len(docs)) >= len(parts[0][0])
        order, _, later = _later(docs, missing, hashes)
        for kind in found:
            own = order[later & (missing[order] == kind)]
            found[kind].append((docs[own], hashes[own]))
    tables = []
    for kind, parts in found.items():
        docs, hashes = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
        edges = np.flatnonzero(np.diff(docs, prepend=~docs[:1], append=~docs[-1:])) if len(docs) else []
        tables.append(pd.DataFrame({"id": docs[edges[:-1]] if len(docs) else docs, "nameless": kind,
                                    "hashes": [hashes[a:b].tobytes() for a, b in zip(edges, edges[1:])]}))
    return pd.concat(tables)


def _key() -> Column:
    return F.xxhash64("text")


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, nameless, hashes): for a document, packed hashes of its windows that start in an earlier one too.

    ``nameless`` are rows without a doc_id; their id is a hash of the text. Of a document there is a row for each range
    of hashes at most.
    """
    ranges = max(RANGES, parts_for(docs, per_task=32 << 20))
    sent = lean(docs, "doc_id", "text").withColumn("key", _key()).mapInArrow(_sent(length, ranges), PACKED)
    return sent.repartition(ranges, "range").groupBy("range").applyInPandas(_compared, "id long, nameless boolean, hashes binary")


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space behind each."""
    pieces, at = [], 0
    for first, end in spans:
        if end < len(starts):
            pieces.append(text[at:starts[first]])
            at = starts[end]
        else:
            pieces.append(text[at:ends[first - 1] if first else 0])
            at = len(text)
    return b"".join([*pieces, text[at:]]).decode()


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with n_words, n_removed, intervals (maximal, of word numbers from 0, end not included) and kept_text.

    ``kept_text`` keeps the white space between words that stay.
    """
    plain = [f for f in docs.schema.fields if f.name.lower() not in RESULTS]
    own, nameless, held = free(docs, "_id", "_nameless", "_hashes")
    found = settled(repeated(docs, length)).groupBy(F.col("id").alias(own), F.col("nameless").alias(nameless)).agg(F.collect_list("hashes").alias(held))
    keyed = lean(docs, *[f.name for f in plain]).withColumns({own: F.coalesce(F.col("doc_id").cast("long"), _key()), nameless: F.col("doc_id").isNull()})
    joined = keyed.join(found, [own, nameless], "left").drop(own, nameless)
    schema = T.StructType(plain + [T.StructField(k, v) for k, v in RESULTS.items()])
    arrow = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, starts, ends, edges, hashes, at, rows = _hashed(batch, length)
            marks = [b"".join(x) if x else b"" for x in batch.column(held).to_pylist()]
            wanted = np.frombuffer(b"".join(marks), U)
            of = np.repeat(np.arange(len(marks)), [len(x) // 8 for x in marks])
            own = lambda h, r: mix(h + r.astype(U) * CODES[0])
            some = np.array([bool(x) for x in marks], bool)[rows] if len(marks) else np.zeros(0, bool)
            hits = at[some][np.isin(own(hashes[some], rows[some]), own(wanted, of))]
            covered = np.zeros(len(starts) + 1, np.int32)
            np.add.at(covered, hits, 1)
            np.add.at(covered, hits + length, -1)
            covered = np.cumsum(covered)[:-1] > 0
            sums = np.concatenate([[0], np.cumsum(covered)])
            kept, intervals = [], []
            for row in range(texts.rows):
                a, b = edges[row], edges[row + 1]
                if sums[b] == sums[a]:
                    kept.append(None)
                    intervals.append([])
                    continue
                flags = np.diff(covered[a:b].astype(np.int8), prepend=0, append=0)
                spans = list(zip(np.flatnonzero(flags == 1).tolist(), np.flatnonzero(flags == -1).tolist()))
                low, high = texts.edges[row], texts.edges[row + 1]
                kept.append(_cut(texts.data[low:high].tobytes(), starts[a:b] - low, ends[a:b] - low, spans))
                intervals.append([{"first": s, "end": e} for s, e in spans])
            changed = pa.array([x is not None for x in kept])
            kept = pc.if_else(changed, pa.array(kept, pa.string()), batch.column("text").cast(pa.string()))
            made = [pa.array(np.diff(edges)), pa.array(sums[edges[1:]] - sums[edges[:-1]]), kept, pa.array(intervals, arrow[3])]
            columns = [batch.column(f.name) for f in plain] + [x.cast(t) for x, t in zip(made, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in plain), *RESULTS])

    return joined.mapInArrow(run, schema)
