"""Token ids in binary shards with constant-time access by document key.

Documents are dealt to tasks by ranges of doc_id and sorted there; each task encodes its texts and writes one shard
to the shared folder. A shard holds, little-endian:

    header   7 numbers of 64 bits: MAGIC, keys n, ids m, index levels v, bits of all levels b, bytes of an id w, and how
             many of the last documents have no doc_id
    ids      m numbers of w bytes (2 if every id of the vocabulary fits, else 4), documents in ascending doc_id order
    levels   v numbers of 64 bits: bits of each index level
    bits     b bits, levels one after another, padded to 64 bits each
    prints   n numbers of 32 bits: fingerprint of the key in each slot
    bounds   n pairs of 64 bits: first id and number of ids of the document in each slot
    keys     n numbers of 64 bits: the doc_ids in the order of the documents; parts are padded to 8 bytes

The index is a minimal perfect hash: a key is tried in one level after another and owns the first set bit it hits;
that bit's rank is its slot (n keys, n slots, no key stored for a look-up). The fingerprint tells unknown keys
apart (one in 2**32 passes). A look-up reads a bit in a few levels, a print and a pair of bounds, whatever n is.

A key is made from doc_id and how many rows of the shard with that doc_id come before, so repeated rows, also with a
null doc_id (they come last, under the greatest id), keep an entry each. A null text is empty. The manifest has a row for each shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillframe.llm.bpe import encoder
from rillframe.llm.store import get, lean, new_folder, parts_for, put, settled
from rillframe.llm.words import BASE, U, mix, slices

MAGIC = 0x31444955534B4F54
NULL_ID = np.iinfo(np.int64).max
SPREAD = 1.6  # bits of a level for each key that reaches it
MANIFEST = "shard int, path string, docs long, ids long, last_key long"


def keys_of(doc_ids: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row of a sorted column of ids: the id, and how often it stood before."""
    new = np.diff(doc_ids, prepend=~doc_ids[:1]) != 0 if len(doc_ids) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    again = np.arange(len(doc_ids)) - np.repeat(first, np.diff(first, append=len(doc_ids)))
    return mix(mix(doc_ids.astype(np.int64).view(U)) + again.astype(U) * BASE)


class Index:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, prints: np.ndarray, bounds: np.ndarray):
        self.sizes, self.bits, self.prints, self.bounds = sizes, bits, prints, bounds
        ones = np.bitwise_count(bits)
        self.before = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @staticmethod
    def bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + U((level + 1) * int(BASE) % (1 << 64))) % U(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, bounds: np.ndarray) -> Index:
        rest, sizes, words = keys, [], []
        while len(rest):
            if len(sizes) == 256:
                raise ValueError("keys must be distinct")
            size = 64 * int(np.ceil(len(rest) * SPREAD / 64))
            at = cls.bit(rest, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(U))
            sizes.append(size)
            rest = rest[~alone[at]]
        index = cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, U), np.zeros(len(keys), np.uint32),
                    np.zeros((len(keys), 2), np.int64))
        slots = index.slots(keys)
        index.prints[slots], index.bounds[slots] = cls.print_of(keys), bounds
        return index

    @staticmethod
    def print_of(keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ BASE) >> U(32)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit."""
        found, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.bit(keys[rest], level, size) + self.starts[level]
            word, shift = self.bits[at >> 6], (at & 63).astype(U)
            hit = (word >> shift) & U(1) == 1
            below = np.bitwise_count(word & ((U(1) << shift) - U(1)))
            found[rest[hit]] = self.before[at[hit] >> 6] + below[hit]
            rest = rest[~hit]
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First id and number of ids of each key; (-1, -1) for one that the shard does not have."""
        slots = self.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == self.print_of(keys[known])
        out = np.full((len(keys), 2), -1, np.int64)
        out[known] = self.bounds[slots[known]]
        return out


def write_shard(path: str, doc_ids: np.ndarray, ids: list[np.ndarray], width: int = 4, nameless: int = 0) -> int:
    """Write documents that are in ascending order of id, the last ``nameless`` without one; the number of ids."""
    keys, sizes = keys_of(doc_ids), np.array([len(x) for x in ids], np.int64)
    index = Index.build(keys, np.stack([np.cumsum(sizes) - sizes, sizes], 1) if len(ids) else np.zeros((0, 2), np.int64))
    header = np.array([MAGIC, len(keys), sizes.sum(), len(index.sizes), index.sizes.sum(), width, nameless], np.int64)
    kind = np.dtype(f"<u{width}")
    parts = [[header], (x.astype(kind) for x in ids), [index.sizes], [index.bits], [index.prints], [index.bounds], [doc_ids]]
    put(path, (piece for part in parts for piece in _padded(part)))
    return int(sizes.sum())


def _padded(arrays) -> Iterator[bytes]:
    size = 0
    for x in arrays:
        size += x.nbytes
        yield x.tobytes()
    yield bytes(-size % 8)


class Shard:
    """A shard as it lies in the file; nothing is read before it is asked for."""

    def __init__(self, path: str):
        buffer = get(path)
        magic, n, m, levels, bits, width, self.nameless = np.frombuffer(buffer, np.int64, 7).tolist()
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard")
        at = 56

        def part(kind, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(buffer, kind, count, at) if count else np.zeros(0, kind)
            at += -(-found.nbytes // 8) * 8
            return found

        self.ids = part(f"<u{width}", m)
        self.index = Index(part(np.int64, levels), part(U, bits // 64), part(np.uint32, n), part(np.int64, 2 * n).reshape(-1, 2))
        self.doc_ids = part(np.int64, n)

    def __getitem__(self, key: int) -> np.ndarray:
        """The ids of the first document with this doc_id."""
        start, size = self.index.find(keys_of(np.array([key], np.int64)))[0]
        if start < 0 or key == NULL_ID and NULL_ID not in self.doc_ids[:len(self.doc_ids) - self.nameless][-1:]:
            raise KeyError(key)
        return self.ids[start:start + size].astype(np.uint32)


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write all documents; the manifest, one row for each shard in ascending order."""
    folder = folder or new_folder(docs.sparkSession, "ids")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NULL_ID)))
    keyed = lean(docs, "doc_id", "text").select(order.alias("_key"), F.col("doc_id").isNull().alias("_nameless"), "text")
    place = ["_key", "_nameless", F.xxhash64("text")]
    spread = keyed.repartitionByRange(parts_for(docs), *place).sortWithinPartitions(*place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, own, end = TaskContext.get().partitionId(), encoder(tokenizer), np.array([end_id])
        width = 2 if max(own.library.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
        keys, ids, nameless = [], [], 0
        for batch in slices(batches):
            nameless += batch.column("_nameless").true_count
            keys.append(batch.column("_key").to_numpy())
            ids += [np.append(x, end).astype(f"<u{width}") for x in own.encode(batch.column("text").to_pylist())]
        if keys:
            doc_ids, path = np.concatenate(keys), f"{folder}/shard-{shard:08d}.ids"
            total = write_shard(path, doc_ids, ids, width, nameless)
            row = {"shard": shard, "path": path, "docs": len(ids), "ids": total, "last_key": int(doc_ids[-1])}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("last_key", pa.int64())]))

    return settled(spread.mapInArrow(run, MANIFEST))


def read(manifest: DataFrame) -> DataFrame:
    """Every document from the files, by its key: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before; the totals that it needs are one number for each shard.
    """
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).alias("before"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in frame.to_pylist():
                shard = Shard(row["path"])
                bounds = shard.index.find(keys_of(shard.doc_ids))
                if (bounds < 0).any():
                    raise ValueError(f"{row['path']}: a key is not found")
                crcs = [zlib.crc32(shard.ids[a:a + n].astype("<u4").tobytes()) for a, n in bounds.tolist()]
                keys = pa.array(shard.doc_ids, mask=np.arange(len(shard.doc_ids)) >= len(shard.doc_ids) - shard.nameless)
                yield pa.RecordBatch.from_arrays([keys, pa.array(bounds[:, 0] + row["before"]), pa.array(bounds[:, 1]), pa.array(crcs, pa.int64())], schema=schema)

    parts = max(1, int(manifest.count()))
    return placed.repartition(parts, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, key: int) -> np.ndarray:
    """The ids of one document: the manifest says which shard, its index where."""
    near = manifest.where(F.col("last_key") >= key).orderBy("shard").select("path").first()
    if near is None:
        raise KeyError(key)
    return Shard(near["path"])[key]
