"""Files in the shared folder in which a key is looked up without reading them whole.

A table of (key, value) is dealt to files by ranges of the key and sorted there. A file holds, little-endian: the number
of keys n; every ``BLOCK``-th key; the keys; n + 1 bounds of the values; the values as UTF-8. A look-up reads the short
list, then the blocks of keys and the values that it needs. Which file has a key is known from the first key of each.

Rows with a NULL key or value are in no file: they are found as a missing key is, as None. Of equal keys one is found.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from rillframe.session import own, shared_dir

BLOCK = 1024
FILE_ROWS = 1_000_000


def _place(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address) if urlparse(address).scheme else (fs.LocalFileSystem(), address)


def _write(address: str, keys: np.ndarray, values: list[bytes]) -> None:
    """As a whole: under another name first, so that a task that is run again leaves no half file."""
    system, path = _place(address)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
    new = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(new) as out:
        for part in (np.array([len(keys)], np.int64), keys[::BLOCK], keys, bounds):
            out.write(part.tobytes())
        out.write(b"".join(values))
    system.move(new, path)


@dataclass(frozen=True)
class Keyed:
    """The files of a table in order, each with its first key."""

    paths: list[str]
    firsts: list[int]

    def find(self, keys: list[int | None]) -> list[str | None]:
        """The value of each key; files are opened one after another."""
        wanted: dict[int, list[int]] = {}
        for key in {k for k in keys if k is not None}:
            file = bisect_right(self.firsts, key) - 1
            if file >= 0:
                wanted.setdefault(file, []).append(key)
        found: dict[int, str] = {}
        for file, own_keys in wanted.items():
            found |= _read(self.paths[file], np.array(sorted(own_keys), np.int64))
        return [found.get(k) for k in keys]


def _read(address: str, keys: np.ndarray) -> dict[int, str]:
    system, path = _place(address)
    with system.open_input_file(path) as file:
        numbers = lambda count, at: np.frombuffer(file.read_at(8 * count, at), np.int64)
        n = int(numbers(1, 0)[0])
        sparse = numbers(math.ceil(n / BLOCK), 8)
        start = 8 + 8 * len(sparse)
        bounds_at, values_at = start + 8 * n, start + 8 * n + 8 * (n + 1)
        out = {}
        block = np.searchsorted(sparse, keys, side="right") - 1
        for b in np.unique(block[block >= 0]).tolist():
            held = numbers(min(BLOCK, n - b * BLOCK), start + 8 * b * BLOCK)
            bounds = numbers(len(held) + 1, bounds_at + 8 * b * BLOCK)
            asked = keys[block == b]
            at = np.searchsorted(held, asked)
            for key, k in zip(asked.tolist(), at.tolist()):
                if k < len(held) and held[k] == key:
                    out[key] = file.read_at(int(bounds[k + 1] - bounds[k]), values_at + int(bounds[k])).decode()
    return out


def write(df: DataFrame, key: str, value: str, file_rows: int = FILE_ROWS) -> Keyed:
    """Write (key, value) of a table; a row for each file comes back."""
    folder = own(f"{shared_dir(df.sparkSession)}/keyed/{uuid.uuid4().hex}")
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(value).cast("string").alias("value")).dropna()
    files = max(1, math.ceil(rows.count() / file_rows))
    schema = pa.schema([("first", pa.int64()), ("path", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []
        for batch in batches:
            keys.append(batch.column("key").to_numpy())
            values += [v.encode() for v in batch.column("value").to_pylist()]
        if values:
            keys = np.concatenate(keys)
            path = f"{folder}/{int(keys[0]):+020d}-{int(keys[-1]):+020d}.keys"
            _write(path, keys, values)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:1]), pa.array([path])], schema=schema)

    dealt = rows.repartitionByRange(files, "key").sortWithinPartitions("key")
    made = dealt.mapInArrow(run, "first bigint, path string").orderBy("first").collect()
    return Keyed([r["path"] for r in made], [r["first"] for r in made])
