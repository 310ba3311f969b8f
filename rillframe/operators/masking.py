"""Reversible masking of text columns, and its audit.

Every UTF-16 unit of a text is shifted, without wrapping inside an alphabet. Texts go through in Arrow batches, a whole
text at a time in vector operations. Where the shifted units form no valid text the result is NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


def shifted(text: str | None, shift: int) -> str | None:
    """A text whose UTF-16 units are shifted modulo 2**16; None where they form no text."""
    if not text:
        return text
    units = np.frombuffer(text.encode("utf-16-le"), "<u2") + np.uint16(shift % (1 << 16))
    try:
        return units.astype("<u2").tobytes().decode("utf-16-le")
    except UnicodeDecodeError:
        return None


def _column(values: pa.Array, shift: int) -> pa.Array:
    return pa.array([shifted(v, shift) for v in values.to_pylist()], pa.string())


def mask(df: DataFrame, columns: list[str], shift: int) -> DataFrame:
    """``df`` with the texts in ``columns`` shifted; other columns pass."""
    names = df.columns
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in columns else f for f in df.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_column(c, shift) if n in columns else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays(made, names=names)

    return df.mapInArrow(run, schema)


def unmask(df: DataFrame, columns: list[str], shift: int) -> DataFrame:
    return mask(df, columns, -shift)


def audit(df: DataFrame, column: str, shift: int) -> DataFrame:
    """Rows read, and rows whose round trip differs or cannot be represented."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.column(0).to_pylist()
            there = [shifted(v, shift) for v in plain]
            differing = sum(v != shifted(m, -shift) or (v is None) != (m is None) for v, m in zip(plain, there))
            yield pa.RecordBatch.from_pydict({"rows": [len(plain)], "differing": [differing]}, schema=pa.schema([("rows", pa.int64()), ("differing", pa.int64())]))

    counts = df.select(F.col(column).cast("string")).mapInArrow(run, "rows bigint, differing bigint")
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "differing")])
