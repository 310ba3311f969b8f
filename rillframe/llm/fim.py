"""Fill-in-the-middle by piece tables.

A document is a list of descriptors (buffer, first byte, number of bytes) over two buffers that never change: the text
as it came, and the sentinels. Cutting a document at two places splits its one descriptor into prefix, middle and
suffix. An arrangement permutes these three and the three descriptors of the sentinels; no text is copied for that.
``restored`` finds the sentinels in an output, cuts it there and applies the inverse permutation. Hashes are fed from
the descriptors, a piece after another.

Units are ``[\\t-\\r ]*[^\\t-\\r ]+|[\\t-\\r ]+``, words with the white space before them and white space at the end; the text is cut
between units. Where, and whether at all, is drawn from a hash of ``seed`` and doc_id: ``rate`` percent of the documents are
arranged, ``spm`` percent of those with the suffix first. Empty and null texts, and texts that hold a sentinel, stay plain;
so does what is drawn to. A null doc_id is drawn like an empty name. Whole texts are read; rows that repeat give equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.llm.store import free, lean
from rillframe.llm.words import SPACE, Texts, slices

#: The sentinels, and the order of the pieces in each form.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PARTS = ("prefix", "middle", "suffix")  # as they stand in the text
MARKS = b"".join(SENTINELS.values())
MARK_AT = {name: MARKS.index(mark) for name, mark in SENTINELS.items()}
MARK_SIZE = 3
RESULTS = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType()}

Piece = tuple[memoryview, int, int]


def arrangement(form: str) -> list[int]:
    """Which of (three sentinels, prefix, middle, suffix) comes at each place of an output."""
    if form == "plain":
        return [3, 4, 5]
    return [x for name in FORMS[form] for x in (list(SENTINELS).index(name), 3 + PARTS.index(name))]


def arranged(pieces: list[Piece], form: str) -> list[Piece]:
    marks = memoryview(MARKS)
    table = [(marks, at, MARK_SIZE) for at in MARK_AT.values()] + pieces
    return [table[k] for k in arrangement(form)]


def cut_back(output: memoryview, data: bytes, form: str) -> list[Piece]:
    """The pieces of the text in an output: split at its sentinels, then put in the order of the text."""
    if form == "plain":
        return [(output, 0, len(data))]
    places, at = [], 0
    for name in FORMS[form]:  # no text has a sentinel, so the next one is that of the arrangement
        at = data.index(SENTINELS[name], at)
        places.append(at)
        at += MARK_SIZE
    table = [x for a, b in zip(places, [*places[1:], len(data)]) for x in ((output, a, MARK_SIZE), (output, a + MARK_SIZE, b - a - MARK_SIZE))]
    order = arrangement(form)
    inverse = [order.index(k) for k in range(len(order))]
    return [table[inverse[3 + k]] for k in range(len(PARTS))]


def joined(pieces: list[Piece]) -> bytes:
    return b"".join(buffer[at:at + size] for buffer, at, size in pieces)


def digest(pieces: list[Piece]) -> str:
    made = hashlib.sha256()
    for buffer, at, size in pieces:
        made.update(buffer[at:at + size])
    return made.hexdigest()


def draws(seed: str, key: str) -> list[Column]:
    """Four whole numbers of 32 bits for each key."""
    made = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(made, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


class Cuts:
    """Where the texts of a slice are cut, and in which form they come out."""

    def __init__(self, texts: Texts, draw: list[np.ndarray], rate: int, spm: int):
        starts, ends, edges = texts.words()
        low, high = texts.edges[:-1], texts.edges[1:]
        words = np.diff(edges)
        last = np.concatenate([texts.data, [0]])[high - 1]  # of an empty text any byte
        filled = high > low
        self.n = words + (filled & SPACE[last])
        one, two = draw[0] % (self.n + 1), draw[1] % (self.n + 1)
        bounds = np.concatenate([ends, [0]])

        def byte(units: np.ndarray) -> np.ndarray:
            inside = np.clip(edges[:-1] + units - 1, 0, len(bounds) - 1)
            return np.where(units == 0, low, np.where(units <= words, bounds[inside], high))

        self.cuts = np.stack([low, byte(np.minimum(one, two)), byte(np.maximum(one, two)), high])
        marked = np.zeros(len(texts.data), bool)
        for mark in SENTINELS.values():
            hit = np.ones(max(len(texts.data) - MARK_SIZE + 1, 0), bool)
            for k, b in enumerate(mark):
                hit &= texts.data[k:len(hit) + k] == b
            marked[:len(hit)] |= hit
        at = np.flatnonzero(marked)
        row = np.searchsorted(texts.edges, at, side="right") - 1
        holds = np.bincount(row[at + MARK_SIZE <= high[row]], minlength=texts.rows) > 0
        plain = ~filled | holds | (draw[2] % 100 >= rate)
        self.forms = np.where(plain, "plain", np.where(draw[3] % 100 < spm, "spm", "psm"))
        chars = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
        self.chars = [pa.array(chars[self.cuts[k + 1]] - chars[self.cuts[k]], pa.int64(), mask=plain) for k in range(2)]

    def columns(self) -> list[pa.Array]:
        return [pa.array(self.n, pa.int64()), pa.array(self.forms.tolist(), pa.string()), *self.chars]

    def outputs(self, texts: Texts) -> Iterator[tuple[str, list[Piece]]]:
        """Form and pieces of each output."""
        buffer = memoryview(np.ascontiguousarray(texts.data))
        for form, (a, b, c, d) in zip(self.forms.tolist(), self.cuts.T.tolist()):
            yield form, arranged([(buffer, a, b - a), (buffer, b, c - b), (buffer, c, d - c)], form)


def _run(docs: DataFrame, names: list[str], fields: list[T.StructField], seed: str, rate: int, spm: int, made) -> DataFrame:
    """The columns ``names``, those of RESULTS, and what ``made`` gives for the texts and cuts of a slice."""
    own = free(docs, "_h1", "_h2", "_h3", "_h4")
    plain = [docs.schema[c] for c in names]
    schema = T.StructType([*plain, *[T.StructField(k, v) for k, v in RESULTS.items()], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            cuts = Cuts(texts, [batch.column(c).to_numpy() for c in own], rate, spm)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *cuts.columns(), *made(texts, cuts)], names=schema.names)

    given = lean(docs, *dict.fromkeys([*names, "doc_id", "text"]))
    return given.withColumns(dict(zip(own, draws(seed, "doc_id")))).mapInArrow(run, schema)


def transformed(docs: DataFrame, seed: str = "42", rate: int = 50, spm: int = 80) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars and middle_chars (code points, null if plain) and output.

    Columns of the input named like a result are replaced, others pass.
    """
    names = [c for c in docs.columns if c.lower() not in (*RESULTS, "output")]
    made = lambda texts, cuts: [pa.array([joined(pieces).decode() for _, pieces in cuts.outputs(texts)], pa.string())]
    return _run(docs, names, [T.StructField("output", T.StringType())], seed, rate, spm, made)


def restored(made: DataFrame) -> DataFrame:
    """``made`` with the exact text of each output in ``restored``, from ``output`` and ``form`` alone."""
    names = [c for c in made.columns if c.lower() != "restored"]
    schema = T.StructType([*[made.schema[c] for c in names], T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for output, form in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist()):
                data = (output or "").encode()
                texts.append(joined(cut_back(memoryview(data), data, form)).decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=schema.names)

    return lean(made, *names).mapInArrow(run, schema)


def digests(docs: DataFrame, seed: str = "42", rate: int = 50, spm: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row."""

    def hashed(texts: Texts, cuts: Cuts) -> list[pa.Array]:
        rows = []
        for form, pieces in cuts.outputs(texts):
            data = joined(pieces)
            rows.append((digest(pieces), digest(cut_back(memoryview(data), data, form))))
        return [pa.array([r[k] for r in rows], pa.string()) for k in range(2)]

    return _run(docs, ["doc_id"], [T.StructField(c, T.StringType()) for c in ("output_sha256", "restored_sha256")], seed, rate, spm, hashed)
