"""Quality rules whose cutoffs are certified on labelled documents.

Each text is measured (``measure``). For every stratum and signal the labelled good documents say how many a
cutoff would reject wrongly. A cutoff is certified if the exact (Clopper-Pearson) upper bound of its false
rejection rate is at most its share of ``risk``. The bound's level is ``doubt`` divided by the number of all
strata, signals and cutoffs looked at (Bonferroni), so that with probability 1 - doubt no stratum loses more than
``risk`` of its good documents over all signals together. Of the certified cutoffs the one that rejects most
labelled bad documents less ``weight`` times the good ones is taken, the loosest of equals; if none is better
than no rule, the signal has none there. Few labels certify nothing, so such a stratum has the fixed rules alone.

Null texts have no words and fail the fixed rules. A null stratum is one of its own. Repeated rows are each
measured and judged. Labels: of several for a document the worst counts, a null one does not. Other columns pass,
those named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.llm.store import free, lean, settled, unwrapped, wrapped
from rillframe.llm.words import Texts, distinct, owners, slices

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
CAPITALS = np.isin(np.arange(256), list(range(65, 91)))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
STEPS = 64  # cutoffs of each signal, fixed before any label is seen
#: Signals between 0 and 1; a document above the cutoff is rejected.
SIGNALS = {
    "symbols": lambda: _share("n_symbols", "word_chars"),
    "dup_lines": lambda: _share("n_dup_lines", "n_lines"),
    "repeats": lambda: _share("n_repeat_words", "n_words"),
    "capitals": lambda: _share("n_capitals", "word_chars"),
}


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.least(F.col(part) / F.col(whole), F.lit(1.0))).otherwise(F.lit(0.0))


def _paired(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers, the same for equal pairs only; small if it has to be."""
    if len(one) and (int(one.max()) + 1) * (int(two.max()) + 1) >= 1 << 62:
        one = np.unique(one, return_inverse=True)[1]
    return one * (int(two.max()) + 1 if len(two) else 1) + two


def _measured(batch: pa.RecordBatch) -> list[np.ndarray]:
    texts = Texts(batch.column("text"))
    starts, ends, edges = texts.words()
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    in_word = np.cumsum(inside[:-1]).astype(bool) if len(starts) else np.zeros(len(texts.data), bool)

    rows = owners(edges)
    at = np.flatnonzero(np.arange(len(starts)) + 3 <= edges[1:][rows]) if len(starts) else np.zeros(0, np.int64)
    number = distinct(texts.data, starts, ends)[1]
    triple = number[at]
    for more in (number[np.minimum(at + 1, len(starts) - 1)], number[np.minimum(at + 2, len(starts) - 1)], rows[at]) if len(at) else ():
        triple = _paired(triple, more)
    _, where, count = np.unique(triple, return_inverse=True, return_counts=True)
    covered = np.zeros(len(starts) + 3, bool)
    hit = at[count[where] > 1]
    for k in range(3):
        covered[hit + k] = True
    covered_sums = np.concatenate([[0], np.cumsum(covered[:len(starts)])])

    line_at, line_to, line_edges = texts.parts(texts.data != 10)
    worded = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_at)
    line_rows = owners(line_edges)[worded]
    lines = _paired(distinct(texts.data, line_at[worded], line_to[worded])[1], line_rows)
    _, first = np.unique(lines, return_index=True)
    all_lines = np.bincount(line_rows, minlength=texts.rows)
    new_lines = np.bincount(line_rows[first], minlength=texts.rows)
    return [
        np.diff(edges),
        texts.per_row(in_word & ((texts.data & 0xC0) != 0x80)),
        texts.per_row(SYMBOLS[texts.data]),
        all_lines - new_lines,
        covered_sums[edges[1:]] - covered_sums[edges[:-1]],
        all_lines,
        texts.per_row(CAPITALS[texts.data]),
    ]


def measure(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """The columns of ``docs``, ``text`` only if wanted, and the counts of COUNTS for each whole text (null: none).

    Words are [^ \\t-\\r]+. word_chars: code points in words. n_symbols: characters of #*$%&|<>. n_lines: lines with a
    word; n_dup_lines: those equal to an earlier line. n_repeat_words: words in 3-word windows that the text has
    twice or more. n_capitals: A-Z. A column of ``docs`` named like a count is replaced by it.
    """
    kept = [f for f in docs.schema.fields if f.name != "text" and f.name not in COUNTS]
    names = [f.name for f in kept]
    if with_text:
        kept = kept + [docs.schema["text"]]
    schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch.column(i) for i in range(len(kept))]
            found = [pa.array(x.astype(np.int64)) for x in _measured(batch)]
            yield pa.RecordBatch.from_arrays(columns + found, names=[f.name for f in kept] + list(COUNTS))

    return lean(docs, *names, "text").mapInArrow(run, schema)


def certified(good: int, wrong: int, risk: float, doubt: float) -> bool:
    """Whether the exact upper bound, at level 1 - doubt, of a rate seen as wrong of good is at most risk."""
    if good <= 0 or wrong >= good * risk:
        return False
    log = [math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1) + k * math.log(risk)
           + (good - k) * math.log1p(-risk) for k in range(wrong + 1)]
    top = max(log)
    return top + math.log(sum(math.exp(x - top) for x in log)) <= math.log(doubt)


def choose(good: np.ndarray, bad: np.ndarray, risk: float, doubt: float, weight: float) -> float | None:
    """The cutoff for counts of good and bad documents in each of STEPS bins, or None. Bin i holds (i-1, i] / STEPS."""
    total, best, cut = int(good.sum()), 0.0, None
    above_good = np.cumsum(good[::-1])[::-1]
    above_bad = np.cumsum(bad[::-1])[::-1]
    for i in range(STEPS - 1, -1, -1):  # cutoff i / STEPS rejects the bins above i
        wrong, right = int(above_good[i + 1]), int(above_bad[i + 1])
        if right - weight * wrong > best and certified(total, wrong, risk, doubt):
            best, cut = right - weight * wrong, i / STEPS
    return cut


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, doubt: float = 0.05,
            weight: float = 10.0) -> DataFrame:
    """One row for each stratum: a column cut_<signal>, null where no cutoff is certified and useful.

    All labelled documents that pass the fixed rules count. What reaches one task is a histogram of a stratum,
    signals x (STEPS + 1) x 2 numbers, summed before the shuffle.
    """
    truth = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_good"))
    known = lean(measured, "doc_id", *COUNTS, *[stratum] * (stratum not in ("doc_id", *COUNTS)))
    judged = base(known).where(~F.col("base_failed")).join(truth, F.col("doc_id") == F.col("_id"))
    bins = F.explode(F.array(*[
        F.struct(F.lit(name).alias("signal"), F.ceil(signal() * STEPS).cast("int").alias("bin")) for name, signal in SIGNALS.items()
    ]))
    counted = (
        judged.select(F.col(f"`{stratum}`").cast("string").alias("stratum"), "_good", bins.alias("b"))
        .groupBy("stratum", "b.signal", "b.bin").agg(F.sum(F.when(F.col("_good") >= 1, 1).otherwise(0)).alias("good"),
                                                   F.sum(F.when(F.col("_good") >= 1, 0).otherwise(1)).alias("bad"))
    )
    counted = settled(counted)
    strata = max(1, counted.select(F.coalesce(F.concat(F.lit("="), "stratum"), F.lit("")).alias("s")).distinct().count())
    each = doubt / (strata * len(SIGNALS) * STEPS)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        row = {"stratum": frame["stratum"].iloc[0]}
        for name in SIGNALS:
            own = frame[frame["signal"] == name]
            good, bad = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
            np.add.at(good, own["bin"].to_numpy(), own["good"].to_numpy())
            np.add.at(bad, own["bin"].to_numpy(), own["bad"].to_numpy())
            row[f"cut_{name}"] = choose(good, bad, risk / len(SIGNALS), each, weight)
        return pd.DataFrame([row]).astype({f"cut_{n}": "float64" for n in SIGNALS})

    return counted.groupBy("stratum").applyInPandas(one, "stratum string, " + ", ".join(f"cut_{n} double" for n in SIGNALS))


def base(measured: DataFrame) -> DataFrame:
    """Adds base_failed: fewer than 50 words, or over half of the words in repeated windows."""
    return measured.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def judge(measured: DataFrame, cuts: DataFrame, stratum: str = "stratum") -> DataFrame:
    """Adds base_failed and kept: not base_failed, and no signal above its stratum's cutoff."""
    measured = base(measured)
    of, given = free(measured, "_stratum", "_cuts")
    cuts = cuts.select(F.col("stratum").alias(of), F.struct(*[f"cut_{name}" for name in SIGNALS]).alias(given))
    joined = measured.join(cuts, F.col(f"`{stratum}`").cast("string").eqNullSafe(F.col(of)), "left")
    over = F.lit(False)
    for name, signal in SIGNALS.items():
        over = over | F.coalesce(signal() > F.col(given)[f"cut_{name}"], F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop(of, given)


def verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """``docs`` without texts, with counts, base_failed and kept; texts are read once."""
    measured = settled(measure(docs))
    return judge(measured, settled(cutoffs(measured, labels, stratum, **options)), stratum)


def passing(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are. Texts are read twice and not moved."""
    cuts = settled(cutoffs(settled(measure(docs)), labels, stratum, **options))
    rows = wrapped(docs, "text").withColumn("stratum", F.col("text") if stratum == "text" else F.col("row").getField(stratum))
    return unwrapped(judge(measure(rows, with_text=True), cuts).where("kept"), docs.columns, "text")
