"""Toxicity by class-conditional Kneser-Ney models of expressions.

An expression is a term (see ``terms``). A model of toxic and one of ordinary language count in how many different labelled
texts of their class an expression stands, copies of a text once: as in Kneser-Ney smoothing, contexts count and not
occurrences, the context being the text. With t and o of these counts

    p(e | class) = (1 - SHARED) max(count - discount, 0) / rest + SHARED (t + o + 1) / (all + expressions)

where rest is the sum of the discounted counts of the class. The second part, the backoff, is shared by both
classes with the same weight, so expressions that are rare in both say nothing; the discount is DISCOUNT in the
smaller class and larger in the other in proportion to the classes' counts, so that being rare means the same there.
A text's margin is the sum over its different expressions of ln p(e | toxic) - ln p(e | ordinary), divided by their number
plus LEAST: length-normalised, with short texts drawn to 0.

The score is the share of toxic texts at that margin, a rising curve fitted to the training texts (pool adjacent
violators). For it each training text is judged without its own count. Margins are whole billionths, summed exactly.

Every labelled text that is not held out counts; nothing is sampled. A text that has both labels counts in both
classes. Of several labels for a doc_id the largest counts, null ones do not. Null and empty texts have margin 0. Without
labels of both classes every margin is 0, and without any the score is 0. A null doc_id has no label and is not held
out. Rows that repeat are each scored. Of the columns of the input only doc_id passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rillframe.llm.store import few, lean, settled
from rillframe.llm.terms import terms
from rillframe.llm.words import U, Texts, owners, slices, spans

DISCOUNT, SHARED, LEAST = 3.0, 0.98, 50
UNIT = 1e9
GRID = 4096  # steps of the curve for each unit of margin
ROWS = 2_000_000  # rows of narrow numbers that are broadcast at most
BAGS = "row long, doc_id long, copy long, n int, words array<long>"


def bags(docs: DataFrame) -> DataFrame:
    """(row, doc_id, copy, n, words): a number for the row, a hash of its text, and the hashes of its different terms."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("copy", pa.int64()), ("n", pa.int32()), ("words", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, starts, ends, edges = terms(Texts(batch.column("text")))
            hashes, rows = spans(data, starts, ends), owners(edges)
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order], rows[order]
            new = np.ones(len(rows), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            hashes, rows = hashes[new], rows[new]
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id").cast(pa.int64()), batch.column("copy"),
                                              pa.array(np.diff(bounds).astype(np.int32)), lists], schema=schema)

    numbered = lean(docs, "doc_id", "text").withColumns({"row": F.monotonically_increasing_id(), "copy": F.xxhash64("text")})
    return numbered.mapInArrow(run, BAGS)


def held_out(folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def chosen(made: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, toxic): one row for each different text and label of the rows that are not held out."""
    truth = labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    known = made.select("row", "doc_id", "copy").where(~held_out()).join(truth, "doc_id")
    return known.groupBy("copy", "toxic").agg(F.min("row").alias("row")).select("row", "toxic")


def evidence(made: DataFrame, picked: DataFrame) -> DataFrame:
    """(word, all, without_toxic, without_ordinary): ln p(e | toxic) - ln p(e | ordinary) in billionths.

    Of the expressions for which it is not 0; also as it is without one text of either class.
    """
    listed = made.select("row", F.explode("words").alias("word")).join(few(picked, ROWS), "row")
    counts = settled(listed.groupBy("word").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("o")))
    t, o, words = counts.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("o"), F.lit(0)), F.count("*")).first()
    if not t or not o:
        return counts.where("false").select("word", *[F.lit(0).cast("long").alias(c) for c in ("all", "without_toxic", "without_ordinary")])
    discount = {"t": DISCOUNT * t / min(t, o), "o": DISCOUNT * o / min(t, o)}
    left = lambda c, less=0: F.greatest(F.col(c) - F.lit(discount[c] + less), F.lit(0.0))
    rest = counts.agg(F.sum(left("t")).alias("t"), F.sum(left("o")).alias("o")).first()
    backoff = SHARED * (F.col("t") + F.col("o") + 1) / float(t + o + words)
    own = lambda c, less=0: backoff + ((1 - SHARED) * left(c, less) / rest[c] if rest[c] else F.lit(0.0))
    ratio = lambda a, b: F.round(UNIT * F.log(own("t", a) / own("o", b))).cast("long")
    found = counts.select("word", ratio(0, 0).alias("all"), ratio(1, 0).alias("without_toxic"), ratio(0, 1).alias("without_ordinary"))
    return found.where("all <> 0 OR without_toxic <> 0 OR without_ordinary <> 0")


def margins(made: DataFrame, known: DataFrame) -> DataFrame:
    """(row, doc_id, n, all, without_toxic, without_ordinary) of every row: sums over its different expressions."""
    sums = ["all", "without_toxic", "without_ordinary"]
    hits = made.select("row", F.explode("words").alias("word")).join(few(known, ROWS), "word")
    totals = hits.groupBy("row").agg(*[F.sum(c).alias(c) for c in sums])
    return made.select("row", "doc_id", "n").join(totals, "row", "left").fillna(0, sums)


def rising(count: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising shares closest to ``good`` of ``count``, one for each entry."""
    pools: list[list[float]] = []
    for n, g in zip(count.tolist(), good.tolist()):
        pools.append([n, g, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n, g, size = pools.pop()
            pools[-1] = [pools[-1][0] + n, pools[-1][1] + g, pools[-1][2] + size]
    return np.repeat([g / n for n, g, _ in pools], [size for _, _, size in pools]) if pools else np.zeros(0)


@dataclass
class Curve:
    """Shares of toxic texts at margins, straight between them."""

    margins: np.ndarray
    shares: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.margins, self.shares) if len(self.margins) else np.zeros(len(margin))


def _margin(total: Column) -> Column:
    return total / F.lit(UNIT) / (F.col("n") + LEAST)


def curve(found: DataFrame, picked: DataFrame) -> Curve:
    """The curve of the training texts. To the driver come counts of steps of the margin, bounded by its range."""
    own = found.join(few(picked, ROWS), "row").select("toxic", _margin(F.when(F.col("toxic"), F.col("without_toxic")).otherwise(F.col("without_ordinary"))).alias("margin"))
    steps = own.groupBy(F.floor(F.col("margin") * GRID).alias("step")).agg(F.count("*").alias("n"), F.count_if("toxic").alias("toxic")).orderBy("step").collect()
    n, toxic = (np.array([r[c] for r in steps], float) for c in ("n", "toxic"))
    return Curve((np.array([r["step"] for r in steps], float) + 0.5) / GRID, rising(n, toxic))


def scored(found: DataFrame, shape: Curve) -> DataFrame:
    """(doc_id, n, margin, score) of every row of ``margins``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("margin", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch.column("margin").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n").cast(pa.int64()), pa.array(margin), pa.array(shape(margin))], schema=schema)

    return found.select("doc_id", "n", _margin(F.col("all")).alias("margin")).mapInArrow(run, "doc_id long, n long, margin double, score double")


def classified(docs: DataFrame, labels: DataFrame, toxic_from: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, n, margin) of every row, by models of the labelled rows that are not held out."""
    made = settled(bags(docs))
    picked = settled(chosen(made, labels))
    found = settled(margins(made, settled(evidence(made, picked))))
    out = scored(found, curve(found, picked))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxic_from).cast("int").alias("predicted"), "n", "margin")
