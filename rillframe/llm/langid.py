"""Language of a text by the nearest of several centroids for each language, with rejection by distance.

A text is the multiset of its letter n-grams (1 to 3 letters, lower case, words bounded by a blank), hashed to
``SIZE`` features, weighted by 1 + log of the count and by inverse document frequency, scaled to length 1.
Document frequencies count every labelled text given to ``fit``. The centroids of a language come from spherical
k-means over about ``SAMPLE`` of its different texts, chosen by hash, each once: that bound is a parameter, as is
``CENTROIDS``.
The distance of a text is 1 - cosine to the nearest centroid of all; the language of that centroid is the answer.
A text is rejected if it is further away than all but ``ODD`` of that language's sample were, by more than ``slack``,
or further than ``LIMIT``. The sample's distances are to centroids of the other folds of it: a text that has made a
centroid lies closer than texts to come. A language with less than ``FEW`` texts has no such quantile, only ``LIMIT``.

A text that is null or has no letter is UNKNOWN with score 0, and rejected. If no labelled text has letters every text
is UNKNOWN with score 0, and those with letters are not rejected: nothing is known that they could be far from. Whole texts are read. Rows that repeat are each judged. Ties go to the first centroid in order of language.
Only ``text`` is read for a prediction; other columns pass, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillframe.llm.store import lean
from rillframe.llm.words import BASE, U, mix, slices

SIZE = 1 << 14
SAMPLE = 1000
CENTROIDS = 4
ROUNDS = 12
FOLDS = 5
ODD, LIMIT = 0.005, 0.9
FEW = round(1 / ODD)  # texts that a quantile of 1 - ODD takes
UNKNOWN = "und"
ROWS = 64  # texts counted at a time, each into SIZE numbers
COLUMNS = 512  # features of the chosen texts that are copied at a time
RESULTS = {"lang_pred": T.StringType(), "score": T.DoubleType(), "distance": T.DoubleType(), "rejected": T.BooleanType()}
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of the n-grams of each text, in order of row."""
    texts = [t.lower() for t in texts]
    points = np.frombuffer(f" {' '.join(texts)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    is_letter = letters()[points]
    value = np.where(is_letter, points, 0).astype(U)
    at = np.flatnonzero(is_letter)
    row = np.searchsorted(np.cumsum(sizes + 1), at)
    one = mix(value[at] + BASE)
    two = mix(one * BASE + value[at + 1])
    three = mix(two + value[at - 1] * BASE + U(1))
    feature = np.concatenate([x % U(SIZE) for x in (one, two, three)]).astype(np.int64)
    cells = np.bincount(np.tile(row, 3) * SIZE + feature, minlength=1)
    found = np.flatnonzero(cells)
    return found // SIZE, found % SIZE, cells[found]


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and weight of each text's vector of length 1."""
    row, feature, count = grams(texts)
    weight = (1 + np.log(count)) * idf[feature]
    length = np.sqrt(np.bincount(row, weight * weight, minlength=len(texts)))
    return row, feature, weight / np.maximum(length, 1e-300)[row]


@dataclass
class Model:
    """Weights of the features and, for each centroid, its language, its vector and how far its texts may be."""

    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    reach: np.ndarray

    def nearest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each text and the cosine to it; -1 without letters or centroids."""
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        if not self.langs:
            return best, score
        row, feature, weight = vectors(texts, self.idf)
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            cosines = np.add.reduceat(self.centroids[feature] * weight[:, None], first, axis=0)
            best[row[first]], score[row[first]] = cosines.argmax(1), np.clip(cosines.max(1), 0, 1)
        return best, score


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _sum(points: np.ndarray, some: np.ndarray) -> np.ndarray:
    """The sum of some of the points, of which a few columns are copied at a time."""
    return np.concatenate([points[some, a:a + COLUMNS].sum(0) for a in range(0, points.shape[1], COLUMNS)])


def kmeans(points: np.ndarray, k: int, rounds: int, some: np.ndarray | None = None, support: float = 0.1) -> np.ndarray:
    """Spherical k-means: unit centroids, started at points of evenly spread closeness to the mean.

    ``some`` are the numbers of the points that count, all if not given; points are large and not copied for it.
    A centroid that is nearest to less than ``support`` of the points is left out: it stands for a few odd or mixed
    texts and would draw other languages' texts to it.
    """
    some = np.arange(len(points)) if some is None else some
    order = some[np.argsort((points @ (_sum(points, some) / len(some)))[some], kind="stable")]
    centroids = points[order[(np.arange(k) * 2 + 1) * len(some) // (2 * k)]]
    for _ in range(rounds):
        own = (points @ centroids.T).argmax(1)[some]
        sums = np.stack([_sum(points, some[own == c]) for c in range(k)])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-30), centroids)
    shares = np.bincount((points @ centroids.T).argmax(1)[some], minlength=k) / len(some)
    return centroids[shares >= min(support, shares.max())]


def reach_of(points: np.ndarray, centroids: int, slack: float) -> float:
    """How far texts of a language may be: a quantile over texts that the centroids they are held against have not seen."""
    if len(points) < FEW:
        return LIMIT
    distances, fold = np.zeros(len(points)), np.arange(len(points)) % FOLDS
    for k in range(FOLDS):
        made = kmeans(points, centroids, ROUNDS, np.flatnonzero(fold != k))
        distances[fold == k] = 1 - (points @ made.T).max(1)[fold == k]
    return min(float(np.quantile(distances, 1 - ODD)) + slack, LIMIT)


def fit(labelled: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, slack: float = 0.25) -> Model:
    """A model from ``text`` and ``lang`` of labelled rows; rows where either is null do not count.

    To the driver come SIZE document frequencies, a count for each language, and the centroids.
    """
    rows = lean(labelled, "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(SIZE, np.int64), 0
        for batch in _texts(batches):
            row, feature, _ = grams(batch.column("text").to_pylist())
            total += np.bincount(feature, minlength=SIZE)
            count += len(np.unique(row))
        if count:
            yield pa.RecordBatch.from_pydict({"feature": np.append(np.arange(SIZE), -1), "n": np.append(total, count)})

    found = {r["feature"]: r["n"] for r in rows.mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    count = found.pop(-1, 0)
    frequency = np.zeros(SIZE)
    frequency[list(found)] = list(found.values())
    idf = np.log((1 + count) / (1 + frequency)) + 0.1  # what all texts have still counts a little
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", F.xxhash64("text").alias("text")).distinct().groupBy("lang").count().collect()}
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))]) if sizes else F.lit(None)
    draw = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 20)) / F.lit(1 << 20)
    chosen = rows.where(draw < share[F.col("lang")]).dropDuplicates(["lang", "text"]) if sizes else rows

    def vectored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            row, feature, weight = vectors(batch.column("text").to_pylist(), idf)
            lang = batch.column("lang").to_pylist()
            cuts = np.flatnonzero(np.diff(row, prepend=-1, append=-1)) if len(row) else []
            made = [(lang[row[a]], feature[a:b].astype(np.int32).tobytes(), weight[a:b].astype(np.float32).tobytes()) for a, b in zip(cuts, cuts[1:])]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.binary(), pa.binary()))], names=["lang", "feature", "weight"])

    def clustered(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["feature", "weight"]).reset_index(drop=True)
        points = np.zeros((len(frame), SIZE), np.float32)
        for i, (f, w) in enumerate(zip(frame["feature"], frame["weight"])):
            points[i, np.frombuffer(f, np.int32)] = np.frombuffer(w, np.float32)
        made = kmeans(points, centroids, ROUNDS)
        reach = reach_of(points, centroids, slack)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "part": range(len(made)), "vector": [c.astype(np.float32).tobytes() for c in made], "reach": reach})

    made = chosen.mapInArrow(vectored, "lang string, feature binary, weight binary").groupBy("lang").applyInPandas(clustered, "lang string, part int, vector binary, reach double")
    made = sorted(made.collect(), key=lambda r: (r["lang"], r["part"]))
    matrix = np.array([np.frombuffer(r["vector"], np.float32) for r in made], np.float32).reshape(len(made), SIZE).T
    return Model(idf, [r["lang"] for r in made], np.ascontiguousarray(matrix), np.array([r["reach"] for r in made]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1), distance and rejected."""
    plain = [f for f in docs.schema.fields if f.name not in RESULTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            best, score = model.nearest(texts)
            lang = [model.langs[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            out = [1 - s > model.reach[b] if b >= 0 else bool(model.langs) or not any(c.isalpha() for c in t.lower()) for b, s, t in zip(best.tolist(), score.tolist(), texts)]
            made = [pa.array(lang, pa.string()), pa.array(score), pa.array(1 - score), pa.array(out, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in plain] + made, names=[*(f.name for f in plain), *RESULTS])

    schema = T.StructType(plain + [T.StructField(k, v) for k, v in RESULTS.items()])
    return lean(docs, *[f.name for f in plain]).mapInArrow(run, schema)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from training: crc32 of its key as text leaves no rest; a null key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))


def classified(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with held_out and the results of ``predict``, by a model of the rows that are not held out."""
    model = fit(docs.where(~held_out()), **options)
    return predict(docs.withColumn("held_out", held_out()), model)
