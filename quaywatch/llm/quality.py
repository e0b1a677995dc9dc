"""Quality classifier: regularised quadratic discriminant over transformed text statistics.

Each class k has a mean m_k and a covariance shrunk towards the pooled one and
a multiple of the identity,

    S_k = (1 - a) ((1 - b) C_k + b C) + a mean(diag C) I,

over some of FEATURES, scaled by pooled deviation. The score is the logistic of
the difference of log densities, log prior included; the Mahalanobis terms use
Cholesky factors that are computed once, on the driver. Moments are summed over
all labelled rows that are not held out, so no sample is taken. Statistics are
ranked by how far apart their two classes lie, and the number of them, from the
first, and the weights a and b are those with the least log loss over FOLDS
folds of these same rows, each fold ranked and scored by the moments of the others;
ties go to fewer statistics and stronger weights. Held-out labels are never read.

Inputs of a score are statistics of the text alone. Null texts are empty texts.
Every input row gives one row, repeated rows alike. Rows without a doc_id are
not held out and never learned from; a doc_id with several labels gives each.
Without labels of class 0 everything scores 1; with class 0 alone, 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywatch.llm import words
from quaywatch.llm.tables import written

_CLASSES = (
    words.byte_class(b"#$%&*+/<=>@[\\]^_`{|}~"),
    words.byte_class(b"!?"),
    words.byte_class(b".,;:"),
    words.byte_class(b"0123456789"),
    words.byte_class(bytes(range(65, 91))),
    words.byte_class(bytes(range(97, 123))),
    words.byte_class(bytes(range(128, 192))),
    words.byte_class(b"\n"),
)
#: What a text can be told by; `choose` picks those that a model uses.
FEATURES = ("words", "word_length", "distinct", "repeats", "symbols", "exclaims", "stops", "digits", "capitals", "lines", "longest", "commonest", "beyond_ascii")
THRESHOLD = 0.7
FOLDS = 5
#: (to_pooled, to_identity), the strongest first.
GRID = tuple((b, a) for b in (1.0, 0.8, 0.6, 0.4, 0.2, 0.0) for a in (0.3, 0.1, 0.03, 0.01, 0.001))
#: What a fit chooses among: weights, and how many features.
CHOICES = tuple((*weights, size) for size in range(1, len(FEATURES) + 1) for weights in GRID)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; shares go through the arcsine of their root, counts through a log."""
    rows = len(offsets) - 1
    counts = []
    for table in _CLASSES:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        counts.append(total[offsets[1:]] - total[offsets[:-1]])
    symbols, exclaims, stops, digits, upper, lower, tails, lines = (c.astype(np.float64) for c in counts)
    hashes, of = words.word_hashes(data, offsets)
    n = np.bincount(of, minlength=rows).astype(np.float64)
    same = np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=rows)
    order = np.lexsort((hashes, of))
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order][new], minlength=rows)
    chars = np.diff(offsets) - tails
    place = np.flatnonzero(new)
    times = np.diff(np.append(place, len(hashes)))
    longest, commonest = np.zeros(rows), np.zeros(rows)
    starts, ends, _ = words.spans(data, offsets)
    np.maximum.at(longest, of, (ends - starts).astype(np.float64))
    np.maximum.at(commonest, of[order][place], times.astype(np.float64))
    some, letters = np.maximum(n, 1), np.maximum(upper + lower, 1)
    share = lambda x, of: np.arcsin(np.sqrt(np.clip(x / of, 0, 1)))
    out = np.empty((rows, len(FEATURES)))
    for k, x in enumerate(
        (
            np.log1p(n), np.log1p(chars / some), np.log1p(distinct) / np.log1p(some), share(same, some), share(symbols, 2 * some), share(exclaims, 2 * some),
            share(stops, 2 * some), share(digits, np.maximum(chars, 1)), share(upper, letters), share(lines, some), np.log1p(longest), share(commonest, some), share(tails, np.maximum(chars, 1)),
        )
    ):
        out[:, k] = x
    return out


@dataclass(frozen=True)
class Model:
    """The features in use, their scale, means, inverse Cholesky factors, and the constants of the two log densities."""

    use: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    constants: tuple[float, float]

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1."""
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            away = (x[:, self.use] / self.scale - mean) @ factor.T
            logs.append(constant - 0.5 * np.einsum("ij,ij->i", away, away))
        return np.clip(logs[1] - logs[0], -700, 700)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.odds(x)))


@dataclass(frozen=True)
class Constant:
    """What scores when a class has no labels."""

    score: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), 700.0 if self.score else -700.0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.score)


def ranked(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Features, the most telling first: by the divergence of the classes' normal distributions along each, both ways."""
    if any(moments[k][0] <= 0 for k in (0, 1)):
        return np.arange(len(FEATURES))
    mean = [moments[k][1] / moments[k][0] for k in (0, 1)]
    var = [np.maximum(np.diag(moments[k][2]) / moments[k][0] - mean[k] ** 2, 1e-6) for k in (0, 1)]
    apart = (var[0] + (mean[0] - mean[1]) ** 2) / var[1] + (var[1] + (mean[0] - mean[1]) ** 2) / var[0]
    return np.argsort(-apart, kind="stable")


def fit_moments(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float, to_identity: float, size: int = len(FEATURES)) -> Model | Constant:
    """moments: for class 0 and 1, the rows, their sum, and the sum of outer products; size: features to use."""
    use = np.sort(ranked(moments)[:size]) if {0, 1} <= moments.keys() else np.arange(size)
    moments = {k: (n, s[use], ss[np.ix_(use, use)]) for k, (n, s, ss) in moments.items()}
    moments = {k: m for k, m in moments.items() if m[0] > 0}
    if 0 not in moments:
        return Constant(1.0)
    if 1 not in moments:
        return Constant(0.0)
    total = sum(m[0] for m in moments.values())
    cov = {k: (ss / n - np.outer(s / n, s / n)) for k, (n, s, ss) in moments.items()}
    pooled = sum(moments[k][0] * cov[k] for k in (0, 1)) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    by = np.outer(scale, scale)
    pooled = pooled / by
    means, factors, constants = [], [], []
    for k in (0, 1):
        n, s, _ = moments[k]
        shrunk = (1 - to_identity) * ((1 - to_pooled) * cov[k] / by + to_pooled * pooled) + to_identity * max(np.trace(pooled) / len(scale), 1e-3) * np.eye(len(scale))
        factor = np.linalg.cholesky(shrunk)
        means.append(s / n / scale)
        factors.append(np.linalg.inv(factor))
        constants.append(float(np.log(n / total) - np.log(np.diag(factor)).sum()))
    return Model(use, scale, tuple(means), tuple(factors), tuple(constants))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _featured(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                x = features(data, offsets)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), listed], ["doc_id", "x"])

    return documents.select(documents[id_column].alias("doc_id"), documents[text_column].alias("text")).mapInArrow(each, "doc_id long, x array<double>")


def _parted(sums: np.ndarray) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """fit_moments' moments, from a row of 1 + d + d * d sums for each class."""
    d = len(FEATURES)
    return {k: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for k, v in enumerate(sums)}


def _fold_moments(labelled: DataFrame) -> np.ndarray:
    """Sums by fold and class; FOLDS * 2 of them reach the driver."""
    d = len(FEATURES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((FOLDS * 2, 1 + d + d * d))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            part = batch.column("part").to_numpy(zero_copy_only=False)
            for k in range(FOLDS * 2):
                mine = x[part == k]
                kept[k] += np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
        some = np.flatnonzero(kept[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([kept[k] for k in some], pa.list_(pa.float64()))], ["part", "s"])

    out = np.zeros((FOLDS * 2, 1 + d + d * d))
    for r in labelled.mapInArrow(sums, "part int, s array<double>").select("part", F.posexplode("s").alias("at", "s")).groupBy("part", "at").agg(F.sum("s").alias("s")).collect():
        out[r.part, r.at] = r.s
    return out.reshape(FOLDS, 2, -1)


def choose(labelled: DataFrame, moments: np.ndarray) -> tuple[float, float, int]:
    """The one of CHOICES with the least log loss over all folds; a loss for each reaches the driver."""
    d = len(FEATURES)
    models = [[fit_moments(_parted(moments.sum(axis=0) - moments[fold]), *choice) for fold in range(FOLDS)] for choice in CHOICES]

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = np.zeros(len(CHOICES))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            part = batch.column("part").to_numpy(zero_copy_only=False)
            for k in np.unique(part):
                mine, sign = x[part == k], 1 if k % 2 else -1
                for g, by_fold in enumerate(models):
                    lost[g] += np.logaddexp(0, -sign * by_fold[k // 2].odds(mine)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(CHOICES)), pa.int32()), pa.array(lost)], ["at", "loss"])

    found = {r["at"]: r.loss for r in labelled.mapInArrow(losses, "at int, loss double").groupBy("at").agg(F.sum("loss").alias("loss")).collect()}
    return CHOICES[min(range(len(CHOICES)), key=lambda g: (found.get(g, 0.0), g))]


def fit_features(featured: DataFrame, labels: DataFrame) -> Model | Constant:
    """The model of all labelled rows that are not held out; these alone choose its weights."""
    learn = labels.where(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id")) != 2)).select("doc_id", "quality")
    # Rows of one doc_id are in one fold.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) * 2 + F.col("quality")
    labelled = written(featured.join(learn, "doc_id").select(part.cast("int").alias("part"), "x"), "labelled")
    moments = _fold_moments(labelled)
    return fit_moments(_parted(moments.sum(axis=0)), *choose(labelled, moments))


def score(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    featured = written(_featured(documents, id_column, text_column), "features")
    model = fit_features(featured, labels)
    d = len(FEATURES)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], ["doc_id", "score"])

    return featured.mapInArrow(each, "doc_id long, score double").select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all their columns, that the classifier doesn't reject; no shuffle of texts."""
    featured = written(_featured(documents, id_column, text_column), "features")
    model = fit_features(featured, labels)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in words.chunks(batch, text_column):
                good = model.scores(features(data, offsets)) >= threshold
                yield piece.filter(pa.array(good))

    return documents.mapInArrow(each, documents.schema)
