"""Quality classifier: regularised quadratic discriminant.

Each text becomes a vector of transformed statistics (logs of lengths, variance
stabilised shares). Per class, the mean and the covariance follow from sums and
sums of products that Spark adds up over the labelled training rows; the class
covariances are shrunk towards the pooled one and its mean variance. A score is
the logistic of the log-density difference of the two Gaussians plus the log
prior odds; the Mahalanobis terms use Cholesky factors computed once per model.

Defined cases: null and empty texts have the statistics of an empty text and
get a score like any other; several labels for one id count by their mean
(0.5 and over: 1), null labels are left out; repeated rows count and are scored
each; with labels of one class only the score is that class's share smoothed by
one row of each class, with none it is 0.5; scores may tie and are not ranked;
very long texts are measured whole; columns other than id, text and label are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidspark.llm.common import WordHash, documents, materialize
from aidspark.llm.divergence import _class_table, class_counts, duplicate_lines, repeated_words

FEATURES = ("log_words", "word_length", "word_length_spread", "distinct_words", "top_word",
            "repeated_words", "duplicate_lines", "upper", "digits", "punctuation", "symbols",
            "accented", "newlines", "words_with_letters", "shouted_words", "ended_words",
            "line_words", "class_entropy")


def _share(x: float) -> float:
    return float(np.arcsin(np.sqrt(min(1.0, max(0.0, x)))))


def statistics(text: str, table: np.ndarray, hashes: WordHash) -> list[float]:
    """The transformed statistics of a text, in the order of ``FEATURES``."""
    words = text.encode().split()
    n, chars = len(words), max(1, len(text))
    c = class_counts(text, table) / chars
    lengths = np.fromiter(map(len, words), dtype=float, count=n) if n else np.zeros(1)
    h = hashes.of(words)
    counts = np.unique(h, return_counts=True)[1] if n else np.zeros(1)
    lines = text.count("\n") + 1
    m = max(1, n)
    positive = c[c > 0]
    return [np.log1p(n), np.log1p(lengths.mean()), np.log1p(lengths.std()),
            np.log1p(len(counts)) / np.log1p(m), _share(counts.max() / m),
            _share(repeated_words(h) / m), _share(duplicate_lines(text) / lines),
            _share(c[1]), _share(c[2]), _share(c[5]), _share(c[6]), _share(c[7]), _share(c[4]),
            _share(sum(map(bytes.isalpha, words)) / m), _share(sum(map(bytes.isupper, words)) / m),
            _share(sum(w[-1] in b".,;:!?" for w in words) / m), np.log1p(n / lines),
            float(-(positive * np.log2(positive)).sum())]


def _features(batches):
    table, hashes = _class_table(), WordHash()
    for batch in batches:
        x = [statistics(t, table, hashes) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))],
                                         names=["doc_id", "x"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x``, the transformed statistics, of every row."""
    return documents(docs, id_col, text_col).mapInArrow(_features, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Model:
    log_prior_odds: float
    means: np.ndarray | None = None     # 2 x d, of standardised statistics
    factors: np.ndarray | None = None   # 2 x d x d, inverted Cholesky factors
    log_dets: np.ndarray | None = None
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.log_prior_odds)
        if self.means is not None:
            s = (x - self.centre) / self.scale
            d = [np.square((s - m) @ f.T).sum(1) for m, f in zip(self.means, self.factors)]
            z = z + (d[0] - d[1] + self.log_dets[0] - self.log_dets[1]) / 2
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def labels_by_id(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """One label (0 or 1) per id."""
    return (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("y"))
            .dropna().groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))


def fit(rows: DataFrame, pooling: float = 0.3, ridge: float = 0.02) -> Model:
    """``rows``: ``x`` and ``y``. Covariances are
    ``(1-ridge) * ((1-pooling) * own + pooling * pooled) + ridge * mean variance * I``."""
    d = len(FEATURES)
    at = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("y").agg(
        F.count("*").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(d)]).alias("s"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in at]).alias("q")).collect()
    sums = {r["y"]: r for r in sums}
    n = [sums[k]["n"] if k in sums else 0 for k in (0, 1)]
    odds = float(np.log((n[1] + 1) / (n[0] + 1)))
    if min(n) < 2:
        return Model(odds)
    s, q = np.zeros((2, d)), np.zeros((2, d, d))
    for k in (0, 1):
        s[k] = sums[k]["s"]
        for (i, j), v in zip(at, sums[k]["q"]):
            q[k, i, j] = q[k, j, i] = v
    total = sum(n)
    centre = s.sum(0) / total
    scale = np.sqrt(np.maximum(np.diagonal(q.sum(0)) / total - centre ** 2, 1e-8))
    means = (s / np.array(n)[:, None] - centre) / scale
    cov = np.array([(q[k] - np.outer(s[k], s[k]) / n[k]) / n[k] for k in (0, 1)]) / np.outer(scale, scale)
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / total
    factors, dets = [], []
    for k in (0, 1):
        own = (1 - pooling) * cov[k] + pooling * pooled
        own = (1 - ridge) * own + ridge * max(np.trace(own) / d, 1e-3) * np.eye(d)
        low = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(low))
        dets.append(2 * np.log(np.diagonal(low)).sum())
    return Model(odds, means, np.array(factors), np.array(dets), centre, scale)


def classify(docs: DataFrame, labels: DataFrame, label_col: str, train: Column | None = None,
             threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row; ``train`` (a condition on
    ``doc_id``) tells which rows' labels may be learned from."""
    found = materialize(features(docs, id_col, text_col), "statistics")
    rows = found if train is None else found.filter(train)
    model = fit(rows.join(labels_by_id(labels, label_col), "doc_id").select("x", "y"))

    def run(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))],
                                             names=["doc_id", "score"])

    return (found.mapInArrow(run, "doc_id long, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
