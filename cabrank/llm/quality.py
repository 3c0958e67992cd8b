"""Quality scores by regularised quadratic discriminant analysis over statistics of the text.

Every text is described by statistics that are transformed towards normal
distributions. Both classes get a mean and a covariance, which is drawn towards the
covariance of all labelled rows and towards a multiple of the identity; the score is the
logistic function of the difference of the log densities and the log ratio of the
class sizes. Mahalanobis distances use Cholesky factors that are computed once.
Means and covariances are sums over all labelled rows, so no row is collected and
no sample is drawn; only the sums reach the driver, and their number depends on the
number of statistics alone.

Null texts count as empty; an empty text has a score like any other. Labels other
than 0 and 1, and labels of unknown documents, are not used; repeated rows count as
often as they occur. If one of the classes has no labelled row, every score is the
share of label 1, or 0.5 without any labelled row. A null doc_id is scored and never
learned from. An empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cabrank.llm.common import saved, spare, text_of

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
#: Weight of the common covariance in that of a class, and of the identity in both.
SHRINKAGE, RIDGE = 0.1, 0.02
#: Standard deviations beyond which a statistic counts as at this distance.
FAR = 8.0
#: Words of no particular kind that every text is taken to have besides its own.
FEW = 10

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LOWER = (_CODES >= 97) & (_CODES <= 122)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_BLANK = (_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13))
_HIGH = _CODES >= 128
_PLAIN = np.isin(_CODES, [ord(c) for c in ".,;:'\"()-?"])
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _BLANK | _HIGH | _PLAIN)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text: lengths as logarithms, shares as arcs."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    n, ink = len(words), int(counts[~_BLANK].sum())
    letters = int(counts[_UPPER | _LOWER | _HIGH].sum())
    used = Counter(words)
    common = sum(k for _, k in used.most_common(3))
    shares = counts / max(1, len(data))
    again = (shares**2).sum()

    def arc(part: float, whole: float, few: float) -> float:
        """A share as an arc; short texts are drawn towards none, as ``few`` more of the whole would."""
        return float(np.arcsin(np.sqrt(min(1.0, part / (whole + few)))))

    return [
        float(np.log((ink + 5 * FEW) / (n + FEW))),
        arc(counts[_SYMBOL].sum(), ink, 5 * FEW),
        arc(counts[_PLAIN].sum(), ink, 5 * FEW),
        arc(counts[_DIGIT].sum(), ink, 5 * FEW),
        arc(counts[_UPPER].sum(), letters, 5 * FEW),
        arc(counts[_HIGH].sum(), ink, 5 * FEW),
        arc(n - len(used), n, FEW),
        arc(common, n, FEW),
        arc(sum(a == b for a, b in zip(words, words[1:])), n, FEW),
        arc(len(lines) - len(set(lines)), len(lines), 4),
        float(np.log((n + 10) / (len(lines) + 1))),
        float(again),
    ]


SIZE = len(statistics(""))
ARRAY = T.ArrayType(T.DoubleType())


@F.pandas_udf(ARRAY)
def described(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts], dtype=object)


def held_out(folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether a row is kept away from learning: by the CRC-32 of its doc_id as text; a null doc_id is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(True))


@dataclass
class Model:
    """Prior of label 1 and, unless a class is missing, place, scale, means and inverse Cholesky factors."""

    prior: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: list[np.ndarray] | None = None
    factors: list[np.ndarray] | None = None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.factors is None:
            return np.full(len(rows), self.prior)
        z = np.clip((rows - self.center) / self.scale, -FAR, FAR)
        density = [
            np.log(np.diag(factor)).sum() - 0.5 * (((z - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor in zip(self.means, self.factors)
        ]
        odds = density[1] - density[0] + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per partition and class: counts (i = j = 0), sums (j = 0) and sums of products, with 1 put in front of a row."""
    total = np.zeros((2, SIZE + 1, SIZE + 1))
    for batch in batches:
        for label in (0, 1):
            chosen = batch.loc[batch["label"] == label, "x"]
            if len(chosen):
                rows = np.column_stack([np.ones(len(chosen)), np.vstack(chosen)])
                total[label] += rows.T @ rows
    label, i, j = np.indices(total.shape)
    yield pd.DataFrame({"label": label.ravel(), "i": i.ravel(), "j": j.ravel(), "value": total.ravel()})


def fit(features: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Model:
    """The model of all labelled rows; ``features`` has doc_id and x, ``labels`` doc_id and quality."""
    known = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    rows = features.join(known, "doc_id").select("label", "x")
    sums = rows.mapInPandas(moments, "label int, i int, j int, value double").groupBy("label", "i", "j").agg(F.sum("value").alias("value"))
    total = np.zeros((2, SIZE + 1, SIZE + 1))
    for label, i, j, value in sums.collect():  # 2 * (SIZE + 1) ** 2 rows
        total[label, i, j] = value
    n = total[:, 0, 0]
    if not n.all():
        return Model(float(n[1] / n.sum()) if n.any() else 0.5)
    both = total.sum(axis=0)
    center = both[0, 1:] / n.sum()
    common = both[1:, 1:] / n.sum() - np.outer(center, center)
    scale = np.sqrt(np.maximum(np.diag(common), 1e-6))
    common = common / np.outer(scale, scale)
    means, factors = [], []
    for k in (0, 1):
        mean = total[k, 0, 1:] / n[k]
        own = (total[k, 1:, 1:] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        # A class with few rows leans more on the common covariance.
        weight = max(shrinkage, SIZE / (SIZE + n[k]))
        mixed = (1 - weight) * own + weight * common + ridge * np.eye(SIZE)
        means.append((mean - center) / scale)
        factors.append(np.linalg.inv(np.linalg.cholesky((mixed + mixed.T) / 2)))
    return Model(float(n[1] / n.sum()), center, scale, means, factors)


def learned(features: DataFrame, labels: DataFrame) -> Model:
    return fit(features.where(~held_out()), labels)


def scored(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted (1 from the threshold on)."""
    features = saved(documents.select("doc_id", described(text_of()).alias("x")))
    model = learned(features, labels)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.vstack(x)) if len(x) else [], dtype=float)

    return features.select("doc_id", held_out().alias("held_out"), score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns; scored where they are read."""
    # Kept, so that no task runs two Python workers, one for the statistics and one for their sums.
    model = learned(saved(documents.select("doc_id", described(text_of()).alias("x"))), labels)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in texts]).reshape(-1, SIZE)
        return pd.Series(model.score(rows))

    (name,) = spare(documents, "score")
    return documents.withColumn(name, score(text_of())).where(F.col(name) >= threshold).select(documents.columns)
