"""Quality classifier by positive-unlabelled learning.

Trusted positives (a bounded sample of rows labelled good) and the unlabelled corpus are told apart by a linear model on
hashed n-grams.  The class prior is the least ratio, over score thresholds, of the unlabelled to the positive share
above the threshold, on rows the first model has not seen (the best-bin estimate with its confidence terms); Spark counts
the unlabelled share over all documents.  The final model minimises the non-negative unbiased risk

    prior * risk(positives as +) + max(0, risk(unlabelled as -) - prior * risk(positives as -))

with the logistic loss; while the second part is negative its slope is reversed, as published.  The descent
runs on the positives and an unlabelled sample; in ``ROUNDS`` rounds Spark sums loss and gradient over all unlabelled
rows, and the descent goes on with what the sample misses of them.  Labels of bad rows are not used.  Both samples are
bounded by a parameter; every row is scored.

Null and empty texts have no n-grams and get the score of the bias alone.  Without positives all scores are 0.5; with
nothing unlabelled beside them, 1.0.  Equal texts get equal scores.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmonth.llm.arrays import slices, text_bytes
from pressmonth.llm.features import LinearModel, collected, descend, ngrams, one_label, sample_features, sample_of, sigmoid
from pressmonth.llm.staging import widened

SAMPLE_ROWS = 2000  # rows of each of the two samples
ROUNDS = 2  # gradients over all unlabelled rows
KEEP = 0.3
POINT = float(1 << 24)  # unit of the sums over all rows


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of rows that the scoring model has not seen."""
    places = np.unique(positive)
    return prior_of_counts(positive, np.bincount(np.searchsorted(places, unlabelled, side="right"), minlength=len(places) + 1), doubt)


def prior_of_counts(positive: np.ndarray, counts: np.ndarray, doubt: float = 0.1) -> float:
    """The same from the number of unlabelled rows below the first distinct positive score, the second, ..., and beyond."""
    places = np.unique(positive)
    total = counts.sum()
    above_p = 1 - np.searchsorted(np.sort(positive), places, side="left") / len(positive)
    above_u = 1 - np.cumsum(counts)[:-1] / total
    slack = np.sqrt(np.log(4 / doubt) / (2 * total)) + np.sqrt(np.log(4 / doubt) / (2 * len(positive)))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.99))


class NonNegativeRisk:
    """Derivative of the non-negative risk of a run of rows by each row's score.

    ``loss`` and ``gradient``: by how much those of all unlabelled rows exceed those of the sampled ones.
    """

    def __init__(self, is_positive: np.ndarray, prior: float, loss: float = 0.0, gradient: np.ndarray | None = None) -> None:
        self.is_positive, self.prior, self.loss, self.gradient = is_positive, prior, loss, gradient
        self.sign = 1.0

    def slope(self, z: np.ndarray, own: slice) -> np.ndarray:
        p = self.is_positive[own]
        n_p, n_u = max(p.sum(), 1), max((~p).sum(), 1)
        q = sigmoid(z)
        as_negative = np.logaddexp(0, z)
        rest = as_negative[~p].sum() / n_u + self.loss - self.prior * as_negative[p].sum() / n_p
        part = np.where(p, -self.prior * q / n_p, q / n_u)
        self.sign = 1.0 if rest >= 0 else -1.0
        return np.where(p, self.prior * (q - 1) / n_p, 0.0) + part if rest >= 0 else -part

    def extra(self) -> np.ndarray | float:
        return 0.0 if self.gradient is None else self.sign * self.gradient


def _others(docs: DataFrame, key: str, text: str, known: list, measure: Callable) -> np.ndarray:
    """Sums over all rows whose id is not ``known`` of what ``measure`` gives by place for a slice of their texts.

    Sums are of fixed point, so their order does not matter.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            own = batch.filter(pc.invert(pc.is_in(batch.column(key), pa.array(known, batch.schema.field(key).type))))
            for piece in slices(own, text):
                found = measure(*text_bytes(piece.column(text)))
                total = found if total is None else total + found
        if total is not None:
            fixed = np.round(total * POINT).astype(np.int64)
            at = np.flatnonzero(fixed)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(fixed[at])], ["place", "amount"])

    rows = docs.select(key, text).mapInArrow(run, "place int, amount bigint").groupBy("place").agg(F.sum("amount").alias("amount")).toArrow()
    sums = np.zeros(rows.column("place").to_numpy().max(initial=-1) + 1)
    sums[rows.column("place").to_numpy()] = rows.column("amount").to_numpy() / POINT
    return sums


def unlabelled_counts(docs: DataFrame, key: str, text: str, known: list, weights: np.ndarray, bias: float, places: np.ndarray) -> np.ndarray:
    """Numbers of rows whose score lies before the first place, the second, ..., and beyond the last."""
    model = LinearModel(weights, bias)

    def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(places, model.raw(data, offsets), side="right"), minlength=len(places) + 1).astype(np.float64)

    found = _others(docs, key, text, known, measure)
    return np.append(found, np.zeros(len(places) + 1 - len(found)))


def unlabelled_risk(docs: DataFrame, key: str, text: str, known: list, weights: np.ndarray, bias: float) -> tuple[float, float, np.ndarray]:
    """(rows, mean loss as negatives, its gradient by unscaled weights and bias) over all rows that are not ``known``."""
    size = len(weights)

    def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        z = np.full(rows, bias)
        held = []
        for row, bucket in ngrams(data, offsets):
            share = 1 / np.maximum(np.bincount(row, minlength=rows), 1)
            z += np.bincount(row, weights[bucket], rows) * share
            held.append((row.astype(np.int32), bucket.astype(np.uint16), share))
        q = sigmoid(z)
        gradient = np.zeros(size)
        for row, bucket, share in held:
            gradient += np.bincount(bucket, (q * share)[row], size)
        return np.concatenate([gradient, [q.sum(), np.logaddexp(0, z).sum(), rows]])

    found = _others(docs, key, text, known, measure)
    if len(found) < size + 3:  # nothing unlabelled
        return 0.0, 0.0, np.zeros(size + 1)
    return found[-1], found[-2] / found[-1], found[:-2] / found[-1]


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, sample_rows: int = SAMPLE_ROWS) -> tuple[LinearModel | float, float]:
    """(model, class prior); a constant score stands for the model where one sample is empty."""
    trusted = sample_of(one_label(labels, key, label).where("y = 1"), sample_rows, key, 1).select(key, F.lit(True).alias("positive"))
    # rows of the trusted sample stay out of the unlabelled one; equal ids of several rows count once
    others = docs.select(key).join(F.broadcast(trusted), key, "left_anti").distinct()
    web = sample_of(others, sample_rows, key, 2).select(key, F.lit(False).alias("positive"))
    chosen = trusted.unionByName(web)
    features = sample_features(docs.select(key, text).join(F.broadcast(chosen), key), text, [key, "positive"])
    ids, positive, sample = collected(features, key, "positive")
    positive = positive.astype(bool)
    if not positive.any():
        return 0.5, 0.5
    if positive.all():
        return 1.0, 1.0
    middle, prior = len(positive) // 2, 0.5
    known = [i for i, p in zip(ids, positive) if p]
    seen, unseen = positive[:middle], positive[middle:]
    if 0 < seen.sum() < len(seen) and 0 < unseen.sum() < len(unseen):
        weights, bias = descend(sample.rows(0, middle), lambda z, own: (sigmoid(z) - positive[own]) / len(z))
        judged = sample.rows(middle, len(positive)).scores(weights, bias)[unseen]
        counts = unlabelled_counts(docs, key, text, list({*known, *ids[:middle]}), weights * sample.scale, bias, np.unique(judged))
        prior = prior_of_counts(judged, counts)
    risk = NonNegativeRisk(positive, prior)
    weights, bias = descend(sample, risk.slope)
    for _ in range(ROUNDS):
        rows, loss, gradient = unlabelled_risk(docs, key, text, known, weights * sample.scale, bias)
        if not rows:
            break
        # the sample's curvature with the corpus's slope: the descent's goal is the risk over all unlabelled rows
        z = sample.scores(weights, bias)
        q = np.where(positive, 0.0, sigmoid(z)) / (~positive).sum()
        own = np.append(sample.gradient(q), q.sum())
        own_loss = float(np.logaddexp(0, z)[~positive].mean())
        risk = NonNegativeRisk(positive, prior, loss - own_loss, gradient * np.append(sample.scale, 1.0) - own)
        weights, bias = descend(sample, risk.slope, start=(weights, bias), extra=risk.extra)
    return LinearModel(weights * sample.scale, bias), prior


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """All columns of ``docs`` with ``quality_score`` (an own column of that name is replaced)."""
    model, _ = fit(docs, labels, label, key, text, sample_rows)
    docs = docs.drop("quality_score")
    schema = widened(docs.schema, quality_score="double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                if isinstance(model, float):
                    scores = np.full(piece.num_rows, model)
                else:
                    scores = model.score(*text_bytes(piece.column(text)))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(scores)], schema.names)

    return docs.mapInArrow(run, schema)
