"""Quality classifier learned from preference pairs (Bradley-Terry).

A labelled good document is preferred to a labelled bad one. The score is linear in the
document's features, and its weights minimize the logistic loss of the features'
differences over sampled pairs. The threshold is the exact quantile, over the scores of all
labelled documents of the input, that the share of bad labels among them names; scores map
to 0..1 so that the threshold is ``THRESHOLD``.

Labels are sampled for the weights alone: ``CLASS_ROWS`` documents of each class at most, in
hash order, so that the fit's cost does not depend on the input. Everything else covers all
rows: share and quantile take every label whose document the input has, and every text is
scored whole.

Cases: a NULL text is an empty one and has a score; a NULL doc_id is scored and never
trains; labels that are NULL, that contradict each other for a doc_id, or whose document is
missing, are not used; repeated rows are scored each and train as one document, with their
lowest score; without labels of both classes nothing can be learned and every score is
``THRESHOLD``; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.tables import python_tasks
from lanewise.session import materialize

CLASS_ROWS = 4_000  # documented bound of the training sample, for each class
PAIRS_EACH = 4
THRESHOLD = 0.7
BINS = 8
BUCKETS = 1000  # of a range of scores, counted at once
PENALTY, STEPS = 1e-2, 25

# Places of byte values in the counts of a text.
_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGITS = np.arange(48, 58)
_SPACES = np.array([32, 9, 11, 12, 13])
_MARKS = [ord(c) for c in ".,!?#*$%&|<>@:/-_(){}[]\"'=+\\~^;"]


def text_features(text: str) -> list[float]:
    """Shares and sizes of a whole text; all zero for an empty one."""
    data = text.encode()
    words = data.split()
    n, n_words = max(1, len(data)), max(1, len(words))
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    lines = [line for line in data.split(b"\n") if line.strip()]
    frequency = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    line_sizes = [len(line) for line in lines] or [0]
    repeats = sum([a == b for a, b in zip(words, words[1:], strict=False)])
    marks = counts[_MARKS]
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        float(sizes.mean()),
        math.log1p(float(sizes.std())),
        math.log1p(float(sizes.max())),
        len(frequency) / n_words,
        max(frequency.values(), default=0) / n_words,
        sum([v for v in frequency.values() if v > 2]) / n_words,
        repeats / n_words,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        math.log1p(sum(line_sizes) / len(line_sizes)),
        float(counts[_UPPER].sum()) / n,
        float(counts[_LOWER].sum()) / n,
        float(counts[_DIGITS].sum()) / n,
        float(counts[_SPACES].sum()) / n,
        float(counts[10]) / n,
        float(counts[128:].sum()) / n,
        float(counts[:32].sum() - counts[[9, 10, 11, 12, 13]].sum()) / n,
        float(marks.sum()) / n,
        *(marks / n_words).tolist(),
    ]


@dataclass(frozen=True)
class Model:
    """Feature scaling, bin edges, weights and the raw score at the threshold."""

    mean: np.ndarray
    scale: np.ndarray
    edges: np.ndarray  # (features, BINS - 1)
    weights: np.ndarray
    cut: float

    def expand(self, features: np.ndarray) -> np.ndarray:
        """Scaled features and the bins they fall into, so scores need not be straight."""
        scaled = np.clip((features - self.mean) / self.scale, -5, 5)
        above = features[:, :, None] > self.edges[None, :, :]
        return np.concatenate([scaled, above.reshape(len(features), -1)], axis=1)

    def raw(self, features: np.ndarray) -> np.ndarray:
        return self.expand(features) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        shifted = self.raw(features) - self.cut + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(shifted, -30, 30)))


def _fit_weights(differences: np.ndarray) -> np.ndarray:
    """Newton steps on the penalized logistic loss of preferred minus other."""
    weights = np.zeros(differences.shape[1])
    n = len(differences)
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(np.clip(differences @ weights, -30, 30)))
        gradient = PENALTY * weights - differences.T @ chance / n
        curve = (differences * (chance * (1 - chance))[:, None]).T @ differences / n
        step = np.linalg.solve(curve + PENALTY * np.eye(len(weights)), gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit(good: np.ndarray, bad: np.ndarray, seed: int = 0) -> Model:
    """Weights of the samples; the model's cut is still zero."""
    both = np.concatenate([good, bad])
    scale = both.std(axis=0)
    steps = np.arange(1, BINS) / BINS
    edges = np.concatenate([np.quantile(part, steps, axis=0) for part in (good, bad)]).T
    blank = Model(both.mean(axis=0), np.where(scale > 0, scale, 1.0), edges, np.zeros(0), 0.0)
    rng = np.random.default_rng(seed)
    n = PAIRS_EACH * max(len(good), len(bad))
    preferred = np.resize(rng.permutation(len(good)), n)
    other = rng.integers(0, len(bad), n)
    weights = _fit_weights(blank.expand(good)[preferred] - blank.expand(bad)[other])
    return replace(blank, weights=weights)


def _sample_features(rows: DataFrame) -> DataFrame:
    """(labelled, label, features), one row for each document of the sample.

    ``rows`` are (labelled, label, text). Of the texts of a document the one with the
    smallest hash counts; tasks keep one for each document, however often it is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict = {}
        for batch in batches:
            names, labels = batch[0].to_pylist(), batch[1].to_pylist()
            for name, label, text in zip(names, labels, batch[2], strict=True):
                text = text.as_py() or ""
                key = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=7).digest())
                if name not in least or key < least[name][1]:
                    least[name] = (label, key, text_features(text))
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64())]
        columns = list(zip(*least.values(), strict=True)) or [[]] * 3
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(least, pa.int64()), *arrays], names=["labelled", "label", "key", "features"]
        )

    python_tasks(rows.sparkSession)
    found = rows.select(F.col("labelled").cast("bigint"), "label", "text").mapInArrow(
        run, "labelled bigint, label int, key bigint, features array<double>"
    )
    return (
        found.groupBy("labelled", "label")
        .agg(F.min(F.struct("key", "features")).alias("least"))
        .select("labelled", "label", "least.features")
    )


def _ranked(values: DataFrame, rank: int) -> float:
    """The value of column ``raw`` with ``rank`` values before it, by counting ever
    narrower ranges."""
    low, high = values.agg(F.min("raw"), F.max("raw")).first()
    while low < high:
        place = F.floor((F.col("raw") - low) / (high - low) * BUCKETS)
        found = (
            values.filter(F.col("raw").between(low, high))
            .groupBy(place.alias("place"))
            .agg(F.count("raw").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
            .orderBy("place")
            .collect()
        )
        for bucket in found:
            if rank < bucket.n:
                break
            rank -= bucket.n
        low, high = bucket.low, bucket.high
    return low


def _cut(documents: DataFrame, clear: DataFrame, model: Model) -> float:
    """Between the scores that have as many labelled documents below as labels are bad."""

    @F.pandas_udf("double")
    def raw(texts: pd.Series) -> pd.Series:
        if texts.empty:
            return pd.Series([], dtype="float64")
        return pd.Series(model.raw(np.array([text_features(t) for t in texts])))

    scores = (
        documents.filter(F.col("doc_id").isNotNull())
        .select("doc_id", raw(F.coalesce("text", F.lit(""))).alias("raw"))
        .groupBy("doc_id")
        .agg(F.min("raw").alias("raw"))
    )
    values = materialize(
        scores.join(clear, F.col("doc_id") == F.col("labelled")).select("label", "raw"),
        "label-scores",
    )
    n_bad = values.filter(F.col("label") == 0).count()
    return (_ranked(values, n_bad - 1) + _ranked(values, n_bad)) / 2


def train(documents: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS) -> Model | None:
    """A model from ``labels`` (doc_id, quality), all of which may be used; None if those
    of ``documents`` do not hold both classes."""
    present = documents.select(F.col("doc_id").alias("labelled")).distinct()
    clear = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .filter(F.col("label") == F.col("most"))
        .select(F.col("doc_id").alias("labelled"), F.col("label").cast("int"))
        .join(present, "labelled", "left_semi")
    )
    clear = materialize(clear, "clear-labels")
    order = [F.xxhash64("labelled"), F.col("labelled")]
    chosen = None
    for label in (0, 1):
        part = clear.filter(F.col("label") == label).orderBy(*order).limit(class_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most two times class_rows pairs of numbers.
    texts = documents.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("labelled")
    )
    rows = _sample_features(texts).orderBy(F.xxhash64("labelled"), "labelled").collect()
    parts = [np.array([r.features for r in rows if r.label == label]) for label in (1, 0)]
    if not all(len(p) for p in parts):
        return None
    model = fit(*parts)
    return replace(model, cut=_cut(documents, clear, model))


def score_documents(documents: DataFrame, model: Model | None) -> DataFrame:
    """(row, score) with the document in the struct ``row``."""
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    if model is None:
        return rows.withColumn("score", F.lit(THRESHOLD))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if texts.empty:
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([text_features(t) for t in texts])))

    python_tasks(documents.sparkSession)
    return rows.withColumn("score", score(F.coalesce("row.text", F.lit(""))))


def keep_preferred(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold."""
    scored = score_documents(documents, train(documents, labels))
    return scored.filter(F.col("score") >= THRESHOLD).select("row.*")
