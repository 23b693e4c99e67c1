"""Quality classifier: naive Bayes support vectors.

A text is the set of its n-grams: runs of 2 to 4 characters and of 1 or 2
words, hashed to a table. Each indicator is scaled by the log ratio of its
smoothed shares in the two classes, the row is brought to unit length, and a
linear hinge-loss model is fitted on the scaled rows by dual coordinate
descent. The margin becomes a probability by a logistic curve fitted on
training rows that the model has not seen.

The model is fitted on a bounded sample of labelled rows (``per_class`` rows
of each class, texts of at most ``max_chars`` characters) on the driver and
sent to the tasks (two tables of ``FEATURES`` floats); every whole text is
then scored in one map pass without a shuffle.

Defined cases: null and empty texts have no n-grams and get the score of the
offset alone; without labels of both classes the score is the share of label
1 among the labels (0.5 without any); repeated rows score alike; columns of
the input named like results are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import (MIX_A, MIX_B, MIX_C, hinge_dual, labelled_sample, logistic_fit, mix, small_batches,
                                   span_hashes, split_words, text_slices, word_hashes)

CHAR_BITS, WORD_BITS = 17, 19
FEATURES = (1 << CHAR_BITS) + (1 << WORD_BITS)
CHAR_LENGTHS = (2, 3, 4)


@dataclass(frozen=True)
class Model:
    """Margin of a text: sum of ``weight`` over its features divided by the
    root of the sum of ``square``, plus ``bias``; then the logistic curve."""
    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, features: np.ndarray) -> float:
        norm = float(self.square[features].sum())
        margin = float(self.weight[features].sum()) / norm ** 0.5 if norm > 0 else 0.0
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slope * (margin + self.bias) + self.offset, -35, 35))))


def char_codes(points: np.ndarray) -> np.ndarray:
    """Feature numbers of all character n-grams of a text's code points."""
    out = []
    c = points.astype(np.uint64) + np.uint64(1)
    h, factors = c * MIX_A, (MIX_B, MIX_C, MIX_A)
    for n in CHAR_LENGTHS:
        if len(c) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * factors[n - 2] + c[n - 1:] * MIX_A
        out.append((h * MIX_B) >> np.uint64(64 - CHAR_BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def word_codes(words: np.ndarray) -> np.ndarray:
    """Feature numbers of single words and pairs of neighbours."""
    at = np.arange(max(0, len(words) - 1))
    pairs = span_hashes(words, at, at + 2) if len(at) else np.zeros(0, np.uint64)
    h = np.concatenate((mix(words), pairs))
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64) + (1 << CHAR_BITS)


class Indicator:
    """Distinct values of an array of feature numbers, without sorting."""

    def __init__(self) -> None:
        self.place = np.zeros(FEATURES, np.int64)

    def distinct(self, codes: np.ndarray) -> np.ndarray:
        at = np.arange(len(codes))
        self.place[codes] = at
        return codes[self.place[codes] == at]


def text_features(text: pa.Array, indicator: Indicator) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text."""
    offsets, words = split_words(text)
    hashes = word_hashes(words)
    for r, value in enumerate(text.to_numpy(zero_copy_only=False)):
        points = np.frombuffer((value or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        yield indicator.distinct(np.concatenate((char_codes(points), word_codes(hashes[offsets[r]:offsets[r + 1]]))))


def fit(texts: list[str], y: np.ndarray, counts: np.ndarray, smoothing: float = 1.0, cost: float = 1.0,
        held: float = 0.25, seed: int = 3) -> Model:
    """Fit on labelled texts; ``counts`` are the class sizes among all labels."""
    zero = np.zeros(FEATURES, np.float32)
    if counts.min() == 0 or len(np.unique(y)) < 2:
        share = counts[1] / counts.sum() if counts.sum() else 0.5
        return Model(zero, zero, 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    rows = list(text_features(pa.array(texts, pa.large_string()), Indicator()))
    keep = np.random.default_rng(seed).random(len(y)) >= held
    for c in (0, 1):                       # each class has a row on both sides where it can
        own = np.flatnonzero(y == c)
        keep[own[0]] = True
        if len(own) > 1:
            keep[own[-1]] = False
    seen = [np.full(FEATURES, smoothing) for _ in range(2)]
    for r, k, c in zip(rows, keep, y):
        if k:
            seen[c][r] += 1
    ratio = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
    square = (ratio * ratio).astype(np.float32)

    def scaled(r: np.ndarray) -> np.ndarray:
        v = ratio[r]
        n = np.sqrt((v * v).sum())
        return v / n if n > 0 else v

    train = [i for i in range(len(y)) if keep[i]]
    balance = np.array([len(train) / (2 * max(1, (y[train] == c).sum())) for c in (0, 1)])
    w, bias = hinge_dual([rows[i] for i in train], [scaled(rows[i]) for i in train], y[train], FEATURES,
                         cost * balance[y[train]])
    model = Model((w * ratio).astype(np.float32), square, bias, 1.0, 0.0)
    rest = [i for i in range(len(y)) if not keep[i]] or train
    margin = np.array([float(w[rows[i]] @ scaled(rows[i])) + bias for i in rest])
    weight = (counts / np.maximum(1, np.bincount(y, minlength=2)))[y[rest]]
    slope, offset = logistic_fit(margin, y[rest], weight * len(rest) / weight.sum())
    return Model(model.weight, model.square, bias, slope, offset)


def fit_quality(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = 2500,
                max_chars: int = 20_000) -> Model:
    """Model from the labelled rows that are not held out (bounded sample)."""
    return fit(*labelled_sample(docs, labels, target, per_class, max_chars))


def score_texts(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` for every whole text."""
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, indicator = sent.value, Indicator()
        for batch in batches:
            for part in text_slices(batch, "text"):
                score = np.array([own.score(f) for f in text_features(part.column("text"), indicator)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(score, pa.float64()), pa.array(score >= threshold).cast(pa.int32())],
                    names=names + ["score", "predicted"])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(work, schema)
