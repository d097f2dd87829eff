"""Quality classifier learnt from trusted positives and unlabelled text (non-negative PU learning).

Texts known to be good are the positives; any text at all is unlabelled. With class prior p, the risk of a scorer g is
``p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)])`` for the logistic loss l: the second term estimates the
risk on negatives without having seen one, and is kept from going below zero, where it would only reward overfitting.
The prior is estimated as the share of good texts among the judged training rows.

Every text is measured once, whole, in tasks (shares of bytes, words, repeats, lines). The model is a small network on
these measures, fitted on the driver on a bounded sample: at most ``POSITIVES`` + ``UNLABELLED`` rows of measures.
"""

from __future__ import annotations

from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map, utf8
from postloom.session import materialize

POSITIVES = 8_000
UNLABELLED = 12_000
HIDDEN = 24
STEPS = 500
THRESHOLD = 0.3
SEED = 11

#: Words among which distinct ones are counted, so that a long text is not taken for a repetitive one.
SPAN = 256

_PUNCTUATION = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)


def measures(text: bytes | None) -> np.ndarray:
    """Measures of a text that do not depend on its length beyond a few words; all zero where it has no word."""
    text = text or b""
    words = text.split()
    if not words:
        return np.zeros(len(_PUNCTUATION) + 17)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, size = len(words), len(text)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    lines = [x for x in text.split(b"\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, n)
    stats = [
        1.0,
        np.minimum(n, 8) / 8,
        upper / size,
        lower / size,
        upper / max(1, upper + lower),
        counts[48:58].sum() / size,
        counts[128:].sum() / size,
        (counts[9:14].sum() + counts[32]) / size,
        counts[:9].sum() / size + counts[14:32].sum() / size + counts[127] / size,
        counts[_PUNCTUATION].sum() / size,
        sum(len(set(words[i : i + SPAN])) for i in range(0, n, SPAN)) / n,
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(100 * len(lines) / n),
        np.log1p(100 * (counts[46] + counts[33] + counts[63]) / n),
        np.log(lengths.mean()),
        (lengths > 20).mean(),
    ]
    return np.concatenate((stats, np.log1p(counts[_PUNCTUATION] * (100.0 / n))))


def _measured(batches):
    for batch in batches:
        rows = [measures(t).astype(np.float32) for t in batch.column("text").to_pylist()]
        lengths = np.cumsum([0, *map(len, rows)], dtype=np.int32)
        flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.float32))
        yield {"doc_id": batch.column("doc_id"), "features": pa.ListArray.from_arrays(pa.array(lengths), flat)}


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, features)`` of ``docs(doc_id, text)``: one pass over the texts, no shuffle."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    return arrow_map(source, _measured, "doc_id long, features array<float>")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's digits leaves no remainder by 5; a missing id counts as the empty string, so it does."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Model:
    """One hidden layer over standardised measures."""

    def __init__(self, center, scale, weights):
        self.center, self.scale, self.weights = center, scale, weights

    def inputs(self, x):
        return np.clip((x - self.center) / self.scale, -8, 8)

    def raw(self, x):
        w1, b1, w2, b2 = self.weights
        return np.tanh(self.inputs(x) @ w1 + b1) @ w2 + b2

    def score(self, x):
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = SEED) -> Model:
    """Minimise the non-negative risk by Adam over the whole sample; the same arrays give the same model."""
    rng = np.random.default_rng(seed)
    x = unlabelled if len(unlabelled) else positive
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, None)
    p, u = model.inputs(positive), model.inputs(unlabelled)
    wide = p.shape[1]
    model.weights = [rng.normal(0, 1 / np.sqrt(wide), (wide, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), 0.0]
    first, second = [0.0] * 4, [0.0] * 4
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = lambda z: np.logaddexp(0, -z)

    def forward(a):
        w1, b1, w2, b2 = model.weights
        hidden = np.tanh(a @ w1 + b1)
        return hidden, hidden @ w2 + b2

    def backward(a, hidden, slope):
        inner = np.outer(slope, model.weights[2]) * (1 - hidden**2)
        return [a.T @ inner, inner.sum(axis=0), hidden.T @ slope, slope.sum()]

    for step in range(1, steps + 1):
        hp, gp = forward(p)
        hu, gu = forward(u)
        negative = loss(-gu).mean() - prior * loss(-gp).mean()
        if negative >= 0:
            slope_p = prior * (-sigmoid(-gp) - sigmoid(gp)) / len(p)
            slope_u = sigmoid(gu) / len(u)
        else:  # step back from a negative estimate
            slope_p = prior * sigmoid(gp) / len(p)
            slope_u = -sigmoid(gu) / len(u)
        for i, (a, b) in enumerate(zip(backward(p, hp, slope_p), backward(u, hu, slope_u))):
            g = a + b + 1e-4 * model.weights[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            model.weights[i] = model.weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    return model


def _sample(rows: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` rows of measures, chosen and ordered by a hash of id and measures."""
    draw = F.xxhash64(F.lit(SEED), "doc_id", "features")
    got = rows.select(draw.alias("draw"), "features").orderBy("draw", "features").limit(most).toArrow()
    return np.array(got.column("features").to_pylist(), np.float64)


def train(features: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """Model from ``features(doc_id, features)`` and ``labels(doc_id, quality)``, held-out rows left aside.

    An id judged both ways, or without a verdict, is not trusted. None where there is no trusted positive.
    """
    judged = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("quality is not null")
    judged = judged.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("r"))
    judged = materialize(judged.filter("q = r and doc_id is not null"), "judged")
    prior = judged.agg(F.avg(F.col("q").cast("double"))).first()[0]
    learn = features.filter(~held_out(F.col("doc_id")))
    good = _sample(learn.join(judged.filter("q = 1").select("doc_id"), "doc_id", "left_semi"), positives)
    if not len(good):
        return None
    return fit(good, _sample(learn, unlabelled), min(max(prior, 0.02), 0.98))


def _scored(batches, model):
    for batch in batches:
        column = batch.column("features")
        x = column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)
        yield {"doc_id": batch.column("doc_id"), "score": model.score(x)}


def _kept(batches, model, threshold):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        if texts:
            x = np.array([measures(t) for t in texts], np.float32).astype(np.float64)
            good = model.score(x) >= threshold
            yield batch.filter(pa.array(good))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that score ``threshold`` or more, all their columns as they are. The
    model sees and judges texts as in ``score_quality``; each text is measured once to learn and once to judge, so that
    no text is shuffled. Without a trusted positive every row stays."""
    model = train(materialize(measured(docs), "measures"), labels)
    return docs if model is None else docs.mapInArrow(partial(_kept, model=model, threshold=threshold), docs.schema)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``; fits the model in a job.

    Only the text is an input of the score. Null and empty texts are scored like any other (all measures zero); equal
    texts score alike; repeated rows stay repeated. Without a trusted positive to learn from, every score is 0.5. No
    rows give no rows; further columns are not read.
    """
    features = materialize(measured(docs), "measures")
    model = train(features, labels)
    if model is None:
        scored = features.select("doc_id", F.lit(0.5).alias("score"))
    else:
        scored = arrow_map(features, partial(_scored, model=model), "doc_id long, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
