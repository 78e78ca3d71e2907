"""Quality classifier learned from trusted positives and unlabelled text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Most trusted positives that the classifier is fitted on; the unlabelled side is all rows.
FIT_ROWS = 20_000

#: ``total(f)``: the sum of ``f(block)`` over blocks of rows, wherever these are.
Total = Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray]

_BYTES = np.arange(256)
#: Classes of bytes whose share is a feature.
_CLASSES = np.stack(
    [np.isin(_BYTES, list(c)) for c in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789",
                                        b" ", b"\n", b".", b",;:", b"!?", b"'\"()-", b"|/\\_", b"#$%&*+<=>@^`~[]{}")]
    + [_BYTES >= 0x80, (_BYTES < 0x20) & (_BYTES != 0x0A)]
).astype(float)


def features(text: str | None) -> np.ndarray:
    """Numbers that describe the form of a text, whatever its language and length."""
    raw = (text or "").encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = _CLASSES @ counts / max(len(raw), 1)
    seen = counts[counts > 0] / max(len(raw), 1)
    words = raw.split()
    n = max(len(words), 1)
    times = Counter(words)
    top = max(times.values(), default=0)
    again = sum(map(eq, words, words[1:]))
    ends = sum(w[-1] in b".!?" for w in times) / max(len(times), 1)
    loud = sum(w.isupper() for w in times) / max(len(times), 1)
    signs = sum(not w[:1].isalnum() and w[0] < 0x80 for w in times) / max(len(times), 1)
    lines = [line for line in raw.split(b"\n") if line]
    own = np.array([
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / n, len(times) / n, len(times) / np.sqrt(n), top / n, again / n,
        np.sqrt(again / n), ends, loud, signs, -(seen * np.log(seen)).sum(), 1 - len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1) / 100,
    ])
    return np.concatenate([shares, np.sqrt(shares), own])


WIDTH = len(features(""))


@dataclass(frozen=True)
class Classifier:
    """A linear score over standardised features; ``prior`` is the share of positives assumed."""

    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])


def _at(w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Sums over unlabelled rows at the weights ``w``: the loss of calling them negative, its slope and curvature."""

    def sums(x: np.ndarray) -> np.ndarray:
        u = np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))]
        f = u @ w
        s = _sigmoid(f)
        return np.concatenate([[_softplus(f).sum()], u.T @ s, ((u * (s * (1 - s))[:, None]).T @ u).ravel()])

    return sums


@dataclass(frozen=True)
class Risk:
    """Risks of a linear score over positive rows ``p`` (standardised, with a column of ones) and all rows."""

    p: np.ndarray
    total: Total
    n: int
    mean: np.ndarray
    scale: np.ndarray
    decay: float

    def least(self, of_positive: Callable[[np.ndarray], tuple], weight: float, w: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
        """Weights that minimise ``P[g(f)] + weight U[l(-f)]`` by Newton steps from ``w``, and U[l(-f)] there.

        l is the logistic loss; ``of_positive`` gives g and its first two derivatives at given scores.
        """
        width = self.p.shape[1]
        pull = np.full(width, self.decay)
        pull[-1] = 0

        def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
            sums = self.total(_at(w, self.mean, self.scale)) / self.n
            value, first, second = of_positive(self.p @ w)
            slope = weight * sums[1 : width + 1] + self.p.T @ first / len(self.p) + pull * w
            curve = weight * sums[width + 1 :].reshape(width, width) + (self.p * second[:, None]).T @ self.p / len(self.p)
            return weight * sums[0] + value.mean() + 0.5 * (pull * w * w).sum(), slope, curve + np.diag(pull + 1e-9), sums[0]

        risk, slope, curve, loss = at(w)
        for _ in range(rounds):
            step, share = np.linalg.solve(curve, slope), 1.0
            found = at(w - step)
            while found[0] > risk + 1e-12 and share > 1e-3:
                share /= 2
                found = at(w - share * step)
            if found[0] > risk + 1e-12:
                break
            w, better = w - share * step, risk - found[0]
            risk, slope, curve, loss = found
            if better < 1e-6:
                break
        return w, loss

    def told_from_all(self, rounds: int) -> np.ndarray:
        """Weights that tell positives from all rows."""

        def g(f: np.ndarray) -> tuple:
            s = _sigmoid(-f)
            return _softplus(-f), -s, s * (1 - s)

        return self.least(g, 1.0, np.zeros(self.p.shape[1]), rounds)[0]

    def non_negative(self, prior: float, rounds: int) -> np.ndarray:
        """Weights of least unbiased risk whose estimated risk on negatives is not below zero.

        The risk is prior P[l(f)] + N, where N = U[l(-f)] - prior P[l(-f)] estimates without negatives what
        calling them positive costs. If N is below zero at the least risk (by more than its sampling error), which
        no set of negatives could give, N counts half as much, and so on until it is not.
        """

        def at(weight: float, w: np.ndarray) -> tuple[np.ndarray, float]:
            def g(f: np.ndarray) -> tuple:
                s = _sigmoid(f)
                own = prior * (1 - weight)
                return own * _softplus(f) - prior * f, own * s - prior, own * s * (1 - s)

            w, loss = self.least(g, weight, w, rounds)
            own = _softplus(self.p @ w)
            # positives were drawn, both the trusted and those among all rows: N may be off by this much
            error = 2 * prior * own.std() * np.sqrt(1 / len(own) + 1 / (prior * self.n))
            return w, loss - prior * own.mean() + error

        weight, (w, negative) = 1.0, at(1.0, np.zeros(self.p.shape[1]))
        while negative < 0 and weight > 2**-14:
            weight /= 2
            w, negative = at(weight, w)
        return w if negative >= 0 else np.zeros(self.p.shape[1])


def estimated_prior(p: np.ndarray, total: Total, n: int, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> float:
    """The share of positives among all rows, from positives and unlabelled rows alone.

    Above any score, rows hold at least the prior times the share of positives above it, so the
    least quotient of both shares bounds the prior. Scores that keep nine in ten positives or
    more are looked at: further up, few rows would decide.
    """
    limits = np.quantile(p @ w, np.linspace(0, 0.1, 21))
    kept = (p @ w >= limits[:, None]).mean(axis=1)

    def above(x: np.ndarray) -> np.ndarray:
        f = np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))] @ w
        return (f >= limits[:, None]).sum(axis=1).astype(float)

    return float(np.clip((total(above) / n / kept).min(), 0.01, 0.99))


def fit(positive: np.ndarray, total: Total, prior: float | None = None, decay: float = 1e-3, rounds: int = 12) -> Classifier:
    """Minimise the non-negative unbiased risk of positive rows and all rows.

    ``total(f)`` gives the sum of ``f(block)`` over blocks of rows that together are the
    unlabelled rows; no row leaves its task. Mean and scale are theirs too. Where no ``prior`` is
    given it is estimated with a first classifier that tells positives from all rows.
    """
    sums = total(_moments)
    n = int(sums[0])
    if not n or not len(positive) or (prior is not None and prior >= 1):
        return Classifier(np.zeros(WIDTH), 0.0, np.zeros(WIDTH), np.ones(WIDTH), 1.0 if prior is None else prior)
    mean = np.round(sums[1 : WIDTH + 1] / n, 12)
    scale = np.round(np.sqrt(np.maximum(sums[WIDTH + 1 :] / n - mean**2, 0)), 9) + 1e-6
    p = np.c_[np.clip((positive - mean) / scale, -8, 8), np.ones(len(positive))]
    risk = Risk(p, total, n, mean, scale, decay)
    if prior is None:
        prior = estimated_prior(p, total, n, mean, scale, risk.told_from_all(rounds))
    w = np.round(risk.non_negative(prior, rounds), 9)  # sums arrive in any order; what differs behind this digit is theirs
    return Classifier(w[:-1], float(w[-1]), mean, scale, prior)


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def summed_over(rows: DataFrame) -> Total:
    """Sums over a written table with a column ``x``; each task sends one vector."""

    def total(of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = of(np.zeros((0, WIDTH)))
            for batch in batches:
                sums = sums + of(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH))
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(sums)), pa.int32()), "v": pa.array(sums, pa.float64())})

        found = rows.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        return np.array([r["v"] for r in found]) if found else of(np.zeros((0, WIDTH)))

    return total


def train(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    prior: float | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Classifier:
    """A classifier from ``labels`` (``doc_id``, ``label``) and the texts of ``docs``.

    Trusted positives are documents all of whose labels are 1, held-out ones left out; of these
    ``fit_rows`` at most are used, chosen by a hash of the id, with one text each (the smallest of an id
    that repeats). This is the only bound. The unlabelled side is every row of ``docs``, labels unseen:
    its risk, mean and scale are sums over all rows, added up in tasks. ``prior`` is the share of
    positives; where not given it is estimated from positives and unlabelled rows.

    Rows with a NULL id or label teach nothing as positives, repeated labels count once. With no
    positives or no text, every score is 0.5.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label")).where("id is not null and label is not null")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label")).where("label = 1")
    chosen = known.select("id").orderBy(F.xxhash64("id", F.lit("positive")), "id").limit(fit_rows)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # only ids of one or more rows come back, and one row of each: the least text
    positive = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column("text")]
            x = np.stack(x).ravel() if x else np.zeros(0)
            ends = pa.array(np.arange(batch.num_rows + 1) * WIDTH, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x, pa.float64()))], ["x"])

    trusted = positive.select("text").mapInArrow(described, "x array<double>").collect()
    trusted = np.array([r["x"] for r in trusted], float).reshape(-1, WIDTH)
    trusted = trusted[np.lexsort(trusted.T)]  # rows arrive in any order
    unlabelled = written(texts.select("text").mapInArrow(described, "x array<double>"), "quality-features")
    return fit(trusted, summed_over(unlabelled), prior)


def quality_score(text: Column, classifier: Classifier) -> Column:
    """The probability that a text is of good quality; NULL counts as empty."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(classifier.score(np.stack([features(t) for t in texts])))

    return score(text)


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), **options) -> DataFrame:
    """Every row of ``docs`` scored: ``doc_id``, ``held_out``, ``score``, ``predicted`` and the
    columns named in ``keep``.

    The score sees the text alone. Repeated rows are scored alike, NULL texts as empty ones, NULL
    ids are not held out; an empty table gives an empty result.
    """
    classifier = train(docs, labels, doc_id=doc_id, text=text, **options)
    row = F.struct(F.lit(None).alias("_"), *(F.col(f"`{c}`") for c in keep)).alias("kept")
    scored = docs.select(F.col(doc_id).alias("doc_id"), quality_score(F.col(text), classifier).alias("score"), row)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *(F.col(f"kept.`{c}`").alias(c) for c in keep),
    )
