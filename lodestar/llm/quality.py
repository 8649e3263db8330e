"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled 1; unlabelled rows are web text of unknown
quality.  With logistic loss ``l`` and class prior ``q`` the unbiased risk of a
linear score ``z`` is ``q E_p[l(z)] + (E_u[l(-z)] - q E_p[l(-z)])``; the part
in brackets is the risk of the negatives and cannot be below 0.  Newton steps
minimise the risk (it is convex for logistic loss, plus a small ridge); a step
that would make the negative part negative is halved until it does not, which
keeps the risk non-negative.

The class prior is estimated from positives and unlabelled rows alone: a
classifier of positives against unlabelled rows gives every row a probability
``g`` of being a known positive, and ``q = E_u[g] / E_p[g]`` (at most 1).

Features are counts and ratios of the whole text, taken in Arrow batches and
checkpointed (``len(NAMES)`` numbers a row).  Every step is one pass over all
training rows; per task it returns one gradient and one Hessian, so what
reaches the driver does not depend on the corpus.

Defined results: a null or empty text has the features of "" and gets a score;
labels are joined once per id, and an id labelled more than once counts as
positive only if all its labels are 1; null labels and ids are unlabelled; if
there are no positives or no unlabelled rows, every score is the share of
positives among the labelled rows (0.5 if there are none); other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import text_slices
from lodestar.llm.common import cut, ship

RIDGE = 3.0              # a Gaussian prior on the weights: this over the smaller class's rows
STEPS = 12
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c", "line": b"\n", "stop": b".", "comma": b",", "shout": b"!", "ask": b"?",
    "bar": b"|", "markup": b"<>{}[]=/\\&#*_~^`$%@+", "quote": b"\"'()-;:", "other": bytes(range(128, 256)),
}
_MARKS = re.compile(r"[.!?\n]+")
NAMES = ["one", *_CLASSES, "size", "words", "word_length", "distinct_words", "top_word", "shouted", "capital",
         "repeated_lines", "repeated_sentences", "line_length", "sentence_length", "long_words", "short_words",
         "upper_words_sq", "distinct_sq", "bar_any", "shout_any"]


def features(text: str) -> list[float]:
    """Numbers of about unit size; all defined for the empty text."""
    b = text.encode()
    n = len(b)
    rate = {k: (n - len(b.translate(None, v))) / max(n, 1) for k, v in _CLASSES.items()}
    words = text.split()
    w = len(words)
    lower = Counter(text.lower().split())
    lines = [x for x in text.split("\n") if x.strip()]
    sentences = [x.strip() for x in _MARKS.split(text) if x.strip()]
    letters = n * (rate["upper"] + rate["lower"])
    shouted = n * rate["upper"] / max(letters, 1.0)
    distinct = len(lower) / max(w, 1)
    out = [1.0, *(math.sqrt(v) for v in rate.values()), math.log1p(n) / 10, math.log1p(w) / 8,
           min((n - n * rate["blank"]) / max(w, 1), 40) / 10, distinct, max(lower.values(), default=0) / max(w, 1),
           shouted, sum(x[0].isupper() for x in words) / max(w, 1),
           1 - len(set(lines)) / max(len(lines), 1), 1 - len(set(sentences)) / max(len(sentences), 1),
           math.log1p(n / max(len(lines), 1)) / 8, math.log1p(w / max(len(sentences), 1)) / 5,
           sum(len(x) > 12 for x in words) / max(w, 1), sum(len(x) < 4 for x in words) / max(w, 1),
           shouted ** 2, math.log1p(len(lower)) / max(math.log1p(w), 1.0),
           float(rate["bar"] > 0), float(rate["shout"] > 0)]
    return out


def feature_rows(carry: list[str]):
    def run(batches):
        for batch in batches:
            kept = batch.select(carry)
            for at, texts in text_slices(batch):
                packed = [np.array(features(t), "<f4").tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*kept.slice(at, len(texts)).columns, pa.array(packed, pa.binary())], [*carry, "x"])
    return run


def matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f4").reshape(len(rows), -1).astype(np.float64)


def sums(rows: DataFrame, per_batch, n: int) -> np.ndarray:
    """Sum of ``per_batch(kind, x)``, ``n`` numbers, over (kind, x) rows: one
    row per task, added up by Spark in a tree of two levels."""
    def run(batches):
        total = np.zeros(n)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(np.array(batch.column(0).to_pylist()), matrix(batch.column(1)))
        i = np.arange(n)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total)], ["i", "v"])

    got = rows.select("kind", "x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(n)
    for r in got:
        out[r[0]] = r[1]
    return out


def newton(rows: DataFrame, scale: np.ndarray, risk, ridge: float, steps: int = STEPS) -> np.ndarray:
    """Minimise a risk (``pu_part`` or ``pn_part``) plus the ridge."""
    d = len(scale)
    w = np.zeros(d)
    step, last = np.zeros(d), None
    for _ in range(steps):
        got = sums(rows, risk(w, scale), d * d + d + 2)
        value, negative = got[0] + ridge * w @ w / 2, got[1]
        if last is not None and (negative < 0 or value > last + 1e-12) and np.abs(step).max() > 1e-6:
            step = step / 2
            w = w - step
            continue
        if last is not None and last - value < 1e-9:
            break
        last = value
        grad, hess = got[2:2 + d] + ridge * w, got[2 + d:].reshape(d, d) + ridge * np.eye(d)
        step = -np.linalg.solve(hess, grad)
        step *= min(1.0, 10 / max(np.abs(step).max(), 1e-12))
        w = w + step
    return w


def losses(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l(z), l(-z) and the probability of the positive class."""
    soft = np.logaddexp(0, -np.abs(z))
    return soft + np.maximum(-z, 0), soft + np.maximum(z, 0), 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def pu_part(prior: float, n_p: float, n_u: float):
    """Risk, its negative part, gradient and Hessian of the unbiased PU risk."""
    def at(w, scale):
        def part(kind, x):
            x = x / scale
            z = x @ w
            up, down, p = losses(z)
            pos, free = (kind == 1) / n_p, (kind == 0) / n_u
            negative = free @ down - prior * (pos @ down)
            grad = x.T @ (free * p - prior * pos)
            hess = (x * (free * p * (1 - p))[:, None]).T @ x
            return np.concatenate([[prior * (pos @ up) + negative, negative], grad, hess.ravel()])
        return part
    return at


def pn_part(n_p: float, n_u: float):
    """The same for positives against unlabelled rows as two classes."""
    def at(w, scale):
        def part(kind, x):
            x = x / scale
            z = x @ w
            up, down, p = losses(z)
            pos, free = (kind == 1) / (n_p + n_u), (kind == 0) / (n_p + n_u)
            grad = x.T @ ((pos + free) * p - pos)
            hess = (x * ((pos + free) * p * (1 - p))[:, None]).T @ x
            return np.concatenate([[pos @ up + free @ down, 0.0], grad, hess.ravel()])
        return part
    return at


def fit(rows: DataFrame) -> dict:
    """Weights, scale and prior from checkpointed (kind, x) rows; kind is 1 for
    positives, 0 for unlabelled rows, -1 for rows labelled 0 (used only for the
    fallback share)."""
    d = len(NAMES)

    def moments(kind, x):
        used = kind >= 0
        return np.concatenate([[(kind == 1).sum(), (kind == 0).sum(), (kind == -1).sum()], (x[used] ** 2).sum(0)])

    got = sums(rows, moments, d + 3)
    n_p, n_u, n_n = got[:3]
    if not n_p or not n_u:
        return {"constant": float(n_p / (n_p + n_n)) if n_p + n_n else 0.5}
    scale = np.sqrt(got[3:] / (n_p + n_u))
    scale[scale == 0] = 1.0
    ridge = RIDGE / min(n_p, n_u)
    w = newton(rows, scale, pn_part(n_p, n_u), ridge)

    def known(kind, x):
        g = losses(x / scale @ w)[2]
        return np.array([g[kind == 1].sum() / n_p, g[kind == 0].sum() / n_u])

    in_p, in_u = sums(rows, known, 2)
    prior = float(min(max(in_u / max(in_p, 1e-12), 0.01), 0.99))
    w = newton(rows, scale, pu_part(prior, n_p, n_u), ridge)
    return {"w": (w / scale), "prior": prior}


def quality_scores(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, train (as given), score and predicted.  Only
    rows with ``train`` (a column of ``docs``' id) are learned from."""
    wide = ship(docs).select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
                             F.col(text_col).alias("text"))
    kind = wide.schema["id"].dataType.simpleString()
    x = cut(wide.mapInArrow(feature_rows(["id", "train"]), f"id {kind}, train boolean, x binary"))
    known = (labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("label")).dropna()
             .groupBy("label_id").agg(F.min("label").alias("label")))
    kinds = (F.when(F.col("label") == 1, 1).when(F.col("label").isNotNull(), -1).otherwise(0))
    rows = x.where("train").select("id", "x")
    rows = cut(rows.join(known, rows["id"] == known["label_id"], "left").select(kinds.alias("kind"), "x"))
    model = fit(rows)

    def score(batches):
        for batch in batches:
            m = matrix(batch.column(2)) if batch.num_rows else np.zeros((0, len(NAMES)))
            s = losses(m @ model["w"])[2] if "w" in model else np.full(len(m), model["constant"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["id", "train", "score", "predicted"])

    return (x.mapInArrow(score, f"id {kind}, train boolean, score double, predicted int")
            .withColumnRenamed("id", id_col))
