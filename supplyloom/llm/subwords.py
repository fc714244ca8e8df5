"""Averaged vectors of hashed words and character n-grams with a softmax on top, trained by numpy SGD.

Every word stands for its own bucket and those of its character n-grams; a text is the average of the learned vectors
of all its features, whole text, no prefix. Training runs on a bounded sample on the driver; afterwards vectors and
softmax fold into one score per bucket and class. Hashes of all n-grams of a text are computed at once with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 17
DIM = 12
GRAMS = (3, 4, 5)
REPEAT = 0  # bucket of "the same word again"
BLOCK = 1 << 18  # characters that are hashed at a time


@cache
def separators(splitter: str) -> np.ndarray:
    """For every code point whether it stands between words: all but letters, or only white space."""
    between = (lambda c: not c.isalpha()) if splitter == "letters" else str.isspace
    return np.fromiter((between(chr(i)) for i in range(0x110000)), dtype=bool, count=0x110000)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = (h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39)
    return h ^ (h >> np.uint32(15))


def _buckets(h: np.ndarray) -> np.ndarray:
    return np.maximum(_mixed(h) & np.uint32(BUCKETS - 1), 1).astype(np.intp)


def hashed(text: str | None, splitter: str) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams of a text, with repetitions, in blocks that end between words.

    Letters are compared in lower case, other words as they stand. A word boundary counts as a character of an n-gram, but
    only at its ends.
    """
    if not text:
        return
    codes = np.frombuffer((text.lower() if splitter == "letters" else text).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    between = separators(splitter)[codes]
    cuts = np.flatnonzero(between)
    start, last = 0, None
    while start < len(codes):
        end = len(codes)
        if end - start > BLOCK:
            at = np.searchsorted(cuts, start + BLOCK)
            end = int(cuts[at]) + 1 if at < len(cuts) else end
        out, last = _block(codes[start:end], between[start:end], last)
        yield from out
        start = end


def _block(codes: np.ndarray, between: np.ndarray, last: int | None) -> tuple[list[np.ndarray], int | None]:
    c = np.zeros(len(codes) + 2, np.uint32)
    c[1:-1] = np.where(between, 0, codes)
    filled = c != 0
    keep = filled.copy()
    keep[0] = True
    keep[1:] |= filled[:-1]  # one boundary after each word
    c, filled = c[keep], filled[keep]
    starts = np.flatnonzero(filled & ~np.append(False, filled[:-1]))
    if not len(starts):
        return [], last
    out = []
    h = c
    for n in range(2, max(GRAMS) + 1):
        h = h[: len(c) - n + 1] * np.uint32(0x01000193) ^ c[n - 1 :]
        if n == 2:
            inside = filled[1:]
        else:
            inside = inside[: len(h)] if n == 3 else inside[: len(h)] & filled[n - 2 : n - 2 + len(h)]
        if n in GRAMS:
            out.append(_buckets(h[inside[: len(h)]] + np.uint32(n)))
    place = np.arange(len(c), dtype=np.uint32)
    word = np.cumsum(filled & ~np.append(False, filled[:-1])) - 1
    inner = place - place[starts][np.maximum(word, 0)]
    letters = np.where(filled, _mixed(c + inner * np.uint32(0x9E3779B9)), 0).astype(np.uint32)
    words = np.add.reduceat(letters, starts, dtype=np.uint32)
    out.append(_buckets(words))
    before = np.append(-1 if last is None else last, words[:-1].astype(np.int64))
    again = int((before == words).sum())
    if again:
        out.append(np.full(again, REPEAT, np.intp))
    return out, int(words[-1])


def features(text: str | None, splitter: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    counts = np.zeros(BUCKETS)
    for ids in hashed(text, splitter):
        counts += np.bincount(ids, minlength=BUCKETS)
    ids = np.flatnonzero(counts)
    return ids, (counts[ids] / max(counts.sum(), 1)).astype(np.float32)


@dataclass
class Model:
    """Scores per bucket and class, bias, temperature, and the probability from which an answer is accepted."""

    classes: list
    splitter: str
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    accept: float = 0.0

    def __post_init__(self):
        self.columns = [np.ascontiguousarray(c) for c in self.scores.T]

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], labels: list, splitter: str, epochs: int = 3, rate: float = 0.6, seed: int = 0) -> Model:
    """SGD over the texts, one at a time in seeded order with a falling rate; every eighth text is kept for calibration."""
    classes = sorted(set(labels))
    if not classes:
        return Model([], splitter, np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    out = np.zeros((DIM, len(classes)), np.float32)
    bias = np.zeros(len(classes), np.float32)
    data = [(*features(t, splitter), classes.index(y)) for t, y in zip(texts, labels, strict=True)]
    learn = [d for i, d in enumerate(data) if i % 8] or data
    check = [d for i, d in enumerate(data) if i % 8 == 0]
    steps, done = epochs * len(learn), 0
    for _ in range(epochs):
        for at in rng.permutation(len(learn)):
            ids, shares, y = learn[at]
            lr = rate * (1 - done / steps)
            done += 1
            rows = vectors[ids]
            hidden = shares @ rows
            z = hidden @ out + bias
            e = np.exp(z - z.max())
            g = e / e.sum()
            g[y] -= 1
            back = out @ g
            out -= lr * np.outer(hidden, g)
            bias -= lr * 0.1 * g
            # shares are small numbers: scaled so that a vector moves as if its feature stood alone in a short text
            vectors[ids] = rows - (lr * 20.0) * np.outer(shares, back)
    model = Model(classes, splitter, (vectors @ out).astype(np.float32), bias.astype(np.float64))
    return calibrated(model, check)


def calibrated(model: Model, check: list[tuple[np.ndarray, np.ndarray, int]], target: float = 0.99) -> Model:
    """Temperature with the least log loss on the kept texts; answers are accepted from the smallest probability on
    for which the accepted ones are right in ``target`` of all cases."""
    if not check:
        return model
    logits = np.array([shares @ model.scores[ids] for ids, shares, _ in check], dtype=np.float64)
    truth = np.array([y for *_, y in check])
    grid = np.geomspace(0.05, 10, 40)

    def loss(t: float) -> float:
        model.temperature = t
        return float(-np.log(model.probabilities(logits)[np.arange(len(truth)), truth] + 1e-12).mean())

    model.temperature = float(min(grid, key=loss))
    p = model.probabilities(logits)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(right >= target)
    model.accept = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
    return model


def logits(model: Model, text: str | None) -> np.ndarray:
    """Mean score of the features of a text for every class; zero without features."""
    total, count = np.zeros(len(model.classes)), 0
    for ids in hashed(text, model.splitter):
        total += [column.take(ids).sum(dtype=np.float64) for column in model.columns]
        count += len(ids)
    return total / max(count, 1)


def class_probabilities(model: Model, text: Column, spark) -> Column:
    """``array<double>``: the probability of every class, in the order of ``model.classes``, for each whole text."""
    shared = spark.sparkContext.broadcast(model)  # bounded: BUCKETS rows

    @F.pandas_udf("array<double>")
    def probabilities(batch: pd.Series) -> pd.Series:
        mine = shared.value
        return pd.Series([mine.probabilities(logits(mine, t)) for t in batch])

    return probabilities(text)


def sample(docs: DataFrame, labelled: DataFrame, rows: int) -> tuple[list[str], list]:
    """Texts and labels of at most ``rows`` documents of each label, those with the smallest hash of the id.

    ``labelled (doc_id, label)``; only these ids are broadcast and only their texts reach the driver.
    """
    ranked = labelled.filter("doc_id is not null and label is not null").dropDuplicates(["doc_id"])
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rows).select("doc_id", "label")
    found = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id").collect()
    found.sort(key=lambda r: (r.doc_id, r.text))
    return [r.text for r in found], [r.label for r in found]
