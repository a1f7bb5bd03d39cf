"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: words and word pairs as written, and one to three word shapes
(runs of capitals, other letters, digits, each sign for itself; marked if the word repeats the one before).
Over all labelled training rows, Spark counts the documents of each class that hold a feature; the indicator
is scaled by its log-count ratio and each document's vector to length one. On a bounded sample of those rows
(``fit_rows``, half of each class at most) dual coordinate descent fits a linear hinge-loss model, and a
logistic curve fitted on a part of the sample that the model did not see turns margins into scores.

Null and empty texts have no features; their score comes from the intercept alone. Rows with a null label or
a null doc_id are never learned from; rows repeated in the labels count as often. With fewer than
two rows of a class all scores are the smoothed share of class 1 (0.5 without labels). Ties in the draw of the sample go by the
row hash and id; a score of exactly 0.5 predicts 1. A very long text is read whole. An empty table gives no
rows. Only the id and text columns are read; the score depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwise.llm.common import SEED, maybe_broadcast, scratch_table, small_batches
from clickwise.llm.words import _SPACE, Words, groups, keys, mix64, shingles

BITS = 18
FIT_ROWS = 6000
EPOCHS = 12
COST = 1.0

_KIND = np.arange(256, dtype=np.uint64)  # signs stand for themselves
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 65, 97, 97, 48
_KIND_KEY = keys(256, 21)
_FAMILY = keys(8, 22)


def _shapes(w: Words) -> np.ndarray:
    """Hash of each word's shape: its runs of equal kinds."""
    kind = _KIND[w.buf]
    new = np.diff(kind, prepend=np.uint64(0)) != 0
    new[w.start] = True
    new &= ~_SPACE[w.buf]
    at = np.cumsum(new)
    runs = _KIND_KEY[kind[new].astype(np.int64)]
    first, last = at[w.start] - 1, at[w.end - 1]
    place = (np.arange(len(runs)) - np.repeat(first, last - first)) % 64
    value = mix64(runs + place.astype(np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    return total[last] - total[first]


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted feature numbers (below 2**BITS) of each text."""
    shift = np.uint64(64 - BITS)
    for group in groups(texts):
        w = Words(group, lower=False)
        shape = _shapes(w)
        for i in range(len(w)):
            a, b = w.first[i], w.first[i + 1]
            if a == b:
                yield np.zeros(0, np.int32)
                continue
            h, s = w.hash[a:b], shape[a:b].copy()
            s[1:][h[1:] == h[:-1]] ^= _FAMILY[7]
            grams = np.concatenate([f ^ _FAMILY[j] for j, f in enumerate(
                (h, shingles(h, 2), s, shingles(s, 2), shingles(s, 3)))])
            yield np.unique((mix64(grams) >> shift).astype(np.int32))


@dataclass
class Model:
    """Per feature: the log-count ratio and the weight of the scaled indicator; intercept; logistic curve."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def margin(self, f: np.ndarray) -> float:
        r = self.ratio[f]
        return float(r @ self.weight[f]) / max(float(np.sqrt(r @ r)), 1e-12) + self.bias

    def score(self, f: np.ndarray) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slope * self.margin(f) + self.offset, -30, 30))))


def log_count_ratio(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    p, q = pos + 1.0, neg + 1.0
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-loss linear SVM over the scaled indicators; classes weigh the same."""
    w, bias, rng = np.zeros(len(ratio)), 0.0, np.random.default_rng(SEED)
    n = len(rows)
    norm = np.array([max(float(np.sqrt(ratio[f] @ ratio[f])), 1e-12) for f in rows])
    # scaled vectors are made anew at each visit: all of them at once would take several times the sample's memory
    square = np.array([float(np.square(ratio[f] / d).sum()) + 1.0 for f, d in zip(rows, norm)])
    upper = np.where(y > 0, cost * n / (2 * max(1, (y > 0).sum())), cost * n / (2 * max(1, (y < 0).sum())))
    alpha = np.zeros(n)
    for _ in range(epochs):
        for i in rng.permutation(n):
            f, v = rows[i], ratio[rows[i]] / norm[i]
            gradient = y[i] * (float(w[f] @ v) + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def logistic_curve(margins: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset by Newton steps with smoothed targets; ``share``: of class 1 among all labelled rows (the
    sample holds the classes in other shares)."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, share / max(n1, 1), (1 - share) / max(n0, 1)) * len(y)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        hess = np.array([[(h * margins ** 2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * margins).sum() + 1e-3 * a, g.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def fit_sample(rows: list[np.ndarray], y: np.ndarray, pos: np.ndarray, neg: np.ndarray, share: float) -> Model:
    ratio = log_count_ratio(pos, neg)
    aside = np.arange(len(rows)) % 4 == 0
    part = Model(ratio, *dual_coordinate_descent([r for r, o in zip(rows, aside) if not o], y[~aside], ratio))
    curve = logistic_curve(np.array([part.margin(r) for r, o in zip(rows, aside) if o]), y[aside], share)
    return Model(ratio, *dual_coordinate_descent(rows, y, ratio), *curve)


def held_out(id_col: Column) -> Column:
    """The rows that are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on the labelled rows that are not held out. docs: doc_id, text; labels: doc_id and the label (0/1)."""
    small_batches(docs.sparkSession)
    known = scratch_table(labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col("doc_id")))
                          .select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("_y")), "labels")
    sizes = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    share = (n1 + 1) / (n1 + n0 + 2)
    none = np.zeros(1 << BITS)
    if min(n1, n0) < 2:
        return Model(none, none, offset=float(np.log(share / (1 - share))))
    # a seeded hash picks about fit_rows / 2 rows of each class, or all if there are fewer
    chosen = F.pmod(F.xxhash64(F.lit(SEED), "_id"), F.lit(1 << 30)) < F.when(
        F.col("_y") == 1, int((1 << 30) * min(1.0, fit_rows / 2 / n1))).otherwise(int((1 << 30) * min(1.0, fit_rows / 2 / n0)))
    rows = (docs.select("doc_id", "text").join(maybe_broadcast(known.withColumn("_chosen", chosen)), F.col("doc_id") == F.col("_id"))
            .select("_y", "_chosen", "text"))
    schema = pa.schema([("feature", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64()), ("y", pa.int32()),
                        ("row", pa.list_(pa.int32()))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            y, chosen_ = b.column(0).to_pylist(), b.column(1).to_pylist()
            kept = []
            for i, f in enumerate(features(b.column(2).to_pylist())):
                count[y[i], f] += 1
                if chosen_[i]:
                    kept.append((y[i], f))
            k = len(kept)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                                              pa.array([y_ for y_, _ in kept], pa.int32()),
                                              pa.array([f for _, f in kept], pa.list_(pa.int32()))], schema=schema)
        some = np.flatnonzero(count.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[1, some]), pa.array(count[0, some]),
                                          pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.list_(pa.int32()))], schema=schema)

    found = scratch_table(rows.mapInArrow(gather, "feature int, pos long, neg long, y int, row array<int>"), "features")
    # bounded: one row for each feature number, and the sample
    counts = (found.where("feature IS NOT NULL").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
              .toArrow())
    pos, neg = none.copy(), none.copy()
    at = counts["feature"].to_numpy()
    pos[at], neg[at] = counts["pos"].to_numpy(), counts["neg"].to_numpy()
    sample = found.where("y IS NOT NULL").select("y", F.xxhash64("row").alias("key"), "row").toArrow()
    # numpy views of the lists: a Python object for each feature would take ten times the memory
    drawn = []
    for b in sample.to_batches():
        at, flat = b.column(2).offsets.to_numpy(), b.column(2).values.to_numpy()
        drawn += [(y_, key, flat[at[i]:at[i + 1]]) for i, (y_, key) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))]
    drawn.sort(key=lambda r: r[:2])  # rows with one key are equal
    order = np.random.default_rng(SEED).permutation(len(drawn))
    y = np.array([1.0 if drawn[i][0] else -1.0 for i in order])
    return fit_sample([drawn[i][2] for i in order], y, pos, neg, share)


def scorer(docs: DataFrame, model: Model):
    """A column function: the score of a text column, in 0 to 1."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(f) for f in features(texts.tolist())], dtype="float64")

    return score


def score_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    score = scorer(docs, train(docs, labels, fit_rows=fit_rows))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` without the rows scored below ``threshold``, all columns unchanged."""
    score = scorer(docs, train(docs, labels, fit_rows=fit_rows))
    return docs.where(score("text") >= threshold)
