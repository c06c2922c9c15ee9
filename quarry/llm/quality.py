"""Quality classifier: a linear support vector machine over Naive Bayes scaled n-grams.

Every document becomes the set of its n-gram indicators: runs of four bytes,
folded words, and runs of four "equals the word before" flags, hashed into
2**18 slots.  Each slot is scaled by the log ratio of its smoothed counts in
the two classes, the vector is brought to unit length, and a linear
hinge-loss model is fitted by dual coordinate descent.  A logistic curve,
fitted on a part of the sample that the model has not seen, turns margins
into probabilities.

The fit reads a bounded sample of labelled rows (``labelled.FIT_ROWS``); the
scoring pass reads every text once, in Arrow batches, and shuffles nothing.

Empty or null texts have no n-grams: their margin is the bias.  Repeated
rows get equal scores.  Columns beyond doc_id and text are not read.  With no
sample, or one class only, every score is that class's share (0.5 if none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import textcore as tc
from quarry.llm.labelled import FIT_ROWS, fit_sample, held_out

SLOT_BITS = 18
SMOOTH = 1.0
#: Weight of the fitted model against the mean weight (interpolated NB-SVM).
BETA = 0.75
COST = 1.0
EPOCHS = 12


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of the distinct n-grams of each document, sorted by document."""
    found = []
    shift = np.uint64(64 - SLOT_BITS)
    if len(data) >= 4:
        at = np.flatnonzero(np.ones(len(data) - 3, bool))
        document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        at = at[document[:-3] == document[3:]]
        d = data.astype(np.uint64)
        gram = d[at] | d[at + 1] << np.uint64(8) | d[at + 2] << np.uint64(16) | d[at + 3] << np.uint64(24)
        found.append(document[at] << SLOT_BITS | (tc.mix64(gram, 1) >> shift).astype(np.int64))
    _, _, document, word = tc.words(data, offsets)
    found.append(document << SLOT_BITS | (tc.mix64(word, 2) >> shift).astype(np.int64))
    if len(word):
        same = np.concatenate(([False], (word[1:] == word[:-1]) & (document[1:] == document[:-1])))
        run, first = tc.windows(same.astype(np.uint64), document, 4)
        found.append(document[first] << SLOT_BITS | (tc.mix64(run, 3) >> shift).astype(np.int64))
    key = np.sort(np.concatenate(found))
    key = key[tc.runs(key)]
    return key >> SLOT_BITS, key & ((1 << SLOT_BITS) - 1)


@dataclass
class Model:
    ratio: np.ndarray    # class log-count ratio of each slot
    weight: np.ndarray   # weight of each slot in the linear model
    bias: float
    slope: float         # logistic curve of the margin
    offset: float


def _probability(margin, slope: float, offset: float):
    return 1.0 / (1.0 + np.exp(-np.clip(slope * margin + offset, -30, 30)))


def _descend(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: np.ndarray,
             seed: int = 11) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss, on unit rows with a bias of one more unit."""
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    vectors = []
    for slots in rows:
        v = ratio[slots]
        vectors.append(v / (np.sqrt(v @ v) or 1.0))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slots, v = rows[i], vectors[i]
            gradient = y[i] * (w[slots] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / (v @ v + 1.0), 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[slots] += step * v
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def _logistic(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton's method with smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))
    x = np.column_stack([margin, np.ones(len(margin))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _probability(margin, *beta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(sample: DataFrame) -> Model:
    """Fit on (text, label); the driver receives the slots of the bounded sample only."""
    def sets(batches):
        for batch, texts in tc.chunks(batches):
            document, slot = indicators(*tc.text_bytes(texts))
            cut = np.searchsorted(document, np.arange(1, batch.num_rows))
            packed = [s.astype(np.uint32).tobytes() for s in np.split(slot, cut)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("label")).cast(pa.int32()),
                 pa.array(packed, pa.binary())], names=["label", "slots"])

    got = sample.select("text", "label").mapInArrow(sets, "label int, slots binary").toPandas()
    got = got.sort_values(["slots", "label"], kind="stable")  # the same fit whatever order tasks end in
    y = np.where(got["label"].to_numpy() == 1, 1.0, -1.0)
    rows = [np.frombuffer(s, np.uint32) for s in got["slots"]]
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    slots = 1 << SLOT_BITS
    if not n1 or not n0:
        share = 0.5 if not len(y) else (len(y) - 0.0 if n1 else 0.0) / len(y)
        odds = np.log((share + 1e-6) / (1 - share + 1e-6))
        return Model(np.zeros(slots), np.zeros(slots), 0.0, 1.0, float(odds))
    p, q = np.full(slots, SMOOTH), np.full(slots, SMOOTH)
    for label, s in zip(y, rows, strict=True):
        (p if label > 0 else q)[s] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    cost = np.where(y > 0, COST * len(y) / (2 * n1), COST * len(y) / (2 * n0))

    def interpolated(w):
        return (1 - BETA) * np.abs(w).mean() * np.sign(w) + BETA * w

    def margin(s, w, bias):
        v = ratio[s]
        return w[s] @ v / (np.sqrt(v @ v) or 1.0) + bias

    check = np.arange(len(rows)) % 5 == 0
    fitted, curve = np.flatnonzero(~check), np.flatnonzero(check)
    w, bias = _descend([rows[i] for i in fitted], ratio, y[fitted], cost[fitted])
    w = interpolated(w)
    slope, offset = _logistic(np.array([margin(rows[i], w, bias) for i in curve]), y[curve] > 0)
    return Model(ratio, w, float(bias), slope, offset)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``."""
    ratio, product = model.ratio.astype(np.float32), (model.ratio * model.weight).astype(np.float32)
    bias, slope, offset = model.bias, model.slope, model.offset

    def scored(batches):
        for batch, texts in tc.chunks(batches):
            document, slot = indicators(*tc.text_bytes(texts))
            n = batch.num_rows
            dot = np.bincount(document, product[slot], n)
            norm = np.sqrt(np.bincount(document, ratio[slot].astype(float) ** 2, n))
            margin = np.divide(dot, norm, out=np.zeros(n), where=norm > 0) + bias
            value = _probability(margin, slope, offset)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(value)],
                names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(fit_sample(docs, labels, "quality", rows))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def accuracy(scored: DataFrame, labels: DataFrame, label: str) -> pd.DataFrame:
    """Counts of (held_out, label, predicted), for reports and tests."""
    return (scored.join(labels.select("doc_id", label), "doc_id")
            .groupBy("held_out", label, "predicted").count().toPandas())
