"""Quality classifier: naive Bayes support vectors.

A text's n-grams (bytes, ``BYTE_GRAMS`` long, words as they stand, and patterns of repeated words) are hashed into ``2 ** BITS``
indicators. Each indicator is scaled by its class log-count ratio, ``log(p / |p|) - log(q / |q|)`` with
``p`` and ``q`` one plus the number of training texts of either class that hold it, and the vector is
brought to length one. A linear hinge-loss model is fitted to these vectors by dual coordinate descent:
one dual variable a training text, each step solving its one-variable problem exactly, the weight vector
carried along. A logistic curve through margins of texts left out in turn (folds) makes them probabilities.

The model is fitted on the driver to at most ``sample_rows`` labelled rows of at most ``sample_bytes``
of text in all, chosen by a hash (whole texts; the bound does not depend on the table). Every row is
scored, over its whole text. Labels come from rows outside the held-out quarter; labels, language, source
and id are never inputs of a score.

Defined results: a null or empty text has no n-gram and gets the score of the model's constant; an id
whose labels disagree, and labels other than 0 and 1, are not learned from; a null id has no label;
repeated rows get equal scores; with no labelled row of one class or the other every score is the share of
label 1 among those learned from (0.5 if none); an empty table gives an empty result. Columns other than
the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, stable, with_row_id

BITS = 18
BYTE_GRAMS = (1, 2, 3)
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 32 << 20
COST, EPOCHS, FOLDS, SMOOTHING = 1.0, 15, 4, 1.0
THRESHOLD = 0.7
#: Bytes of a text handled at once; n-grams reach over the border.
PIECE = 1 << 20


def _hashed(codes: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (codes.astype(np.uint64) + np.uint64(salt << 40)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def indicators(text: str | None) -> np.ndarray:
    """The different hashed n-grams of a text, sorted."""
    raw = (text or "").encode()
    found = []
    longest = max(BYTE_GRAMS)
    for at in range(0, len(raw), PIECE):
        piece = np.frombuffer(raw[at:at + PIECE + longest - 1], dtype=np.uint8).astype(np.uint32)
        begins = min(PIECE, len(raw) - at)
        for n in BYTE_GRAMS:
            count = min(begins, len(piece) - n + 1)
            if count <= 0:
                continue
            code = piece[:count]
            for k in range(1, n):
                code = (code << np.uint32(8)) | piece[k:count + k]
            found.append(np.unique(code) if n < longest else code)
            found[-1] = np.unique(_hashed(found[-1], n))
    words = raw.split()
    if words:
        different = set(words)
        found.append(_hashed(np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different)), 0))
        found.append(np.unique(_hashed(repeat_grams(words), longest + 1)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def repeat_grams(words: list[bytes]) -> np.ndarray:
    """N-grams of repeats: for every word, which of the words just before it equal it, and the same
    for the word before that."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    padded = np.concatenate((np.full(3, -1), at))
    same = sum((padded[3 - k:3 - k + len(at)] == at).astype(np.int64) << (k - 1) for k in (1, 2, 3))
    return np.concatenate((same, same[1:] << 3 | same[:-1] | 64))


@dataclass
class Model:
    """``scaled`` holds weight times ratio, ``squared`` the squared ratio of every indicator."""

    scaled: np.ndarray
    squared: np.ndarray
    constant: float
    slope: float
    shift: float

    def margin(self, row: np.ndarray) -> float:
        norm = np.sqrt(float(self.squared[row].sum())) or 1.0
        return float(self.scaled[row].sum()) / norm + self.constant

    def score(self, row: np.ndarray) -> float:
        z = self.slope * self.margin(row) + self.shift
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.full((2, 1 << BITS), SMOOTHING)
    for row, label in zip(rows, labels):
        counts[int(label), row] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = COST,
                 epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float, np.ndarray]:
    """Minimise |w|^2 / 2 + cost * sum of hinge losses: (weights, constant, dual variables).

    Every vector has one more item, 1, whose weight is the constant. Stops when no projected
    gradient of an epoch exceeds a hundredth.
    """
    sign = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    values = [ratio[r] / (np.sqrt((ratio[r] ** 2).sum()) or 1.0) for r in rows]
    diagonal = [float((v ** 2).sum()) + 1.0 for v in values]
    weight, constant, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            row, value, y, old = rows[i], values[i], sign[i], dual[i]
            gradient = y * (float(value @ weight[row]) + constant) - 1.0
            projected = min(gradient, 0.0) if old == 0.0 else max(gradient, 0.0) if old == cost else gradient
            worst = max(worst, abs(projected))
            if projected:
                dual[i] = new = min(max(old - gradient / diagonal[i], 0.0), cost)
                step = (new - old) * y
                weight[row] += step * value  # indicators of a text are all different
                constant += step
        if worst < 0.01:
            break
    return weight, constant, dual


def logistic_curve(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve (Newton steps; targets drawn in from 0 and 1)."""
    ones, zeros = float(labels.sum()), float(len(labels) - labels.sum())
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack((margins, np.ones(len(margins))))
    at = np.array([1.0, np.log((ones + 1) / (zeros + 1))])

    def loss(a: np.ndarray) -> float:
        z = x @ a
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        gradient = x.T @ (p - target)
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-9 * np.eye(2)
        step, scale = np.linalg.solve(hessian, gradient), 1.0
        while scale > 1e-6 and loss(at - scale * step) > loss(at):
            scale /= 2
        at = at - scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    return float(max(at[0], 0.0)), float(at[1])


def train(rows: list[np.ndarray], labels: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> Model:
    """Fit the model, and the curve on the margins that models without a text's fold give it."""
    def fitted(some: np.ndarray) -> Model:
        mine = [rows[i] for i in some]
        ratio = log_count_ratios(mine, labels[some])
        weight, constant, _ = dual_descent(mine, labels[some], ratio, cost, epochs)
        return Model(weight * ratio, ratio ** 2, constant, 1.0, 0.0)

    every = np.arange(len(rows))
    fold = np.zeros(len(rows), dtype=int)
    for c in (0, 1):
        mine = np.flatnonzero(labels == c)
        fold[mine] = np.arange(len(mine)) % FOLDS
    margins = np.zeros(len(rows))
    if min((labels == 0).sum(), (labels == 1).sum()) < FOLDS:  # too few to leave any out
        model = fitted(every)
        margins = np.array([model.margin(r) for r in rows])
    else:
        for k in range(FOLDS):
            part = fitted(every[fold != k])
            for i in every[fold == k]:
                margins[i] = part.margin(rows[i])
        model = fitted(every)
    model.slope, model.shift = logistic_curve(margins, labels)
    return model


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str,
                  sample_rows: int, sample_bytes: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Indicators and labels of the sample: in the order of a hash of the id, as many rows as both
    bounds allow (one at least)."""
    agreed = labels.groupBy(F.col(label_id_col).alias("id")).agg(
        F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("other")).filter(
        "id IS NOT NULL AND label = other AND label IN (0, 1)").select("id", "label")
    rows = with_row_id(docs, F.col(id_col).alias("id"), F.octet_length(F.col(text_col).cast("string")).alias("size"))
    known = rows.filter(F.col("id").isNotNull() & ~held_out(F.col("id"))).join(agreed, "id")
    order = [F.xxhash64(F.col("id").cast("string")), F.col(ROW)]
    first = known.orderBy(*order).limit(sample_rows).select(ROW, "size", "label").collect()  # at most sample_rows
    chosen, total = [], 0
    for r in first:
        total += r["size"] or 0
        if chosen and total > sample_bytes:
            break
        chosen.append((r[ROW], r["label"]))
    if not chosen:
        return [], np.zeros(0, dtype=int)
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(chosen, f"{ROW} long, label int"))
    texts = with_row_id(docs, F.col(text_col).cast("string").alias("text")).join(wanted, ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [indicators(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("label"), pa.array([f.tobytes() for f in found], pa.binary())],
                names=[ROW, "label", "found"])

    table = texts.mapInArrow(run, f"{ROW} long, label int, found binary").toArrow().sort_by(ROW)
    return ([np.frombuffer(b, dtype=np.int32) for b in table.column("found").to_pylist()],
            table.column("label").to_numpy().astype(int))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
        sample_bytes: int = SAMPLE_BYTES, **options) -> Model:
    rows, known = training_rows(stable(docs), labels, id_col, text_col, label_id_col, label_col, sample_rows, sample_bytes)
    if len(set(known.tolist())) == 2:
        return train(rows, known, **options)
    ones = (known.sum() / len(known)) if len(known) else 0.5
    none = np.zeros(1 << BITS)
    return Model(none, none, 0.0, 1.0, float(np.log(max(ones, 1e-6) / max(1 - ones, 1e-6))))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  model: Model | None = None, threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``held_out``, ``score``, ``predicted`` (1 if the score
    reaches ``threshold``)."""
    docs = stable(docs)
    model = model or fit(docs, labels, id_col, text_col, **options)
    source = with_row_id(docs, F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"),
                         F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(indicators(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=[ROW, "id", "held_out", "score"])

    scored = source.mapInArrow(run, f"{ROW} long, id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
