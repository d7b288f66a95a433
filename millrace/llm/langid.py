"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all rows to learn from. The weights are trained by follow-the-
regularised-leader with an elastic net on a bounded sample, whole texts, in one task; a part of the
sample is kept back to fit the temperature that calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_crc, ship, slices
from millrace.llm.grams import first_by_hash, gram_cells, letters, spaced

ORDERS, BITS = (1, 2, 3), 16
SAMPLE = 6_000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"
MIN_SCORE = 0.3


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    cells, counts = np.unique(gram_cells(spaced(text), ORDERS, BITS), return_counts=True)
    return cells, counts


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cells, counts = counts_of(text)
    values = (1 + np.log(counts)) * idf[cells]
    norm = np.sqrt((values**2).sum())
    return cells, values / norm if norm else values


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader; a weight is zero until its sum of gradients exceeds L1."""

    def __init__(self, size: int, classes: int):
        self.z, self.n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(self, cells) -> np.ndarray:
        z, n = self.z[cells], self.n[cells]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def step(self, cells, values, label: int) -> None:
        w = self.weights(cells)
        p = _softmax(values @ w)
        p[label] -= 1
        g = values[:, None] * p
        n = self.n[cells]
        self.z[cells] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[cells] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood on kept-back rows; one without rows."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean()
    return float(min(np.exp(np.linspace(np.log(0.05), np.log(5), 60)), key=loss))


def _train(batches: Iterator[pa.RecordBatch], idf: np.ndarray, classes: list[str]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            cells, values = weighted(text, idf)
            rows.append((np.append(cells, 1 << BITS), np.append(values, 1.0).astype(np.float64), classes.index(lang)))
    model = Ftrl((1 << BITS) + 1, len(classes))
    kept_back = rows[::5]
    learned = [r for i, r in enumerate(rows) if i % 5] or rows
    for _ in range(EPOCHS):
        for cells, values, label in learned:
            model.step(cells, values, label)
    weights = model.weights(slice(None))
    logits = np.array([values @ weights[cells] for cells, values, _ in kept_back]).reshape(len(kept_back), len(classes))
    heat = temperature(logits, np.array([label for *_, label in kept_back], dtype=np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()]), pa.array([heat])], names=["weights", "heat"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(1 << BITS, dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            for text in part.column("text").to_pylist():
                totals[np.unique(gram_cells(spaced(text), ORDERS, BITS))] += 1
    used = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["cell", "n"])


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    idf, weights, heat, classes = model.value
    for batch in batches:
        for part in slices(batch, "text"):
            names, scores = [], []
            for text in part.column("text").to_pylist():
                points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
                if not classes or not letters()[points].any():
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cells, values = weighted(text, idf)
                p = _softmax((values @ weights[cells] + weights[-1]) / heat)
                names.append(classes[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])


class LanguageModel:
    """Fitted on ``docs(doc_id, text, lang)``; rows with NULL id, text or lang are not learned from.

    Frequencies are of all rows, repeated ones included; the sample has one row per id, the least by text and
    lang. From an empty table nothing is learned, and every text is `und`.
    """

    def __init__(self, docs: DataFrame, sample: int = SAMPLE):
        spark = docs.sparkSession
        ship(spark)
        rows = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
        # The languages and the cells are few by nature; both are collected.
        sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        classes, total = sorted(sizes), sum(sizes.values())
        idf, weights, heat = np.zeros(1 << BITS), np.zeros(((1 << BITS) + 1, len(classes)), dtype=np.float32), 1.0
        if classes:
            found = rows.select("text").mapInArrow(_frequencies, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
            frequency = np.zeros(1 << BITS)
            for r in found:
                frequency[r.cell] = r.n
            idf = np.log((1 + total) / (1 + frequency)) + 1
            chosen = first_by_hash(rows.select("doc_id").distinct(), sample).withColumnRenamed("doc_id", "chosen")
            one = (
                rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"))
                .groupBy("doc_id")
                .agg(F.min(F.struct("text", "lang")).alias("first"))
                .select("doc_id", "first.text", "first.lang")
                .repartition(1)
                .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text")
                .mapInArrow(lambda b: _train(b, idf, classes), "weights binary, heat double")
                .first()
            )
            weights, heat = np.frombuffer(one.weights, dtype="<f4").reshape(-1, len(classes)), one.heat
        self.classes = classes
        self.shared = spark.sparkContext.broadcast((idf, weights, heat, classes))

    def predict(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, lang_pred, score)``: `und` and 0 for NULL or texts without a letter, or if nothing was learned."""
        shared, kind = self.shared, docs.schema["doc_id"].dataType.simpleString()
        return docs.select("doc_id", "text").mapInArrow(lambda b: _predict(b, shared), f"doc_id {kind}, lang_pred string, score double")


def held_out():
    return F.coalesce(id_crc() % 4 == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(id_crc() % 4 != 2)


def keep_identified(docs: DataFrame, model: LanguageModel, languages: list[str] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text is in one of ``languages`` (None: any that the model knows) with ``min_score`` or more.

    NULL texts and texts without letters are in none and go. The decision is made row by row beside
    the row itself, so no other column matters; an empty table stays empty.
    """
    shared, wanted = model.shared, set(model.classes if languages is None else languages)

    def keep(batches):
        for batch in batches:
            own: list[bool] = []
            for found in _predict([batch.select(["doc_id", "text"])], shared):
                own += [n in wanted and s >= min_score for n, s in zip(found.column("lang_pred").to_pylist(), found.column("score").to_pylist())]
            yield batch.filter(pa.array(own, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
