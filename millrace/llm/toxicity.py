"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The ratios come from all labelled rows to learn from: for each cell of n-grams, how much more
often it occurs in toxic texts than in others, as far as that is more than chance. The weights on the scaled features are
trained on a bounded sample, whole texts, half of it toxic as far as there are so many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_crc, ship, slices
from millrace.llm.grams import first_by_hash, gram_cells, spaced

ORDERS, BITS = (4, 5), 20
SAMPLE = 6_000
MIN_DEVIATIONS, SMOOTH = 3.7, 1.0
STEPS, L1, L2 = 300, 2e-4, 1e-5
THRESHOLD = 0.7


def cells_of(text: str | None) -> np.ndarray:
    return np.unique(gram_cells(spaced(text or ""), ORDERS, BITS))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                totals[int(toxic), cells_of(text)] += 1
    used = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[0, used]), pa.array(totals[1, used])], names=["cell", "clean", "toxic"])


def _train(batches: Iterator[pa.RecordBatch], ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            cells = cells_of(text)
            rows.append(cells[ratios[cells] != 0])
            labels.append(int(toxic))
    used, flat = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale, y = ratios[used], np.array(labels, dtype=np.float64)
    # The two classes weigh the same.
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    # Accelerated proximal gradient steps; the L1 part leaves out what other features explain.
    w, bias, w_ahead, bias_ahead, t = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0, 1.0
    weighted_squares = np.bincount(owner, (scale**2)[flat], minlength=len(rows)) + 1
    rate = 4.0 / float((weight * weighted_squares).sum())
    for _ in range(STEPS):
        margin = np.bincount(owner, (w_ahead * scale)[flat], minlength=len(rows)) + bias_ahead
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * weight
        stepped = w_ahead - rate * (np.bincount(flat, error[owner], minlength=len(used)) * scale + L2 * w_ahead)
        w_next = np.sign(stepped) * np.maximum(np.abs(stepped) - rate * L1, 0)
        bias_next, t_next = bias_ahead - rate * error.sum(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_ahead, bias_ahead = w_next + (t - 1) / t_next * (w_next - w), bias_next + (t - 1) / t_next * (bias_next - bias)
        w, bias, t = w_next, bias_next, t_next
    out = np.zeros(1 << BITS, dtype="<f4")
    out[used] = w * scale
    yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()]), pa.array([float(bias)])], names=["weights", "bias"])


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    weights, bias = model.value
    for batch in batches:
        for part in slices(batch, "text"):
            scores = []
            for text in part.column("text").to_pylist():
                cells = gram_cells(spaced(text or ""), ORDERS, BITS)
                own = np.unique(cells[weights[cells] != 0])
                margin = float(weights[own].sum()) + bias
                scores.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def learnable(labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic)`` of the labels to learn from, one per id; of conflicting labels toxic wins."""
    known = labels.where((id_crc() % 3 != 1) & F.col("toxic").isNotNull())
    return known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


class ToxicityModel:
    """Fitted on ``docs(doc_id, text)`` and the label rows of ``learnable``.

    NULL is an empty text. Labels without a document, or with a NULL id, are not used; of documents that
    share an id each is learned from, the first by text in the sample. With no labels of both kinds, as with empty tables, nothing is learned
    and every text scores one half.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
        spark = docs.sparkSession
        ship(spark)
        texts = docs.select("doc_id", "text")
        labels = labels.select("doc_id", "toxic")
        # Only labels whose document is there count, also in the sample.
        labels = labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        sizes = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        weights, bias = np.zeros(1 << BITS, dtype=np.float32), 0.0
        if sizes.get(0) and sizes.get(1):
            # Copies of a text count once.
            known = texts.join(labels, "doc_id")
            firsts = known.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
            counts = known.join(firsts, "doc_id", "left_semi").select("text", "toxic").mapInArrow(_counts, "cell bigint, clean bigint, toxic bigint")
            # At most 2**BITS rows.
            counts = counts.groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            counts = counts.where(F.col("clean") + F.col("toxic") > 1).toArrow()
            clean, toxic = (counts.column(c).to_numpy().astype(np.float64) for c in ("clean", "toxic"))
            ratio = np.log((toxic + SMOOTH) / (sizes[1] + 2 * SMOOTH)) - np.log((clean + SMOOTH) / (sizes[0] + 2 * SMOOTH))
            deviation = np.sqrt(1 / (toxic + SMOOTH) + 1 / (clean + SMOOTH))
            ratios = np.zeros(1 << BITS)
            ratios[counts.column("cell").to_numpy()] = np.where(np.abs(ratio) >= MIN_DEVIATIONS * deviation, ratio, 0)
            half = [first_by_hash(labels.where(F.col("toxic") == k), sample // 2) for k in (0, 1)]
            chosen = half[0].unionByName(half[1]).withColumnRenamed("doc_id", "chosen")
            one = (
                texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"))
                .groupBy("doc_id", "toxic")
                .agg(F.min("text").alias("text"))
                .repartition(1)
                .sortWithinPartitions("doc_id", "text")
                .mapInArrow(lambda b: _train(b, ratios), "weights binary, bias double")
                .first()
            )
            weights, bias = np.frombuffer(one.weights, dtype="<f4"), one.bias
        self.shared = spark.sparkContext.broadcast((weights, bias))

    def score(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, score)`` for every row, 0 to 1; without labels of both kinds all score one half."""
        shared, kind = self.shared, docs.schema["doc_id"].dataType.simpleString()
        return docs.select("doc_id", "text").mapInArrow(lambda b: _score(b, shared), f"doc_id {kind}, score double")


def held_out():
    return F.coalesce(id_crc() % 3 == 1, F.lit(False))
