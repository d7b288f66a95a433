"""Winnowed document fingerprints, and how they follow an edit.

The k-grams of a text's code points are hashed; of every ``window`` neighbouring grams the least
hash is kept, the rightmost of equals, with its position. Two texts that share ``window + gram - 1``
code points in a row share a kept hash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship, slices, spread
from millrace.llm.words import mix, sliding_min, window_hashes
from millrace.operators.running import BLOCK, Blocks

GRAM, WINDOW = 20, 100
_LOW = np.uint64(0xFFFFFFFF)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions. A text shorter than a gram is one gram; an empty one has none."""
    if not len(points):
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32)
    grams = window_hashes(mix(points.astype(np.uint64) + np.uint64(1)), min(gram, len(points)))
    # Of equal hashes the later position makes the lesser key.
    keys = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
    least = sliding_min(keys, min(window, len(keys)))
    kept = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return (kept >> np.uint64(32)).astype(np.uint32), (_LOW - (kept & _LOW)).astype(np.uint32)


def written_form(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Sixteen hex digits for each kept gram: hash, then position."""
    return np.stack([hashes, positions], axis=1).astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes over all hashes of both; two without any are alike."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - both
    return both / every if every else 1.0


class _Text:
    def __init__(self, doc_id, text):
        self.doc_id, self.points = doc_id, code_points(text)
        self.hashes, self.positions = winnow(self.points)


def _row(own: _Text, after: _Text) -> tuple:
    n = len(own.points)
    moved = n // 2
    edited = np.concatenate([own.points[: n - moved], after.points[:moved]]).astype("<u4")
    hashes, positions = winnow(edited)
    text = edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return (
        own.doc_id, n, hashlib.sha256(text).hexdigest(), written_form(own.hashes, own.positions), written_form(hashes, positions),
        likeness(own.hashes, hashes), likeness(own.hashes, after.hashes),
    )


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and order; a block ends with the first row of the next one."""
    block, before = None, None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for part in slices(batch, "text", 1 << 20):
            rows = []
            for at, ahead, doc_id, text in zip(*(part.column(c).to_pylist() for c in (BLOCK, "ahead", "doc_id", "text"))):
                if at != block:
                    block, before = at, None
                elif before is None:
                    continue  # more rows with the id of the next block's first
                own = _Text(doc_id, text)
                if before is not None:
                    rows.append(_row(before, own))
                before = None if ahead else own
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after it by descending doc_id, NULL ids last, equal ids by text;
    after the last comes the first. The rows are cut into ranges of ids, and each range also gets
    the first row of the next, so a document and its successor meet without a global order in one
    task. NULL is an empty text. One row is its own successor; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    partitions, total = spread(None, docs), rows.count()
    blocks = Blocks.plan(rows.select("doc_id"), (), ("doc_id",), max(50, math.ceil(total / (4 * partitions))))
    placed = blocks.assign(rows)
    # One row per block, of which the plan above bounds the number.
    heads = sorted(placed.groupBy(BLOCK).agg(F.max("doc_id").alias("head")).collect(), key=lambda r: r[BLOCK])
    targets = [(heads[i - 1].head, heads[i][BLOCK]) for i in range(len(heads))]
    heads_of = spark.createDataFrame(targets, f"head {kind}, target int") if targets else spark.createDataFrame([], f"head {kind}, target int")
    ahead = rows.join(F.broadcast(heads_of), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        F.col("target").alias(BLOCK), F.lit(1).alias("ahead"), "doc_id", "text"
    )
    return (
        placed.select(BLOCK, F.lit(0).alias("ahead"), "doc_id", "text")
        .unionByName(ahead)
        .repartition(partitions, BLOCK)
        .sortWithinPartitions(BLOCK, "ahead", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
        .mapInArrow(
            _pairs,
            f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
        )
    )
