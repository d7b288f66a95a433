"""Hashed character n-grams, and the bounded samples that models are fitted on."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import mix


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def spaced(text: str) -> np.ndarray:
    """Lower-case code points with each run of other characters as one space, and one at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.where(letters()[points], points, 0x20)
    points = np.concatenate([[0x20], points, [0x20]]).astype(np.uint64)
    return points[np.concatenate([[True], (points[1:] != 0x20) | (points[:-1] != 0x20)])]


def gram_cells(points: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """The cell of every n-gram of each order, one after the other, repeats included."""
    out = []
    for n in orders:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + points[k : len(points) - n + 1 + k]
            out.append(mix(h) >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


def first_by_hash(ids: DataFrame, n: int) -> DataFrame:
    """At most ``n`` of the rows of ``ids(doc_id, ...)``, the same ones for any layout of the table."""
    return ids.orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id").limit(n)
