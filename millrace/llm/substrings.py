"""Removal of word runs that repeat: a count-min sketch first, exact groups second.

A window is ``window`` consecutive words of one document. A word goes if a window over it also
starts earlier: in a smaller doc_id, or earlier in the same document.

1. Every window has an *anchor*, the least hash among its runs of ``window // 2`` words; equal
   windows have equal anchors. Slices of the table count their anchors in sketches, which are merged
   to one. Its count of the anchor is at least the window's count, at a sixth of the entries.
2. Windows whose anchor is estimated to occur once are done with. Of the others each slice
   settles its own repeats and deals its first occurrences out by window hash; the buckets group
   them exactly. A window met in a third of all documents is one entry per slice there.
3. Positions found to repeat go back to their documents, with the texts, by document.

Windows are compared by 88 bits of two hashes. The sketch is sized from the bytes of the table,
to ``max_bits`` at most; a larger table fills it more, which lets more windows through to the
second step and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ship, slices, spread
from millrace.llm.words import Words, joined, mix, scan, sliding_min, window_hashes

WINDOW = 20
ROWS = 2
MAX_BITS = 28
SLICE = 8 << 20
BUCKET_WINDOWS = 1 << 19
MARKS_HELD = 1 << 20
BYTES_PER_ANCHOR = 32
_SEEDS = np.array([0x51_7C_C1_B7_27_22_0A_95, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93], dtype=np.uint64)
_SEGMENT = 16
_LEAST = -(1 << 63)
_FIELDS = {"hash": "<u8", "check": "<u4", "doc": "<i8", "nth": "<i4", "start": "<i4"}


def pack(**fields: np.ndarray) -> bytes:
    """Arrays of one length as planes of bytes, which the shuffle's compression shrinks."""
    planes = [np.ascontiguousarray(v, dtype=_FIELDS[k]).view(np.uint8).reshape(len(v), -1).T for k, v in fields.items()]
    return np.concatenate(planes).tobytes()


def unpack(data: bytes, *names: str) -> dict[str, np.ndarray]:
    widths = [np.dtype(_FIELDS[k]).itemsize for k in names]
    planes = np.frombuffer(data, dtype=np.uint8).reshape(sum(widths), -1)
    out, at = {}, 0
    for name, width in zip(names, widths):
        out[name] = np.ascontiguousarray(planes[at : at + width].T).view(_FIELDS[name]).ravel()
        at += width
    return out


class Windows:
    """The windows of a slice: hash, anchor, owner and place of each."""

    def __init__(self, words: Words, window: int):
        hashes, half = words.hashes(), max(1, window // 2)
        owner = words.owner()
        self.parts = window_hashes(hashes, half)
        self.anchors = sliding_min(self.parts, window - half + 1)
        n = len(self.anchors)
        self.inside = owner[:n] == owner[window - 1 : window - 1 + n] if n else np.zeros(0, dtype=bool)
        self.owner, self.hashes, self.window, self.first = owner, hashes, window, words.first

    def anchor_places(self) -> np.ndarray:
        """The anchors of the inside windows, once for each place that is an anchor of one."""
        if not self.inside.any():
            return self.parts[:0]
        reach = self.window - max(1, self.window // 2) + 1
        held = np.zeros(len(self.parts) + reach - 1, dtype=np.uint64)
        held[reach - 1 : reach - 1 + len(self.anchors)] = np.where(self.inside, self.anchors, 0)
        most = ~sliding_min(~held, reach)
        return self.parts[(most == self.parts) & (most > 0)]


def cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(anchors ^ _SEEDS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            anchors = Windows(scan(part.column("text")), window).anchor_places()
            rows: list[tuple[int, int, bytes, bytes]] = []
            for row in range(ROWS):
                found, counts = np.unique(cells(anchors, row, bits), return_counts=True)
                segments, starts = np.unique(found >> _SEGMENT, return_index=True)
                for segment, a, b in zip(segments.tolist(), starts.tolist(), [*starts[1:].tolist(), len(found)]):
                    low = (found[a:b] & 0xFFFF).astype("<u2")
                    rows.append((row, segment, low.tobytes(), low[counts[a:b] > 1].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["row", "segment", "seen", "twice"],
                )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the counters of each segment, up to two; rows come sorted by segment."""
    counts, at = np.zeros(1 << _SEGMENT, dtype=np.uint8), None

    def done():
        bitmap = np.packbits(counts > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([bitmap])], names=["row", "segment", "bitmap"])

    for batch in batches:
        for row, segment, seen, twice in zip(*(c.to_pylist() for c in batch.columns)):
            if at != (row, segment):
                if at is not None:
                    yield done()
                counts[:], at = 0, (row, segment)
            for more in (seen, twice):
                places = np.frombuffer(more, dtype="<u2")
                counts[places] = np.minimum(counts[places] + 1, 2)
    if at is not None:
        yield done()


def _bitmaps(docs: DataFrame, window: int, bits: int) -> np.ndarray:
    """One bit per cell: was it counted twice or more? At most ``ROWS * 2**MAX_BITS / 8`` bytes."""
    n = spread(None, docs)
    merged = (
        docs.mapInArrow(lambda b: _sketch(b, window, bits), "row int, segment int, seen binary, twice binary")
        .repartition(n, "row", "segment")
        .sortWithinPartitions("row", "segment")
        .mapInArrow(_merge, "row int, segment int, bitmap binary")
    )
    out = np.zeros((ROWS, max(1 << bits, 1 << _SEGMENT) // 8), dtype=np.uint8)
    for row, segment, bitmap in merged.toLocalIterator():
        width = min(len(bitmap), out.shape[1])
        out[row, segment * width : (segment + 1) * width] = np.frombuffer(bitmap, dtype=np.uint8)[:width]
    return out


def _later(order: np.ndarray, same: tuple[np.ndarray, ...], doc: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Which entries, in the given order by group, doc, nth and start, have an earlier equal."""
    head = np.ones(len(order), dtype=bool)
    for column in same:
        sorted_column = column[order]
        head[1:] &= sorted_column[1:] == sorted_column[:-1]
    head = np.concatenate([[True], ~head[1:]]) if len(order) else head
    d, o = doc[order], nth[order]
    first_doc = d[np.flatnonzero(head)][np.cumsum(head) - 1] if len(order) else d
    repeat = np.zeros(len(order), dtype=bool)
    repeat[1:] = ~head[1:] & (d[1:] == d[:-1]) & (o[1:] == o[:-1])
    later = np.zeros(len(order), dtype=bool)
    later[order] = repeat | (d > first_doc)
    return later


def _bucket_rows(bucket: np.ndarray, fields: dict[str, np.ndarray], kind: int) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    ends = [*starts[1:].tolist(), len(order)]
    rows = [pack(**{k: v[order[a:b]] for k, v in fields.items()}) for a, b in zip(starts.tolist(), ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(found.astype(np.int32)), pa.array(np.full(len(found), kind, dtype=np.int8)), pa.array(rows, pa.binary())],
        names=["bucket", "kind", "entries"],
    )


def _doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _marks(doc, nth, start, buckets: int) -> pa.RecordBatch:
    return _bucket_rows(_doc_bucket(doc, buckets), {"doc": doc, "nth": nth, "start": start}, 0)


def _candidates(batches: Iterator[pa.RecordBatch], window: int, bits: int, buckets: int, sketch) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            found = Windows(scan(part.column("text")), window)
            chosen = np.flatnonzero(found.inside)
            anchors = found.anchors[chosen]
            for row in range(ROWS):
                cell = cells(anchors, row, bits)
                hit = (sketch.value[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
                chosen, anchors = chosen[hit], anchors[hit]
            if not len(chosen):
                continue
            owner = found.owner[chosen]
            doc, nth = (part.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("doc", "nth"))
            start = chosen - found.first[owner]
            hashes = window_hashes(found.hashes, window)[chosen]
            check = (mix(anchors ^ np.uint64(0xA5A5)) & np.uint64(0xFFFFFF)).astype(np.uint32)
            order = np.lexsort((start, nth, doc, check, hashes))
            later = _later(order, (hashes, check), doc, nth)
            if later.any():
                yield _marks(doc[later], nth[later], start[later], buckets)
            order = order[~later[order]]
            bucket = (hashes[order] >> np.uint64(40)).astype(np.int64) * buckets >> 24
            fields = {"hash": hashes[order], "check": check[order], "doc": doc[order], "nth": nth[order], "start": start[order]}
            yield _bucket_rows(bucket, fields, 1)


def _group(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Settle each bucket of candidates; rows come sorted by bucket. Marks pass through."""
    at, held, found, waiting = None, [], [], 0

    def settle() -> int:
        parts = [unpack(data, "hash", "check", "doc", "nth", "start") for data in held]
        f = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        order = np.lexsort((f["start"], f["nth"], f["doc"], f["check"], f["hash"]))
        later = _later(order, (f["hash"], f["check"]), f["doc"], f["nth"])
        found.append([f[k][later] for k in ("doc", "nth", "start")])
        return int(later.sum())

    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        if (kinds == 0).any():
            yield batch.filter(pa.array(kinds == 0)).select(["bucket", "kind", "entries"])
        own = batch.filter(pa.array(kinds == 1))
        for bucket, entries in zip(own.column("bucket").to_pylist(), own.column("entries").to_pylist()):
            if bucket != at:
                waiting += settle() if held else 0
                if waiting > MARKS_HELD:
                    yield _marks(*(np.concatenate(c) for c in zip(*found)), buckets)
                    found, waiting = [], 0
                at, held = bucket, []
            held.append(entries)
    waiting += settle() if held else 0
    if waiting:
        yield _marks(*(np.concatenate(c) for c in zip(*found)), buckets)


def covered_words(words: Words, texts: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in one of the windows that start at word ``starts`` of text ``texts``."""
    change = np.zeros(len(words.starts) + 1, dtype=np.int64)
    places = words.first[texts] + starts
    np.add.at(change, places, 1)
    np.add.at(change, places + window, -1)
    return np.cumsum(change[:-1]) > 0


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Texts without their covered words; in each bucket the marks come first."""
    at, held, marks = None, [], None
    for batch in batches:
        buckets, kinds = batch.column("bucket").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero((buckets[1:] != buckets[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            if b == a:
                continue
            if buckets[a] != at:
                at, held, marks = buckets[a], [], None
            rows = batch.slice(a, b - a)
            if kinds[a] == 0:
                held += rows.column("entries").to_pylist()
                continue
            if marks is None:
                parts = [unpack(data, "doc", "nth", "start") for data in held]
                marks = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for k in ("doc", "nth", "start")}
                order = np.lexsort((marks["start"], marks["nth"], marks["doc"]))
                marks, held = {k: v[order] for k, v in marks.items()}, []
            for part in slices(rows, "text", SLICE):
                words = scan(part.column("text"))
                doc, nth = (part.column(c).to_numpy() for c in ("doc", "nth"))
                texts, starts = [], []
                for i, (d, o) in enumerate(zip(doc.tolist(), nth.tolist())):
                    low, high = np.searchsorted(marks["doc"], [d, d + 1]) if d < (1 << 63) - 1 else (np.searchsorted(marks["doc"], d), len(marks["doc"]))
                    if high > low:
                        low, high = low + np.searchsorted(marks["nth"][low:high], [o, o + 1])
                        starts.append(marks["start"][low:high])
                        texts.append(np.full(high - low, i))
                covered = covered_words(words, *(np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64) for x in (texts, starts)), window)
                before = np.concatenate([[0], np.cumsum(~covered)])
                kept = joined(Words(words.data, words.starts[~covered], words.ends[~covered], before[words.first]))
                data = kept.data.tobytes()
                ends = [data[kept.starts[a] : kept.ends[b - 1]] if b > a else b"" for a, b in zip(kept.first[:-1].tolist(), kept.first[1:].tolist())]
                n_words = words.counts
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(doc), pa.array(nth), pa.array(n_words), pa.array(n_words - kept.counts), pa.array(ends, pa.binary()).cast(pa.string())],
                    names=["doc_id", "doc", "nth", "n_words", "n_removed", "kept"],
                )


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, text, doc, nth``: doc is the id (NULL: the least number), nth tells repeated ids apart."""
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST)).alias("doc"))
    repeated = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc")
    if not repeated.take(1):
        return rows.withColumn("nth", F.lit(0))
    by_text = Window.partitionBy("doc").orderBy(F.xxhash64("text"), "text")
    again = rows.join(repeated, "doc", "left_semi").withColumn("nth", F.row_number().over(by_text))
    return rows.join(repeated, "doc", "left_anti").withColumn("nth", F.lit(0)).unionByName(again)


def remove_repeats(docs: DataFrame, window: int = WINDOW, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` for every row; kept words are joined by one space.

    NULL and empty texts have no words; a text shorter than the window keeps all. NULL ids
    count as the least id. Rows that share an id are separate documents, none earlier than
    the other. An empty table gives no rows; further columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = _numbered(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(np.clip((2 * size // BYTES_PER_ANCHOR).bit_length(), 10, max_bits))
    partitions = spread(None, docs)
    buckets = max(2 * partitions, size // 6 // BUCKET_WINDOWS)
    sketch = spark.sparkContext.broadcast(_bitmaps(rows, window, bits))
    entries = "bucket int, kind tinyint, entries binary"
    marks = (
        rows.mapInArrow(lambda b: _candidates(b, window, bits, buckets, sketch), entries)
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(lambda b: _group(b, buckets), entries)
    )
    texts = rows.mapInArrow(
        lambda batches: (
            b.append_column("bucket", pa.array(_doc_bucket(b.column("doc").to_numpy(), buckets).astype(np.int32))) for b in batches
        ),
        rows.select("*", F.lit(0).alias("bucket")).schema,
    )
    both = texts.select("bucket", F.lit(1).cast("tinyint").alias("kind"), F.lit(None).cast("binary").alias("entries"), "doc_id", "doc", "nth", "text").unionByName(
        marks, allowMissingColumns=True
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        both.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "kind")
        .mapInArrow(lambda b: _remove(b, window), f"doc_id {kind}, doc bigint, nth int, n_words bigint, n_removed bigint, kept string")
        .drop("doc", "nth")
    )
