"""Shards of near equal bytes by histogram sort, with column functions only.

Rows are ordered by a key, the digest of the text and then that of the id, so equal texts are
neighbours and yet any number of them can be cut. The splitters between shards are found by probing: the exact
bytes and rows below candidate keys are counted over all partitions, and each round puts new
probes, one per further digit of the key, between the two probes around a splitter's
target. A splitter is settled where a single key is left between its probes, or within the tolerance;
it stands at the boundary nearest to its target. So a shard is off by half a row at each end, however
rows are distributed. Only the counts between the last probes travel; the rows are
exchanged once, when all splitters are known.

A shard is many tasks: its rows are dealt into pieces by their id's digest, and the rows that earlier
pieces of the shard hold are counted before the exchange, so slots have no gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import forget, free_name, written

DIGITS = 3
PIECE_BYTES = 256 << 20
ROW_BYTES = 8


def key_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """32 hexadecimal digits of the text's MD5, then as many of the id's; NULL is like an empty text."""
    digest = lambda name: F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))
    return F.concat(digest(text), digest(doc_id))


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def _histogram(keyed: DataFrame, cells: list[str] | None, digits: int) -> dict[str, list]:
    """Bytes, rows, least and greatest key per longer prefix, below each of the given cells; at most 4,096 for each."""
    rows = keyed
    if cells is not None:
        rows = rows.where(F.substring("key", 1, digits - DIGITS).isin(cells))
    found = rows.groupBy(F.substring("key", 1, digits).alias("cell")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("first"), F.max("key").alias("last")
    )
    return sorted(found.collect(), key=lambda r: r.cell)


def find_splitters(keyed: DataFrame, shards: int, tolerance: float = 0.0) -> tuple[list[str], int]:
    """The ``shards - 1`` keys that start a new shard, in order, and the rows of the largest group of one key met at a splitter.

    ``keyed`` has a ``key`` of one length and a ``size``. ``tolerance`` is a share of a shard's bytes. The splitter
    stands at the boundary nearest to its share of all bytes, the lower of two.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    # A target and the open cell around it: (bytes below the cell, the cell's prefix).
    open_: dict[int, tuple[int, str]] = {i: (0, "") for i in range(1, shards)} if total else {}
    chosen, widest, digits = {i: "~" for i in range(1, shards)}, 0, 0
    near = tolerance * total / shards
    while open_:
        digits += DIGITS
        cells = sorted({cell for _, cell in open_.values()})
        below_cell = {cell: below for below, cell in open_.values()}
        children: dict[str, list] = {}
        for r in _histogram(keyed, None if cells == [""] else cells, digits):
            children.setdefault(r.cell[: digits - DIGITS], []).append(r)
        still = {}
        for i, (_, cell) in open_.items():
            at, off = below_cell[cell], lambda b: abs(shards * b - i * total)
            for r in children[cell]:
                if shards * (at + r.bytes) >= i * total:
                    break
                at += r.bytes
            start, end = (off(at), r.first), (off(at + r.bytes), r.last + "~")
            best = min(start, end, key=lambda x: x[0])
            if r.first == r.last or best[0] <= near * shards:
                chosen[i] = best[1]
                widest = max(widest, r.rows if r.first == r.last else 0)
            else:
                still[i] = (at, r.cell)
        open_ = still
    return [chosen[i] for i in range(1, shards)], widest


def shard_of(key: Column, splitters: list[str]) -> Column:
    return sum(((key >= F.lit(s)).cast("int") for s in splitters), F.lit(0))


def shards(docs: DataFrame, n: int, tolerance: float = 0.0, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` with ``size``, ``shard`` from 0 to n - 1 and ``slot`` in the shard.

    A row's size is its text's UTF-8 bytes plus 8; a NULL text has none. Shards differ in bytes by no more
    than a row at either end, so with rows larger than a shard some stay small or empty. Slots run from 0
    without gaps, by piece and key. Rows that repeat an id and a text have one key and stay together,
    unless a splitter falls among more of them than one: then rows are numbered first, and their number
    extends the key. Columns of ``docs`` with the new names are replaced by them. An empty table gives no rows.
    """
    names = ("key", "size", "shard", "slot", "piece", "base", "nth")
    key, size, shard, slot, piece, base, nth = (free_name(docs, f"shard_{name}") for name in names)
    rows, numbered = docs, None
    keyed = written(rows.select(key_of().alias("key"), size_of().alias("size")), "shard-keys")
    splitters, widest = find_splitters(keyed, n, tolerance)
    if widest > 1:
        forget(keyed)
        numbered = written(docs.withColumn(nth, F.monotonically_increasing_id()), "shard-rows")
        rows = numbered
        long_key = F.concat(key_of(), F.lpad(F.hex(nth), 16, "0"))
        keyed = written(rows.select(long_key.alias("key"), size_of().alias("size")), "shard-keys")
        splitters, _ = find_splitters(keyed, n, tolerance)
    else:
        long_key = key_of()
    total = keyed.agg(F.sum("size")).first()[0] or 0
    pieces = max(1, -(-total // (n * piece_bytes)))
    piece_of = lambda column: F.pmod(F.xxhash64(F.substring(column, 33, 48)), F.lit(pieces))
    counted = keyed.groupBy(shard_of(F.col("key"), splitters).alias(shard), piece_of(F.col("key")).alias(piece)).agg(F.count(F.lit(1)).alias(nth))
    earlier = Window.partitionBy(shard).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    bases = written(counted.select(shard, piece, F.coalesce(F.sum(nth).over(earlier), F.lit(0)).alias(base)), "shard-pieces")
    forget(keyed)
    placed = rows.drop(nth) if numbered is None else rows
    placed = placed.withColumn(key, long_key).withColumn(size, size_of())
    placed = placed.withColumn(shard, shard_of(F.col(key), splitters)).withColumn(piece, piece_of(F.col(key)))
    in_piece = Window.partitionBy(shard, piece).orderBy(key)
    placed = placed.withColumn(slot, F.row_number().over(in_piece).cast("bigint"))
    kept = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    return placed.join(bases, [shard, piece]).select(
        *kept, F.col(size).alias("size"), F.col(shard).alias("shard"), (F.col(base) + F.col(slot) - 1).alias("slot")
    )
