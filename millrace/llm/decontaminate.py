"""Benchmark decontamination with column functions only: n-gram windows against a hash set.

The number of the benchmark's windows is checked. Up to ``max_literals`` they become a constant hash
set inside the scan's filter, so every executor has it and no window row is made; up to
``max_broadcast`` they are broadcast as a table of hashes that the documents' window hashes are
looked up in, without a shuffle; beyond, both sides' hashes meet in a shuffle. Texts stay where
they are. Hits are then verified word for word.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import numbered, without, written

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
MAX_LITERALS = 50_000
# 16 bytes each.
MAX_BROADCAST = 1 << 23


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, WORD_BREAK), "")


def _hash_at(at: Column, width: int, hashes: str) -> Column:
    return F.xxhash64(*[F.get(F.col(hashes), at + k) for k in range(width)])


def _ends_at(at: Column, width: int, hashes: str) -> Column:
    """A cheap value of a window's first and last word, looked up before the whole window is hashed."""
    return F.shiftleft(F.get(F.col(hashes), at), 1).bitwiseXOR(F.get(F.col(hashes), at + (width - 1)))


def _starts(width: int, hashes: str) -> Column:
    last = F.size(hashes) - width
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _window_words(at: Column, width: int) -> Column:
    return F.array_join(F.transform(F.sequence(at, at + (width - 1)), lambda j: F.get("words", j)), " ")


def _tokenised(texts: DataFrame) -> DataFrame:
    return texts.withColumn("words", words_of(F.col("text"))).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, width, words, hash, ends)``, distinct. Items without id or words have none."""
    items = _tokenised(benchmark.select("item_id", "text").where("item_id is not null"))
    out = None
    for width in range(1, window + 1):
        own = items.where(F.size("words") == width if width < window else F.size("words") >= width)
        rows = own.select("item_id", "words", "hashes", F.explode(_starts(width, "hashes")).alias("at")).select(
            "item_id",
            F.lit(width).alias("width"),
            _window_words(F.col("at"), width).alias("window_words"),
            _hash_at(F.col("at"), width, "hashes").alias("hash"),
            _ends_at(F.col("at"), width, "hashes").alias("ends"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out.withColumnRenamed("window_words", "words").distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_literals: int = MAX_LITERALS, max_broadcast: int = MAX_BROADCAST) -> tuple[DataFrame, DataFrame]:
    """``(row, doc_id, n_words)`` of every document, and the verified hits ``(row, at, width, item_id)``.

    ``docs`` may have a ``row`` that numbers its rows; else they are numbered here.
    """
    items = written(item_windows(benchmark, window), "decontaminate-items")
    sizes = {r.width: r.n for r in items.groupBy("width").agg(F.count_distinct("hash").alias("n")).collect()}
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id()
    tokens = _tokenised(docs.select("doc_id", "text", row.alias("row")))
    found = F.array().cast("array<struct<at:int,width:int,words:string>>")
    literal = sum(sizes.values()) <= max_literals
    for width in sorted(sizes) if literal else []:
        own = items.where(F.col("width") == width).select("hash", "ends").collect()
        hashes, ends = [sorted({r[k] for r in own}) for k in (0, 1)]
        places = _places(width, hashes, ends)
        found = F.concat(found, _named(places, width))
    if literal:
        scanned = written(tokens.select("row", "doc_id", F.size("words").cast("bigint").alias("n_words"), found.alias("found")), "decontaminate-scan")
        candidates = scanned.select("row", F.inline("found"))
    else:
        # Row numbers must not change when the scan is repeated, so the tokens are written.
        tokens = written(tokens.drop("text"), "decontaminate-tokens")
        scanned = tokens.select("row", "doc_id", F.size("words").cast("bigint").alias("n_words"))
        met = None
        for width in sorted(sizes):
            known = items.where(F.col("width") == width).select("hash").distinct()
            every = tokens.select("row", "hashes", F.explode(_starts(width, "hashes")).alias("at"))
            every = every.select("row", "at", F.lit(width).alias("width"), _hash_at(F.col("at"), width, "hashes").alias("hash"))
            own = every.join(F.broadcast(known) if sizes[width] <= max_broadcast else known, "hash", "left_semi").drop("hash")
            met = own if met is None else met.unionByName(own)
        if met is None:
            met = tokens.select("row", F.lit(0).alias("at"), F.lit(0).alias("width")).limit(0)
        # Few rows have hits; only these meet their words again.
        places = met.groupBy("row").agg(F.collect_set(F.struct("at", "width")).alias("places"))
        candidates = tokens.select("row", F.col("words").alias("all")).join(places, "row").select("row", "all", F.inline("places"))
        found_words = F.array_join(F.transform(F.sequence(F.col("at"), F.col("at") + F.col("width") - 1), lambda j: F.get("all", j)), " ")
        candidates = candidates.select("row", "at", "width", found_words.alias("words"))
    hits = candidates.join(items.select("item_id", "width", "words"), ["width", "words"]).select("row", "at", "width", "item_id")
    return scanned.select("row", "doc_id", "n_words"), written(hits, "decontaminate-hits")


def _places(width: int, hashes: list[int], ends: list[int]) -> Column:
    return F.filter(
        _starts(width, "hashes"),
        lambda at: _ends_at(at, width, "hashes").isin(ends) & _hash_at(at, width, "hashes").isin(hashes),
    )


def _named(places: Column, width: int) -> Column:
    return F.transform(places, lambda at: F.struct(at.alias("at"), F.lit(width).alias("width"), _window_words(at, width).alias("words")))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_literals: int = MAX_LITERALS, max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, contaminated)`` for every row of ``docs``.

    ``items`` lists the item ids, as sorted text. NULL and empty texts have no words. A repeated
    row is judged like the first, repeated item ids are one item, and items with NULL id or
    text take no part. Empty tables give no rows or no hits.
    """
    scanned, hits = find_hits(docs.select("doc_id", "text"), benchmark, window, max_literals, max_broadcast)
    places = hits.select("row", "at", "width").distinct().select("row", F.explode(F.expr("sequence(at, at + width - 1)")).alias("place"))
    covered = places.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    items = hits.select("row", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    none = F.array().cast("array<string>")
    return (
        scanned.join(covered, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_literals: int = MAX_LITERALS) -> DataFrame:
    """The documents without those that hold a benchmark passage.

    Every row is judged by its own text, whatever its id; NULL texts stay. An empty table, or a
    benchmark without words, changes nothing. All columns are kept.
    """
    rows, row = numbered(docs)
    _, hits = find_hits(rows.select("doc_id", "text", F.col(row).alias("row")), benchmark, window, max_literals)
    return without(rows, hits.select(F.col("row").alias(row)).distinct(), row)
