"""Word counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import tokens_batch, tokens_nonempty
from millrace.operators.running import BLOCK, ROWS_PER_BLOCK, Blocks

# Sizes blocks only, never results.
BYTES_PER_WORD = 6


def word_counts(
    lines: DataFrame, text: str = "text", tokens: Callable[[Column], Column] = tokens_batch
) -> DataFrame:
    """How often each token occurs; works on batch and streaming lines alike."""
    words = lines.select(F.explode(tokens(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_running_totals(
    lines: DataFrame, sequence: str, text: str = "text", rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """The new total of a word for each of its occurrences, in order of line and position.

    Large inputs are cut into ranges of lines, before these become words: a range's words are counted in their own task,
    and each word comes with its count in the ranges before. Lines are shuffled, their words are not.
    """
    lines = lines.select(F.col(sequence).alias("_line"), F.col(text).alias("_text"))
    n, size = lines.agg(F.count(F.lit(1)), F.sum(F.octet_length("_text"))).first()
    lines_per_block = max(1, n * rows_per_block * BYTES_PER_WORD // max(size or 0, 1))
    blocks = Blocks.plan(lines, [], ["_line"], lines_per_block)
    placed = blocks.assign(lines)
    tokens = tokens_nonempty(F.col("_text"))
    if not blocks.cuts:
        words = placed.select("_line", F.posexplode(tokens).alias("_pos", "word"))
        rows = words.withColumn("n", F.row_number().over(Window.partitionBy("word").orderBy("_line", "_pos")))
    else:
        counts = placed.select(BLOCK, F.explode(tokens).alias("word")).groupBy(BLOCK, "word").agg(F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy("word").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        before = counts.select(BLOCK, "word", F.sum("n").over(earlier).alias("_before")).where("_before is not null")
        # A count stands in the frame as a line of its own, of one word.
        own = placed.select(BLOCK, "_line", "_text", F.lit(None).cast("string").alias("_word"), F.lit(None).cast("bigint").alias("_before"))
        carried = before.select(BLOCK, F.lit(None).cast(lines.schema["_line"].dataType).alias("_line"), F.lit(None).cast("string").alias("_text"), F.col("word").alias("_word"), "_before")
        both = own.unionByName(carried).repartition(len(blocks.cuts) + 1, BLOCK)
        words = F.when(F.col("_before").isNull(), tokens).otherwise(F.array("_word"))
        exploded = both.select(BLOCK, "_line", "_before", F.posexplode(words).alias("_pos", "word"))
        within = Window.partitionBy("word", BLOCK).orderBy(F.col("_before").isNull(), "_line", "_pos").rowsBetween(Window.unboundedPreceding, 0)
        rows = exploded.withColumn("n", F.sum(F.coalesce("_before", F.lit(1))).over(within)).where("_before is null")
    return rows.select(F.col("_line").alias(sequence), F.col("_pos").alias("pos"), "word", F.col("n").cast("bigint").alias("n"))
