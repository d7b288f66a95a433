"""Running totals of words over cut lines."""

import random

from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.text import tokens_nonempty
from millrace.operators import words
from millrace.operators.running import Blocks


def test_lines_are_cut_before_they_become_words(spark, monkeypatch):
    rng = random.Random(5)
    lines = [(rng.choice([None, *range(60)]), " ".join(rng.choice("aaabbcd") for _ in range(rng.randrange(9))) or None) for _ in range(80)]
    lines = spark.createDataFrame([*lines, (3, "a a b"), (3, "a a b"), (61, "seen once")], "i bigint, text string")
    # Lines that share a number stand in no order among themselves, so each number has one text here.
    lines = lines.join(lines.groupBy(F.col("i").alias("j")).agg(F.min("text").alias("t")), F.expr("i <=> j")).select("i", F.col("t").alias("text"))
    planned, plan = [], Blocks.plan.__func__

    def seen(cls, df, *more):
        out = plan(cls, df, *more)
        planned.append((df.columns, len(out.cuts)))
        return out

    monkeypatch.setattr(Blocks, "plan", classmethod(seen))
    got = words.word_running_totals(lines, "i", rows_per_block=20)
    (columns, cuts), = planned
    assert "word" not in columns and cuts > 3
    each = lines.select("i", F.posexplode(tokens_nonempty(F.col("text"))).alias("pos", "word"))
    want = each.withColumn("n", F.row_number().over(Window.partitionBy("word").orderBy("i", "pos")).cast("bigint"))
    assert got.dtypes == want.dtypes and rows(got) == rows(want)


def test_no_lines_have_no_words(spark):
    assert words.word_running_totals(spark.createDataFrame([], "i int, text string"), "i").isEmpty()
