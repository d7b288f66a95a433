"""Running aggregates over an order, without one task per key.

A window with no partition key, or with one very frequent key, puts an unbounded number
of rows in a single task. Here such rows are cut into *blocks*: contiguous ranges of
(keys, order) of about equal size. Each block is aggregated on its own, and what came
before the block within the same key is carried in.

Only the first key of a block can have rows in an earlier block, so there is at most one
carry row per block. The carry table is therefore never larger than ``max_blocks`` rows,
whatever the data, and is broadcast. The rows themselves are shuffled once.

Cut points come from a bounded sample. They decide only how even the blocks are; the
results are exact for any cut points.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import epoch_us

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 8_192
SAMPLES_PER_BLOCK = 16
BLOCK = "_block"


@dataclass(frozen=True)
class Agg:
    """One running aggregate: ``sum``, ``count``, ``min``, ``max`` or ``last``.

    All ignore NULL. ``last`` is the latest non-NULL value in the order.
    """

    kind: str
    value: Column

    def over(self, window) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        return getattr(F, self.kind)(self.value).over(window)

    def total(self, order: Column) -> Column:
        """The aggregate of a whole block."""
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), order))
        return getattr(F, self.kind)(self.value)

    def carry_over(self, name: str, window) -> Column:
        """The aggregate of all earlier blocks, from their totals."""
        if self.kind == "last":
            return F.last(name, ignorenulls=True).over(window)
        kind = "sum" if self.kind == "count" else self.kind
        return getattr(F, kind)(name).over(window)

    def join(self, carry: Column, local: Column) -> Column:
        if self.kind == "count":
            return F.coalesce(carry, F.lit(0)) + local
        if self.kind == "sum":
            return F.coalesce(carry + local, carry, local)
        if self.kind == "last":
            return F.coalesce(local, carry)
        return (F.greatest if self.kind == "max" else F.least)(carry, local)


def running_sum(value: Column) -> Agg:
    return Agg("sum", value)


def running_count(value: Column | None = None) -> Agg:
    return Agg("count", F.lit(1) if value is None else value)


def running_max(value: Column) -> Agg:
    return Agg("max", value)


def running_min(value: Column) -> Agg:
    return Agg("min", value)


def running_last(value: Column) -> Agg:
    return Agg("last", value)


def _comparable(df: DataFrame, name: str) -> Column:
    """Time columns as microseconds, so cut points survive a trip through JSON."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_us(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(name)
    return F.col(name)


def _position(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.struct(*[_comparable(df, c).alias(f"p{i}") for i, c in enumerate(columns)])


@dataclass(frozen=True)
class Blocks:
    """How the rows of one frame are cut. ``cuts`` is empty when no key needs cutting."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: tuple[str, ...]
    cut_type: T.StructType

    @classmethod
    def plan(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        rows_per_block: int = ROWS_PER_BLOCK,
        max_blocks: int = MAX_BLOCKS,
    ) -> Blocks:
        """Size the groups and pick cut points; runs one small job, or two when cutting.

        ``order`` must be a total order within a key.
        """
        keys, order = tuple(keys), tuple(order)
        position = _position(df, keys + order)
        cut_type = df.select(position.alias("p")).schema["p"].dataType
        if keys:
            sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
        else:
            total = largest = df.count()
        total, largest = total or 0, largest or 0
        target = max(rows_per_block, math.ceil(total / max_blocks))
        if largest <= target:
            return cls(keys, order, (), cut_type)

        blocks = math.ceil(total / target)
        wanted = blocks * SAMPLES_PER_BLOCK
        points = (
            df.select(position.alias("p"))
            .sample(min(1.0, wanted / total), seed=7)
            .limit(2 * wanted)
            .orderBy("p")
            .select(F.to_json("p", {"ignoreNullFields": "false"}).alias("p"))
        )
        sampled = [row.p for row in points.collect()]
        step = max(1, len(sampled) // blocks)
        cuts = tuple(dict.fromkeys(sampled[step::step]))[: max_blocks - 1]
        return cls(keys, order, cuts, cut_type)

    def _cut_literal(self) -> Column:
        listed = "[" + ",".join(self.cuts) + "]"
        return F.from_json(F.lit(listed), T.ArrayType(self.cut_type))

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the block number: how many cut points are at or below the row (binary search).

        Each probe is a projection of its own. Chained like this they stay inside generated
        code, and none is evaluated twice.
        """
        placed = df.withColumn(BLOCK, F.lit(0))
        if not self.cuts:
            return placed
        cuts = self._cut_literal()
        here = _position(df, self.keys + self.order).cast(self.cut_type)
        placed = placed.withColumn("_here", here)
        stride = 2 ** int(math.log2(len(self.cuts)))
        while stride:
            reached = F.get(cuts, F.col(BLOCK) + (stride - 1)) <= F.col("_here")
            placed = placed.withColumn(BLOCK, F.col(BLOCK) + F.when(reached, stride).otherwise(0))
            stride //= 2
        return placed.drop("_here")

    def _same_key(self, left: DataFrame, right: DataFrame) -> list[Column]:
        return [left[k].eqNullSafe(right[f"_c_{k}"]) for k in self.keys]

    def _cut_keys(self, df: DataFrame) -> DataFrame:
        """Rows of the keys a cut point falls in; no other key spans two blocks."""
        if not self.keys:
            return df
        spark = df.sparkSession
        spanning = spark.createDataFrame([(c,) for c in self.cuts], "c string").select(
            F.from_json("c", self.cut_type).alias("c")
        )
        spanning = spanning.select(
            *[F.col(f"c.p{i}").alias(f"_k{i}") for i in range(len(self.keys))]
        ).distinct()
        match = [_comparable(df, k).eqNullSafe(spanning[f"_k{i}"]) for i, k in enumerate(self.keys)]
        return df.join(F.broadcast(spanning), reduce(lambda a, b: a & b, match), "left_semi")

    def _spread(self, df: DataFrame) -> DataFrame:
        """As many partitions as blocks where the session would use fewer.

        The window below needs this very partitioning, so the rows still move only once.
        """
        blocks = len(self.cuts) + 1
        if blocks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            return df
        return df.repartition(blocks, *self.keys, BLOCK)

    def running(
        self, df: DataFrame, aggs: Mapping[str, Agg], inclusive: bool = True, spread: bool = True
    ) -> DataFrame:
        """Append running aggregates to an assigned frame.

        With ``inclusive=False`` a row sees only the rows before it. ``spread=False`` is for a
        frame that an earlier call has partitioned already.
        """
        taken = set(aggs) & set(df.columns)
        if taken:
            raise ValueError(f"columns exist already: {sorted(taken)}")
        within = Window.partitionBy(*self.keys, BLOCK) if self.cuts else Window.partitionBy(*self.keys)
        within = within.orderBy(*self.order).rowsBetween(
            Window.unboundedPreceding, 0 if inclusive else -1
        )
        local = {name: agg.over(within) for name, agg in aggs.items()}
        if not self.cuts:
            return df.withColumns(local)

        order = _position(df, self.order)
        totals = (
            self._cut_keys(df)
            .groupBy(*self.keys, BLOCK)
            .agg(*[agg.total(order).alias(name) for name, agg in aggs.items()])
        )
        # One row per block of a spanning key: at most max_blocks of them in all.
        before = Window.partitionBy(*self.keys).orderBy(BLOCK)
        earlier = before.rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            totals.withColumn("_nth", F.row_number().over(before))
            .select(
                "_nth",
                F.col(BLOCK).alias("_c_block"),
                *[F.col(k).alias(f"_c_{k}") for k in self.keys],
                *[agg.carry_over(name, earlier).alias(f"_c_{name}") for name, agg in aggs.items()],
            )
            .where("_nth > 1")
        )
        rows = self._spread(df) if spread else df
        local_df = rows.withColumns({f"_l_{name}": column for name, column in local.items()})
        match = [local_df[BLOCK] == carry["_c_block"], *self._same_key(local_df, carry)]
        joined = local_df.join(F.broadcast(carry), reduce(lambda a, b: a & b, match), "left")
        return joined.select(
            *[F.col(c) for c in df.columns],
            *[
                agg.join(F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name)
                for name, agg in aggs.items()
            ],
        )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: Mapping[str, Agg],
    inclusive: bool = True,
    rows_per_block: int = ROWS_PER_BLOCK,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """Running aggregates of ``df`` per key in the given total order."""
    blocks = Blocks.plan(df, keys, order, rows_per_block, max_blocks)
    return blocks.running(blocks.assign(df), aggs, inclusive).drop(BLOCK)
