"""Bounded feedback loops over DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rows import split_by
from millrace.session import durable

Body = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
Step = Callable[[Column], Column]


@dataclass(frozen=True)
class Loop:
    """``output`` left the loop; ``residue`` was still inside after the last round."""

    output: DataFrame
    residue: DataFrame
    rounds: int
    drained: bool


def iterate(df: DataFrame, body: Body, max_rounds: int) -> Loop:
    """Run ``body`` on what is fed back until nothing is, or for ``max_rounds`` rounds.

    ``body`` takes the rows inside the loop and returns those to feed back and those that
    leave. The fed-back rows are checkpointed each round, so a plan never grows with the
    number of rounds and a lost executor costs one round at most; rows that left are set
    aside and not read again.
    """
    active, outputs, rounds, drained = df, [], 0, False
    while rounds < max_rounds and not drained:
        feedback, output = body(active)
        outputs.append(output)
        active = durable(feedback)
        rounds += 1
        drained = active.isEmpty()
    output = reduce(DataFrame.unionByName, outputs) if outputs else df.limit(0)
    return Loop(output, active, rounds, drained)


def iterate_value(
    df: DataFrame, column: str, step: Step, done: Step, max_rounds: int, fuse: int = 250
) -> Loop:
    """The same for a body that only steps one value until ``done`` holds for it.

    ``fuse`` rounds run inside one expression and one job: a value that is done rests for
    the remaining ones. The expression has the same size for any ``fuse``.
    """

    def settled(value: Column) -> Column:
        return F.coalesce(done(value), F.lit(False))

    taken = 0

    def body(active: DataFrame) -> tuple[DataFrame, DataFrame]:
        nonlocal taken
        count = min(fuse, max_rounds - taken)
        taken += count
        # Rows fed back are not done, so all of them take the first step.
        moved = F.aggregate(
            F.sequence(F.lit(2), F.lit(count)) if count > 1 else F.array().cast("array<int>"),
            step(F.col(column)),
            lambda value, _: F.when(settled(value), value).otherwise(step(value)),
        )
        leaving, staying = split_by(active.withColumn(column, moved), settled(F.col(column)))
        return staying, leaving

    loop = iterate(df, body, max_rounds=-(-max_rounds // fuse))
    return Loop(loop.output, loop.residue, min(taken, max_rounds), loop.drained)


def increment_until_odd(df: DataFrame, column: str, max_rounds: int = 2) -> Loop:
    """Add one on entry; odd values leave, even ones go round unchanged and stay as residue."""
    entered = df.withColumn(column, F.col(column) + 1)

    def body(active: DataFrame) -> tuple[DataFrame, DataFrame]:
        even, odd = split_by(active, F.col(column) % 2 == 0)
        return even, odd

    return iterate(entered, body, max_rounds)


def countdown(df: DataFrame, column: str, max_rounds: int, fuse: int = 250) -> Loop:
    """Subtract one per round; values at or below zero leave."""
    return iterate_value(df, column, lambda v: v - 1, lambda v: v <= 0, max_rounds, fuse)
