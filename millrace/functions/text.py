"""Tokenisers for word counting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator pattern. Both the JVM and RE2 read \W as ASCII here.
SEPARATOR = r"\W+"


def tokens_batch(text: Column) -> Column:
    """Lower-case tokens, keeping a leading empty one and dropping trailing ones.

    Text made of separators only yields no token; the empty text yields one empty token.
    """

    def trimmed(parts: Column) -> Column:
        last = F.size(parts)
        # At most one empty token can stand at either end.
        keep = F.when((last == 1) | (F.get(parts, last - 1) != ""), last)
        keep = keep.when((last == 2) & (F.get(parts, F.lit(0)) == ""), 0).otherwise(last - 1)
        return F.slice(parts, 1, keep)

    # The one-element array binds the split text, so that it is split once.
    return F.get(F.transform(F.array(F.split(F.lower(text), SEPARATOR)), trimmed), F.lit(0))


def tokens_nonempty(text: Column) -> Column:
    """Lower-case tokens without any empty one (the continuous form)."""
    return F.array_remove(F.split(F.lower(text), SEPARATOR), "")
