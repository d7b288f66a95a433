"""SimHash fingerprints, linked within a bit distance by ball hashing that meets in the middle.

The 64 bits are dealt into ``blocks``. A pair within three bits has a block that takes up at
least one differing bit, or all its differing bits lie in one block. So with that block masked
at most two differing bits are left, and both sides reach a common value by one flip: every
fingerprint emits, for each mask, all values within half that radius, about 130 keys in place
of the 2,081 of the whole ball. Buckets are then linked without making pairs:

* first to the least fingerprint of the bucket, verified by the bit distance;
* buckets with a member too far from the least one, and not yet connected as a whole by the
  links so far, are dealt out once more by the masked block: a value and its one-bit variants share a place, and two members there, one of them
  unflipped, differ by at most 2 + 1 bits. Members with equal unmasked bits meet the same way
  within three bits of the block (one side one flip, the other two);
* only members that may have a partner are dealt out: a pair that differs in one masked bit agrees in a half of
  the block, one that differs in three agrees in a quarter.

Every link is between different fingerprints and verified; equal ones are one row from the
start. So a bucket of n fingerprints makes links in proportion to n, and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import numbered, ship, slices, spread, without, written
from millrace.llm.components import components
from millrace.llm.words import joined, scan

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = 3
TASK_PRINTS = 1 << 16
_PIECE = 1 << 16


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes; none: zero."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _PIECE):
        bits = np.unpackbits(hashes[at : at + _PIECE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        for part in slices(batch, "text"):
            found = joined(scan(part.column("text"), lower=True))
            data = found.data.tobytes()
            prints = []
            for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                last = max(low + 1, high - words + 1) if high > low else low
                starts = found.starts[low:last].tolist()
                ends = found.ends[min(low + words, high) - 1 : high].tolist() if high > low else []
                hashes = np.array([digest(data[a:b], SEED) for a, b in zip(starts, ends)], dtype=np.uint64)
                prints.append(fingerprint_of(hashes))
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            rest = [n for n in part.schema.names if n != "text"]
            yield part.select(rest).append_column("fp", pa.array(signed))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, *more: str) -> DataFrame:
    """``(doc_id, *more, fp)``: the 64-bit fingerprint as a signed number. NULL text has no words."""
    ship(docs.sparkSession)
    fields = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in ("doc_id", *more))
    return docs.select("doc_id", *more, "text").mapInArrow(lambda batches: _fingerprints(batches, words), f"{fields}fp bigint")


def block_bits(blocks: int) -> list[range]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [range(a, b) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def _flips(bits) -> Column:
    """No flip, then one of each bit."""
    return F.array(F.lit(0).cast("bigint"), *[F.lit(_mask([b])) for b in bits])


def _double_flips(bits) -> Column:
    bits = list(bits)
    return F.array(*[F.lit(_mask([a, b])) for i, a in enumerate(bits) for b in bits[i + 1 :]])


def _masked_keys(k: int, bits: range) -> Column:
    rest = [b for b in range(64) if b not in bits]
    keep, number = F.lit(_mask(rest)), F.lit(_signed(k << bits[0]))
    return F.transform(_flips(rest), lambda flip: F.col("fp").bitwiseXOR(flip).bitwiseAND(keep).bitwiseOR(number))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _parts(layout: list[range], n: int) -> list[Column]:
    """The masked block of a row's ``fp`` in ``n`` parts."""
    out = []
    for i in range(n):
        part = F.lit(0).cast("bigint")
        for k, bits in enumerate(layout):
            own = list(bits)[len(bits) * i // n : len(bits) * (i + 1) // n]
            part = F.when(F.col("block") == k, F.col("fp").bitwiseAND(F.lit(_mask(own)))).otherwise(part)
        out.append(part)
    return out


def _differ(column: str, *groups: Column | str) -> Column:
    """Does the column have several values in the row's group?"""
    group = Window.partitionBy(*groups)
    return F.min(column).over(group) != F.max(column).over(group)


def ball_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``(u, v)``, u > v, whose components are those of all distinct ``fp`` linked within ``max_bits``.

    ``max_bits`` is at most 3, and ``blocks`` at least 2: the scheme above is for these.
    """
    if not 0 <= max_bits <= 3 or blocks < 2:
        raise ValueError("ball hashing here is for up to three bits and at least two blocks")
    layout = block_bits(blocks)
    # The masked bits of a key are set to the number of the mask, which tells the masks apart.
    keyed = F.concat(*[_masked_keys(k, bits) for k, bits in enumerate(layout)])
    # A fingerprint becomes some hundred keys, so the few bytes that come in are dealt out first.
    tasks = max(spread(None, prints), prints.count() // TASK_PRINTS)
    spread_out = prints.repartition(tasks, "fp").select("fp", F.posexplode(keyed).alias("nth", "key"))
    bounds = np.cumsum([0] + [65 - len(bits) for bits in layout]).tolist()
    block = sum((F.when(F.col("nth") >= edge, 1).otherwise(0) for edge in bounds[1:-1]), F.lit(0))
    of_bucket = Window.partitionBy("block", "key")
    buckets = (
        spread_out.select(block.cast("tinyint").alias("block"), F.col("nth").isin(*bounds[:-1]).alias("same"), "key", "fp")
        .withColumn("least", F.min("fp").over(of_bucket))
        .withColumn("most", F.max("fp").over(of_bucket))
        .where("least <> most")
        .withColumn("bits", _distance(F.col("fp"), F.col("least")))
        .withColumn("widest", F.max("bits").over(of_bucket))
        .where((F.col("widest") > max_bits) | (F.col("fp") != F.col("least")))
        .drop("most")
    )
    buckets = written(buckets, "simhash-buckets")
    near = buckets.where((F.col("fp") != F.col("least")) & (F.col("bits") <= max_bits)).select(
        F.col("fp").alias("u"), F.col("least").alias("v")
    )
    # A bucket whose members the first links connect already has nothing to add.
    so_far = components(near, "simhash-near")
    apart = (
        buckets.where(F.col("widest") > max_bits)
        .select("block", "same", "key", "fp")
        .join(so_far.select(F.col("node").alias("fp"), "component"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
        .withColumn("several", _differ("component", "block", "key"))
        .where("several")
        .withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("block", "key", "component")))
        .withColumn("largest", F.max(F.struct("size", "component")).over(of_bucket)["component"])
    )
    # Two members a masked bit apart agree in one half of the masked block, twins in a part of max_bits + 1: who
    # agrees with no other component there has no partner left.
    crossed = F.lit(False)
    for part in _parts(layout, 2):
        crossed = crossed | _differ("component", "block", "key", part)
    twin = F.lit(False)
    for part in _parts(layout, max_bits + 1):
        twin = twin | _differ("component", "block", "key", "same", part)
    wide = (
        apart.withColumn("crossed", crossed)
        .withColumn("twin", F.col("same") & twin)
        .where("crossed or twin")
        # The largest component waits: the others' variants come to its members.
        .select("block", "crossed", "twin", (F.col("component") == F.col("largest")).alias("waits"), "key", "fp")
    )
    wide = written(wide, "simhash-wide")
    alone = F.array(F.lit(0).cast("bigint"))
    places = []
    for k, bits in enumerate(layout):
        inside = F.lit(_mask(bits))
        own = wide.where(F.col("block") == k)
        one = own.where("crossed").select("block", "key", F.lit(False).alias("far"), "fp", F.posexplode(F.transform(F.when(F.col("waits"), alone).otherwise(_flips(bits)), lambda f: F.col("fp").bitwiseXOR(f).bitwiseAND(inside))).alias("nth", "place"))
        places.append(one.withColumn("core", F.col("nth") == 0).drop("nth"))
        twins = own.where("twin")
        for flips, core in ((_flips(bits), True), (_double_flips(bits), False)):
            own = twins if core else twins.where(~F.col("waits"))
            reached = F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f).bitwiseAND(inside)))
            places.append(own.select("block", "key", F.lit(True).alias("far"), "fp", reached.alias("place"), F.lit(core).alias("core")))
    dealt = places[0]
    for more in places[1:]:
        dealt = dealt.unionByName(more)
    of_place = Window.partitionBy("block", "key", "far", "place")
    met = (
        dealt.withColumn("v", F.min(F.when(F.col("core"), F.col("fp"))).over(of_place))
        .where((F.col("v") != F.col("fp")) & (_distance(F.col("fp"), F.col("v")) <= max_bits))
        .select(F.col("fp").alias("u"), "v")
    )
    return (
        so_far.select(F.col("node").alias("u"), F.col("component").alias("v"))
        .where("u <> v")
        .unionByName(met)
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _components(prints: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """``(fp, component)`` of every fingerprint, with the least ``doc_id`` that has it."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "simhash-distinct")
    nodes = components(ball_links(distinct.select("fp"), max_bits, blocks), "simhash-components")
    return distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_doc", F.coalesce("component", "fp").alias("component")
    )


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: the least doc_id its fingerprint reaches.

    Texts that are NULL, empty or without words have fingerprint zero and are linked like any
    other. Rows with equal doc_id stay apart rows; NULL ids take part and are never a component
    id unless no member has an id. An empty table gives no rows.
    """
    prints = written(fingerprints(docs, words), "simhash-prints")
    grouped = _components(prints, max_bits, blocks)
    roots = grouped.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    labels = written(grouped.join(roots, "component").select("fp", "component_id"), "simhash-labels")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The documents without near copies: of each group one row stays, that of the least doc_id.

    Groups are of texts: rows that share an id are in as many groups as their texts. NULL ids come after all
    others, and of a group's rows with one id the first in the table stays. So every group keeps exactly one row, also
    the group of texts without words. An empty table stays empty; all columns are kept.
    """
    rows, row = numbered(docs)
    prints = written(fingerprints(rows, words, row).withColumnRenamed(row, "row"), "simhash-prints")
    labels = written(_components(prints, max_bits, blocks).select("fp", "component"), "simhash-labels")
    members = prints.join(labels, "fp").select("component", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row").alias("member"))
    firsts = members.groupBy("component").agg(F.min("member").alias("first"))
    gone = written(members.join(firsts, "component").where("member.row <> first.row").select(F.col("member.row").alias(row)), "simhash-gone")
    return without(rows, gone, row)
