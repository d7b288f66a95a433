"""Phrase collocations by best-first growth, with bounds from prefix counts.

A phrase of words w1 .. wk is scored by its worst cut, ``floor(1000 * a * n / (l * r))`` where a, l and r
count the phrase and its two parts and n all words of the language. Two bounds cut the search:

* Whatever starts with w1 has a cut after it, with l = f(w1) and r >= a. So it scores at most
  ``floor(1000 * n / f(w1))``, and the frontier of first words is grown from the rarest on.
* The last cut of a grown phrase has l = f(w1 .. wk-1), known from its own growth, and r = f(wk). Its score
  is at least the phrase's.

Each round grows a block of the frontier: the pairs that start with its words, then all longer
phrases that start with a frequent pair. A phrase below the least count has no extension above it, so
frequent pairs are all that grow. Of what may still reach the best so far, the other cuts' parts
and the neighbours to the left are counted, which gives the scores and drops a phrase that
never occurs but within a longer one. A language is settled when its ``top``-th score is above the bound of all
that is left of its frontier; a tie is not above.

Counts are of the words themselves, never of hashes. A round's words and phrases are broadcast,
``block`` of them at most; all else are tables. Rounds grow until they reach that size.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import forget, ship, slices, written

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
NO_LANGUAGE = "und"
FIRST_BLOCK, BLOCK = 1 << 15, 1 << 19
BINS = 8  # to each doubling of a count
SLICE = 6 << 20
_END = b"."  # ends a piece; never part of a word
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz .........")


def _chunks(data: bytes, limit: int) -> Iterator[bytes]:
    """The text in runs of whole pieces of about ``limit`` bytes; a longer piece is a run of its own."""
    at = 0
    while at < len(data):
        to = len(data)
        if to - at > limit:
            to = data.rfind(_END, at, at + limit) + 1
            if not to:
                to = data.find(_END, at + limit) + 1 or len(data)
        yield data[at:to]
        at = to


def word_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """``(lang, words)`` of runs of ``(lang, text)`` rows; a piece ends with the word ``.``, also each text."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            texts = part.column("text").cast(pa.binary())
            langs = part.column("lang").dictionary_encode()
            number = langs.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.filter(pa.array(number == k)).drop_null().to_pylist()
                for run in _chunks(_END.join(own).translate(_FOLD), SLICE):
                    yield lang, run.replace(_END, b" . ").split()


def _counted(lang: str, phrases, counts) -> pa.RecordBatch:
    phrases = pa.array(phrases, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrases), dtype=np.int64))), phrases, pa.array(counts, pa.int64())], names=["lang", "phrase", "n"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words in word_runs(batches):
        found = Counter(words)
        found.pop(_END, None)
        # The empty word carries the number of all.
        yield _counted(lang, [b"", *found], [sum(found.values()), *found.values()])


class Run:
    """The words of a run as numbers; the end of a piece is zero."""

    def __init__(self, words: list[bytes]):
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[_END]  # the first is zero
        self.at = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        self.names = pa.array(list(numbers), pa.binary())

    def grow(self, admitted: list[pa.Array | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
        """Phrases of 2, 3, .. words that start with an admitted phrase of each shorter length; None admits all.

        Yields (length, starts, which phrase at each, the phrases, their counts).
        """
        size = len(self.names)
        known = pc.is_in(self.names, value_set=admitted[0]).to_numpy(zero_copy_only=False).copy()
        known[0] = False
        starts = np.flatnonzero(known[self.at])
        which, phrases = self.at[starts], self.names
        for length in range(2, len(admitted) + 2):
            ends = starts + (length - 1)
            fits = ends < len(self.at)
            starts, which, ends = starts[fits], which[fits], ends[fits]
            nexts = self.at[ends]
            inside = nexts > 0
            starts, key = starts[inside], which[inside] * size + nexts[inside]
            found, which, counts = np.unique(key, return_inverse=True, return_counts=True)
            before, last = np.divmod(found, size)
            phrases = pc.binary_join_element_wise(phrases.take(pa.array(before)), self.names.take(pa.array(last)), b" ")
            yield length, starts, which, phrases, counts
            if length <= len(admitted) and admitted[length - 1] is not None:
                good = pc.is_in(phrases, value_set=admitted[length - 1]).to_numpy(zero_copy_only=False)
                kept = good[which]
                starts, which = starts[kept], which[kept]


def _grown(batches: Iterator[pa.RecordBatch], block, shortest: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of ``shortest`` words and more that the block's words or pairs grow into."""
    for lang, words in word_runs(batches):
        admitted = block.value.get(lang)
        if admitted is not None:
            for length, _, _, phrases, counts in Run(words).grow(admitted):
                if length >= shortest:
                    yield _counted(lang, phrases, counts)


def _sought(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    """Counts of sought phrases, and of some by the word before, which is empty at the start of a piece. NULL is any word."""
    for lang, words in word_runs(batches):
        sought = block.value.get(lang)
        if sought is None:
            continue
        admitted, counted, with_left = sought
        run = Run(words)
        size = len(run.names)
        for length, starts, which, phrases, counts in run.grow(admitted):
            plain = pc.is_in(phrases, value_set=counted[length]).to_numpy(zero_copy_only=False)
            if plain.any():
                found = _counted(lang, phrases.filter(pa.array(plain)), counts[plain])
                yield found.append_column("before", pa.nulls(found.num_rows, pa.binary()))
            left = pc.is_in(phrases, value_set=with_left[length]).to_numpy(zero_copy_only=False)
            if left.any():
                kept = left[which]
                before = np.where(starts > 0, run.at[starts - 1], 0)[kept]
                key, counts = np.unique(which[kept] * size + before, return_counts=True)
                phrase, before = np.divmod(key, size)
                names = pc.if_else(pa.array(before == 0), pa.scalar(b"", pa.binary()), run.names.take(pa.array(before)))
                yield _counted(lang, phrases.take(pa.array(phrase)), counts).append_column("before", names)


def _set(values) -> pa.Array:
    return pa.array(sorted(set(values)), pa.binary())


def _pass(texts: DataFrame, function, least: int, *more: str) -> DataFrame:
    """One reading of the texts: phrases as text, with their counts from ``least`` on."""
    fields = "".join(f", {name} binary" for name in more)
    rows = texts.mapInArrow(function, f"lang string, phrase binary, n bigint{fields}")
    texts_of = [F.col(c).cast("string").alias(c) for c in ("phrase", *more)]
    return rows.select("lang", *texts_of, "n").groupBy("lang", "phrase", *more).agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def _score(a: str, left: str, right: str) -> Column:
    """Exact: the products are decimals."""
    wide = "cast({} as decimal(18, 0))".format
    return F.expr(f"({wide(a)} * cast(1000 as decimal(4, 0)) * cast(n as decimal(16, 0))) div ({wide(left)} * {wide(right)})")


class Frontier:
    """First words of a language, rarest first: bins of like counts, and slices of bins that are too large."""

    def __init__(self, n: int, bins: list[tuple[int, int, int]]):
        """``bins`` are (bin, words, least count)."""
        self.n, self.bins, self.slice = n, sorted(bins, reverse=True), 0

    def bound(self) -> int:
        """No phrase that starts with a word of the frontier scores more."""
        return 1000 * self.n // self.bins[-1][2] if self.bins else -1

    def take(self, quota: int) -> list[tuple[int, int, int]]:
        """(bin, slices, slice) of about ``quota`` words: whole bins, or one slice of a bin."""
        out, used = [], 0
        while self.bins and used + self.bins[-1][1] <= quota and not self.slice:
            bin_, words, _ = self.bins.pop()
            out.append((bin_, 1, 0))
            used += words
        if not out and self.bins:
            if not self.slice:
                self.slices = -(-self.bins[-1][1] // quota)
            out.append((self.bins[-1][0], self.slices, self.slice))
            self.slice = (self.slice + 1) % self.slices
            if not self.slice:
                self.bins.pop()
        return out


def _parts(rows: DataFrame) -> DataFrame:
    """``head`` is a phrase without its last word, ``last`` that word, ``size`` its number of words."""
    words = F.split("phrase", " ")
    return rows.withColumn("size", F.size(words)).withColumn("last", F.get(words, F.col("size") - 1)).withColumn("head", F.array_join(F.slice(words, 1, F.col("size") - 1), " "))


def _hopeful(grown: DataFrame, words: DataFrame, state: DataFrame) -> DataFrame:
    """Grown phrases that may still be among the best: not always followed by one word, and the last cut scores enough."""
    rows = _parts(grown)
    longer = rows.where("size > 2").groupBy("lang", F.col("head").alias("phrase")).agg(F.max("f").alias("most_right"))
    lefts = words.unionByName(grown).select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rights = words.select("lang", F.col("phrase").alias("last"), F.col("f").alias("r"))
    return (
        rows.join(longer, ["lang", "phrase"], "left")
        .where("most_right is null or most_right < f")
        .join(lefts, ["lang", "head"])
        .join(rights, ["lang", "last"])
        .join(F.broadcast(state), "lang")
        .where(_score("f", "l", "r") >= F.col("least"))
        .select("lang", "phrase", "size", F.col("f").alias("a"), "n")
    )


def _sets_of(rows: list) -> dict[str, tuple]:
    """What to look for per language, for ``_sought``: the hopeful phrases with what precedes them, and the rests of their cuts."""
    out = {}
    for lang in {r.lang for r in rows}:
        with_left, rests, heads = (defaultdict(set) for _ in range(3))
        for r in rows:
            if r.lang == lang:
                words = r.phrase.encode("utf-8", "surrogatepass").split(b" ")
                if r.size < LONGEST:
                    with_left[r.size].add(tuple(words))
                for k in range(1, r.size - 1):
                    rests[r.size - k].add(tuple(words[k:]))
        for sought in (with_left, rests):
            for size, phrases in sought.items():
                for phrase in phrases:
                    for k in range(1, size):
                        heads[k].add(phrase[:k])
        flat = lambda phrases: _set(b" ".join(p) for p in phrases)
        out[lang] = (
            [flat(heads[k]) for k in range(1, max(heads, default=0) + 1)] or [flat(())],
            {k: flat(rests[k] - with_left[k]) for k in range(2, LONGEST + 1)},
            {k: flat(with_left[k]) for k in range(2, LONGEST + 1)},
        )
    return out


def _scored(hopeful: DataFrame, found: DataFrame, grown: DataFrame, words: DataFrame) -> DataFrame:
    """The phrases that are not always preceded by one word, with their lowest-scoring cut."""
    counts = found.groupBy("lang", "phrase").agg(
        F.coalesce(F.max(F.when(F.col("before").isNull(), F.col("f"))), F.sum("f")).alias("f"),
        F.max(F.when(F.col("before") != "", F.col("f"))).alias("most_left"),
    )
    lefts = words.unionByName(grown).select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rights = words.unionByName(counts.select("lang", "phrase", "f")).select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    split = F.split("phrase", " ")
    surviving = hopeful.join(counts.select("lang", "phrase", "most_left"), ["lang", "phrase"], "left").where(
        f"size = {LONGEST} or most_left is null or most_left < a"
    )
    cuts = surviving.select("lang", "phrase", "a", "n", "size", split.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "n", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("rest"),
    )
    scored = cuts.join(lefts, ["lang", "head"]).join(rights, ["lang", "rest"]).withColumn("score", _score("a", "l", "r"))
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
    return worst.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, first_block: int = FIRST_BLOCK, block: int = BLOCK) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to 5 words by score.

    Words are lower-cased in A-Z, and no phrase crosses ``. , ; : ! ?`` or a line's end. Counts are of all
    documents, repeated rows included. A NULL lang is ``und``; NULL and empty texts have no words.
    Equal scores are ordered by count, most first, then by phrase. Phrases that always stand within one
    longer phrase of up to 5 words are left out. Without a phrase of ``min_count`` occurrences, as in an
    empty table, there are no rows. Further columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").where("text is not null")
    all_words = written(_pass(texts, _words, 0).where((F.col("f") >= min_count) | (F.col("phrase") == "")), "phrase-words")
    # One row per language and, of these, one per bin: few by nature.
    totals = {r.lang: r.f for r in all_words.where("phrase = ''").collect()}
    words = all_words.where("phrase <> ''")
    of_bin = F.floor(F.log2("f") * BINS).cast("int")
    bins = defaultdict(list)
    for r in words.groupBy("lang", of_bin.alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("f").alias("least")).collect():
        bins[r.lang].append((r.bin, r.words, r.least))
    frontiers = {lang: Frontier(totals[lang], own) for lang, own in bins.items()}
    least, best, size = dict.fromkeys(frontiers, -1), None, first_block
    while open_ := [lang for lang, f in frontiers.items() if f.bins and f.bound() >= least[lang]]:
        quota = max(1, size // len(open_))
        taken = [(lang, *item) for lang in open_ for item in frontiers[lang].take(quota)]
        dealt = spark.createDataFrame(taken, "lang string, bin int, slices int, slice int")
        state = spark.createDataFrame([(lang, totals[lang], least[lang]) for lang in open_], "lang string, n bigint, least bigint")
        firsts = (
            words.withColumn("bin", of_bin)
            .join(F.broadcast(dealt), ["lang", "bin"])
            .where(F.pmod(F.xxhash64("phrase"), F.col("slices")) == F.col("slice"))
            .select("lang", "phrase")
            .collect()
        )
        own = [written(_pass(texts, _looking(spark, _grown, _firsts(firsts), 2), min_count), "phrase-pairs")]
        for slice_ in _slices_of(own[0], block):
            own.append(written(_pass(texts, _looking(spark, _grown, _pairs(slice_.collect()), 3), min_count), "phrase-longer"))
        grown = _union(own)
        hopeful = written(_hopeful(grown, words, state), "phrase-hopeful")
        found = [
            written(_pass(texts, _looking(spark, _sought, _sets_of(slice_.collect())), 1, "before"), "phrase-parts")
            for slice_ in _slices_of(hopeful.select("lang", "phrase", "size"), max(1, block // 4))
        ]
        if found:
            # A part may be sought in several slices, each time with the same count.
            scored = _scored(hopeful, _union(found).distinct(), grown, words)
            old, best = best, written(_ranked(scored if best is None else scored.unionByName(best.drop("rank")), top), "phrase-best")
            forget(*found, *([old] if old is not None else []))
            for r in best.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= top).collect():
                least[r.lang] = r.least
        forget(*own, hopeful)
        size = min(2 * size, block)
    forget(all_words)
    if best is None:
        best = spark.createDataFrame([], "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint, rank bigint")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _looking(spark, function, sets: dict, *more):
    """The function of a pass, with the sets it looks words up in."""
    shared = spark.sparkContext.broadcast(sets)
    return lambda batches: function(batches, shared, *more)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def _slices_of(rows: DataFrame, size: int) -> list[DataFrame]:
    """The rows in parts of about ``size``; none without rows."""
    n = -(-rows.count() // size)
    return [rows.where(F.pmod(F.xxhash64("phrase", "lang"), F.lit(n)) == k) for k in range(n)] if n > 1 else [rows] * n


def _by_lang(rows: list) -> dict[str, list[bytes]]:
    out = defaultdict(list)
    for r in rows:
        out[r.lang].append(r.phrase.encode("utf-8", "surrogatepass"))
    return out


def _firsts(rows: list) -> dict[str, list]:
    return {lang: [_set(own)] for lang, own in _by_lang(rows).items()}


def _pairs(rows: list) -> dict[str, list]:
    """Pairs admit all that is longer."""
    return {lang: [_set(p.split(b" ")[0] for p in own), _set(own), *[None] * (LONGEST - 3)] for lang, own in _by_lang(rows).items()}
