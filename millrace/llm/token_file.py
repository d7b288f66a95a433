"""Token ids as files: length-limited canonical Huffman codes in blocks that decode on their own.

A file set has a codebook (the code length of each id, from the counts of all documents) and
blocks in ascending doc_id order. A block holds whole documents: their ids and sizes, the
code bits, and the bit offset of every ``STRIDE``-th id. From these checkpoints the lanes of a
block are decoded side by side through one table lookup per id.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.common import drop_folder, ship, slices, spread, text_buffer, uncollected
from millrace.session import scratch_dir

END_ID = 1
LIMIT = 18
BLOCK_IDS = 1 << 18
STRIDE = 64
STARTS = 1 << 18
REMEMBERED, LONGEST_REMEMBERED = 500_000, 40
PIECE_BYTES, CALL_BYTES = 1 << 20, 8 << 20


def _byte_letters() -> dict[int, int]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: b for b in own}, **{b: 256 + n for n, b in enumerate(rest)}}


BYTE_LETTERS = _byte_letters()
LAST_PLAIN = "\u024f"
# Signs that are never part of a letter token, a contraction or a special token.
_SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def plain_form(word: str) -> str | None:
    """How the tokenizer's model sees a word of Latin letters alone: lower case, as byte letters; None for other words."""
    if not word.isalpha():
        return None
    if word.isascii():
        return word.lower()
    if max(word) > LAST_PLAIN:
        return None
    word = word.lower()
    if word.isascii():
        return word
    return word.encode().decode("latin-1").translate(BYTE_LETTERS) if word.isalpha() else None


SPACE, OTHER, LETTER, SIGN = range(4)


def _values(column: pa.Array) -> list[bytes]:
    """The values of a binary column without NULLs, in a third of the time of ``to_pylist``."""
    if not len(column):
        return []
    _, ends, data = column.buffers()
    data, ends = data.to_pybytes() if data else b"", np.frombuffer(ends, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return [data[a:b] for a, b in itertools.pairwise(ends.tolist())]


class WordEncoder:
    """Ids of texts by a tokenizer that never joins over ASCII white space; each distinct word of a call is looked up once.

    Words of Latin letters alone go straight to the tokenizer's model, which spares its normaliser
    and splitter; signs after such a word are looked up on their own. That both ways agree on such words is tried
    when the tokenizer is loaded; if they do not, every word takes the whole way. So is that white space joins nothing;
    if it does, texts are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # each word comes once, so what the model would remember is only in the way
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        letters = [chr(c) for c in range(ord(LAST_PLAIN) + 1) if plain_form(chr(c))]
        trial = [*letters, *(a + b for a in letters for b in "aZ\u00e9"), *(f"The{a}rest" for a in letters)]
        self.direct = self._whole(trial) == [self._by_model(plain_form(w)) for w in trial]
        # The same for a run of signs after a letter: it is encoded on its own.
        ends = [a + b for a in _SIGNS for b in ("", *_SIGNS)]
        apart = [a + b for a, b in zip(self._whole(["\u00e9a"] * len(ends)), self._whole(ends))]
        self.signs_apart = self._whole(["\u00e9a" + e for e in ends]) == apart
        after = [(a, e) for a in letters for e in _SIGNS]
        alone = {w: ids for w, ids in zip([*letters, *_SIGNS], self._whole([*letters, *_SIGNS]))}
        self.signs_apart &= self._whole([a + e for a, e in after]) == [alone[a] + alone[e] for a, e in after]
        words = ["a", "Zebra", "\u00e9t\u00e9", "don't", "42", "x9.", "...", "<b>", "\u65e5\u672c"]
        pairs = [(a, gap, b) for a in words for b in words for gap in (" ", "  ", "\t", "\n", "\r\n", "\x0b", "\x0c", " \n ")]
        alone = dict(zip(words, self._whole(words)))
        joined = self._whole([a + gap + b for a, gap, b in pairs])
        padded = self._whole([gap + a + gap for a, gap, _ in pairs])
        self.apart = all(ids == alone[a] + alone[b] and pad == alone[a] for (a, _, b), ids, pad in zip(pairs, joined, padded))
        # What each byte is; of two-byte characters, those in ``pairs`` are letters.
        self.kinds, self.pairs = np.full(256, OTHER, dtype=np.uint8), np.zeros(1 << 16, dtype=bool)
        self.kinds[list(b" \t\n\r\x0b\x0c")] = SPACE
        if self.direct and self.signs_apart:
            self.kinds[list(_SIGNS.encode())] = SIGN
            for letter in (a.encode() for a in letters):
                self.kinds[list(letter)] = LETTER
                if len(letter) == 2:
                    self.pairs[int.from_bytes(letter)] = True

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_model(self, form: str) -> list[int]:
        return [t.id for t in self.model.tokenize(form)]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        forms = [plain_form(t) if self.direct else None for t in texts]
        whole = iter(self._whole([t for t, form in zip(texts, forms) if form is None]))
        return [array("I", next(whole) if form is None else self._by_model(form)).tobytes() for form in forms]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        known, older = self.known, self.older
        out, fresh = list(map(known.get, words)), []
        for n in [n for n, ids in enumerate(out) if ids is None]:
            ids = older.get(words[n])
            if ids is None:
                fresh.append(n)
            else:
                known[words[n]] = out[n] = ids
        for n, ids in zip(fresh, self._learn([words[n] for n in fresh])):
            out[n] = ids
            if len(words[n]) <= LONGEST_REMEMBERED:
                known[words[n]] = ids
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known  # what is still in use comes back from there
        return out

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words in ``data`` but for its last byte, letters and the signs after them apart, and how many begin before each offset."""
        size = len(data) - 1
        kind = self.kinds[data[:size]]
        wide = np.flatnonzero((data[:size] >= 0xC2) & (kind == LETTER))  # the first byte of a two-byte character
        kind[wide[~self.pairs[data[wide].astype(np.int64) << 8 | data[wide + 1]]]] = OTHER
        begins = np.zeros(size, dtype=bool)
        begins[offsets[(offsets >= 0) & (offsets < size)]] = True
        change = begins.copy()
        change[:1] = True
        change[1:] |= kind[1:] != kind[:-1]
        # Runs of bytes of one kind in one text. A word is one or more of them.
        start = np.flatnonzero(change)
        sort = kind[start]
        filled = sort != SPACE
        head = begins[start]
        head[:1] = True
        head[1:] |= ~filled[:-1]
        end = np.append(start[1:], size)[filled]
        start, sort, head = start[filled], sort[filled], head[filled]
        heads = np.flatnonzero(head)
        runs = np.diff(heads, append=len(start))
        plain = heads[(runs == 1) & (sort[heads] == LETTER)]
        two = heads[runs == 2]
        signed = two[(sort[two] == LETTER) & (sort[two + 1] == SIGN)]
        # Words of letters alone are lower-cased as far as they are ASCII: so fewer differ.
        fold = np.zeros(len(start), dtype=bool)
        fold[plain] = fold[signed] = True
        capital = np.flatnonzero((data[:size] >= ord("A")) & (data[:size] <= ord("Z")))
        capital = capital[fold[np.searchsorted(start, capital, side="right") - 1]]
        lower = data[:size].copy()
        lower[capital] += 32
        head[signed + 1] = True
        first = np.flatnonzero(head)
        ends = end[np.append(first[1:], len(start))[: len(first)] - 1]
        start = start[first]
        bounds = np.zeros(len(start) + 1, dtype=np.int32)
        np.cumsum(ends - start, out=bounds[1:])
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(lower[kind != SPACE])])
        return words, np.searchsorted(start, offsets)

    def _cut(self, texts: pa.Array) -> list[tuple[pa.Array, np.ndarray]]:
        """``_words`` of the texts; a long text is taken in pieces that end after white space."""
        data, offsets = text_buffer(texts)
        size = int(offsets[-1])
        cuts = np.array([0, size])
        if size > PIECE_BYTES:
            after = np.flatnonzero(self.kinds[data[:size]] == SPACE) + 1
            near = np.searchsorted(after, np.arange(PIECE_BYTES, size, PIECE_BYTES))
            cuts = np.unique(np.concatenate([cuts, after[near[near < len(after)]]]))
        return [self._words(data[a : b + 1], offsets - a) for a, b in itertools.pairwise(cuts.tolist())]

    def encode_pieces(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Run by run of texts: their ids, one after the other, and where each text's begin, with the end of the last.

        NULL is an empty text. Words are looked up for all texts together; what else is needed is held for a run at a time.
        """
        runs = list(slices(pa.record_batch([texts], ["text"]), "text", PIECE_BYTES))
        if not self.apart:
            for run in runs:
                ids = self._whole([t or "" for t in run.column("text").to_pylist()])
                yield np.array([i for own in ids for i in own], dtype=np.uint32), np.cumsum([0, *map(len, ids)])
            return
        cut = [self._cut(run.column("text")) for run in runs]
        pieces = [[(len(w), before) for w, before in parts] for parts in cut]
        words = pa.chunked_array([w for parts in cut for w, _ in parts], pa.binary())
        del cut
        chunks = words.dictionary_encode().chunks  # of one dictionary; empty chunks are gone
        del words
        own = self._ids(_values(chunks[0].dictionary)) if chunks else []
        all_which = np.concatenate([np.zeros(0, dtype=np.int32), *(c.indices.to_numpy() for c in chunks)])
        del chunks
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) >> 2
        places, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(own), dtype="<u4")
        at = 0
        for parts in pieces:
            found, bounds = [], np.zeros(len(parts[0][1]), dtype=np.int64)
            for n, before in parts:
                which = all_which[at : at + n]
                ends = np.zeros(n + 1, dtype=np.int64)
                np.cumsum(sizes[which], out=ends[1:])
                place = np.repeat(places[which] - ends[:-1], sizes[which])
                place += np.arange(len(place))
                found.append(pool[place])
                bounds += ends[before]
                at += n
            yield np.concatenate(found), bounds

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, as little-endian 32-bit numbers."""
        found = self.encode_pieces(pa.array(texts, pa.binary()).cast(pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for ids, bounds in found for a, b in itertools.pairwise(bounds.tolist())]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encoded(batches: Iterator[pa.RecordBatch], name: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, end = _encoder(SparkFiles.get(name)), np.array([end_id], dtype="<u4")
    end_low, end_high = end.astype("<u2").tobytes(), (end >> 16).astype("<u2").tobytes()
    totals, kind = np.zeros(0, dtype=np.int64), None
    with uncollected():
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in slices(batch, "text", CALL_BYTES):
                at = 0
                for ids, bounds in encoder.encode_pieces(part.column("text")):
                    own = np.bincount(ids, minlength=end_id + 1)
                    own[end_id] += len(bounds) - 1
                    if len(own) > len(totals):
                        totals = np.concatenate([totals, np.zeros(len(own) - len(totals), dtype=np.int64)])
                    totals[: len(own)] += own
                    # The low and high halves apart: the high ones are mostly zero and compress away.
                    low, high = ids.astype("<u2"), (ids >> 16).astype("<u2")
                    halves = [low[a:b].tobytes() + end_low + high[a:b].tobytes() + end_high for a, b in itertools.pairwise(bounds.tolist())]
                    none = pa.nulls(len(halves), pa.binary())
                    columns = [part.column("doc_id").slice(at, len(halves)), pa.array(halves, pa.binary()), none, none]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "used", "counts"])
                    at += len(halves)
    used = np.flatnonzero(totals)
    if len(used):
        row = [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([used.astype("<i8").tobytes()]), pa.array([totals[used].astype("<i8").tobytes()])]
        yield pa.RecordBatch.from_arrays(row, names=["doc_id", "ids", "used", "counts"])


def _ids_of(halves: bytes) -> np.ndarray:
    low, high = np.frombuffer(halves, dtype="<u2").reshape(2, -1).astype(np.uint32)
    return low | high << 16


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, ids)``: the ids of each text with the end id, as two planes of 16-bit halves.

    NULL is an empty text; repeated rows repeat; an empty table gives no rows. Each task adds a row without
    ids that has the ids it ``used`` and their ``counts``.
    """
    spark = docs.sparkSession
    ship(spark)
    spark.sparkContext.addFile(tokenizer)
    name, kind = tokenizer.rstrip("/").rsplit("/", 1)[-1], docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda b: _encoded(b, name, end_id), f"doc_id {kind}, ids binary, used binary, counts binary"
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("used", "counts"))):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c, dtype="<i8")) for c in row], names=["id", "n"])


def limited_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need more than {limit} bits")
    by_count = np.argsort(counts, kind="stable")
    leaves = counts[by_count]
    items, levels = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        items = both[order]
        levels.append(order < n)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, dtype=np.int64)
    out[by_count] = lengths
    return out


class Codebook:
    """Canonical codes: shorter first, equal lengths by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, limit: int):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths, self.limit = ids[order].astype(np.int64), lengths[order].astype(np.int64), limit
        ends = np.cumsum(np.int64(1) << (limit - self.lengths))
        self.codes = (ends - (np.int64(1) << (limit - self.lengths))) >> (limit - self.lengths)
        self.span = int(ends[-1]) if len(ends) else 0

    def by_id(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max()) + 1 if len(self.ids) else 0
        codes, lengths = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        codes[self.ids], lengths[self.ids] = self.codes, self.lengths
        return codes, lengths

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        repeats = np.int64(1) << (self.limit - self.lengths)
        symbols, widths = np.zeros(1 << self.limit, dtype=np.uint32), np.ones(1 << self.limit, dtype=np.int64)
        symbols[: self.span], widths[: self.span] = np.repeat(self.ids, repeats), np.repeat(self.lengths, repeats)
        return symbols, widths


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
    """The code bits of a block, first bit highest, and the offsets of every ``stride``-th id."""
    width = lengths[ids]
    end = np.cumsum(width)
    start = end - width
    code, word, off = codes[ids], start >> 6, start & 63
    over = off + width - 64
    fits = over <= 0
    first = np.where(fits, code << np.where(fits, -over, 0).astype(np.uint64), code >> np.where(fits, 0, over).astype(np.uint64))
    out = np.zeros((int(end[-1]) >> 6) + 2 if len(end) else 1, dtype=np.uint64)
    if len(ids):
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[heads]] = np.bitwise_or.reduceat(first, heads)
        split = np.flatnonzero(~fits)
        out[word[split] + 1] |= code[split] << (64 - over[split]).astype(np.uint64)
    bits = int(end[-1]) if len(end) else 0
    return out.astype(">u8").tobytes()[: (bits + 7) // 8], start[::stride]


def unpack_bits(data: bytes, offsets: np.ndarray, n: int, symbols: np.ndarray, widths: np.ndarray, limit: int, stride: int = STRIDE) -> np.ndarray:
    """The ids of a block; all lanes take one id per step."""
    words = np.frombuffer(data + b"\0" * (-len(data) % 8 + 16), dtype=">u8").astype(np.uint64)
    at = offsets.astype(np.int64)
    out = np.zeros((len(at), stride), dtype=np.uint32)
    shift = np.uint64(64 - limit)
    for step in range(min(stride, n)):
        lanes = len(at) if step < n - (len(at) - 1) * stride else len(at) - 1
        here = at[:lanes]
        word, off = here >> 6, (here & 63).astype(np.uint64)
        window = (words[word] << off) | (words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - off)
        code = (window >> shift).astype(np.int64)
        out[:lanes, step] = symbols[code]
        here += widths[code]
    return out.ravel()[:n]


_BLOCKS = "part int, block int, doc_ids array<{kind}>, sizes array<int>, n_ids bigint, offsets binary, bits binary"


def _blocks(batches: Iterator[pa.RecordBatch], book: Codebook, block_ids: int) -> Iterator[pa.RecordBatch]:
    codes, lengths = book.by_id()
    part, docs, held, size, block = TaskContext.get().partitionId(), [], [], 0, 0

    def close(kind):
        bits, offsets = pack_bits(np.concatenate(held), codes, lengths)
        row = [[part], [block], [docs], [[len(i) for i in held]], [size], [offsets.astype("<u8").tobytes()], [bits]]
        types = [pa.int32(), pa.int32(), pa.list_(kind), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=["part", "block", "doc_ids", "sizes", "n_ids", "offsets", "bits"])

    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for doc, halves in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
            docs.append(doc)
            held.append(_ids_of(halves).astype(np.int64))
            size += len(held[-1])
            if size >= block_ids:
                yield close(kind)
                docs, held, size, block = [], [], 0, block + 1
    if held:
        yield close(kind)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, limit: int = LIMIT, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all texts below ``path``, in ascending doc_id order.

    NULL is an empty text, which has the end id alone. Rows without an id come first; rows that
    share one are ordered by their ids. An empty table gives an empty file set.
    """
    spark = docs.sparkSession
    kept = scratch_dir(spark, "token-ids")
    encoded(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(kept)
    both = spark.read.parquet(kept)
    ids = both.where("ids is not null").select("doc_id", "ids")
    counts = both.where("ids is null").select("used", "counts").mapInArrow(_counts, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # One row per id of the vocabulary at most.
    rows = counts.collect()
    found = np.array([r.id for r in rows], dtype=np.int64)
    lengths = limited_lengths(np.array([r.n for r in rows], dtype=np.int64), limit)
    spark.createDataFrame(
        [(int(i), int(n), limit) for i, n in zip(found, lengths)], "id bigint, length bigint, max_length int"
    ).coalesce(1).write.parquet(f"{path}/codebook")
    book = Codebook(found, lengths, limit)
    (
        ids.repartitionByRange(spread(None, docs), "doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(lambda b: _blocks(b, book, block_ids), _BLOCKS.format(kind=docs.schema["doc_id"].dataType.simpleString()))
        .write.option("compression", "uncompressed")
        .parquet(f"{path}/blocks")
    )
    drop_folder(spark, kept)


def _decoded(batches: Iterator[pa.RecordBatch], book: Codebook) -> Iterator[pa.RecordBatch]:
    symbols, widths = book.table()
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            n = one.column("n_ids")[0].as_py()
            offsets = np.frombuffer(one.column("offsets")[0].as_py(), dtype="<u8")
            ids = unpack_bits(one.column("bits")[0].as_py(), offsets, n, symbols, widths, book.limit).astype("<u4")
            sizes = np.array(one.column("sizes")[0].as_py(), dtype=np.int64)
            ends = np.cumsum(sizes)
            own = [ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    one.column("doc_ids").flatten(),
                    pa.array(one.column("start")[0].as_py() + ends - sizes),
                    pa.array(sizes),
                    pa.array([zlib.crc32(i) for i in own], pa.int64()),
                    pa.array(own, pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` of every document in a file set.

    Documents without text have the end id alone; an empty file set gives no rows. The starts of the blocks
    are broadcast up to ``STARTS`` blocks, beyond which they meet the blocks in a shuffle.
    """
    ship(spark)
    rows = spark.read.parquet(f"{path}/codebook").collect()
    limit = rows[0].max_length if rows else 1
    book = Codebook(np.array([r.id for r in rows], dtype=np.int64), np.array([r.length for r in rows], dtype=np.int64), limit)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"), F.count(F.lit(1)).alias("blocks"))
    # One row per written partition; the starts of blocks within a partition follow by a window.
    before, before_blocks, at = {}, {}, 0
    for row in sorted(parts.collect(), key=lambda r: r.part):
        before_blocks[row.part] = row.blocks
        before[row.part], at = at, at + row.n
    starts = spark.createDataFrame(list(before.items()), "part int, base bigint")
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        blocks.select("part", "block", "n_ids")
        .join(starts, "part")
        .select("part", "block", (F.col("base") + F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).alias("start"))
    )
    if sum(before_blocks.values()) <= STARTS:
        placed = F.broadcast(placed)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.join(placed, ["part", "block"]).mapInArrow(
        lambda b: _decoded(b, book), f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    )
