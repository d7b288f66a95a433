"""Piece encoding for merge-type vocabularies: an agenda of adjacent pairs, ordered by score.

A text is normalised by the sentencepiece library and cut before every word mark. No piece of
the vocabulary crosses such a cut (this is verified when it is loaded; else a text is one
segment), so segments can be merged one by one, and each distinct one once. The pair of highest
score is merged first, the leftmost of equals; pairs that a merge has made stale are
skipped when they come up. What no piece covers becomes bytes.

Every segment that is merged anew is also encoded by the library, in the same Arrow batch, behind another
word where the library would not see it alone (a mark at the end of a text). Texts with a segment on
which both differ, or that cannot be checked, get the library's ids of the whole text.
"""

from __future__ import annotations

import heapq
import itertools
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from millrace.llm.common import ship, slices, uncollected

MARK = "▁"
REMEMBERED, LONGEST_REMEMBERED = 300_000, 40
SHORT = 64


class PairTable:
    """All pairs of symbols that make a piece, for the agendas of many segments at once.

    Each segment's agenda is the run of its neighbours' orders. In a round every segment takes its best pair,
    the leftmost of equals, and the two pairs beside it are looked up anew; segments without a pair are done.
    """

    def __init__(self, ids: dict[str, int], order: dict[str, float]):
        self.size = max(ids.values(), default=0) + 2
        self.of_char = np.full(0x110000, -1, dtype=np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        found = {}
        for piece in ids:
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    found[left * self.size + right] = piece
        self.keys = np.array(sorted(found), dtype=np.int64)
        pieces = [found[k] for k in self.keys.tolist()]
        self.none = 1 << 40
        ranks = {o: n for n, o in enumerate(sorted(set(order.values())))}
        self.made = np.array([ids[p] for p in pieces] + [0], dtype=np.int64)
        self.rank = np.array([ranks[order[p]] for p in pieces], dtype=np.int64)

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.full(len(left), self.none), np.zeros(len(left), dtype=np.int64)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none), self.made[at]

    def merged(self, segments: list[str]) -> dict[str, bytes]:
        """The ids of each segment whose characters are all pieces."""
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        if not lengths.sum():
            return {}
        symbols = self.of_char[np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        whole = np.minimum.reduceat(symbols, np.cumsum(lengths) - lengths) >= 0
        owner = np.repeat(np.arange(len(segments)), lengths)
        keep = whole[owner]
        symbols, owner = symbols[keep], owner[keep]
        order, made = self._looked_up(symbols, np.append(symbols[1:], 0))
        order[np.flatnonzero(owner[1:] != owner[:-1])] = self.none
        order[-1:] = self.none
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(heads, len(owner)))
            best = np.minimum.reduceat(order, heads)
            ended = best == self.none
            if ended.any():
                over = np.repeat(ended, sizes)
                done.append((owner[over], symbols[over]))
                symbols, owner, order, made = (c[~over] for c in (symbols, owner, order, made))
                best, sizes = best[~ended], sizes[~ended]
                if not len(symbols):
                    break
            hits = np.flatnonzero(order == np.repeat(best, sizes))
            first = hits[np.concatenate([[True], owner[hits][1:] != owner[hits][:-1]])]
            symbols[first] = made[first]
            order[first], made[first] = order[first + 1], made[first + 1]
            stay = np.ones(len(symbols), dtype=bool)
            stay[first + 1] = False
            symbols, owner, order, made = (c[stay] for c in (symbols, owner, order, made))
            first -= np.arange(len(first))  # one symbol has gone from each segment before
            left = first[(first > 0) & (owner[first - 1] == owner[first])] - 1
            right = first[first + 1 < len(owner)]
            right = right[owner[right + 1] == owner[right]]
            for at in (left, right):
                order[at], made[at] = self._looked_up(symbols[at], symbols[at + 1])
        owner, symbols = (np.concatenate(c) for c in zip(*done)) if done else (owner, symbols)
        by_owner = np.argsort(owner, kind="stable")
        owner, data = owner[by_owner], symbols[by_owner].astype("<u4").tobytes()
        edges = np.searchsorted(owner, np.arange(len(segments) + 1)) * 4
        ends = edges.tolist()
        return {s: data[a:b] for s, a, b, w in zip(segments, ends, ends[1:], whole.tolist()) if w}


class Pieces:
    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.order = {piece: -sp.get_score(i) for piece, i in self.ids.items()}
        self.unused = {piece for piece, i in self.ids.items() if sp.is_unused(i)}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes, self.unknown = sp.is_byte(self.bytes[0]), sp.unk_id()
        crossing = any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.ids)
        self.cut = re.compile("(?s).+" if crossing else f"{MARK}*[^{MARK}]+|{MARK}+")
        # What the library puts before a text.
        self.prefix = MARK if sp.normalize("a").startswith(MARK) else ""
        self.before_bytes = array("I", sp.encode("a")).tobytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.table = None if self.unused else PairTable(self.ids, self.order)

    def merge(self, segment: str) -> list[str]:
        """The segment's symbols after all merges."""
        symbols, order = list(segment), self.order
        last = len(symbols)
        before, after = list(range(-1, last - 1)), list(range(1, last + 1))
        made: dict[str, tuple[str, str]] = {}
        agenda = []
        for i in range(last - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in order:
                agenda.append((order[pair], i, pair, i + 1))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair, j = heapq.heappop(agenda)
            if symbols[i] is None or symbols[j] is None or after[i] != j or symbols[i] + symbols[j] != pair:
                continue
            if pair in self.unused:
                made[pair] = (symbols[i], symbols[j])
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k < last:
                before[k] = i
                right = pair + symbols[k]
                if right in order:
                    heapq.heappush(agenda, (order[right], i, right, k))
            h = before[i]
            if h >= 0:
                left = symbols[h] + pair
                if left in order:
                    heapq.heappush(agenda, (order[left], h, left, i))
        out, stack = [], [s for s in reversed(symbols) if s is not None]
        while stack:
            symbol = stack.pop()
            if symbol in made:
                stack += reversed(made[symbol])
            else:
                out.append(symbol)
        return out

    def segment_ids(self, segment: str) -> list[int]:
        out: list[int] = []
        for symbol in self.merge(segment):
            i = self.ids.get(symbol)
            if i is not None:
                out.append(i)
            elif self.has_bytes:
                out += [self.bytes[b] for b in symbol.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def learn(self, segments: list[str]) -> dict[str, bytes | None]:
        """The ids of new segments; None where the library's differ or cannot be told."""
        shown = []
        for segment in segments:
            plain = segment.removeprefix(self.prefix)
            # Spaces alone are nothing to the library, so they stand behind a word.
            alone = plain.strip(MARK) != ""
            shown.append((plain if alone else f"a{segment}").replace(MARK, " "))
        quick = self.table.merged([s for s in segments if len(s) <= SHORT]) if self.table else {}
        out = {}
        for segment, theirs in zip(segments, self.library.encode(shown, num_threads=1)):
            own = quick.get(segment)
            if own is None:
                own = array("I", self.segment_ids(segment)).tobytes()
            if segment.strip(MARK) == "":
                own_shown = self.before_bytes + own
            else:
                own_shown = own
            out[segment] = own if segment.startswith(self.prefix) and own_shown == array("I", theirs).tobytes() else None
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with begin and end ids."""
        cut = [self.cut.findall(t) for t in self.library.normalize(texts)] if texts else []
        known, have, missing = self.known, {}, []
        for segment in set(itertools.chain.from_iterable(cut)):
            if segment in known:
                have[segment] = known[segment]
            elif segment in self.older:
                have[segment] = known[segment] = self.older[segment]
            else:
                missing.append(segment)
        doubtful = None in have.values()
        if missing:
            learned = self.learn(missing)
            have.update(learned)
            doubtful = doubtful or None in learned.values()
            known.update((s, i) for s, i in learned.items() if len(s) <= LONGEST_REMEMBERED)
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known  # what is still in use comes back from there
        begin, end = (array("I", [i]).tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        out = []
        for text, own in zip(texts, cut):
            if doubtful and any(have[s] is None for s in own):
                ids = array("I", self.library.encode(text)).tobytes()
            else:
                ids = b"".join(map(have.__getitem__, own))
            out.append(np.frombuffer(begin + ids + end, dtype="<u4"))
        return out


@lru_cache(maxsize=2)
def _loaded(path: str) -> Pieces:
    return Pieces(path)


def _encoded(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    pieces = _loaded(SparkFiles.get(name))
    with uncollected():
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = pieces.encode([t or "" for t in part.column("text").to_pylist()])
                texts = pieces.library.decode([i.tolist() for i in ids], num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([i.tobytes() for i in ids], pa.binary()),
                        pa.array(texts, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` per row: ids as little-endian 32-bit numbers, and their text.

    ``model`` is a path on the driver; the file is sent to the executors. NULL is an empty text,
    which has the begin and end ids alone. Repeated rows repeat; further columns are not
    looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    spark.sparkContext.addFile(model)
    name, kind = model.rstrip("/").rsplit("/", 1)[-1], docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _encoded(batches, name), f"doc_id {kind}, n_tokens bigint, ids binary, decoded string"
    )
