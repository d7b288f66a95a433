"""Main text of web pages: the markup's structure as a first guess, and what a host's pages share.

1. A tolerant reader cuts a page into blocks of text. Scripts, styles and the like are no text. What stands
   in menus, headers, footers, sidebars, notices, adverts, forms or comments, by element or by its
   class, id or role, goes, also within an article and also if it is an article element itself.
   Of the rest, blocks in an article element are the page's text if there are any, else those in a main
   element, else all.
2. The token streams of all pages of a host are searched for runs that distinct pages share. Of a page without an article element,
   tokens in a run of ``MIN_TOKENS`` or more that at least ``MIN_PAGES`` pages of the host have are
   boilerplate, and the unique runs between them stay. In an article element only whole blocks go, that
   consist of runs on half of the host's pages or more, of ``MANY_PAGES`` at least; and none if less
   than half of the article were left, because then the pages are copies.

The suffix array of a host with a third of all pages does not fit into one task. So its groups of equal
run beginnings are counted instead: every run of ``MIN_TOKENS`` tokens is hashed with its host,
count-min sketches of the runs' anchors find those that may repeat, and these are counted over all
pages. A longer repeated run is covered by its parts. No result depends on how pages are dealt out,
and no page is shuffled or written: pages are parsed anew in each of the three readings.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship, slices, spread, written
from millrace.llm.substrings import _SEGMENT, ROWS, _merge, cells
from millrace.llm.words import Words, mix, scan, sliding_min, window_hashes

MIN_TOKENS, MIN_PAGES = 6, 3
MANY_PAGES, MANY_SHARE = 8, 2
MAX_BITS = 28
BROADCAST_RUNS = 1 << 23
REMEMBERED_TAG = 256

SILENT = frozenset("script style noscript template title svg math iframe object canvas audio video select textarea".split())
ASIDE = frozenset("nav header footer aside form button dialog menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "footer header masthead menu nav navbar navigation newsletter notice popup promo promoted related share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget disqus respond signup modal teaser teasers".split()
)
# Words that say where or how, and nothing about what: "main-nav" is a menu, "menu-cuisine" need not be.
PLAIN_WORDS = frozenset(
    "site main top left right bottom upper lower primary secondary global local page list item items box area container wrapper wrap "
    "section block inner outer bar link links slot unit form panel group thread small large mobile desktop sticky fixed".split()
)
WHOLE_PAGE = frozenset("html body main".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i ins del kbd mark q s samp small span strong sub sup time tt u var wbr label img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Every alternative starts differently and is never given back, so a tag is read once. A quoted value may hold ">".
_TAG = re.compile(
    r"<!--(?:(?s:.)*?-->|(?s:.)*)|<!\[CDATA\[(?:(?s:.)*?\]\]>|(?s:.)*)|<[!?][^>]*+>?|<(/?)(?=([A-Za-z][^\s/>]*+))[A-Za-z](?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+(?:>|\Z)"
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

OTHER, MAIN, ARTICLE = 0, 1, 2


def _aside_name(token: str) -> bool:
    """Does a class or id say that this is no main text? Each of its words must, or be a plain one."""
    words = [w.lower() for w in _PARTS.split(token) if w]
    return any(w in ASIDE_WORDS for w in words) and all(w in ASIDE_WORDS or w in PLAIN_WORDS for w in words)


def _kind_of(name: str, tag: str) -> tuple[bool, bool, int]:
    """(goes by element, goes by its names, mark) of an opening tag."""
    mark = ARTICLE if name == "article" else MAIN if name == "main" else OTHER
    if " " not in tag and "\n" not in tag and "\t" not in tag:
        return name in ASIDE, False, mark
    attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(tag[1 + len(name) : -1])}
    if attributes.get("itemprop", "").lower() == "articlebody":
        mark = ARTICLE
    role = attributes.get("role", "").lower()
    if role == "main":
        mark = max(mark, MAIN)
    if name in WHOLE_PAGE:
        return False, False, mark
    by_element = name in ASIDE or "hidden" in attributes or bool(_HIDDEN.search(attributes.get("style", "")))
    names = attributes.get("class", "").split() + attributes.get("id", "").split()
    return by_element, role in ASIDE_ROLES or any(map(_aside_name, names)), mark


_known_kind = lru_cache(maxsize=1 << 14)(_kind_of)


def _closed(tags: list[tuple[bool, str, int]]) -> dict[int, int]:
    """For each opening tag with an end tag of its own: the place of that in the list.

    An end tag closes the last open element of its name and all that were opened in it.
    """
    out, stack, open_ = {}, [], {}
    for i, (closing, name, _) in enumerate(tags):
        if not closing:
            stack.append(i)
            open_[name] = open_.get(name, 0) + 1
        elif open_.get(name):
            while True:
                top = stack.pop()
                open_[tags[top][1]] -= 1
                if tags[top][1] == name:
                    out[top] = i
                    break
    return out


def _read(page: str) -> tuple[list[tuple[int, str]], list[tuple[bool, str, int]], dict[int, tuple]]:
    """The pieces of text, each before the tag of its number; the tags that stand for elements; what opening tags say."""
    pieces, tags, kinds, at, end = [], [], {}, 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        pieces.append((len(tags), page[at : found.start() if found else end]))
        if not found:
            break
        at, tag = found.end(), found[0]
        if not found[2]:
            continue
        if not tag.endswith(">"):
            break  # the page ends within a tag
        closing, name = bool(found[1]), found[2].lower()
        if name in SILENT and not closing:
            close = re.compile(rf"</{re.escape(name)}\s*+>", re.I).search(page, at)
            at = close.end() if close else end
            tags.append((True, "", len(tags)))
            continue
        if name in VOID:
            tags.append((True, "" if name in INLINE and name != "br" else "br", len(tags)))
            continue
        if not closing:
            kinds[len(tags)] = (_known_kind if len(tag) <= REMEMBERED_TAG else _kind_of)(name, tag)
        tags.append((closing, name, len(tags)))
    return pieces, tags, kinds


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """The blocks that may be main text, in order, as (mark, text); references decoded, single spaces.

    What stands in a dropped element goes. One without an end tag ends with its parent, or where an
    article or main element begins. If nothing were left, class and id names are not believed.
    """
    if not page:
        return []
    pieces, tags, kinds = _read(page)
    for trust in (True, False):
        out = _blocks(pieces, tags, kinds, trust)
        if out or not any(by_name for _, by_name, _ in kinds.values()):
            break
    return out


def _blocks(pieces, tags, kinds, trust: bool) -> list[tuple[int, str]]:
    out: list[tuple[int, str]] = []
    held: list[str] = []
    # Open elements that matter, as (name, number, dropped, mark); others only count.
    stack: list[tuple[str, int, bool, int]] = []
    open_: dict[str, int] = {}
    drops, marks = 0, [OTHER]
    closed: dict[int, int] | None = None

    def flush():
        if held and not drops:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((marks[-1], text))
        held.clear()

    def pop():
        nonlocal drops
        if stack[-1][2]:
            flush()
        name, _, dropped, _ = stack.pop()
        open_[name] -= 1
        drops -= dropped
        marks.pop()

    at = 0
    for i, (closing, name, _) in enumerate(tags):
        while at < len(pieces) and pieces[at][0] <= i:
            held.append(pieces[at][1])
            at += 1
        if name not in INLINE:
            flush()
        if closing:
            if open_.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        by_element, by_name, mark = kinds[i]
        dropped = by_element or (trust and by_name)
        if name in INLINE and not dropped:
            continue
        if dropped and name in INLINE:
            flush()
        if mark != OTHER and not dropped and drops:
            # Whatever was opened and never closed has ended here.
            closed = _closed(tags) if closed is None else closed
            while drops and any(d and n not in closed for _, n, d, _ in stack):
                pop()
        stack.append((name, i, dropped, mark))
        open_[name] = open_.get(name, 0) + 1
        drops += dropped
        marks.append(max(mark, marks[-1]))
    while at < len(pieces):
        held.append(pieces[at][1])
        at += 1
    flush()
    return out


def chosen_blocks(page: str | None) -> tuple[bool, list[str]]:
    """Is it an article, and the texts of the blocks that stay by markup."""
    blocks = blocks_of(page)
    best = max((mark for mark, _ in blocks), default=OTHER)
    return best == ARTICLE, [text for mark, text in blocks if mark == best]


_PARSED = "page_id {kind}, url string, host bigint, article boolean, sizes array<int>, text string"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            found = [chosen_blocks(h) for h in part.column("html").to_pylist()]
            columns = [
                pa.array([a for a, _ in found], pa.bool_()),
                pa.array([[t.count(" ") + 1 for t in texts] for _, texts in found], pa.list_(pa.int32())),
                pa.array([" ".join(texts) for _, texts in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "url", "host")), *columns], names=["page_id", "url", "host", "article", "sizes", "text"])


def _runs(part: pa.RecordBatch, length: int, with_anchors: bool = True) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
    """The words of the pages, and of each run within a page its place, hash with the host, anchor and page.

    Its anchor is the least hash of the shorter runs in it: equal runs have one, and neighbours share it.
    """
    words, short = scan(part.column("text")), max(1, length // 2)
    of_words, owner = words.hashes(), words.owner()
    hosts = mix(part.column("host").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    hashes = window_hashes(of_words, length)
    places = np.flatnonzero(owner[: len(hashes)] == owner[length - 1 : length - 1 + len(hashes)])
    pages, anchors = owner[places], None
    if with_anchors:
        parts = window_hashes(of_words, short)
        anchors = sliding_min(mix(parts ^ hosts[owner[: len(parts)]]), length - short + 1)[places]
    return words, places, mix(hashes[places] ^ hosts[pages]), anchors, pages


def _on_pages(hashes: np.ndarray, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct hash and on how many pages it is."""
    if not len(hashes):
        return hashes, np.zeros(0, dtype=np.int64)
    order = np.lexsort((pages, hashes))
    h, p = hashes[order], pages[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (p[1:] != p[:-1])])
    return np.unique(h[new], return_counts=True)


def _sketch(batches: Iterator[pa.RecordBatch], length: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            *_, anchors, pages = _runs(part, length)
            found, counts = _on_pages(anchors, pages)
            rows = []
            for row in range(ROWS):
                cell = cells(found, row, bits)
                order = np.argsort(cell, kind="stable")
                cell, first = np.unique(cell[order], return_index=True)
                many = np.add.reduceat(counts[order], first) > 1 if len(first) else np.zeros(0, dtype=bool)
                segments, starts = np.unique(cell >> _SEGMENT, return_index=True)
                for segment, a, b in zip(segments.tolist(), starts.tolist(), [*starts[1:].tolist(), len(cell)]):
                    low = (cell[a:b] & 0xFFFF).astype("<u2")
                    rows.append((row, segment, low.tobytes(), low[many[a:b]].tobytes()))
            if rows:
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["row", "segment", "seen", "twice"])


def _candidates(batches: Iterator[pa.RecordBatch], length: int, bits: int, sketch) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 16 << 20):
            _, _, hashes, anchors, pages = _runs(part, length)
            for row in range(ROWS):
                cell = cells(anchors, row, bits)
                hit = (sketch.value[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
                hashes, anchors, pages = hashes[hit], anchors[hit], pages[hit]
            found, counts = _on_pages(hashes, pages)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["run", "n"])


def repeated_runs(parsed: DataFrame, size: int, length: int, pages: int, max_bits: int = MAX_BITS) -> DataFrame:
    """``(run, n)``: hashes of runs with their host, and the number of its pages that have them, from ``pages`` on.

    ``size`` is about the bytes of all texts.
    """
    spark = parsed.sparkSession
    rows = parsed.select("host", "text")
    bits = int(np.clip((size // 8).bit_length(), 16, max_bits))
    merged = (
        rows.mapInArrow(lambda b: _sketch(b, length, bits), "row int, segment int, seen binary, twice binary")
        .repartition(spread(None, parsed), "row", "segment")
        .sortWithinPartitions("row", "segment")
        .mapInArrow(_merge, "row int, segment int, bitmap binary")
    )
    # One bit a cell, 64 MB at most.
    bitmaps = np.zeros((ROWS, (1 << bits) // 8), dtype=np.uint8)
    for row, segment, bitmap in merged.toLocalIterator():
        bitmaps[row, segment * len(bitmap) : (segment + 1) * len(bitmap)] = np.frombuffer(bitmap, dtype=np.uint8)
    sketch = spark.sparkContext.broadcast(bitmaps)
    found = rows.mapInArrow(lambda b: _candidates(b, length, bits, sketch), "run bigint, n bigint")
    return found.groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= pages)


def _bits(covered: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [np.packbits(covered[a:b]).tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def _covered(part: pa.RecordBatch, length: int, runs: np.ndarray, counts: np.ndarray) -> tuple[Words, np.ndarray]:
    """Which words lie in a known run; of an article, in one that is on enough of its host's pages."""
    words, places, hashes, _, pages = _runs(part, length, with_anchors=False)
    change = np.zeros(len(words.starts) + 1, dtype=np.int64)
    if len(runs):
        at = np.minimum(np.searchsorted(runs, hashes), len(runs) - 1)
        least = part.column("least").to_numpy(zero_copy_only=False)
        hit = places[(runs[at] == hashes) & (counts[at] >= least[pages])]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + length, -1)
    return words, np.cumsum(change[:-1]) > 0


def _kept(text: str, article: bool, sizes: list[int], covered: np.ndarray) -> str:
    """The page's text without boilerplate."""
    if not covered.any():
        return text
    if not article:
        return " ".join(w for w, gone in zip(text.split(" "), covered.tolist()) if not gone)
    ends = np.cumsum(sizes)
    whole = np.minimum.reduceat(covered, ends - sizes)
    stays = np.repeat(~whole, sizes)
    if 2 * stays.sum() < len(stays):
        return text
    return " ".join(w for w, here in zip(text.split(" "), stays.tolist()) if here)


def _result(part: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def _extracted(batches: Iterator[pa.RecordBatch], length: int, shared) -> Iterator[pa.RecordBatch]:
    runs, counts = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            words, covered = _covered(part, length, runs, counts)
            rows = zip(*(part.column(c).to_pylist() for c in ("text", "article", "sizes")), words.first[:-1].tolist(), words.first[1:].tolist())
            yield _result(part, [_kept(t, a, s, covered[i:j]) for t, a, s, i, j in rows])


def _marked(batches: Iterator[pa.RecordBatch], length: int, shared) -> Iterator[pa.RecordBatch]:
    """``(row, bits)`` of the pages that the given runs cover a part of."""
    runs, counts = shared.value
    for batch in batches:
        for part in slices(batch, "text"):
            words, covered = _covered(part, length, runs, counts)
            rows = [(r, b) for r, b in zip(part.column("row").to_pylist(), _bits(covered, words.first)) if any(b)]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.binary())], names=["row", "bits"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, article, sizes, all_bits in zip(*(batch.column(c).to_pylist() for c in ("text", "article", "sizes", "bits"))):
            covered = np.zeros(sum(sizes), dtype=bool)
            for bits in all_bits or []:
                covered |= np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[: len(covered)].astype(bool)
            texts.append(_kept(text, article, sizes, covered))
        yield _result(batch, texts)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _arrays(runs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = runs.toArrow()
    run, n = (found.column(c).to_numpy() for c in ("run", "n"))
    order = np.argsort(run.view(np.uint64))
    return run.view(np.uint64)[order], np.minimum(n[order], (1 << 31) - 1).astype(np.int32)


def extract(pages: DataFrame, min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES, broadcast_runs: int = BROADCAST_RUNS) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    NULL or empty html gives an empty text. Pages without a url are one host. Repeated rows are
    pages of their own; further columns are not looked at; an empty table gives no rows.

    The repeated runs are broadcast, 12 bytes each, up to ``broadcast_runs``; more than that are
    taken in slices, each of which marks the pages, and the marks meet the pages in a shuffle.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select("page_id", "url", F.xxhash64(host_of(F.col("url"))).alias("host"), "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parsed = rows.mapInArrow(_parsed, _PARSED.format(kind=kind))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= MANY_PAGES)
    few = hosts.limit(broadcast_runs + 1).count() <= broadcast_runs
    runs = written(repeated_runs(parsed, size, min_tokens, min_pages), "pages-runs")
    n = runs.count()
    if n > broadcast_runs:
        parsed = written(parsed.withColumn("row", F.monotonically_increasing_id()), "pages-parsed")
    # How many pages must have a run. No number is enough for an article on a host of few pages.
    half = F.ceil(F.col("pages") / MANY_SHARE)
    least = F.when(~F.col("article"), F.lit(min_pages)).otherwise(F.coalesce(F.greatest(half, F.lit(min_pages)), F.lit((1 << 62))))
    known = parsed.join(F.broadcast(hosts) if few else hosts, "host", "left").withColumn("least", least.cast("bigint"))
    out = f"page_id {kind}, url string, text string, n_chars bigint"
    if n <= broadcast_runs:
        shared = spark.sparkContext.broadcast(_arrays(runs))
        return known.mapInArrow(lambda b: _extracted(b, min_tokens, shared), out)
    marks = None
    slices_ = -(-n // broadcast_runs)
    for k in range(slices_):
        shared = spark.sparkContext.broadcast(_arrays(runs.where(F.pmod(F.xxhash64("run"), F.lit(slices_)) == k)))
        own = written(known.mapInArrow(lambda b, s=shared: _marked(b, min_tokens, s), "row bigint, bits binary"), "pages-marks")
        marks = own if marks is None else marks.unionByName(own)
    marks = marks.groupBy("row").agg(F.collect_list("bits").alias("bits"))
    return known.join(marks, "row", "left").select("page_id", "url", "text", "article", "sizes", "bits").mapInArrow(_merged, out)
