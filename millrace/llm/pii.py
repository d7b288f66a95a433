"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, schemes, digits and identifier cues. From
each anchor a deterministic parser grows the span to both sides and validates it. Every
parser reads a run of characters once, so a long run costs its length, not its square.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ship, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "id")
CUES = ("iban", "ssn", "passport", "account", "token", "secret", "password", "api_key", "license no")

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`{}|\\^\[\]]+")
_IBAN = re.compile(r"[\s:=#]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){10,30})")
_TOKEN = re.compile(r"(?:\s+(?:no|number|id)\.?)?[\s:=#\"']{1,5}([A-Za-z0-9_/+-]{6,})")
_NO_DIGITS = str.maketrans("", "", " -().+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    code = text.replace(" ", "")
    return 14 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in string.digits:
        found.add_word(digit, ("digit", 1))
        found.add_word(f"+{digit}", ("phone", 2))
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url", 3))
    found.add_word("www.", ("www", 4))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("iban" if cue == "iban" else "id", len(form)))
    found.make_automaton()
    return found


def _email(text: str, at: int, floor: int) -> Span | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def _ips(text: str, start: int, end: int) -> list[Span]:
    """Four numbers with single dots between, from the left, out of a run of digits and dots."""
    out, chain, at = [], [], start
    for piece in text[start:end].split("."):
        if not piece:
            chain = []
        else:
            chain.append((at, piece))
            if len(chain) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for _, p in chain):
                    out.append((chain[0][0], at + len(piece)))
                chain = []
        at += len(piece) + 1
    return out


def _url_end(text: str, start: int) -> int:
    body = _URL.match(text, start)
    return start + len(body.group().rstrip(".,;:!?)")) if body else start


def find(text: str) -> dict[str, list[Span]]:
    """The spans of each kind, by start, in code points; those of one kind do not overlap."""
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys((*KINDS, "dotted"), 0)
    for last, (kind, size) in automaton().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= done["dotted"]:
                done["dotted"] = end = _DOTTED.match(text, at).end()
                out["ip"] += _ips(text, at, end)
            if at >= done["card"] and (m := _CARD.match(text, at)):
                done["card"] = m.end()
                digits = m.group().translate(_NO_DIGITS)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        elif kind == "email":
            if span := _email(text, at, done["email"]):
                out["email"].append(span)
                done["email"] = span[1]
        elif kind == "phone":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 9 <= len(m.group().translate(_NO_DIGITS)) <= 15:
                    out["phone"].append(m.span())
        elif kind in ("url", "www"):
            start = at
            if start < done["url"]:
                continue
            while kind == "url" and start > max(done["url"], at - 20) and text[start - 1] in _SCHEME:
                start -= 1
            # The run is read only where a span may start, and then it is done.
            if start < at if kind == "url" else not text[max(at - 1, 0) : at].isalnum():
                end = _url_end(text, at + size)
                if end > at + size:
                    out["url"].append((start, end))
                    done["url"] = end
        elif m := (_IBAN if kind == "iban" else _TOKEN).match(text, last + 1):
            good = iban_valid(m[1]) if kind == "iban" else any(c.isdigit() for c in m[1])
            if good and m.start(1) >= done[kind]:
                out[kind].append(m.span(1))
                done[kind] = m.end(1)
    return out


def listed(found: dict[str, list[Span]], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in found[kind])


def masked(text: str, found: dict[str, list[Span]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    spans = sorted((a, -b, kind) for kind, own in found.items() for a, b in own)
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i][0], -spans[i][1], spans[i][2]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, -spans[i][1])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                found = find(text or "")
                rows.append((*(len(found[k]) for k in BASE), hashlib.sha256(listed(found, BASE).encode()).hexdigest(), listed(found)))
            columns = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(zip(*rows))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, the digest of their spans, and all spans as text.

    NULL is an empty text and has none. Rows are independent, so repeated rows give repeated
    results; further columns are not looked at; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _spans, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    )


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = [None if t is None else masked(t, find(t)) for t in part.column("text").to_pylist()]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "text", pa.array(texts, part.schema.field(at).type))


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """The rows with every span masked in ``text``; NULL stays NULL, other columns are unchanged."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_masked, docs.schema)
