"""Repair of conversations: the cheapest edits after which roles run ``(s?(ua)+)?``.

A conversation is read once, in order of its turns, by a Viterbi search over four states: nothing
kept yet, after the system row, after a user row, after an assistant row. Each state has one
survivor, the cheapest edits that reach it and of equal ones the ASCII-least. Survivors are leaves
of one tree of back pointers whose nodes count what hangs on them: a node that no survivor needs
goes at once, and when all survivors share an ancestor, the edits up to it are final, are
emitted and leave memory with their texts. A survivor that costs more than another state's
plus the dearest way to follow the same rows from there can never win and is dropped, so that the path
that deletes everything does not hold the tree open. What stays in memory is the unresolved
part, and ties between survivors compare that part whole, back to where they part. It may be
long where the outcome depends on what comes later: a run of user rows is repaired one way if its end
is even and another if it is odd.

Equal costs are only compared between edits of the same rows, so neither is a prefix of the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ship

BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
# Where a row with this initial may be kept, and the state after it.
KEPT = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# The state after the one role that may follow, be it by a new row or by a new role.
EXPECTED = (USER, USER, ASSISTANT, USER)
LEGAL = frozenset(("su", "ua", "au"))
# _SLACK[x][y]: what y may cost less than x before x is beyond winning. From y one can do what x does with the
# rows to come for at most so much more.
_SLACK = (
    (0, DELETE + 2 * INSERT, DELETE + INSERT, DELETE),
    (None, 0, INSERT, 0),
    (None, INSERT + 2 * INSERT, 0, INSERT),
    (None, 2 * INSERT, INSERT, 0),
)


class Node:
    """An edit, the edit before it, and what hangs on it: later edits, and survivors by their number.

    ``jump`` leads to an edit further back whose depth follows from this one's alone, so two paths
    are followed back to where they part in steps that grow.
    """

    __slots__ = ("before", "edit", "line", "held", "after", "depth", "jump")

    def __init__(self, before: Node | None, edit: str, line: tuple[str, str] | None):
        self.before, self.edit, self.line = before, edit, line
        self.held = 0
        self.after: dict[int, Node] = {}
        if before is None:
            self.depth, self.jump = 0, self
        else:
            before.after[id(self)] = self
            far = before.jump
            self.depth = before.depth + 1
            self.jump = far.jump if before.depth - far.depth == far.depth - far.jump.depth else before

    def back_to(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.jump if node.jump.depth >= depth else node.before
        return node


def first_difference(a: Node, b: Node) -> tuple[str, str]:
    """The edits with which the paths to ``a`` and ``b`` part; empty where a path has ended."""
    depth = min(a.depth, b.depth)
    x, y = a.back_to(depth), b.back_to(depth)
    if x is y:
        return tuple(n.back_to(depth + 1).edit if n.depth > depth else "" for n in (a, b))
    while x.before is not y.before:
        x, y = (x.jump, y.jump) if x.jump is not y.jump else (x.before, y.before)
    return x.edit, y.edit


class Repair:
    """The search over one conversation; ``emit(edit, line)`` gets each edit once it is final."""

    def __init__(self, emit: Callable[[str, tuple[str, str] | None], None]):
        self.emit = emit
        self.root = Node(None, "", None)
        self.root.held = 1
        self.best: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]

    @staticmethod
    def _better(new: tuple, old: tuple | None) -> bool:
        """Both are (cost, node before, edit, line); an old survivor has itself as the node and no edit."""
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        if new[1] is old[1]:
            return new[2] < old[2]
        ours, theirs = first_difference(new[1], old[1])
        return (ours or new[2]) < (theirs or old[2])

    def _release(self, node: Node) -> None:
        node.held -= 1
        while node is not self.root and not node.held and not node.after:
            before = node.before
            del before.after[id(node)]
            node = before

    def _take(self, chosen: list[tuple | None]) -> None:
        """The chosen ways become the survivors."""
        costs = [None if c is None else c[0] for c in chosen]
        new: list[tuple[int, Node] | None] = []
        for x, way in enumerate(chosen):
            if way is not None and any(
                costs[y] is not None and _SLACK[x][y] is not None and way[0] > costs[y] + _SLACK[x][y] for y in range(4) if y != x
            ):
                way = None
            if way is None:
                new.append(None)
                continue
            node = Node(way[1], way[2], way[3]) if way[2] else way[1]
            node.held += 1
            new.append((way[0], node))
        for old in self.best:
            if old is not None:
                self._release(old[1])
        self.best = new
        while not self.root.held and len(self.root.after) == 1:
            (self.root,) = self.root.after.values()
            self.emit(self.root.edit, self.root.line)
            self.root.before = self.root.line = None

    def _insert(self) -> None:
        """New rows where they lead to a state in a better way: at most two in a row."""
        for _ in range(2):
            chosen: list[tuple | None] = [None if b is None else (b[0], b[1], "", None) for b in self.best]
            changed = False
            for x, b in enumerate(self.best):
                if b is not None:
                    y = EXPECTED[x]
                    way = (b[0] + INSERT, b[1], "I", (ROLES[y], ""))
                    if self._better(way, chosen[y]):
                        chosen[y], changed = way, True
            if not changed:
                return
            self._take(chosen)

    def row(self, role: str, text: str, must_go: bool, cut_off: bool) -> None:
        self._insert()
        chosen: list[tuple | None] = [None] * 4
        more = CUT_OFF if cut_off else 0
        for x, b in enumerate(self.best):
            if b is None:
                continue
            cost, node = b
            ways = [(x, (cost + DELETE, node, "D", None))]
            if not must_go:
                y = KEPT.get(role[:1], {}).get(x)
                if y is not None:
                    ways.append((y, (cost + more, node, "K", (role, text))))
                y = EXPECTED[x]
                ways.append((y, (cost + REROLE + more, node, "R", (ROLES[y], text))))
            for y, way in ways:
                if self._better(way, chosen[y]):
                    chosen[y] = way
        self._take(chosen)

    def end(self) -> int:
        """Emit what is left; the cost of all edits."""
        self._insert()
        last = None
        for x in (NONE, ASSISTANT):
            b = self.best[x]
            if b is not None and self._better((b[0], b[1], "", None), last):
                last = (b[0], b[1], "", None)
        cost, node = last[:2]
        left = []
        while node is not self.root:
            left.append(node)
            node = node.before
        for node in reversed(left):
            self.emit(node.edit, node.line)
        return cost


def fault_of(text: str, seen: bool) -> str:
    """The row's first fault: blank, duplicate, truncated or none."""
    words = text.rstrip(BLANKS)
    if not words:
        return "blank"
    if seen:
        return "duplicate"
    return "" if words[-1] in STOPS else "truncated"


class Conversation:
    """Counts, edits and the repaired rows of one conversation, row after row."""

    def __init__(self, conv_id, keep_lines: bool):
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.least = self.most = self.last_turn = self.last_initial = None
        self.turns = 0
        self.audit, self.hash, self.n_lines = [], hashlib.sha256(), 0
        self.lines: list[tuple[int, str, str, str]] | None = [] if keep_lines else None
        self.search = Repair(self._final)

    def _final(self, edit: str, line: tuple[str, str] | None) -> None:
        self.audit.append(edit)
        if line is not None:
            self.hash.update(f"{chr(10) if self.n_lines else ''}{line[0]}:{line[1]}".encode("utf-8", "surrogatepass"))
            if self.lines is not None:
                self.lines.append((self.n_lines, edit, *line))
            self.n_lines += 1

    def row(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.least, self.most, self.last_turn = turn if self.least is None else self.least, turn, turn
        fault, initial = fault_of(text, seen), role[:1]
        if fault:
            self.counts[fault] += 1
        if self.last_initial is not None and self.last_initial + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.last_initial = initial
        self.search.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def end(self) -> tuple:
        cost = self.search.end()
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.counts.values(), cost, "".join(self.audit), self.hash.hexdigest())


_SUMMARY = "conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_LINES = "conv_id {kind}, nth bigint, edit string, role string, text string"
_IDS, _SEEN, _ROW = range(3)
_HELD = 4096


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _repaired(batches: Iterator[pa.RecordBatch], lines: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and turn; marks of repeated rows come first in their turn."""
    now, out, schema = None, [], None
    turn_now, marked, before = None, set(), None
    for batch in batches:
        if schema is None:
            kind = batch.schema.field("conv_id").type
            names = ("nth", "edit", "role", "text") if lines else ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
            types = {n: pa.string() if n in ("edit", "role", "text", "audit", "repaired_sha256") else pa.int64() for n in names}
            schema = pa.schema([("conv_id", kind), *types.items()])
        for conv_id, turn, what, role, text, digest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "what", "role", "text", "digest"))):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    summary = now.end()
                    out += [(now.conv_id, *line) for line in now.lines] if lines else [summary]
                now = Conversation(conv_id, lines)
                turn_now, marked, before = None, set(), None
            if what == _IDS:
                continue
            if turn != turn_now:
                turn_now, marked, before = turn, set(), None
            if what == _SEEN:
                marked.add(digest)
                continue
            now.row(turn, role, text, digest == before or digest in marked)
            before = digest
            if lines and now.lines:
                out += [(conv_id, *line) for line in now.lines]
                now.lines.clear()
            if len(out) >= _HELD:
                yield _batch(out, schema)
                out = []
    if now is not None:
        summary = now.end()
        out += [(now.conv_id, *line) for line in now.lines] if lines else [summary]
    if out:
        yield _batch(out, schema)


def _digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary"))


def _sorted_rows(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """All that one conversation needs, in one partition and in order.

    Which rows repeat an earlier turn's row is found on digests alone; texts are shuffled once.
    """
    told = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", _digest(F.col("role"), F.col("text")))
    places = told.select("conv_id", "turn", "digest").distinct()
    earlier = Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())
    marks = places.withColumn("nth", F.row_number().over(earlier)).where("nth > 1").drop("nth")
    both = told.withColumn("what", F.lit(_ROW)).unionByName(marks.withColumn("what", F.lit(_SEEN)), allowMissingColumns=True)
    if ids is not None:
        both = both.unionByName(ids.select("conv_id").distinct().withColumn("what", F.lit(_IDS)), allowMissingColumns=True)
    return (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "what", "role", "text")
        .select("conv_id", "turn", "what", "role", "text", "digest")
    )


def _run(rows: DataFrame, ids: DataFrame | None, lines: bool) -> DataFrame:
    ship(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _sorted_rows(rows, ids).mapInArrow(lambda b: _repaired(b, lines), (_LINES if lines else _SUMMARY).format(kind=kind))


def audit(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: faults, cheapest edits, digest of the outcome.

    NULL roles and texts are one space, so such a text is blank. NULL turns come first. Rows of
    one turn are taken by role, then text; one that repeats another is its duplicate. Rows without
    a conv_id are one conversation. ``ids(conv_id)`` adds conversations without rows: all zero, empty
    audit and the digest of nothing. An empty table gives no rows; further columns are not
    looked at.

    The digest runs over the whole repaired conversation, so one task reads a conversation; it holds
    the unresolved rows only, and its edits at a byte each.
    """
    return _run(rows, ids, False)


def repaired(rows: DataFrame) -> DataFrame:
    """The rows after repair, ``(conv_id, nth, edit, role, text)``, as ``audit`` describes; deleted rows are gone."""
    return _run(rows, None, True)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by the crc32 of ``conv_id:turn`` modulo 20 (NULL: one space).

    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks,
    3 repeats it, 4 makes it a user's.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    return (
        rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), case.alias("damage"))
        .where("damage <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )
