"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

A repaired conversation is nothing, or an optional system turn and one or more pairs of user and
assistant, ``(s?(ua)+)?`` by the initials of the roles. Rows in order are kept, given another role or
deleted, and empty turns are inserted anywhere; the edits of a conversation, one letter each, are its
audit. Of equally cheap audits the least by ASCII is taken.

Persistent audit DP: after each row four cells, one for each place in the pattern, hold the cheapest
edits so far. The edits are no strings but linked nodes that share their prefixes (``Audits``): a node
has its letters, a rolling hash of all letters up to it, and ancestors at binary distances. Two
audits of equal cost are compared by a search for their longest common prefix over the ancestors' hashes;
as equal prefixes are one node, a hash that agrees where the nodes differ is a collision, and the search
is done again on the nodes. Insertions cost something, so that of two equally cheap audits of a cell
none is the beginning of the other, and the lesser one stays the lesser whatever follows.

A conversation of any length is split: rows are range-sorted by conversation and turn, and each task
runs the DP over its own stretches of at most ``STRETCH`` rows, from every cell in which a stretch may be
entered. Only those results, sixteen audits per stretch at most, are then chained per conversation. Rows
alike in conversation, turn, role and text are counted before they are sorted. The texts are shuffled
once, at the end, to be hashed as they stream by in order: a SHA-256 can't be put together from parts.

Cases: nulls of any column are one space where text is needed, and a null turn comes first in order;
rows of equal turn are ordered by role and by the MD5 of their text; repeated rows are duplicates; a role
without a letter, or with another initial than s, u or a, can't be kept; a conversation that loses all
rows has zeros, an empty audit and the hash of an empty text; an empty table gives no rows; long texts
are never gathered; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.sources.storage import cut

#: Rows over which one run of the DP goes.
STRETCH = 4096
SPACES = " \t\n\x0b\f\r"
ENDS = ".!?"

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a row of each initial leads; where an edit to user or assistant leads, which is one place each.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

_MODULUS, _BASE = (1 << 61) - 1, 911382323


class Audits:
    """Edits as linked nodes: node 0 is empty, every other one adds letters to its parent."""

    def __init__(self):
        self.letters, self.depth, self.hash, self.up = [""], [0], [0], [()]
        self.collisions = 0

    def add(self, parent: int, letters: str) -> int:
        h = self.hash[parent]
        for c in letters.encode():
            h = (h * _BASE + c) % _MODULUS
        ancestors, k = [parent], 0
        while len(self.up[ancestors[k]]) > k:
            ancestors.append(self.up[ancestors[k]][k])
            k += 1
        self.letters.append(letters)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append(h)
        self.up.append(ancestors)
        return len(self.letters) - 1

    def ancestor(self, node: int, depth: int) -> int:
        step = self.depth[node] - depth
        while step:
            k = step.bit_length() - 1
            node = self.up[node][k]
            step -= 1 << k
        return node

    def _parted(self, a: int, b: int, same) -> int:
        """Depth of the longest common prefix of two nodes of equal depth that differ."""
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and not same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.depth[a] - 1

    def less(self, a: int, b: int) -> bool:
        """Whether the letters of ``a`` come before those of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x != y:
            depth = self._parted(x, y, lambda p, q: self.hash[p] == self.hash[q])
            if self.ancestor(a, depth) != self.ancestor(b, depth):
                self.collisions += 1
                depth = self._parted(x, y, int.__eq__)
        left = right = ""
        while True:
            depth += 1
            more_left = self.letters[self.ancestor(a, depth)] if depth <= self.depth[a] else ""
            more_right = self.letters[self.ancestor(b, depth)] if depth <= self.depth[b] else ""
            left, right = left + more_left, right + more_right
            n = min(len(left), len(right))
            if left[:n] != right[:n] or not (more_left or more_right):
                return left < right
            left, right = left[n:], right[n:]

    def text(self, node: int) -> str:
        parts = []
        while node:
            parts.append(self.letters[node])
            node = self.up[node][0]
        return "".join(reversed(parts))


def _cheapest(audits: Audits, offers: list[tuple[int, int, str]]) -> tuple[int, int]:
    """Cost and node of the best of some (cost, parent, letters)."""
    cost = min(o[0] for o in offers)
    best = None
    for _, parent, letters in (o for o in offers if o[0] == cost):
        node = audits.add(parent, letters) if letters else parent
        best = node if best is None or audits.less(node, best) else best
    return cost, best


def _with_inserts(audits: Audits, cells: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """Cells after any insertions. More than one insertion from a cell can only pay on the way to the pattern's end."""
    for place, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        offers = [(cells[q][0] + INSERT, cells[q][1], "I") for q in sources if q in cells]
        own = [(*cells[place], "")] if place in cells else []
        if offers and (not own or min(o[0] for o in offers) <= own[0][0]):
            cells[place] = _cheapest(audits, own + offers)
    return cells


def _after_row(audits: Audits, cells, initial: str, fault: str, copies: int):
    """Cells after one row and those like it, which are duplicates."""
    offers: dict[int, list] = {}
    for place, (cost, node) in cells.items():
        offers.setdefault(place, []).append((cost + DELETE, node, "D"))
        if fault in ("", "truncated"):
            more = TRUNCATED if fault else 0
            if (place, initial) in _KEPT:
                offers.setdefault(_KEPT[place, initial], []).append((cost + more, node, "K"))
            offers.setdefault(_NEXT[place], []).append((cost + more + REROLE, node, "R"))
    cells = {place: _cheapest(audits, found) for place, found in offers.items()}
    if copies > 1:
        gone = "D" * (copies - 1)
        cells = {place: (cost + DELETE * len(gone), audits.add(node, gone)) for place, (cost, node) in cells.items()}
    return _with_inserts(audits, cells)


class Stretch:
    """Rows of one conversation that follow each other, entered at its beginning or in any of the cells."""

    def __init__(self, at_start: bool):
        self.entries = (-1,) if at_start else (-1, START, SYSTEM, USER, ASSISTANT)
        self.audits = [Audits() for _ in self.entries]
        self.cells = [
            _with_inserts(a, {START: (0, 0)}) if entry < 0 else {entry: (0, 0)} for entry, a in zip(self.entries, self.audits)
        ]
        self.rows = 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.initials, self.span = ["", ""], [None, None]

    def add(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        counts = self.counts
        if fault:
            counts[fault] += 1
        if copies > 1:
            counts["blank" if fault == "blank" else "duplicate"] += copies - 1
            counts["illegal"] += (copies - 1) * (initial * 2 not in _LEGAL)
        if self.rows:
            counts["illegal"] += self.initials[1] + initial not in _LEGAL
        else:
            self.initials[0] = initial
        self.initials[1] = initial
        if turn is not None:
            counts["turns"] += turn != self.span[1]
            self.span = [turn if self.span[0] is None else self.span[0], turn]
        self.rows += 1
        self.cells = [_after_row(a, cells, initial, fault, copies) for a, cells in zip(self.audits, self.cells)]

    def moves(self) -> list[dict]:
        return [
            {"entry": entry, "exit": place, "cost": cost, "audit": audits.text(node)}
            for entry, audits, cells in zip(self.entries, self.audits, self.cells) for place, (cost, node) in cells.items()
        ]

    def row(self, conv: int | None, part: int, number: int) -> tuple:
        return (conv, part, number, self.rows, *self.counts.values(), *self.initials, *self.span, self.moves())


_STRETCHES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("rows", pa.int64()),
    *((name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "turns")),
    ("first_initial", pa.string()), ("last_initial", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("moves", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
_STRETCHES_DDL = (
    "conv_id bigint, part int, number bigint, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "turns bigint, first_initial string, last_initial string, first_turn bigint, last_turn bigint, "
    "moves array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _stretch_task(limit: int):
    def found(batches):
        part, number, held, last = TaskContext.get().partitionId(), 0, None, ()
        for conv, turn, initial, fault, copies in _records(batches):
            if held is None or last != (conv,) or held.rows >= limit:
                if held is not None:
                    yield held.row(*last, part, number)
                    number += 1
                # only a conversation that begins inside the task surely begins here
                held, last = Stretch(bool(last) and last != (conv,)), (conv,)
            if copies:
                held.add(turn, initial, fault, copies)
        if held is not None:
            yield held.row(*last, part, number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(found(batches), _STRETCHES)

    return run


_AUDITED = pa.schema([
    ("conv_id", pa.int64()), *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()),
])
_AUDITED_DDL = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


class _Chain:
    """The stretches of one conversation, put together in order."""

    def __init__(self):
        self.audits, self.cells = Audits(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial, self.first, self.last = "", None, None

    def add(self, rows, blank, duplicate, truncated, illegal, turns, first_initial, last_initial, first_turn, last_turn, moves):
        if not rows:
            return
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal + (self.cells is not None and self.initial + first_initial not in _LEGAL)
        self.initial = last_initial
        if first_turn is not None:
            self.turns += turns - (first_turn == self.last)
            self.first, self.last = first_turn if self.first is None else self.first, last_turn
        offers: dict[int, list] = {}
        entered = {-1: (0, 0)} if self.cells is None else self.cells
        for m in moves:
            if m["entry"] in entered:
                cost, node = entered[m["entry"]]
                offers.setdefault(m["exit"], []).append((cost + m["cost"], node, m["audit"]))
        self.cells = {place: _cheapest(self.audits, o) for place, o in offers.items()}

    def row(self, conv) -> tuple:
        cost, node = 0, 0
        if self.cells is not None:
            cost, node = _cheapest(self.audits, [(*self.cells[q], "") for q in (START, ASSISTANT) if q in self.cells])
        gaps = self.last - self.first + 1 - self.turns if self.first is not None else 0
        return conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, self.audits.text(node)


def _chain_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        chain, last = None, ()
        for conv, *rest in _records(batches):
            if last != (conv,):
                if chain is not None:
                    yield chain.row(*last)
                chain, last = _Chain(), (conv,)
            chain.add(*rest)
        if chain is not None:
            yield chain.row(*last)

    return _batches(found(), _AUDITED)


class _Writer:
    """The repaired rows of one conversation, as its rows come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit.startswith("I", self.at):
            self.at, self.place = self.at + 1, _NEXT[self.place]
            yield _ROLE[self.place], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.place = _NEXT[self.place]
            yield _ROLE[self.place], text
        elif edit == "K":
            self.place = _KEPT[self.place, role[:1]]
            yield role, text


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, role, text) of repaired rows; before those of each conversation (conv, None, None)."""
    writer, last = None, None
    for conv, audit, role, text in _records(batches):
        if audit is not None:  # a conversation's audit comes before its rows
            if writer is not None:
                yield from ((last, *row) for row in writer.inserted())
            writer, last = _Writer(audit), conv
            yield conv, None, None
        else:
            yield from ((conv, *row) for row in writer.row(role, text))
    if writer is not None:
        yield from ((last, *row) for row in writer.inserted())


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
_ROWS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        digest, last, mark = None, None, ""
        for conv, role, text in _written(batches):
            if role is None:
                if digest is not None:
                    yield last, digest.hexdigest()
                digest, last, mark = hashlib.sha256(), conv, ""
            else:
                digest.update(f"{mark}{role}:{text}".encode())
                mark = "\n"
        if digest is not None:
            yield last, digest.hexdigest()

    return _batches(found(), _DIGESTS)


def _rows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        place = 0
        for conv, role, text in _written(batches):
            place = 0 if role is None else place + 1
            if role is not None:
                yield conv, place - 1, role, text

    return _batches(found(), _ROWS)


def _spelled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def plain_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows as they are, nulls spelled out."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        _spelled("role").alias("role"), _spelled("text").alias("text"), F.lit(1).alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The same rows, of which a checksum of ``conv_id:turn`` drops, empties, cuts, repeats or renames some.

    A dropped row stays, with 0 copies, so that its conversation is not forgotten.
    """
    rows = plain_rows(conversations)
    kind = F.crc32(F.concat(_spelled("conv_id"), F.lit(":"), _spelled("turn")).cast("binary")) % 20
    return rows.withColumn("_kind", kind).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"),
    )


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def audits(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Faults and cheapest edits per conversation of (conv_id, turn, role, text, copies)."""
    bare = F.rtrim("text", F.lit(SPACES))
    fault = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(*ENDS), "truncated").otherwise("")
    narrow = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), fault.alias("fault"), "copies")
    narrow = cut(narrow.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("copies")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    again = narrow.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    again = again.filter("n > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    late = F.col("first").isNotNull() & (place > F.col("first")) & (F.col("fault") != "blank")
    marked = narrow.join(again, same, "left").withColumn("fault", F.when(late, "duplicate").otherwise(F.col("fault")))
    marked = marked.select("conv_id", "turn", "role", "digest", "fault", "copies")
    sorted_rows = marked.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    narrow_rows = sorted_rows.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    found = cut(narrow_rows.mapInArrow(_stretch_task(stretch), _STRETCHES_DDL), "stretches")
    chained = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").drop("part", "number")
    return chained.mapInArrow(_chain_task, _AUDITED_DDL)


def _along(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order; a conversation streams through one task."""
    texts = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    texts = texts.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", F.unhex(F.md5("text")).alias("digest"))
    both = audited.select("conv_id", "audit").unionByName(texts, allowMissingColumns=True)
    first, *order = _order()
    both = both.repartition("conv_id").sortWithinPartitions(first, F.col("audit").isNull(), *order)
    return both.select("conv_id", "audit", "role", "text")


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the repaired conversations."""
    return _along(rows, audited).mapInArrow(_rows_task, "conv_id bigint, place bigint, role string, text string")


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text``, joined by newlines."""
    return _along(rows, audited).mapInArrow(_digest_task, "conv_id bigint, repaired_sha256 string")


def repair(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per conversation."""
    audited = cut(audits(rows, stretch), "audits")
    digests = repaired_digests(rows, audited).withColumnRenamed("conv_id", "_c")
    return audited.join(digests, audited["conv_id"].eqNullSafe(digests["_c"])).drop("_c")
