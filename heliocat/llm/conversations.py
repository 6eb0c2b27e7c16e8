"""Conversation structure repair by a Viterbi search whose chunks run in parallel.

Every row is kept, given another role, or deleted, and empty rows are inserted, so that the
roles' initials read ``(s?(ua)+)?`` at least cost. A row's step maps the costs to go behind it,
one per state of that grammar, to those before it; only their differences matter, so a vector
is kept less its least cost and each step is looked up once made.

Rows are sorted by range, so a conversation of any size is spread over tasks; a task cuts its
sorted rows into chunks of bounded size. A conversation that lies in one chunk is repaired
there. The chunks of the others start from a speculative vector, the one of a conversation's
end, all at once. Fix-up passes rerun a chunk from the vector that its successor now gives,
until the new vectors differ from the old ones only by a constant; passes end when no vector
changes. With the stitched vectors one walk ahead, chunk after chunk, picks the least letters.

Defined results. Rows are taken by turn, nulls first; rows of one turn by role, the text's first
64 characters and its MD5. A null role or text is one space. A null ``conv_id`` is a conversation
of its own; equal rows are duplicates. A role without a legal initial, or an empty one, cannot be
kept. An empty table gives an empty result; other columns are ignored. SHA-256 and the audit are
one value of a conversation, so the last walk over one conversation is one task, which holds the
audit and one chunk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import give_back, in_small_batches, written

#: A chunk's bounds: rows, and characters of text unless it is a single row.
CHUNK_ROWS, CHUNK_TEXT = 1000, 1 << 16
RENAME, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
#: States of the grammar: at the start, behind the system row, behind a user row, behind an answer.
START, SYSTEM, ASKED, ANSWERED = range(4)
#: The state behind a user or assistant row that a state still needs, and that row's role.
_NEXT = (ASKED, ASKED, ANSWERED, ASKED)
_ROLE = ("user", "user", "assistant", "user")
#: States that a kept row leads to, by its initial.
_KEPT = {"s": {START: SYSTEM}, "u": {START: ASKED, SYSTEM: ASKED, ANSWERED: ASKED}, "a": {ASKED: ANSWERED}}
_LEGAL = {"su", "ua", "au"}
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
_SPACES = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def _with_inserts(cost: list[int]) -> list[int]:
    """Costs to go when empty rows may come first."""
    start, system, asked, answered = cost
    asked, answered = min(asked, INSERT + answered), min(answered, INSERT + asked)
    return [min(start, INSERT + asked), min(system, INSERT + asked), asked, answered]


#: Costs to go at a conversation's end: nothing, or a question that is answered.
END: Vector = tuple(_with_inserts([0, 1 << 30, 1 << 30, 0]))


def code(role: str, fault: int) -> int:
    """What the search needs to know of a row: 0 if it must go, else its initial and whether it is cut short."""
    if fault in (BLANK, DUPLICATE):
        return 0
    return 1 + 2 * ("sua".find(role[:1]) % 4 if role else 3) + (fault == TRUNCATED)


def _edits(after: Vector, row: int, state: int) -> list[tuple[str, int, int]]:
    """The row's edits in the order of their letters: letter, cost to go, state behind."""
    found = [("D", DELETE + after[state], state)]
    if row:
        extra = UNFINISHED * ((row - 1) % 2)
        kept = _KEPT.get("sua-"[(row - 1) // 2], {}).get(state)
        if kept is not None:
            found.append(("K", extra + after[kept], kept))
        found.append(("R", RENAME + extra + after[_NEXT[state]], _NEXT[state]))
    return found


@cache
def _costs(after: Vector, row: int) -> tuple[int, ...]:
    return tuple(_with_inserts([min(c for _, c, _ in _edits(after, row, s)) for s in range(4)]))


@cache
def back(after: Vector, row: int) -> Vector:
    """The costs to go before a row, less the least of them."""
    cost = _costs(after, row)
    least = min(cost)
    return tuple(c - least for c in cost)


@cache
def ahead(after: Vector, row: int, state: int) -> tuple[tuple[str, ...], str, str | None, int, int]:
    """The least letters before and at a row: roles of rows inserted, letter, new role, state behind, cost."""
    cost, inserted = _costs(after, row), []
    while True:
        best = cost[state]
        delete, *others = _edits(after, row, state)
        if delete[1] == best:
            letter, _, then = delete
        elif INSERT + cost[_NEXT[state]] == best:
            inserted.append(_ROLE[state])
            state = _NEXT[state]
            continue
        else:
            letter, _, then = next(e for e in others if e[1] == best)
        spent = best - after[then] + INSERT * len(inserted)
        return tuple(inserted), letter, _ROLE[state] if letter == "R" else None, then, spent


def backward(codes: bytes, after: Vector) -> list[Vector]:
    """The vectors behind each row, in the rows' order, and before them the one in front of all."""
    found = [after]
    for row in reversed(codes):
        after = back(after, row)
        found.append(after)
    return found[::-1]


def rerun(codes: bytes, old: Vector, new: Vector, front: Vector) -> Vector:
    """The vector in front of a chunk from ``new``; ``front`` is the one that ``old`` gave.

    Stops at the first row where both runs differ by a constant only.
    """
    for row in reversed(codes):
        if old == new:
            return front
        old, new = back(old, row), back(new, row)
    return new


def fault_of(role: str, text: str, seen: set) -> int:
    """The row's first fault; ``seen`` holds role and text of the rows before it."""
    last = text.rstrip(_SPACES)
    if not last:
        return BLANK
    if (role, text) in seen:
        return DUPLICATE
    seen.add((role, text))
    return FINE if last[-1] in ".!?" else TRUNCATED


class Walk:
    """The walk ahead through one conversation, chunk by chunk; memory grows with the audit only."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.rows, self.written = conv_id, START, 0, 0
        self.turns, self.first, self.last = 0, None, None
        self.counts, self.illegal, self.cost = [0, 0, 0, 0], 0, 0
        self.initial, self.audit, self.sha = None, [], hashlib.sha256()
        self.lines: list[tuple[str, str | None, str | None]] = []

    def _line(self, letter: str, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written += 1
        self.lines.append((letter, role, text))

    def _insert(self, role: str) -> None:
        self.audit.append("I")
        self.cost += INSERT
        self._line("I", role, "")

    def add(self, turns: list, roles: list[str], texts: list[str], faults: bytes, after: Vector) -> None:
        """The next rows, and the vector behind the last of them."""
        codes = bytes(map(code, roles, faults))
        vectors = backward(codes, after)
        for i, (turn, role, text, fault) in enumerate(zip(turns, roles, texts, faults)):
            self.rows += 1
            self.counts[fault] += 1
            if turn is not None and turn != self.last:
                self.turns, self.last = self.turns + 1, turn
                self.first = turn if self.first is None else self.first
            if self.initial is not None and self.initial + role[:1] not in _LEGAL:
                self.illegal += 1
            self.initial = role[:1]
            inserted, letter, renamed, self.state, spent = ahead(vectors[i + 1], codes[i], self.state)
            for missing in inserted:
                self._insert(missing)
            self.audit.append(letter)
            self.cost += spent - INSERT * len(inserted)
            if letter != "D":
                self._line(letter, renamed or role, text)
            else:
                self.lines.append((letter, None, None))

    def finish(self) -> dict:
        while self.state not in (START, ANSWERED):
            self._insert(_ROLE[self.state])
            self.state = _NEXT[self.state]
        return {
            "conv_id": self.conv_id,
            "gaps": self.last - self.first + 1 - self.turns if self.turns else 0,
            "blank": self.counts[BLANK],
            "duplicate": self.counts[DUPLICATE],
            "truncated": self.counts[TRUNCATED],
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.sha.hexdigest(),
        }


_CONV = pa.schema([("conv_id", pa.int64())])
_AUDIT = pa.schema(
    [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_LINES = pa.schema([("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_CHUNK = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int64()),
        ("turns", pa.list_(pa.int64())),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("faults", pa.binary()),
        ("digests", pa.list_(pa.binary())),
    ]
)
_DDL = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"} | {
    pa.list_(k): f"array<{n}>" for k, n in ((pa.int64(), "long"), (pa.string(), "string"), (pa.binary(), "binary"))
}


def _ddl(*schemas: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for s in schemas for f in s)


class _Rows:
    """Output rows gathered to Arrow batches of bounded size."""

    def __init__(self, *schemas: pa.Schema):
        self.schema = pa.schema([f for s in schemas for f in s])
        self.rows, self.size = [], 0

    def add(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 100
        if self.size > 1 << 21:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _out(walk: Walk, lines: bool, out: _Rows, done: bool = True) -> Iterator[pa.RecordBatch]:
    """What is to be returned of a walk: its digest at the end, or its repaired rows."""
    if not lines:
        walk.lines = []
        if done:
            found = walk.finish()
            yield from out.add(found, len(found["audit"]))
        return
    if done:
        walk.finish()
    for place, (letter, role, text) in enumerate(walk.lines, len(walk.audit) - len(walk.lines)):
        row = {"conv_id": walk.conv_id, "place": place, "edit": letter, "role": role, "text": text}
        yield from out.add(row, len(text or ""))
    walk.lines = []


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{role}\0{text}".encode()).digest()


def _scan(chunk_rows: int, chunk_text: int, lines: bool):
    """Sorted rows to chunks; a conversation that lies in one chunk, away from the task's ends, is repaired."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_CONV, _LINES if lines else _AUDIT, _CHUNK)
        part, seq, conv, first, cut = TaskContext.get().partitionId(), 0, None, True, False
        rows: list[tuple] = []
        size = 0

        def chunk(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal seq, rows, size
            seen: set = set()
            faults = bytes(fault_of(role, text, seen) for _, role, text in rows)
            turns, roles, texts = ([r[i] for r in rows] for i in range(3))
            if whole:
                walk = Walk(conv)
                walk.add(turns, roles, texts, faults, END)
                yield from _out(walk, lines, out)
            else:
                # only rows that stand for a text can be repeats of one in an earlier chunk
                marks = [None if f in (BLANK, DUPLICATE) else _digest(r, t) for r, t, f in zip(roles, texts, faults)]
                row = dict(conv_id=conv, part=part, seq=seq, turns=turns, roles=roles, texts=texts, faults=faults, digests=marks)
                yield from out.add(row, size + 64 * len(rows))
            seq, rows, size = seq + 1, [], 0

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv_id", "gone", "turn", "role", "text"))
            for conv_id, gone, turn, role, text in zip(*columns):
                if first is True:
                    conv, first = conv_id, None  # the task's first conversation
                elif conv_id != conv:
                    yield from chunk(first is False and not cut)
                    conv, first, cut = conv_id, False, False
                if gone:
                    continue
                if rows and (len(rows) >= chunk_rows or size + len(text) > chunk_text):
                    yield from chunk(False)
                    cut = True
                rows.append((turn, role, text))
                size += len(text)
        if first is not True:
            yield from chunk(False)
        yield from out.flush()
        give_back()

    return run


def _key() -> list:
    """A conversation as columns that joins can compare: nulls are one conversation too."""
    return [F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("void")]


def _marked(batch: pa.RecordBatch) -> list[bytes]:
    """The chunks' faults with the repeats of rows in earlier chunks."""
    found = []
    for faults, late in zip(batch["faults"].to_pylist(), batch["late"].to_pylist()):
        changed = bytearray(faults)
        for place in late or ():
            changed[place] = DUPLICATE
        found.append(bytes(changed))
    return found


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector in front of each chunk from the one given behind it; chunks run before are only fixed up."""
    for batch in batches:
        fronts = []
        for codes, old, given, front in zip(*(batch[c].to_pylist() for c in ("codes", "behind", "given", "front"))):
            if old is None:
                fronts.append(backward(codes, tuple(given))[0])
            else:
                fronts.append(rerun(codes, tuple(old), tuple(given), tuple(front)))
        yield pa.record_batch(
            {
                **{c: batch[c] for c in ("conv", "void", "k", "codes")},
                "behind": batch["given"],
                "front": pa.array(fronts, pa.list_(pa.int64())),
            }
        )


_STATE = "conv long, void boolean, k int, codes binary, behind array<long>, front array<long>"


def _stitched(coded: DataFrame) -> DataFrame:
    """conv, void, k and the vector ``behind`` each chunk. ``coded``: conv, void, k and the chunk's codes."""
    end = F.array(*map(F.lit, END)).cast("array<long>")
    none = F.lit(None).cast("array<long>")
    first = coded.withColumns({"behind": none, "given": end, "front": none})
    state = written(first.mapInArrow(_vectors, _STATE))
    while True:
        nearer = state.select("conv", "void", (F.col("k") - 1).alias("k"), F.col("front").alias("_given"))
        joined = state.join(nearer, ["conv", "void", "k"], "left").withColumn("given", F.coalesce("_given", end))
        if joined.where("given <> behind").isEmpty():
            return state.select("conv", "void", "k", "behind")
        state = written(joined.drop("_given").mapInArrow(_vectors, _STATE))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        faults = _marked(batch)
        codes = [bytes(map(code, r, f)) for r, f in zip(batch["roles"].to_pylist(), faults)]
        yield pa.record_batch(
            {**{c: batch[c] for c in ("conv", "void", "k")}, "codes": pa.array(codes, pa.binary())}
        )


def _walked(lines: bool):
    """Chunks sorted by conversation and place to results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, walk = _Rows(_CONV, _LINES if lines else _AUDIT), None
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv_id", "k", "turns", "roles", "texts", "behind"))
            for (conv_id, k, turns, roles, texts, behind), faults in zip(zip(*columns), _marked(batch)):
                if k == 1:
                    if walk:
                        yield from _out(walk, lines, out)
                    walk = Walk(conv_id)
                walk.add(turns, roles, texts, faults, tuple(behind) if behind else END)
                yield from _out(walk, lines, out, done=False)
        if walk:
            yield from _out(walk, lines, out)
        yield from out.flush()
        give_back()

    return run


def _repair(rows: DataFrame, chunk_rows: int, chunk_text: int, lines: bool) -> DataFrame:
    head = F.substring("text", 1, 64)
    # the last key splits equal rows, whose order does not matter, over tasks
    order = [
        F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("hash"), F.col("row")
    ]
    keyed = in_small_batches(rows).withColumns(
        {"head": head, "hash": F.md5("text"), "row": F.monotonically_increasing_id()}
    )
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = (_CONV, _LINES if lines else _AUDIT)
    names = [f.name for s in kind for f in s]
    scanned = written(
        placed.select("conv_id", "gone", "turn", "role", "text").mapInArrow(
            _scan(chunk_rows, chunk_text, lines), _ddl(*kind, _CHUNK)
        )
    )
    done = scanned.where("part IS NULL").select(*names)
    open_ = scanned.where("part IS NOT NULL").select(*_key(), "conv_id", *_CHUNK.names)
    # of the chunks only their places are numbered
    by_place = Window.partitionBy("conv", "void").orderBy("part", "seq")
    places = open_.select("conv", "void", "part", "seq").withColumns(
        {"k": F.row_number().over(by_place), "n": F.count("*").over(Window.partitionBy("conv", "void"))}
    )
    chunks = written(open_.join(places, ["conv", "void", "part", "seq"]))
    several = chunks.where("n > 1")
    marks = several.select("conv", "void", "k", F.posexplode("digests").alias("place", "digest"))
    firsts = marks.where("digest IS NOT NULL").groupBy("conv", "void", "digest").agg(
        F.min("k").alias("first"), F.count("*").alias("times")
    )
    again = marks.join(firsts.where("times > 1"), ["conv", "void", "digest"]).where("k > first")
    late = written(again.groupBy("conv", "void", "k").agg(F.collect_list("place").alias("late")))
    marked = chunks.join(late, ["conv", "void", "k"], "left")
    if several.isEmpty():
        ready = marked.withColumn("behind", F.lit(None).cast("array<long>"))
    else:
        coded = marked.where("n > 1").select("conv", "void", "k", "roles", "faults", "late")
        behind = _stitched(written(coded.mapInArrow(_codes, "conv long, void boolean, k int, codes binary")))
        ready = marked.join(behind, ["conv", "void", "k"], "left")
    columns = ["conv_id", "k", "turns", "roles", "texts", "faults", "late", "behind"]
    sorted_ = ready.repartition("conv", "void").sortWithinPartitions("void", "conv", "k").select(*columns)
    return done.unionByName(sorted_.mapInArrow(_walked(lines), _ddl(*kind)))


def _rows(rows: DataFrame) -> DataFrame:
    """The operator's input: ``gone`` marks rows that only say that their conversation exists."""
    space = F.lit(" ")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.coalesce("gone", F.lit(False)) if "gone" in rows.columns else F.lit(False)).alias("gone"),
    )


def audit(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """One row per conversation: faults, the cost and letters of its repair, the repaired text's digest.

    ``rows``: conv_id, turn, role, text. Rows with a true ``gone``, if there is such a column, are
    no rows of their conversation, which is returned all the same.
    """
    return _repair(_rows(rows), chunk_rows, chunk_text, False).select("conv_id", *_AUDIT.names)


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """conv_id, place, edit, role, text: each edit in its place, with the repaired row unless deleted."""
    return _repair(_rows(rows), chunk_rows, chunk_text, True).select("conv_id", *_LINES.names)


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20; rows that it drops are ``gone``."""
    space, text, role = F.lit(" "), F.col("text").cast("string"), F.col("role").cast("string")
    name = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("long").cast("string"), space) for c in ("conv_id", "turn"))
    )
    kind = F.crc32(name) % 20
    text, role = F.coalesce(text, space), F.coalesce(role, space)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
