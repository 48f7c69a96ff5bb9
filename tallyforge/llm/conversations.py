"""Conversations brought into a proper order of roles by the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from math import ceil, isqrt, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import in_bitmap, slot_bitmap, written

#: White space, and the marks that end a text.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States: nothing put out yet, then after a system, a user, an assistant role.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the role that is due: user, or assistant after a user.
DUE = (USER, USER, ASSISTANT, USER)
#: Costs from the end of a conversation: nothing, or what has to be inserted.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60

# Edits of a row, in one string: u and a insert a role, K keeps the row, U and A change its role, D deletes it.
LETTERS = str.maketrans("uaUA", "IIRR")


def _moves(kind: int) -> list[list[tuple[str, int, int]]]:
    """For each state what can be done with a row but deleting it: (edit, cost, state after), in the order of letters."""
    if not kind:
        return [[]] * 4
    initial, extra = "sua-"[(kind - 1) // 2], TRUNCATED * ((kind - 1) % 2)
    found = []
    for state in range(4):
        due = DUE[state]
        keeps = SYSTEM if initial == "s" and state == START else due if initial == "?ua"[due - 1] else None
        kept = [] if keeps is None else [("K", extra, keeps)]
        found.append([*kept, ("U" if due == USER else "A", REROLE + extra, due)])
    return found


#: By kind of row: 0 must go; else 1 + 2 * (place of the role's initial in "sua", or 3) + (1 if truncated).
MOVES = [_moves(kind) for kind in range(9)]


def kind_of(must_go: bool, initial: str, truncated: bool) -> int:
    return 0 if must_go else 1 + 2 * ("sua".index(initial) if initial and initial in "sua" else 3) + truncated


def step(kind: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of all states before a row from those after it, insertions before the row included."""
    s, y, u, a = (
        min([DELETE + after[state], *[cost + after[to] for _, cost, to in moves]]) for state, moves in enumerate(MOVES[kind])
    )
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(s, INSERT + u), min(y, INSERT + u), u, a


def _edit(kind: int, at: tuple[int, ...], after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The edits of a row that cost no more than need be, the least in ASCII order (D, I, K, R), and the state after them."""
    code = ""
    while True:
        if DELETE + after[state] == at[state]:
            return code + "D", state
        if INSERT + at[DUE[state]] != at[state]:
            edit, _, to = next(m for m in MOVES[kind][state] if m[1] + after[m[2]] == at[state])
            return code + edit, to
        code += "a" if state == USER else "u"
        state = DUE[state]


def walk(kinds: list[int], end: tuple[int, ...], state: int, last: bool) -> tuple[list[str], int]:
    """Edits of each row, and the state after them.

    Backward, costs are stored at every sqrt(n)-th row only; forward, those between two
    checkpoints are computed again.  ``last`` says that the conversation ends here; roles inserted then stand behind the last row.
    """
    width = max(8, isqrt(len(kinds)))
    checkpoints, cost = {len(kinds): end}, end
    for i in range(len(kinds) - 1, -1, -1):
        cost = step(kinds[i], cost)
        if i % width == 0:
            checkpoints[i] = cost
    codes = []
    for start in range(0, len(kinds), width):
        stop = min(len(kinds), start + width)
        costs = [checkpoints[stop]]
        for i in range(stop - 1, start, -1):
            costs.append(step(kinds[i], costs[-1]))
        costs.append(checkpoints[start])
        for i in range(start, stop):
            code, state = _edit(kinds[i], costs[stop - i], costs[stop - i - 1], state)
            codes.append(code)
    while last and END[state]:
        codes[-1] += "a" if state == USER else "u"
        state = DUE[state]
    return codes, state


def transfer(kinds: list[int]) -> list[int]:
    """Costs from each state before the rows to each state after them, row by row of a matrix."""
    columns = []
    for to in range(4):
        cost = tuple(0 if s == to else NEVER for s in range(4))
        for kind in reversed(kinds):
            cost = step(kind, cost)
        columns.append(cost)
    return [min(NEVER, columns[to][s]) for s in range(4) for to in range(4)]


def lines_of(role: str, text: str, code: str) -> Iterator[tuple[str, str]]:
    """(role, text) of what a row becomes."""
    for c in code:
        if c != "D":
            yield {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}.get(c, role), text if c in "KUA" else ""


class Summary:
    """Figures of one conversation, row by row in order; only the audit grows with it, by a byte an edit."""

    def __init__(self, conv: int | None):
        self.conv, self.audit, self.digest, self.lines = conv, bytearray(), hashlib.sha256(), 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = 0
        self.first = self.turn = self.before = None

    def add(self, turn: int | None, role: str, text: str, fault: str | None, code: str) -> None:
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.first, self.turn, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        letters = code.translate(LETTERS)
        self.audit += letters.encode()
        self.cost += INSERT * letters.count("I") + REROLE * letters.count("R") + DELETE * letters.count("D")
        self.cost += TRUNCATED * (fault == "truncated" and "D" not in letters)
        for line in lines_of(role, text, code):
            self.digest.update(("\n" * bool(self.lines) + ":".join(line)).encode("utf-8", "surrogatepass"))
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.first + 1 - self.turns
        return self.conv, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest()


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_EDITED = "conv_id long, place long, turn long, role string, text string, fault string, code string"


def _tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batches(rows: Iterable[tuple], schema: str, size: int = 4096, letters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most ``size``, and of about so many ``letters``."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    held: list[tuple] = []
    weight = 0

    def packed() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if type(x) is str)
        if len(held) == size or weight >= letters:
            yield packed()
            held, weight = [], 0
    if held:
        yield packed()


def _mapped(rows: DataFrame, of: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows of tuples from rows of tuples, task by task."""
    return rows.mapInArrow(lambda batches: _batches(of(_tuples(batches)), schema), schema)


def _solved(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits of conversations that come whole and in order: (conv, live, turn, role, text) to rows of ``_EDITED``.

    A conversation without live rows gives one row without a code.
    """
    for conv, group in groupby(rows, key=lambda r: r[0]):
        live = [r for r in group if r[1]]
        seen: set[tuple[str, str]] = set()
        faults, kinds = [], []
        for _, _, _, role, text in live:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ENDS else "truncated"
            seen.add((role, text))
            faults.append(fault)
            kinds.append(kind_of(fault in ("blank", "duplicate"), role[:1], fault == "truncated"))
        if not live:
            yield conv, -1, None, None, None, None, None
            continue
        codes, _ = walk(kinds, END, START, True)
        for place, ((_, _, *row), fault, code) in enumerate(zip(live, faults, codes, strict=True)):
            yield conv, place, *row, fault, code


def _summed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """A summary per conversation of rows of ``_EDITED`` in order."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        summary = Summary(conv)
        for _, _, turn, role, text, fault, code in group:
            if code is not None:
                summary.add(turn, role, text, fault, code)
        yield summary.row()


# Long conversations: blocks of rows in order, each in a task of its own.


def _with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault`` and ``kind``; the first of equal rows is found by an aggregation, so a hot text is no hot task."""
    rows = rows.withColumn("same", F.md5(F.encode("text", "UTF-8")))
    first = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "same")]).agg(
        F.min(F.struct("turn", "tie")).alias("first"), F.count("*").alias("copies")
    )
    equal = [rows[c].eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "role", "same")]
    joined = rows.join(first.filter("copies > 1"), equal, "left")
    body = F.rtrim("text", F.lit(SPACE))
    again = F.col("first").isNotNull() & ~F.struct("turn", "tie").eqNullSafe(F.col("first"))
    fault = F.when(body == "", "blank").when(again, "duplicate").when(~F.substring(body, -1, 1).isin(*ENDS), "truncated")
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), 0).otherwise(1 + 2 * place + F.when(F.col("fault") == "truncated", 1).otherwise(0))
    return joined.withColumn("fault", fault).withColumn("kind", kind.cast("long")).select(*rows.columns, "fault", "kind").drop("same")


def _matrices(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (conv, block), group in groupby(rows, key=lambda r: r[:2]):
        yield conv, block, transfer([r[3] for r in group])


def _checkpoints(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Costs behind each block, from the last block of a conversation to its first."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        cost = END
        for _, block, matrix in group:
            yield conv, block, list(cost)
            cost = tuple(min(matrix[4 * s + to] + cost[to] for to in range(4)) for s in range(4))


def _walks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Each block walked from every state: a row of edits by state for each row, and one of the states after the block (place -1)."""
    for (conv, block), group in groupby(rows, key=lambda r: r[:2]):
        held = list(group)
        cost, ends = tuple(held[0][4]), held[0][5]
        walked = [walk([r[3] for r in held], cost, state, bool(ends)) for state in range(4)]
        yield conv, block, -1, [str(state) for _, state in walked]
        for i, r in enumerate(held):
            yield conv, block, r[2], [codes[i] for codes, _ in walked]


def _entries(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The state in which each block of a conversation is entered, from the first to the last."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        state = START
        for _, block, exits in group:
            yield conv, block, state
            state = int(exits[state])


def _edited_in_blocks(rows: DataFrame, least: int) -> DataFrame:
    """Rows of ``_EDITED`` of conversations of any length, in no order.

    All rows are sorted by ranges of their order, so a conversation is spread over tasks, and cut into blocks of about the
    square root of the longest one (``least`` at least).  A block's rows are one map from the costs behind it to those before it: a
    four by four matrix of shortest costs.  The matrices give the costs at the block borders, the checkpoints; then
    each block is walked from all four states, the states are followed over the borders, and each row takes the edits of the
    state that came true.  Only matrices and states of a conversation meet in one task, read in order and never held.
    """
    order = ["conv_id", "turn", "role", "text", "tie"]
    tied = written(rows.filter("live").drop("live").withColumn("tie", F.monotonically_increasing_id()), "damaged")
    ranged = _with_faults(tied).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("place", F.monotonically_increasing_id()).drop("tie"), "placed")
    longest = placed.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    shift = ceil(log2(max(2, least, isqrt(longest))))
    narrow = placed.select("conv_id", F.shiftright("place", shift).alias("block"), "place", "kind")

    key = ["conv_id", "block"]
    blocks = lambda df, *more: df.repartition(*key).sortWithinPartitions(*key, "place").select(*key, "place", "kind", *more)
    matrices = written(_mapped(blocks(narrow), _matrices, "conv_id long, block long, matrix array<long>"), "matrices")
    backward = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    costs = written(_mapped(backward, _checkpoints, "conv_id long, block long, cost array<long>"), "checkpoints")
    final = costs.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("block").alias("_last"))
    costs = costs.join(final, costs["conv_id"].eqNullSafe(final["_conv"])).select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "cost", (F.col("block") == F.col("_last")).cast("long").alias("ends")
    )
    met = lambda df, other: df["conv_id"].eqNullSafe(other["_conv"]) & (df["block"] == other["_block"])
    known = narrow.join(costs, met(narrow, costs))
    walks = written(_mapped(blocks(known, "cost", "ends"), _walks, "conv_id long, block long, place long, codes array<string>"), "walks")
    forward = walks.filter("place < 0").select(*key, "codes").repartition("conv_id").sortWithinPartitions(*key)
    entries = _mapped(forward, _entries, "conv_id long, block long, state long").toDF("_conv", "_block", "state")
    walks = walks.filter("place >= 0")
    chosen = walks.join(entries, met(walks, entries)).select("place", F.get("codes", F.col("state").cast("int")).alias("code"))
    return placed.join(chosen, "place").select(*[c.split()[0] for c in _EDITED.split(", ")])


def damage(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows with planted faults, by the remainder of 20 of crc32(``conv:turn``): 0 drops the row, 1 empties its text, 2 removes
    its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's.  Nulls count as one space.

    A dropped row stays with ``live`` = false, so that its conversation is known.  Other columns are left out.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(word(conv_col), F.lit(":"), word(turn_col)).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(word(text_col), "[.!?]", "")).otherwise(word(text_col))
    return rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(code == 4, "user").otherwise(word(role_col)).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(code != 0, F.when(code == 3, 2).otherwise(1))).alias("live"),
    )


def _parts(rows: DataFrame, block: int, live: Column, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame | None]:
    """(rows of short conversations, rows of long ones or None): a bitmap of fixed size tells, so nothing is shuffled for it.

    The few short conversations that hit the bitmap go with the long ones, which gives the same.
    """
    conv, turn, role, text = columns
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(
        F.col(conv).cast("long").alias("conv_id"), live.alias("live"), F.col(turn).cast("long").alias("turn"), word(role).alias("role"), word(text).alias("text")
    )
    bits = 1 << 22
    long_ones = plain.groupBy("conv_id").count().filter(F.col("count") > block)
    marks = written(slot_bitmap(long_ones, F.xxhash64("conv_id"), bits), "long")
    if not marks.head(1):
        return plain, None
    marked = in_bitmap(plain, F.xxhash64("conv_id"), marks, bits)
    return marked.filter("NOT hit").drop("hit"), marked.filter("hit").drop("hit")


def _whole(rows: DataFrame) -> DataFrame:
    """Short conversations, each whole and in order in one task."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair_conversations(
    rows: DataFrame,
    live: Column | None = None,
    block: int = 4096,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The faults of each conversation and its cheapest repair.

    Rows are taken by turn (nulls first), then role and text.  A row is blank (no character but white space), else a duplicate (role and
    text seen earlier), else truncated (does not end in a full stop, exclamation or question mark), or sound.  Edits, row
    by row: Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or assistant text 3; blank and
    duplicate rows must go, a truncated one that stays costs 3 more.  The initials of the roles must then read ``(s?(ua)+)?``.

    Costs are computed backward over four states and stored only at checkpoints, about the square root of the rows apart; walking
    forward, those between two checkpoints are computed again and of all cheapest edits the least in ASCII order
    is taken.  Conversations of up to ``block`` rows are walked whole, in one task each; longer ones in blocks that
    are spread over tasks (see ``_edited_in_blocks``).  The digest of a conversation is a chain over its rows, so one task streams
    them in order; it holds a batch of rows and the audit.

    Returns per conversation (also the null one): ``conv_id``, ``gaps`` (turns missing between the first and last known), ``blank``, ``duplicate``,
    ``truncated``, ``illegal`` (neighbours whose initials are not su, ua or au), ``cost``, ``audit`` (initials of the edits in order),
    ``repaired_sha256`` (of the repaired ``role:text``, joined by newlines).  A null role or text counts as one space.  Rows
    that are not ``live`` only name their conversation; without others it has zeros, an empty audit and the hash of nothing.
    Equal rows are duplicates.  An empty table gives no rows; no other column is read.
    """
    alive = F.lit(True) if live is None else F.coalesce(live, F.lit(False))
    short, long_rows = _parts(rows, block, alive, (conv_col, turn_col, role_col, text_col))
    summed = _mapped(_whole(short), lambda r: _summed(_solved(r)), SUMMARY)
    if long_rows is None:
        return summed
    edited = _edited_in_blocks(long_rows, min(block, 1024))
    names = [F.col("conv_id"), F.lit(-1).cast("long").alias("place"), *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _EDITED.split(", ")[2:])]]
    edited = edited.union(long_rows.select("conv_id").distinct().select(*names))
    ordered = edited.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return summed.union(_mapped(ordered, _summed, SUMMARY))


def repaired_turns(rows: DataFrame, live: Column | None = None, block: int = 4096, columns: tuple[str, ...] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """The repaired conversations themselves: ``conv_id``, ``place`` and ``line`` (their order), ``role``, ``text``.

    Rules as in ``repair_conversations``; a conversation of which nothing stays has no rows.
    """
    short, long_rows = _parts(rows, block, F.lit(True) if live is None else F.coalesce(live, F.lit(False)), columns)
    edited = _mapped(_whole(short), _solved, _EDITED)
    if long_rows is not None:
        edited = edited.union(_edited_in_blocks(long_rows, min(block, 1024)))

    def lines(found: Iterator[tuple]) -> Iterator[tuple]:
        for conv, place, _, role, text, _, code in found:
            for line, (r, t) in enumerate(lines_of(role, text, code or "")):
                yield conv, place, line, r, t

    return _mapped(edited, lines, "conv_id long, place long, line long, role string, text string")
