"""Conversation structure repair (operator 13): secondary-sorted streaming.

Rows are repartitioned by conversation and sorted by turn inside the partition; a
``mapInPandas`` pass reads them as one stream and carries its state across Arrow
batches, so a conversation may span any number of batches.

Cheapest edits make the role initials of a conversation match ``(s?(ua)+)?``:
Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant
turn 5; blank and duplicate rows must go; a truncated row that stays costs 5 more.
The dynamic program has four cells, the state of the output after a row:

  0 nothing yet, S after a system turn, U after a user, A after an assistant.

A cell holds its least cost and the place of its audit string (the initials of the
edits) among the four; ties take the ASCII-least string.  Inserts are taken
together with the row that follows them, so no cell's string begins another's and
places decide every later comparison.  Costs are kept relative to the least one.
A cell more than ``REACH`` above it cannot be on a cheapest path (any cell can
follow the path of any other for at most that much) and is closed.  So only few
different columns of cells exist (384 in all): a row is one look-up of (column, kind of row),
which gives the next column and the number of the step taken.  These numbers, two
bytes a row, are all that the way back needs.

Memory: rows and step numbers of the current conversation; past ``SPILL`` rows or
bytes both go to a temporary file in Spark's own scratch space (removed when it is
closed; a lost task writes it again) and are read back in blocks, step numbers
from the end, rows from the start.  Duplicates are flagged before the stream by a
window inside the same partitioning: a second sort, no second shuffle, and no set
of texts seen.  One conversation is one stream by the method; however long, it
needs no more memory.

Defined results: a null role or text is one space; a null conversation id is a
conversation of its own; null turns come first; rows of equal turn are ordered by
role and text (``order_cols`` adds more keys before them); an empty table gives no
rows.  Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED_STAYS = 5
REACH = 12
#: Rows (and 256 times as many bytes) of a conversation that stay in memory.
SPILL = 100_000
#: Rows of output that one batch holds.
BATCH = 8_192

#: Characters that a blank text consists of.
SPACES = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Kinds of rows by what may be done with them.
GOOD, MUST_GO, CUT = range(3)
FAULTS = ("", "blank", "duplicate", "truncated")
ROLES = {USER: "user", ASSISTANT: "assistant"}

# Ids and turns travel as text: pandas would turn whole numbers beside nulls into floats.
EDITS = "conv_id string, step bigint, edit string, fault string, turn string, role string, text string, illegal boolean"


# ---- the dynamic program ----------------------------------------------------
def _turn(state: int) -> int:
    """The state after a user or assistant turn that fits."""
    return ASSISTANT if state == USER else USER


def _after_inserts(state: int, n: int) -> int:
    for _ in range(n):
        state = _turn(state)
    return state


def _edits(state: int, initial: str, kind: int) -> Iterator[tuple[int, str, int]]:
    """(cost, edit, next state) of all that can be done with a row."""
    yield DELETE, "D", state
    if kind == MUST_GO:
        return
    extra = TRUNCATED_STAYS if kind == CUT else 0
    yield REROLE + extra, "R", _turn(state)
    if initial == "s" and state == NOTHING:
        yield KEEP + extra, "K", SYSTEM
    if initial in "ua" and initial and _turn(state) == (USER if initial == "u" else ASSISTANT):
        yield KEEP + extra, "K", _turn(state)


#: A column of cells: for each state (cost above the least, place of its string), or None.
Column = tuple
START: Column = ((0, 0), None, None, None)


class Steps:
    """Columns and steps met so far, numbered as they come up (one set a worker)."""

    def __init__(self):
        self.columns: list[Column] = [START]
        self.number: dict[Column, int] = {START: 0}
        self.moves: dict[tuple[int, str, int], tuple[int, int, int]] = {}
        #: per step: for each next state (state before, edits)
        self.back: list[tuple] = []

    def move(self, column: int, initial: str, kind: int) -> tuple[int, int, int]:
        """(next column, cost added to the least, step) for a row."""
        key = (column, initial if initial in "sua" else "", kind)
        found = self.moves.get(key)
        if found is None:
            found = self.moves[key] = self._take(self.columns[column], *key[1:])
        return found

    def _take(self, cells: Column, initial: str, kind: int) -> tuple[int, int, int]:
        best: dict[int, tuple[int, int, str, int]] = {}
        for state, cell in enumerate(cells):
            if cell is None:
                continue
            for inserts in range(3):
                for cost, edit, after in _edits(_after_inserts(state, inserts), initial, kind):
                    way = (cell[0] + inserts * INSERT + cost, cell[1], "I" * inserts + edit, state)
                    if after not in best or way < best[after]:
                        best[after] = way
        least = min(way[0] for way in best.values())
        best = {s: way for s, way in best.items() if way[0] - least <= REACH}
        places = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        column = tuple((best[s][0] - least, places[s]) if s in best else None for s in range(4))
        if column not in self.number:
            self.number[column] = len(self.columns)
            self.columns.append(column)
        self.back.append(tuple((best[s][3], best[s][2]) if s in best else None for s in range(4)))
        return self.number[column], least, len(self.back) - 1

    def finish(self, column: int) -> tuple[int, int, int]:
        """(cost above the least, state before, inserts) of the cheapest end."""
        ways = []
        for state, cell in enumerate(self.columns[column]):
            if cell is None:
                continue
            for inserts in range(3):
                if _after_inserts(state, inserts) in (NOTHING, ASSISTANT):
                    ways.append((cell[0] + inserts * INSERT, cell[1], "I" * inserts, state))
        cost, _, tail, state = min(ways)
        return cost, state, len(tail)


_workers: dict = {}


def steps() -> Steps:
    return _workers.setdefault("steps", Steps())


# ---- one conversation ---------------------------------------------------------
class Held:
    """Rows and step numbers of the conversation being read."""

    FIELDS = ("turn", "role", "text", "fault", "illegal")

    def __init__(self, conv_id):
        self.conv_id, self.n, self.bytes = conv_id, 0, 0
        self.rows: list[tuple] = []
        self.numbers = bytearray()
        self.files = None
        self.column, self.least = 0, 0
        self.initial: str | None = None

    def add(self, row: tuple, initial: str, kind: int) -> None:
        column, cost, step = steps().move(self.column, initial, kind)
        self.column, self.least, self.initial = column, self.least + cost, initial
        self.numbers += step.to_bytes(2, "little")
        self.rows.append(row)
        self.n += 1
        self.bytes += len(row[2])
        if len(self.rows) >= SPILL or self.bytes >= 256 * SPILL:
            self._spill()

    def _spill(self) -> None:
        if self.files is None:
            scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            self.files = tempfile.TemporaryFile(dir=scratch), tempfile.TemporaryFile(dir=scratch)
        frame = pa.Table.from_pylist([dict(zip(self.FIELDS, r)) for r in self.rows], schema=_HELD)
        with pa.ipc.new_stream(self.files[0], _HELD) as stream:
            stream.write_table(frame, max_chunksize=BATCH)
        self.files[1].write(self.numbers)
        self.rows, self.bytes, self.numbers = [], 0, bytearray()

    def _numbers_backwards(self) -> Iterator[np.ndarray]:
        yield np.frombuffer(bytes(self.numbers), "<u2")
        if self.files is not None:
            done = self.files[1].tell()
            while done:
                size = min(done, 2 * SPILL)
                done -= size
                self.files[1].seek(done)
                yield np.frombuffer(self.files[1].read(size), "<u2")

    def _rows_forwards(self) -> Iterator[tuple]:
        if self.files is not None:
            stop = self.files[0].tell()
            self.files[0].seek(0)
            while self.files[0].tell() < stop:
                for batch in pa.ipc.open_stream(self.files[0]):
                    yield from zip(*(batch.column(f).to_pylist() for f in self.FIELDS))
        yield from self.rows

    def edits(self) -> Iterator[tuple]:
        """(edit, fault, turn, role, text, illegal) in order; role and text as they
        are after the edit, those of deleted rows as they were."""
        cost, state, tail = steps().finish(self.column)
        back = steps().back
        # audit pieces (at most three letters a row) from the end; packed like the step numbers
        pieces = {piece: i for i, piece in enumerate(_PIECES)}
        packed = [bytearray()]
        for block in self._numbers_backwards():
            part = bytearray(len(block))
            for i in range(len(block) - 1, -1, -1):
                state, piece = back[block[i]][state]
                part[i] = pieces[piece]
            packed.append(part)
        codes = (code for part in reversed(packed) for code in part)
        state = NOTHING
        for code, (turn, role, text, fault, illegal) in zip(codes, self._rows_forwards()):
            for edit in _PIECES[code]:
                if edit == "D":
                    yield "D", fault, turn, role, text, illegal
                elif edit == "K":
                    state = SYSTEM if role.startswith("s") else _turn(state)
                    yield "K", fault, turn, role, text, illegal
                else:
                    state = _turn(state)
                    if edit == "I":
                        yield "I", "", None, ROLES[state], "", False
                    else:
                        yield "R", fault, turn, ROLES[state], text, illegal
        for _ in range(tail):
            state = _turn(state)
            yield "I", "", None, ROLES[state], "", False
        if self.files is not None:
            for file in self.files:
                file.close()

_HELD = pa.schema([("turn", pa.string()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("illegal", pa.bool_())])
_PIECES = tuple("I" * n + e for n in range(3) for e in "DKR")
_LEGAL = ("su", "ua", "au")


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """All edits of the conversations of a sorted partition, each with its id and number."""
    held: Held | None = None
    for frame in frames:
        for conv_id, turn, role, text, fault in zip(*(frame[c] for c in ("conv_id", "turn", "role", "text", "fault"))):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    yield from ((held.conv_id, i, *edit) for i, edit in enumerate(held.edits()))
                held = Held(conv_id)
            initial = role[:1]
            illegal = held.initial is not None and held.initial + initial not in _LEGAL
            kind = CUT if fault == "truncated" else MUST_GO if fault else GOOD
            held.add((turn, role, text, fault, illegal), initial, kind)
    if held is not None:
        yield from ((held.conv_id, i, *edit) for i, edit in enumerate(held.edits()))


def _batches(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(out) >= BATCH or size >= 256 * BATCH:
            yield pd.DataFrame(out, columns=columns)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=columns)


# ---- operators ------------------------------------------------------------------
def with_faults(rows: DataFrame, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Rows (conv_id, turn, role, text) partitioned by conversation, sorted by turn,
    with each row's first fault: blank, duplicate, truncated or none (empty)."""
    space = F.lit(" ")
    clean = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"), *order_cols)
    order = [F.col("turn").asc_nulls_first(), *(F.col(c) for c in order_cols), F.col("role"), F.col("text")]
    dealt = clean.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text").orderBy(*order[:1 + len(order_cols)])
    numbered = dealt.withColumn("_again", F.row_number().over(same) > 1)
    ink = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(ink == "", "blank").when(F.col("_again"), "duplicate")
             .when(~F.right(ink, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise(""))
    return (numbered.select("conv_id", "turn", "role", "text", fault.alias("fault"), *order_cols)
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order))


def repair(rows: DataFrame, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Cheapest edits of all conversations: one row per edit, in order (``step``),
    contiguous per conversation.  The repaired conversation is the rows whose edit
    is not D; ``fault`` and ``illegal`` describe the row as it came in (illegal: its
    role cannot follow that of the row before)."""
    faulty = with_faults(rows, order_cols).select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "fault")
    columns = ["conv_id", "step", "edit", "fault", "turn", "role", "text", "illegal"]
    kind = rows.schema["conv_id"].dataType

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _batches(_stream(frames), columns)

    edits = faulty.mapInPandas(run, EDITS)
    return edits.withColumn("conv_id", F.col("conv_id").cast(kind)).withColumn("turn", F.col("turn").cast("bigint"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Test damage by d = crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties
    the text, 2 removes its ``[.!?]``, 3 repeats the row (same turn), 4 makes the role
    user.  Nulls count as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    d = F.crc32(key) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", d.alias("_d"), role.alias("role"), text.alias("text")).where(F.col("_d") != 0)
    new = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"), new.alias("text"),
                       F.explode(copies).alias("_copy")).drop("_copy")


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and the hash of
    the repaired turns.  Reads the edits as ``repair`` leaves them: a second pass over
    the same partitions, state carried along, without a shuffle."""
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    reads = ["conv_id", "step", "edit", "fault", "turn", "role", "text", "illegal"]
    price = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
    sent = edits.select(F.col("conv_id").cast("string"), "step", "edit", "fault", F.col("turn").cast("string"), "role", "text", "illegal")

    def summaries(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        state = None
        for frame in frames:
            for conv_id, step, edit, fault, turn, role, text, illegal in zip(*(frame[c] for c in reads)):
                if step == 0:
                    if state is not None:
                        yield state.row()
                    state = Summary(conv_id)
                state.add(edit, fault, None if turn is None else int(turn), role, text, bool(illegal), price[edit])
        if state is not None:
            yield state.row()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _batches(summaries(frames), columns)

    schema = "conv_id string, " + ", ".join(f"{c} bigint" for c in columns[1:7]) + ", audit string, repaired_sha256 string"
    return sent.mapInPandas(run, schema).withColumn("conv_id", F.col("conv_id").cast(edits.schema["conv_id"].dataType))


class Summary:
    """Running figures of one conversation's edits."""

    def __init__(self, conv_id):
        self.conv_id, self.first, self.last, self.distinct = conv_id, None, None, 0
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = self.turns = 0
        self.audit = bytearray()
        self.hash = hashlib.sha256()

    def add(self, edit: str, fault: str, turn, role: str, text: str, illegal: bool, price: int) -> None:
        self.audit += edit.encode()
        self.cost += price + (TRUNCATED_STAYS if fault == "truncated" and edit != "D" else 0)
        self.illegal += illegal
        if edit != "I":
            self.faults[fault] += 1
            if turn is not None:
                self.first = turn if self.first is None else self.first
                self.distinct += turn != self.last
                self.last = turn
        if edit != "D":
            self.hash.update(("\n" if self.turns else "").encode() + f"{role}:{text}".encode())
            self.turns += 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else int(self.last - self.first + 1 - self.distinct)
        return (self.conv_id, gaps, *(self.faults[f] for f in FAULTS[1:]), self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())


def with_empty(conversations: DataFrame, summary: DataFrame) -> DataFrame:
    """``summary`` with a row of zeros for conversations that have no row in it."""
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    joined = ids.join(summary, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
