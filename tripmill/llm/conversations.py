"""Repair of conversations into turns that alternate between user and assistant.

Turns are gathered by conversation, sorted by turn and streamed through ``mapInPandas``. A
task carries the state of the conversation at hand from one Arrow batch to the next: for
each of four places in the pattern ``(s?(ua)+)?`` the least cost to get there, and how the
cheapest edits compare as text. Only that much is needed to go on, so a step is looked up
in a table of the steps met before. What has to be kept of a turn is a backpointer of four
bytes, and its text for the result. Both go to files of the task beyond ``SPILL_TURNS`` turns
or ``SPILL_BYTES``, so a conversation of any length takes bounded memory; at its end the
backpointers are followed from the last to the first and the texts are read once more.

Turns that repeat an earlier one are found before, by digests that are counted in the map
tasks; no task remembers the turns it has seen.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.sources.staging import staged

#: Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Beyond this a conversation at hand goes to files of its task.
SPILL_TURNS, SPILL_BYTES = 1 << 16, 1 << 22
#: Edits that the result keeps together in a batch.
BATCH = 4096

_SPACE = " \t\n\x0b\x0c\r"
_USER, _ASSISTANT = "user", "assistant"
#: Places in the pattern: nothing yet, behind s, behind u, behind a; and where a role leads.
_START, _S, _U, _A = range(4)
_NEXT = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_A, "u"): _U, (_U, "a"): _A}
_ENDS = (_START, _A)
_NEEDED = {_START: "u", _S: "u", _A: "u", _U: "a"}  # role that an inserted or changed turn gets
_INF = 1 << 60
_LETTER = "DIKR"

REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
EDITS = "conv string, place long, edit string, turn string, role string, text string"


def _inserted(place: int, times: int) -> int:
    for _ in range(times):
        place = _NEXT[place, _NEEDED[place]]
    return place


def _candidates(role: str, faulty: bool, cut: bool) -> list[tuple[int, str, int, int]]:
    """(place before, edits, place after, cost) of everything a turn may cause. ``edits`` are
    any inserted turns and then the turn's own edit. More than two inserted turns in a row
    never pay, as the places behind them can be had for less."""
    every = []
    for place in range(4):
        for times in range(3):
            here, cost = _inserted(place, times), times * INSERT
            letters = "I" * times
            every.append((place, letters + "D", here, cost + DELETE))
            if faulty:
                continue
            undeleted = cost + (TRUNCATED if cut else 0)
            if (here, role) in _NEXT:
                every.append((place, letters + "K", _NEXT[here, role], undeleted + KEEP))
            # to the role it has already would cost more than to keep it
            every.append((place, letters + "R", _NEXT[here, _NEEDED[here]], undeleted + REROLE))
    return every


@dataclass
class _Steps:
    """What a turn makes of a state, by kind of turn. A state holds the costs above the least
    one and the order of the cheapest edits as text, per place.

    Edits of two places never begin with each other: both end with the edit of the same
    turn. So their order, and the letters that are added, decide which are the least.
    """

    kinds: dict = field(default_factory=dict)
    known: dict = field(default_factory=dict)

    def __call__(self, state: tuple, kind: tuple) -> tuple[tuple, int, bytes]:
        """(next state, cost that all places have in common, backpointer)"""
        found = self.known.get((state, kind))
        if found is None:
            found = self.known[state, kind] = self._step(state, kind)
        return found

    def _step(self, state: tuple, kind: tuple) -> tuple[tuple, int, bytes]:
        if kind not in self.kinds:
            self.kinds[kind] = _candidates(*kind)
        costs, ranks = state
        best: dict[int, tuple] = {}
        for before, edits, after, cost in self.kinds[kind]:
            if costs[before] < _INF:
                way = (costs[before] + cost, ranks[before], edits, before)
                best[after] = min(best.get(after, way), way)
        least = min(way[0] for way in best.values())
        order = sorted(best, key=lambda place: best[place][1:3])
        # whoever is too far behind can't catch up: every place is within reach of every other
        costs = tuple(best[p][0] - least if p in best else _INF for p in range(4))
        ranks = tuple(order.index(p) if p in best else -1 for p in range(4))
        pointer = bytes(_packed(best[p][3], best[p][2]) if p in best else 0xFF for p in range(4))
        return (costs, ranks), least, pointer


_FIRST = ((0, _INF, _INF, _INF), (0, -1, -1, -1))


def _packed(before: int, edits: str) -> int:
    return before << 4 | (len(edits) - 1) << 2 | _LETTER.index(edits[-1])


def _unpacked(byte: int) -> tuple[int, str]:
    return byte >> 4, "I" * (byte >> 2 & 3) + _LETTER[byte & 3]


class _Tape:
    """Bytes that are appended, then read from either end; in a file once there are many."""

    def __init__(self, most: int):
        self._most, self._buffer, self._file, self._size = most, bytearray(), None, 0

    def add(self, data: bytes) -> None:
        self._buffer += data
        if len(self._buffer) >= self._most:
            if self._file is None:
                self._file = tempfile.TemporaryFile()  # of this attempt of the task alone
            self._file.write(self._buffer)
            self._size += len(self._buffer)
            self._buffer = bytearray()

    def backward(self, unit: int) -> Iterator[bytes]:
        """Units of fixed size from the last to the first."""
        for i in range(len(self._buffer) - unit, -1, -unit):
            yield bytes(self._buffer[i : i + unit])
        end, step = self._size, max(unit, self._most // unit * unit)
        while end:
            begin = max(0, end - step)
            self._file.seek(begin)
            data = self._file.read(end - begin)
            for i in range(len(data) - unit, -1, -unit):
                yield data[i : i + unit]
            end = begin

    def records(self) -> Iterator[list[bytes]]:
        """Rows written by ``add(record(...))``, first to last."""
        if self._file is not None:
            self._file.write(self._buffer)
            self._buffer = bytearray()
            self._file.seek(0)
            read = self._file.read
        else:
            read = io.BytesIO(self._buffer).read
        while head := read(12):
            yield [read(n) for n in struct.unpack("<3I", head)]

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def _record(*parts: bytes) -> bytes:
    return struct.pack("<3I", *map(len, parts)) + b"".join(parts)


class _Conversation:
    """The conversation at hand."""

    def __init__(self, conv, steps: _Steps, turns: int, size: int):
        self.conv, self.steps = conv, steps
        self.state, self.cost = _FIRST, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.initial = 0, None
        self.lowest = self.highest = None
        self.numbers, self.last = 0, None
        self.pointers, self.rows = _Tape(4 * turns), _Tape(size)

    def add(self, turn: str | None, role: str, text: str, again: bool) -> None:
        if turn is not None:
            number = int(turn)
            self.lowest = number if self.lowest is None else self.lowest
            self.highest = number
            if number != self.last:
                self.numbers, self.last = self.numbers + 1, number
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial

        end = text.rstrip(_SPACE)[-1:]
        fault = "blank" if not end else "duplicate" if again else "truncated" if end not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        kind = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
        self.state, cost, pointer = self.steps(self.state, kind)
        self.cost += cost
        self.pointers.add(pointer)
        self.rows.add(_record(*((x or "").encode("utf-8", "surrogatepass") for x in (turn, role, text))))

    def edits(self) -> tuple[int, str]:
        """The least cost and the letters of the cheapest edits."""
        costs, ranks = self.state
        ends = []
        for place in range(4):
            for times in range(3):
                if costs[place] < _INF and _inserted(place, times) in _ENDS:
                    ends.append((costs[place] + times * INSERT, ranks[place], "I" * times, place))
        cost, _, tail, place = min(ends)
        letters = bytearray(tail.encode())
        for pointer in self.pointers.backward(4):
            place, some = _unpacked(pointer[place])
            letters += some[::-1].encode()
        letters.reverse()
        return self.cost + cost, letters.decode()

    def repaired(self, audit: str) -> Iterator[tuple]:
        """(edit, turn, role, text) for each letter; the role is the one after the edit."""
        place, rows = _START, self.rows.records()
        for letter in audit:
            if letter == "I":
                turn, role, text = None, _USER if _NEEDED[place] == "u" else _ASSISTANT, ""
            else:
                turn, role, text = (x.decode("utf-8", "surrogatepass") for x in next(rows))
                if letter == "R":
                    role = _USER if _NEEDED[place] == "u" else _ASSISTANT
            if letter != "D":
                place = _NEXT[place, role[0]]
            yield letter, turn or None, role, text

    def report(self) -> tuple:
        cost, audit = self.edits()
        digest, first = hashlib.sha256(), True
        for letter, _, role, text in self.repaired(audit):
            if letter != "D":
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.numbers
        return (self.conv, gaps, *self.faults.values(), self.illegal, cost, audit, digest.hexdigest())

    def close(self) -> None:
        self.pointers.close()
        self.rows.close()


def _conversations(batches, turns: int, size: int) -> Iterator[_Conversation]:
    """Every conversation of sorted batches, once its last turn has come."""
    steps, now, last = _Steps(), None, None
    for batch in batches:
        for conv, turn, role, text, later, first, gone in batch.itertuples(index=False, name=None):
            if first:  # copies within the first turn that says it are next to each other
                row = (conv, turn, role, text)
                later, last = row == last, row
            if now is None or conv != now.conv:
                if now is not None:
                    yield now
                    now.close()
                now = _Conversation(conv, steps, turns, size)
            if not gone:
                now.add(turn, role, text, later)
    if now is not None:
        yield now
        now.close()


def _frames(rows: Iterator[tuple], schema: str, most_bytes: int = SPILL_BYTES) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in schema.split(", ")]
    found, held = [], 0
    for row in rows:
        found.append(row)
        held += sum(len(x) for x in row if isinstance(x, str))
        if len(found) >= BATCH or held >= most_bytes:
            yield pd.DataFrame(found, columns=names)
            found, held = [], 0
    if found:
        yield pd.DataFrame(found, columns=names)


def _sorted(df: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """Turns gathered by conversation and in order. Of turns that say the same, ``first``
    marks those with the least turn number and ``later`` all others."""
    blank = F.lit(" ")
    rows = df.select(
        F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), blank).alias("role"),
        F.coalesce(F.col(text).cast("string"), blank).alias("text"), F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)).alias("gone"),
    )
    said = (F.xxhash64("role", "text"), F.xxhash64("text", F.lit("again"), "role"))
    rows = rows.withColumns({"h1": said[0], "h2": said[1]})
    # which turn was the first to say it; nulls come first and have to count as the least
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = rows.where(~F.col("gone")).groupBy("conv", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv")), F.lit(""))  # a null conversation is one of its own
    repeated = staged(firsts.where("n > 1").select(key.alias("key"), "h1", "h2", "first"), "repeated-turns")
    rows = rows.withColumn("key", key).join(repeated, ["key", "h1", "h2"], "left").withColumn("at", at)
    later = F.coalesce((F.col("at") > F.col("first")) & ~F.col("gone"), F.lit(False))
    first = F.col("first").isNotNull() & ~later & ~F.col("gone")
    judged = rows.select("key", "conv", "turn", "role", "text", later.alias("later"), first.alias("first"), "gone")
    return judged.repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "gone", "role", "text").drop("key")


def _streamed(df: DataFrame, schema: str, make, conv: str, turn: str, role: str, text: str, gone: Column | None, turns: int, size: int) -> DataFrame:
    rows = _sorted(df, conv, turn, role, text, gone)

    def run(batches):
        yield from _frames((row for c in _conversations(batches, turns, size) for row in make(c)), schema)

    sent = rows.withColumn("turn", F.col("turn").cast("string"))  # no detour over floating point
    out = sent.mapInPandas(run, schema)
    kind = df.schema[conv].dataType
    return out.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv)


def report(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: Column | None = None,
    spill_turns: int = SPILL_TURNS,
    spill_bytes: int = SPILL_BYTES,
) -> DataFrame:
    """A row per conversation: gaps in its turn numbers, faults, the cheapest edits (letters
    of ``audit``, one per turn or inserted turn) with their cost, and the digest of the
    repaired turns.

    Turns are taken in order of their number (nulls first), equal numbers by role and text.
    Turns for which ``gone`` holds count as lost; a conversation without any other keeps a
    row of zeros with empty edits. Null roles and texts count as one space: such a turn has
    no role of the pattern, and is blank, respectively. Rows without a conversation are one
    conversation. Rows that agree in all columns are repeats of each other. Texts of any length
    are looked at whole. An empty table has no rows; other columns are not looked at.
    """
    return _streamed(df, REPORT, lambda c: [c.report()], conv, turn, role, text, gone, spill_turns, spill_bytes)


def _edits(c: _Conversation) -> Iterator[tuple]:
    _, audit = c.edits()
    for place, edit in enumerate(c.repaired(audit)):
        yield (c.conv, place, *edit)


def edits(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: Column | None = None,
    spill_turns: int = SPILL_TURNS,
    spill_bytes: int = SPILL_BYTES,
) -> DataFrame:
    """A row per edit, in order of ``place``: K keeps, R changes the role of, D deletes and I
    inserts a turn. The rows other than D are the repaired conversation. Nulls, ties and the
    like as in ``report``."""
    out = _streamed(df, EDITS, _edits, conv, turn, role, text, gone, spill_turns, spill_bytes)
    return out.withColumn("turn", F.col("turn").cast("long"))


def damaged(df: DataFrame) -> tuple[DataFrame, Column]:
    """The turns as a bad export would leave them, and which of them are lost.

    What happens follows from the CRC of ``conv_id:turn`` modulo 20: 0 loses the turn, 1 its
    text, 2 its ends of sentences, 3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    blank = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(F.col(c), blank) for c in ("role", "text"))
    what = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = df.select(
        "conv_id", "turn", F.when(what == 4, "user").otherwise(role).alias("role"), text.alias("text"), (what == 0).alias("lost"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy"), F.col("lost")
