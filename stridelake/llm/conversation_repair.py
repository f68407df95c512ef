"""Conversation structure repair: the cheapest edits that turn each conversation into (system?)(user assistant)+.

A secondary sort brings the rows of a conversation to one task in the order of their turns; the task then streams over
Arrow batches and carries the state of a dynamic programme from row to row and batch to batch. The programme has four
places in the pattern (nothing yet, after system, after user, after assistant); of each place it keeps the cheapest
edits so far, their alphabetical rank among the four, and a running digest of what they have written. For each row it
notes four bytes, one a place, that say where the edits came from; a conversation that has noted more than ``SPILL_BYTES``
spills them to an unnamed file of the task, as Spark's own sorts do: nobody else reads it, and a repeated task starts
afresh. So memory is bounded but for the audit itself (one letter an edit), which is a single value of the result.

Two paths of equal cost to the same place are never prefixes of one another: an equal start leaves the shorter one's last
row to be treated alike and any further letter is an insertion that costs. So comparing them at the row where they meet
gives the least audit of all.

Faults, the first that holds: blank (no character but ASCII white space), duplicate (role and text stood earlier in the
conversation), truncated (the last such character is no ``.!?``). A NULL role or text is one blank; NULL turns come first;
rows of equal turn are taken by role, then text; an empty role fits no place, so it cannot be kept; a NULL conversation id
is a conversation; other columns are ignored; conversations without rows get zeros, an empty audit and the digest of
nothing; an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stridelake.llm.common import SPACE

#: Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Backpointers that one conversation keeps in memory.
SPILL_BYTES = 4 << 20
#: Repaired rows in one output batch.
OUT_ROWS = 4096

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant row leads: the role that fits a place, and the place after it.
FITTING = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
FIRST = {"s": 0, "u": 1, "a": 2}
SOUND, CUT, DUPLICATE, BLANK = range(4)
EDITS = [i + e for i in ("", "I", "II") for e in "DKR"]
DEAD = 255


# --- the programme ---


def _edits(place: int, must_go: bool, price: int, first: str) -> Iterator[tuple[str, int, int]]:
    """What can become of a row at a place: letter, next place, cost."""
    yield "D", place, DELETE
    if must_go:
        return
    role, after = FITTING[place]
    if first and role.startswith(first):
        yield "K", after, price
    elif first == "s" and place == NOTHING:
        yield "K", SYSTEM, price
    yield "R", after, REROLE + price


def _hopeless(costs: list[int | None]) -> list[int | None]:
    """Drop places from which every way on is dearer than one through another place."""
    nothing, system, user, assistant = [c if c is not None else 1 << 60 for c in costs]
    through = min(assistant, user + INSERT)
    worse = (nothing > through + DELETE, system > through, user > assistant + INSERT, assistant > user + INSERT)
    return [None if w else c for w, c in zip(worse, costs)]


@lru_cache(maxsize=100_000)
def step(costs: tuple[int | None, ...], ranks: tuple[int, ...], must_go: bool, price: int, first: str):
    """One row on: costs above the least, ranks, the least itself, and by place the place and edits it came from."""
    best: list[tuple[int, int, str, int] | None] = [None] * 4
    for source, cost in enumerate(costs):
        if cost is None:
            continue
        place = source
        for inserted in range(3):
            for letter, after, paid in _edits(place, must_go, price, first):
                way = (cost + INSERT * inserted + paid, ranks[source], "I" * inserted + letter, source)
                if best[after] is None or way < best[after]:
                    best[after] = way
            place = FITTING[place][1]
    left = _hopeless([w and w[0] for w in best])
    least = min(c for c in left if c is not None)
    order = sorted((w[1], w[2], p) for p, w in enumerate(best) if left[p] is not None)
    rank = {p: i for i, (_, _, p) in enumerate(order)}
    moves = [None if left[p] is None else (best[p][3], best[p][2]) for p in range(4)]
    back = bytes(DEAD if m is None else m[0] * len(EDITS) + EDITS.index(m[1]) for m in moves)
    return (tuple(None if c is None else c - least for c in left), tuple(rank.get(p, 0) for p in range(4)), least, tuple(moves), back)


START = ((0, None, None, None), (0, 0, 0, 0))


class Backpointers:
    """Four bytes a row, the newest first when read back; beyond ``SPILL_BYTES`` in a file of the task."""

    def __init__(self):
        self.buffer, self.file = bytearray(), None

    def add(self, back: bytes) -> None:
        self.buffer += back
        if len(self.buffer) >= SPILL_BYTES:
            if self.file is None:
                local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
                self.file = tempfile.TemporaryFile(dir=local if os.path.isdir(local) else None)
            self.file.write(self.buffer)
            self.buffer = bytearray()

    def blocks(self) -> Iterator[bytes]:
        yield bytes(self.buffer)
        if self.file is not None:
            at = self.file.tell()
            while at:
                size = min(at, SPILL_BYTES)
                at -= size
                self.file.seek(at)
                yield self.file.read(size)
            self.file.close()

    def audit(self, place: int) -> str:
        out = bytearray()
        for block in self.blocks():
            for at in range(len(block) - 4, -1, -4):
                place, edit = divmod(block[at + place], len(EDITS))
                out += EDITS[edit][::-1].encode()
        out.reverse()
        return out.decode()


def _line(place: int, role: str, text: str) -> bytes:
    return f"{'' if place == NOTHING else chr(10)}{role}:{text}".encode()


class Conversation:
    """What is carried from row to row."""

    def __init__(self, conv_id: str | None):
        self.conv_id = conv_id
        self.low = self.high = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.faults = [0, 0, 0, 0]
        self.before: str | None = None
        self.costs, self.ranks = START
        self.digests = [hashlib.sha256(), None, None, None]
        self.back = Backpointers()

    def take(self, turn: int | None, role: str, text: str | None, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1
        self.faults[fault] += 1
        first = role[:1]
        if self.before is not None:
            self.illegal += self.before + first not in ("su", "ua", "au")
        self.before = first
        self.costs, self.ranks, least, moves, back = step(
            self.costs, self.ranks, fault in (BLANK, DUPLICATE), TRUNCATED * (fault == CUT), first if first in FIRST else "")
        self.cost += least
        self.back.add(back)
        self.digests = [m and self.written(m, role, text) for m in moves]

    def written(self, move: tuple[int, str], role: str, text: str | None):
        place, edits = move
        digest = self.digests[place]
        if edits == "D":
            return digest
        digest = digest.copy()
        for letter in edits:
            fits, after = FITTING[place]
            if letter == "I":
                digest.update(_line(place, fits, ""))
                place = after
            elif letter != "D":
                digest.update(_line(place, fits if letter == "R" else role, text))
        return digest

    def result(self) -> tuple:
        ways = []
        for place, cost in enumerate(self.costs):
            if cost is not None:
                missing = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[place]
                ways.append((cost + INSERT * len(missing), self.ranks[place], place, missing))
        cost, _, place, missing = min(ways)
        digest = self.written((place, missing), "", "") if missing else self.digests[place]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, self.cost + cost,
                self.back.audit(place) + missing, digest.hexdigest())


# --- on Spark ---


def _fault(nth: Column) -> Column:
    end = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    return (F.when(end == "", BLANK).when(nth > 1, DUPLICATE).when(~end.isin(".", "!", "?"), CUT).otherwise(SOUND))


def _plain(turns: DataFrame, *more: Column) -> DataFrame:
    blank = F.lit(" ")
    return turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                        F.coalesce(F.col("text").cast("string"), blank).alias("text"), *more)


def sorted_turns(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """Rows by conversation and turn within partitions, each with its fault. One shuffle: copies of a row are numbered
    where the conversation already is, and the second sort stays there too."""
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = _plain(turns, there.alias("there")).withColumn("text", F.when(F.col("there"), F.col("text")).otherwise(""))
    early = F.col("turn").asc_nulls_first()
    nth = F.row_number().over(W.partitionBy("conv_id", "there", "role", "text").orderBy(early))
    rows = rows.repartition("conv_id").withColumn("nth", nth).withColumn("fault", _fault(F.col("nth")).cast("int"))
    return rows.sortWithinPartitions("conv_id", early, "role", "text", "nth")


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """One row for each conversation of ``turns (conv_id, turn, role, text)``: counts of faults, ``cost``, ``audit`` (the
    letters of the cheapest edits in order: Keep, Rerole, Delete, Insert) and the digest of the repaired lines.

    Rows for which ``present`` does not hold only name their conversation. ``repaired_turns`` gives the repaired rows.
    """
    kind = turns.schema["conv_id"].dataType
    gone = F.col("fault").isin(BLANK, DUPLICATE)
    slim = sorted_turns(turns, present).select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", F.when(~gone, F.col("text")).alias("text"), "fault", "there")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        now = None
        for batch in batches:
            done = []
            for conv_id, turn, role, text, fault, there in zip(*[batch[c].tolist() for c in batch.columns]):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv_id)
                if there:
                    now.take(None if turn is None else int(turn), role, text, fault)
            yield pd.DataFrame(done, columns=names)
        if now is not None:
            yield pd.DataFrame([now.result()], columns=names)

    found = slim.mapInPandas(run, "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place`` (from 0), ``role, text, edit``. The audit of a conversation is sorted
    in front of its rows and played back over them in the same stream."""
    kind = turns.schema["conv_id"].dataType
    rows = _plain(turns).withColumn("audit", F.lit(None).cast("string"))
    audits = repairs.select("conv_id", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    ordered = rows.unionByName(audits).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        conv_id = audit = None
        at = count = place = 0

        def emit(role: str, text: str, edit: str) -> None:
            nonlocal count
            out.append((conv_id, count, role, text, edit))
            count += 1

        def inserts() -> None:
            nonlocal at, place
            while at < len(audit) and audit[at] == "I":
                emit(FITTING[place][0], "", "I")
                place = FITTING[place][1]
                at += 1

        for batch in batches:
            for key, role, text, line in zip(*[batch[c].tolist() for c in ("conv_id", "role", "text", "audit")]):
                if line is not None:
                    if audit is not None:
                        inserts()
                    conv_id, audit, at, count, place = key, line, 0, 0, NOTHING
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit != "D":
                    fits, after = FITTING[place]
                    emit(fits if edit == "R" else role, text, edit)
                    place = SYSTEM if edit == "K" and place == NOTHING and role[:1] == "s" else after
                if len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=names)
                    out.clear()
        if audit is not None:
            inserts()
        yield pd.DataFrame(out, columns=names)

    names = ["conv_id", "place", "role", "text", "edit"]
    slim = ordered.select(F.col("conv_id").cast("string"), "role", "text", "audit")
    return slim.mapInPandas(run, "conv_id string, place long, role string, text string, edit string").withColumn("conv_id", F.col("conv_id").cast(kind))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, by a checksum of conversation and turn: of twenty rows one goes (``present`` false), one
    loses its text, one its sentence ends, one comes twice and one is said by the user."""
    blank = F.lit(" ")
    word = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                                F.pmod(F.crc32(word), F.lit(20)).alias("harm"))
    harm = F.col("harm")
    text = F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (harm != 0).alias("present"), F.explode(copies))
    return rows.drop("col")
