"""Repair of conversations whose turns were damaged, by secondary-sorted streaming.

Rows are dealt out by conversation once and sorted inside their partition, so a
conversation passes through its task row by row, however long it is. Two passes
over the sorted rows carry a few numbers from batch to batch:

* backwards, a dynamic programme over the states of ``(s?(ua)+)?`` finds what
  every state would do with a row. These backpointers are sixteen bits a row and
  leave the pass as a column, so Spark's own sorter spills them for a long one;
* forwards, the backpointers are followed from the start state and every row
  comes out with its edit, inserted rows between them.

One conversation is one task's work, since its digest is a hash of all its text
in order; nothing of it but the audit (a letter an edit) is held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import WORD

# Costs of the edits; a truncated row that is not deleted costs TRUNCATED more.
RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
EDITS = "KRDI"
# What may be put in at the end: only START and ASSISTANT are accepted.
_TAIL = ("", "II", "I", "")
_INITIALS = ("u", "a", "s")

EDIT_SCHEMA = (
    "conv string, seq bigint, edit string, fault string, turn string, was_role string, role string, text string"
)
SUMMARY_SCHEMA = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def damaged(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with faults put in by crc32 of ``conversation:turn`` modulo 20, and ``absent``.

    0 drops a row (it stays, ``absent``, to name its conversation), 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's. A null in
    any of the four columns counts as one space there; the turn itself stays null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", space(conversation), space(turn)).cast("binary")) % 20
    said = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(fault == 4, "user").otherwise(space(role)).alias("role"),
        said.alias("text"),
        (fault == 0).alias("absent"),
        F.explode(F.when(fault == 3, twice).otherwise(once)).alias("copy"),
    ).drop("copy")


# --- the dynamic programme ----------------------------------------------------


def _after(state: int, inserts: int) -> int:
    for _ in range(inserts):
        state = ASSISTANT if state == USER else USER
    return state


def _options(kind: int) -> list[list[tuple[int, str, int, int]]]:
    """Per state: (cost, letters, next state, code) of all that may be done with a row.

    ``kind``: 0 must go; else 1 + initial (u, a, s, other) + 4 if truncated. Rows
    may be inserted before one that stays; before a deleted one is never better,
    as D comes before I. A code is the edit's number and four times the inserts.
    """
    out = []
    for state in range(4):
        own = [(DELETE, "D", state, 2)]
        if kind:
            initial, extra = (kind - 1) % 4, TRUNCATED if kind > 4 else 0
            if initial == 2 and state == START:
                own.append((extra, "K", SYSTEM, 0))
            for inserts in range(3):
                at = _after(state, inserts)
                if inserts and at == state:
                    break
                fits = initial == (1 if at == USER else 0)
                edit = 0 if fits else 1
                cost = INSERT * inserts + extra + (0 if fits else RETITLE)
                own.append((cost, "I" * inserts + EDITS[edit], _after(at, 1), edit + 4 * inserts))
        out.append(own)
    return out


def _ranks(strings: list) -> tuple[int, ...]:
    order = {s: i for i, s in enumerate(sorted(set(strings)))}
    return tuple(order[s] for s in strings)


def _end() -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Cost and rank of what is left to do after the last row, per state."""
    return tuple(INSERT * len(t) for t in _TAIL), _ranks(list(_TAIL))


class Backward:
    """The rows of a conversation from the last to the first.

    Per state: the least cost of the rest, relative to the least of all, and the
    rank of its audit among the four. Audits of different letters differ before
    the shorter ends, so (letters, rank of the rest) orders them as strings.
    Differences are bounded, so there are few situations and each is worked out once.
    """

    def __init__(self):
        self.options = [_options(kind) for kind in range(9)]
        self.known: dict = {}
        self.at = _end()

    def restart(self) -> None:
        self.at = _end()

    def row(self, kind: int) -> int:
        """Backpointers of one row: four bits a state."""
        key = (kind, self.at)
        if key not in self.known:
            cost, rank = self.at
            best = [min((c + cost[q], x, rank[q], code) for c, x, q, code in own) for own in self.options[kind]]
            least = min(b[0] for b in best)
            later = tuple(b[0] - least for b in best), _ranks([b[1:3] for b in best])
            self.known[key] = sum(b[3] << 4 * state for state, b in enumerate(best)), later
        back, self.at = self.known[key]
        return back


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds backpointers and the place from the end; rows come from the last to the first."""
    programme, conv, place, begun = Backward(), None, 0, False
    for frame in frames:
        backs, places = np.zeros(len(frame), np.int32), np.zeros(len(frame), np.int64)
        for i, (name, kind) in enumerate(zip(frame["conv"].tolist(), frame["kind"].tolist())):
            if not begun or name != conv:
                programme.restart()
                conv, place, begun = name, 0, True
            if kind >= 0:
                backs[i] = programme.row(kind)
            places[i] = place
            place += 1
        yield frame.assign(back=backs, place=places)


def _forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follows the backpointers from the first row to the last and writes the edits."""
    conv, state, seq, begun = None, START, 0, False
    names = [c.split()[0] for c in EDIT_SCHEMA.split(", ")]

    def insert(out: list, times: int) -> None:
        nonlocal state, seq
        for _ in range(times):
            out.append((conv, seq, "I", None, None, None, "assistant" if state == USER else "user", ""))
            state, seq = _after(state, 1), seq + 1

    for frame in frames:
        out: list = []
        columns = (frame[c].tolist() for c in ("conv", "kind", "back", "fault", "turn", "role", "text"))
        for name, kind, back, fault, turn, role, text in zip(*columns):
            if not begun or name != conv:
                if begun:
                    insert(out, len(_TAIL[state]))
                conv, state, seq, begun = name, START, 0, True
            if kind < 0:
                out.append((conv, None, None, None, None, None, None, None))
                continue
            code = back >> 4 * state & 15
            insert(out, code >> 2)
            edit, now = EDITS[code & 3], role
            if edit == "R":
                now = "assistant" if state == USER else "user"
            if edit != "D":
                state = SYSTEM if edit == "K" and state == START and role[:1] == "s" else _after(state, 1)
            out.append((conv, seq, edit, fault, turn, role, now, text))
            seq += 1
        yield pd.DataFrame(out, columns=names).astype({"seq": "Int64"})
    if begun:
        out = []
        insert(out, len(_TAIL[state]))
        yield pd.DataFrame(out, columns=names).astype({"seq": "Int64"})


class _Summary:
    """Running counts, audit and digest of one conversation."""

    def __init__(self, conv: str | None):
        self.conv, self.audit, self.digest = conv, bytearray(), hashlib.sha256()
        self.first = self.last = self.turn = self.before = None
        self.turns = self.cost = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.written = False

    def add(self, edit: str, fault: str | None, turn: str | None, was: str | None, role: str, text: str) -> None:
        self.audit += edit.encode()
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None and turn != self.turn:
                self.turn, self.last, self.turns = turn, int(turn), self.turns + 1
                self.first = self.last if self.first is None else self.first
            initial = was[:1]
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
        self.cost += (0, RETITLE, DELETE, INSERT)[EDITS.index(edit)] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if edit != "D":
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            self.digest.update(b"\n" + line if self.written else line)
            self.written = True

    def row(self) -> tuple:
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, (1 << 63) - 1)
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def _summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from its edits in order."""
    names = [c.split()[0] for c in SUMMARY_SCHEMA.split(", ")]
    now: _Summary | None = None
    for frame in frames:
        done = []
        columns = (frame[c].tolist() for c in ("conv", "edit", "fault", "turn", "was_role", "role", "text"))
        for conv, *edit in zip(*columns):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                now = _Summary(conv)
            if edit[0] is not None:
                now.add(*edit)
        if done:
            yield pd.DataFrame(done, columns=names)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


# --- on Spark -------------------------------------------------------------------


def _ordered_edits(turns: DataFrame, absent: Column | None) -> DataFrame:
    """Edits in order, the conversations of a partition one after the other."""
    gone = F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))
    given = lambda c: F.when(~F.col("absent"), F.coalesce(F.col(c), F.lit(" ")))
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("bigint").alias("turn"), "role", "text", gone.alias("absent")
    ).select("conv", "turn", given("role").alias("role"), given("text").alias("text"), "absent")
    # One shuffle: what follows is clustered by conversation already and only sorted.
    dealt = rows.repartition("conv")
    same = Window.partitionBy("conv", "absent", "role", "text").orderBy(F.asc_nulls_first("turn"))
    stripped = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(F.col("absent"), None)
        .when(~F.col("text").rlike(WORD), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~stripped.isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    kind = F.lit(4)
    for number, letter in enumerate(_INITIALS, 1):
        kind = F.when(initial == letter, number).otherwise(kind)
    kind = F.when(F.col("absent"), -1).when(F.col("fault").isin("blank", "duplicate"), 0).otherwise(
        kind + F.when(F.col("fault") == "truncated", 4).otherwise(0)
    )
    marked = dealt.withColumn("nth", F.row_number().over(same)).withColumn("fault", fault).withColumn("kind", kind.cast("int"))
    last_first = marked.sortWithinPartitions("conv", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("nth"))
    narrow = last_first.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "kind")
    pointed = narrow.mapInPandas(_backward, "conv string, turn string, role string, text string, fault string, kind int, back int, place bigint")
    return pointed.sortWithinPartitions("conv", F.desc("place")).mapInPandas(_forward, EDIT_SCHEMA)


def repaired(turns: DataFrame, absent: Column | None = None) -> DataFrame:
    """(conv_id, seq, edit, fault, turn, was_role, role, text): every edit of the cheapest repair.

    ``turns`` has conv_id, turn, role, text; rows with ``absent`` are left out. The
    rows of a conversation are taken by turn (null first), then role and text. A row
    is blank (no word), a duplicate (role and text seen earlier in the conversation)
    or truncated (its last character that is no white space is none of ``.!?``);
    the first that holds is its ``fault``. Edits: K keeps a row, R gives it the role
    user or assistant, D deletes it (blank and duplicate rows always), I puts in an
    empty row. The initials of the roles that stay read ``(s?(ua)+)?``; of equally
    cheap repairs the one with the least audit is taken. ``seq`` counts the edits of
    a conversation from 0. The repaired conversation is what is left without the D
    rows. Null roles and texts count as one space; a role without an initial fits
    nowhere; null conv_ids are one conversation. Equal rows are duplicates of each
    other. Further columns are not looked at.
    """
    kind = turns.schema["conv_id"].dataType
    edits = _ordered_edits(turns, absent).where(F.col("edit").isNotNull())
    typed = edits.withColumns({"conv": F.col("conv").cast(kind), "turn": F.col("turn").cast("bigint")})
    return typed.withColumnRenamed("conv", "conv_id")


def audits(turns: DataFrame, absent: Column | None = None) -> DataFrame:
    """One row per conversation of ``turns``: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256).

    ``audit`` has the initials of the edits of ``repaired`` in order, and the digest
    is of its rows as ``role:text``, joined by newlines. ``gaps`` is the number of
    turns missing between the least and the greatest (null ones apart; held at the
    end of a long), ``illegal`` that of neighbours that may not follow each other.
    A conversation all of whose rows are ``absent`` has zeros and an empty audit.
    """
    kind = turns.schema["conv_id"].dataType
    rows = _ordered_edits(turns, absent).mapInPandas(_summarise, SUMMARY_SCHEMA)
    return rows.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", "conv_id")
