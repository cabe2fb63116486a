"""Conversation structure repair by dynamic programming over sorted streams.

A conversation's turns are edited at least cost until their roles read
``(s?(ua)+)?`` (an optional system turn, then user and assistant in turn):

K keep 0, R change the role to user or assistant 2, D delete 3 (the only edit of a
blank or repeated turn), I insert an empty user or assistant turn 2; a truncated
turn that stays adds 1.  Of the cheapest repairs the one whose edits, written as
letters in order, are least in ASCII is taken.

Rows are dealt by conversation and sorted by turn (secondary sort), and a
conversation's rows stream through ``mapInPandas``:

* ``plans`` carries the state of the dynamic program over Arrow batches: of each state
  of the grammar the cost of the cheapest edits that end there, and the order of
  their letters.  Costs relative to the least take few values, so the steps are a
  small automaton, built as needed, and a turn's back pointer is the number of a
  step: two bytes.  Back pointers beyond ``SPILL`` turns go to files in the shared
  folder and are read backwards at the conversation's end.
* ``apply`` streams the whole turns again, the plan first, and carries the place in the
  plan and a running digest.

So a task's memory doesn't follow the texts or the turns of a conversation, but
for its plan (a letter a turn), which is a cell of the result.  Whether a turn is
a repetition is found before, by an aggregate with map-side combine over digests.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from retainspark.llm.common import require, shared_folder

#: Turns of one conversation whose back pointers stay in memory.
SPILL = 1 << 22
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = "uuau"  # the role that an inserted or changed turn gets in each state
ACCEPTED = (0, 3)
ROLES = "sua?"
MUST_GO = 8  # kinds 0-7: role * 2 + truncated; 8: blank or repeated
#: No state dearer than this above user or assistant is ever of use: an insertion
#: and a deletion lead from either to where any other state leads.
SLACK = 5


class Steps:
    """The dynamic program as an automaton.

    A vector holds ``(cost above the least, order of the letters)`` per grammar state,
    or None where a state is out of reach or of no use.  Letters of two states that have read the
    same turns differ before either ends, so their order among themselves decides
    all later ties."""

    def __init__(self):
        self.start = ((0, 0), None, None, None)
        self.vectors = [self.start]
        self.number = {self.start: 0}
        self.known: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.back: list[dict[int, tuple[int, str]]] = []

    def step(self, vector: int, kind: int) -> tuple[int, int, int]:
        """(step, next vector, what the least cost rises by)."""
        got = self.known.get((vector, kind))
        if got is None:
            got = self.known[vector, kind] = self._make(self.vectors[vector], kind)
        return got

    def _make(self, vector: tuple, kind: int) -> tuple[int, int, int]:
        best: dict[int, tuple] = {}
        for state, cell in enumerate(vector):
            if cell is None:
                continue
            at = state
            for inserts in range(3):  # a third one would only come back to a state passed before
                for letter, cost, to in _edits(at, kind):
                    found = (cell[0] + 2 * inserts + cost, cell[1], "I" * inserts + letter, state)
                    if to not in best or found < best[to]:
                        best[to] = found
                at = NEXT[at, WANTED[at]]
        bound = min((v[0] for s, v in best.items() if s >= 2), default=1 << 30) + SLACK
        best = {s: v for s, v in best.items() if v[0] <= bound}
        least = min(v[0] for v in best.values())
        order = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        new = tuple((best[s][0] - least, order[s]) if s in best else None for s in range(4))
        if new not in self.number:
            self.number[new] = len(self.vectors)
            self.vectors.append(new)
        self.back.append({s: (v[3], v[2]) for s, v in best.items()})
        return len(self.back) - 1, self.number[new], least

    def finish(self, vector: int) -> tuple[int, int, str]:
        """(cost, last state, inserted turns at the end) of the cheapest repair."""
        ends = []
        for state, cell in enumerate(self.vectors[vector]):
            at, inserts = state, 0
            while cell is not None and at not in ACCEPTED:
                at, inserts = NEXT[at, WANTED[at]], inserts + 1
            if cell is not None:
                ends.append((cell[0] + 2 * inserts, cell[1], state, "I" * inserts))
        cost, _, state, tail = min(ends)
        return cost, state, tail


def _edits(state: int, kind: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a turn."""
    yield "D", 3, state
    if kind != MUST_GO:
        role, truncated = ROLES[kind // 2], kind % 2
        if (state, role) in NEXT:
            yield "K", truncated, NEXT[state, role]
        yield "R", 2 + truncated, NEXT[state, WANTED[state]]


class _Trail:
    """Steps taken, two bytes each, in order; read backwards.  Whole chunks beyond
    ``most`` go to files below ``folder``."""

    def __init__(self, folder: str, most: int):
        self.folder, self.most = folder, most
        self.files: list[str] = []
        self.taken: list[int] = []

    def add(self, step: int) -> None:
        self.taken.append(step)
        if len(self.taken) >= self.most:
            store, path = fs.FileSystem.from_uri(self.folder)
            store.create_dir(path, recursive=True)
            name = f"{path}/{uuid.uuid4().hex}"
            with store.open_output_stream(name) as f:
                f.write(np.array(self.taken, dtype="<u2").tobytes())
            self.files.append(name)
            self.taken = []

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.taken)
        if self.files:
            store, _ = fs.FileSystem.from_uri(self.folder)
            for name in reversed(self.files):
                with store.open_input_stream(name) as f:
                    part = np.frombuffer(f.read(), dtype="<u2")
                yield from reversed(part.tolist())
                store.delete_file(name)


class _Conversation:
    """One conversation on its way through ``plans``."""

    def __init__(self, key: str | None, steps: Steps, folder: str, most: int):
        self.key, self.steps, self.trail = key, steps, _Trail(folder, most)
        self.vector = self.cost = 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.lowest = self.turn = self.digest = None
        self.turns, self.role = 0, ""

    def add(self, turn: str | None, digest: str | None, role: str | None, fault: int, later: bool) -> None:
        if digest is None:  # the conversation's name only
            return
        if self.role and self.role + role not in ("su", "ua", "au"):
            self.illegal += 1
        same = turn == self.turn
        if turn is not None and (self.lowest is None or not same):
            self.turns += 1
            if self.lowest is None:
                self.lowest = turn
        kind = MUST_GO
        if fault == 1:
            self.blank += 1
        elif later or (same and digest == self.digest):
            self.duplicate += 1
        else:
            kind = 2 * (ROLES.find(role) if role in "sua" else 3) + (fault == 2)
            self.truncated += fault == 2
        self.turn, self.digest, self.role = turn, digest, role
        step, self.vector, rise = self.steps.step(self.vector, kind)
        self.cost += rise
        self.trail.add(step)

    def result(self) -> tuple:
        cost, state, tail = self.steps.finish(self.vector)
        letters = [tail]
        for step in self.trail.backwards():
            state, part = self.steps.back[step][state]
            letters.append(part)
        gaps = 0 if self.lowest is None else int(self.turn) - int(self.lowest) + 1 - self.turns
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + cost,
                "".join(reversed(letters)))


_PLAN = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
_PLAN_SCHEMA = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``key`` (the conversation as a string), ``turn``, ``role``, ``text``, ``digest`` (of all but the
    turn) and ``fault`` (1 blank, 2 truncated, 0 neither)."""
    cell = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = require(rows, [conv, turn, role, text]).select(
        F.col(f"`{conv}`").cast("string").alias("key"), F.col(f"`{turn}`").cast("long").alias("turn"),
        cell(role).alias("role"), cell(text).alias("text"))
    end = F.rtrim("text", F.lit(BLANKS))
    name = F.coalesce(F.concat(F.lit("k"), F.col("key")), F.lit("n"))
    parts = [name, F.col("role"), F.col("text")]
    whole = F.concat(*[x for p in parts for x in (F.char_length(p).cast("string"), F.lit(":"), p)])
    return rows.withColumns({"digest": F.md5(whole.cast("binary")), "fault": F.when(end == "", 1).when(
        ~F.right(end, F.lit(1)).isin(*ENDS), 2).otherwise(0)})


def _names(conversations: DataFrame | None, turns: DataFrame, conv: str) -> DataFrame:
    rows = turns.select("key") if conversations is None else conversations.select(F.col(f"`{conv}`").cast("string").alias("key"))
    return rows.distinct()


def plans(rows: DataFrame, conversations: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text", spill: int = SPILL) -> DataFrame:
    """The repair of every conversation: ``conv``, ``gaps`` (turn numbers missing between
    the least and the greatest), ``blank``, ``duplicate``, ``truncated`` (turns by their first
    fault), ``illegal`` (neighbouring role initials other than su, ua, au), ``cost`` and
    ``audit`` (letters of the edits).

    ``conversations`` may name conversations that have no rows: they get zeros and an
    empty audit.  Turns are taken by ``turn`` (nulls first), then role and a digest of the
    text; null roles and texts are one space; a null conversation is one of its
    own.  A turn equal to an earlier one in role and text is a duplicate, repeated
    rows too.  Very long texts are only digested.  Other columns are not read.
    Empty tables give an empty result."""
    turns = _turns(rows, conv, turn, role, text)
    slim = turns.select("key", "turn", F.left("role", F.lit(1)).alias("initial"), "digest", "fault")
    # digests that occur more than once, with the first turn that has them
    repeated = (slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.count("turn").alias("known"), F.min("turn").alias("first"))
                .filter("n > 1").select("digest", F.when(F.col("n") == F.col("known"), F.col("first")).alias("first"), F.lit(True).alias("again")))
    # behind a null turn every other one is later; equal turns lie side by side in the stream
    later = F.coalesce(F.col("again") & F.col("turn").isNotNull() & (F.col("first").isNull() | (F.col("turn") > F.col("first"))), F.lit(False))
    flagged = slim.join(repeated, "digest", "left").withColumn("later", later)
    named = _names(conversations, turns, conv).select(
        "key", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("initial"),
        F.lit(None).cast("string").alias("digest"), F.lit(0).alias("fault"), F.lit(False).alias("later"))
    cells = flagged.select(named.columns).unionByName(named)
    ordered = (cells.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), F.asc_nulls_first("initial"), "digest")
               .select("key", F.col("turn").cast("string").alias("turn"), "initial", "digest", "fault", "later"))
    folder = shared_folder(rows.sparkSession, "back-pointers")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    folder = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, here = Steps(), None
        for frame in frames:
            done = []
            for key, t, initial, digest, fault, later_ in zip(*[frame[c].tolist() for c in frame.columns], strict=True):
                if here is None or key != here.key:
                    if here is not None:
                        done.append(here.result())
                    here = _Conversation(key, steps, folder, spill)
                here.add(t, digest, initial, fault, later_)
            yield pd.DataFrame(done, columns=["key", *_PLAN])
        if here is not None:
            yield pd.DataFrame([here.result()], columns=["key", *_PLAN])

    out = ordered.mapInPandas(run, _PLAN_SCHEMA)
    return out.select(F.col("key").cast(rows.schema[conv].dataType).alias(conv), *_PLAN)


def _streams(rows: DataFrame, planned: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Plans and turns in one stream: a conversation's plan, then its turns in order."""
    turns = _turns(rows, conv, turn, role, text).select("key", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    heads = planned.select(F.col(f"`{conv}`").cast("string").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("digest"), F.col("audit").alias("text"))
    return (turns.unionByName(heads).repartition("key")
            .sortWithinPartitions("key", "kind", F.asc_nulls_first("turn"), F.left("role", F.lit(1)), "digest")
            .select("key", "kind", F.col("turn").cast("string").alias("turn"), "role", "text"))


class _Editor:
    """Walks a plan along the turns of its conversation."""

    def __init__(self, key: str | None, audit: str):
        self.key, self.audit, self.at, self.state = key, audit, 0, 0

    def _new(self) -> str:
        wanted = WANTED[self.state]
        self.state = NEXT[self.state, wanted]
        return "user" if wanted == "u" else "assistant"

    def inserted(self) -> Iterator[str]:
        """Roles of the turns inserted here."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._new()

    def turn(self, role: str) -> tuple[str, str | None]:
        """The edit of the next turn and its new role, None if it goes."""
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return edit, None
        if edit == "R":
            return edit, self._new()
        self.state = NEXT[self.state, role[:1]]
        return edit, role


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """Per batch: ``(editor, edit, turn, role, text)`` of the turns that stay or come in, and ``(editor,)``
    where a conversation ends."""
    editor = None
    for frame in frames:
        out: list[tuple] = []
        for key, kind, turn, role, text in zip(*[frame[c].tolist() for c in frame.columns], strict=True):
            if kind == 0:
                if editor is not None:
                    out += [(editor, "I", None, r, "") for r in editor.inserted()]
                    out.append((editor,))
                editor = _Editor(key, text)
                continue
            out += [(editor, "I", None, r, "") for r in editor.inserted()]
            edit, kept = editor.turn(role)
            if kept is not None:
                out.append((editor, edit, turn, kept, text))
        yield out
    if editor is not None:
        yield [*[(editor, "I", None, r, "") for r in editor.inserted()], (editor,)]


def apply(rows: DataFrame, planned: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """The repaired conversations, a row per turn: ``conv``, ``place`` (from 0), ``turn`` (null for
    an inserted one), ``role``, ``text`` and ``edit`` (K, R or I).  ``planned`` is what ``plans`` gave for
    the same rows; see there for nulls, ties and empty tables."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = 0
        for part in _walk(frames):
            done = []
            for editor, *cells in part:
                if cells:
                    edit, at, who, what = cells
                    done.append((editor.key, place, at, who, what, edit))
                place = place + 1 if cells else 0
            yield pd.DataFrame(done, columns=["key", "place", "turn", "role", "text", "edit"])

    out = _streams(rows, planned, conv, turn, role, text).mapInPandas(
        run, "key string, place long, turn string, role string, text string, edit string")
    return out.select(F.col("key").cast(rows.schema[conv].dataType).alias(conv), "place", F.col("turn").cast("long").alias("turn"),
                      "role", "text", "edit")


def digests(rows: DataFrame, planned: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``conv`` and ``repaired_sha256``: of the repaired turns as ``role:text``, joined by newlines,
    hashed as they stream by; of the empty string where nothing is left."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        running, first = hashlib.sha256(), True
        for part in _walk(frames):
            done = []
            for editor, *cells in part:
                if cells:
                    running.update(f"{'' if first else chr(10)}{cells[2]}:{cells[3]}".encode())
                    first = False
                else:
                    done.append((editor.key, running.hexdigest()))
                    running, first = hashlib.sha256(), True
            yield pd.DataFrame(done, columns=["key", "repaired_sha256"])

    out = _streams(rows, planned, conv, turn, role, text).mapInPandas(run, "key string, repaired_sha256 string")
    return out.select(F.col("key").cast(rows.schema[conv].dataType).alias(conv), "repaired_sha256")


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Stand-in input: the rows damaged by ``crc32(conv:turn) % 20``: 0 drops a row, 1
    empties its text, 2 takes out its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the
    user's.  Nulls are one space in the hashed key, and as a role or text."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit: Column = F.crc32(F.concat(cell(conv), F.lit(":"), cell(turn)).cast("binary")) % 20
    rows = rows.select(conv, turn, cell(role).alias(role), cell(text).alias(text), hit.alias("__hit")).filter("__hit != 0")
    rows = rows.withColumns({
        text: F.when(F.col("__hit") == 1, "").when(F.col("__hit") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)),
        role: F.when(F.col("__hit") == 4, "user").otherwise(F.col(role))})
    copies = F.when(F.col("__hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(conv, turn, role, text, F.explode(copies).alias("__copy")).drop("__copy")
