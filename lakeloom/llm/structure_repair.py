"""Repair of conversations: the cheapest edits that give every conversation the form
``(system? (user assistant)+)?``.

Rows are brought together by conversation and sorted by turn; a stream over Arrow batches carries the
state of a dynamic program from row to row, one entry for each place the form can be at.  What led
to an entry fits one byte (a backpointer).  Conversations of ordinary length are traced back at
once; the rows of a giant one are written out with their backpointers and traced by a second stream
that reads them from the end, so neither stream ever holds a conversation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import stage

SPACE = " \t\n\x0b\x0c\r"
#: Rows and characters of a conversation that are held to be traced in place.
HOLD_ROWS = 20_000
HOLD_CHARS = 16 << 20
#: Rows and characters of an output batch.
BATCH_ROWS = 4_000
BATCH_CHARS = 8 << 20

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
CUT_OFF = 1

# ---- the form ---------------------------------------------------------------------------------
#: Places of the form: nothing yet, behind the system turn, behind a user turn, behind an answer.
EMPTY, SYSTEM, USER, ANSWER = range(4)
ENDS = (EMPTY, ANSWER)
#: The user or assistant turn that may follow a place.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ANSWER, ANSWER: USER}
ROLE = {USER: "user", ANSWER: "assistant"}

Layer = tuple[tuple[int, int] | None, ...]
#: Per place: cost above the cheapest, and the rank of the edits' initials among the places.
START: Layer = ((0, 0), None, None, None)


def _kept(place: int, initial: str) -> int | None:
    """The place behind a kept turn, None where it may not stand."""
    if initial == "s":
        return SYSTEM if place == EMPTY else None
    follows = NEXT[place]
    return follows if initial == ROLE[follows][0] else None


def _inserted(place: int, count: int) -> int:
    for _ in range(count):
        place = NEXT[place]
    return place


@cache
def step(layer: Layer, initial: str, fault: str | None) -> tuple[Layer, int, tuple[int, ...]]:
    """One row on: the next layer, what its cheapest entry costs more, and a backpointer for each
    place (former place, inserts before the row, edit; 255 for none).

    Edits up to a row end with the edit of that row, so of two places' edits none begins with the
    other, and ranks tell which comes first by ASCII whatever follows.  Places that a dearer path
    cannot win from are dropped, which leaves few different layers: results are kept."""
    best: dict[int, tuple] = {}
    for place, entry in enumerate(layer):
        if entry is None:
            continue
        for inserts in range(3):
            at, spent = _inserted(place, inserts), entry[0] + inserts * COST[INSERT]
            choices = [(at, DELETE, COST[DELETE])]
            if fault not in ("blank", "duplicate"):
                more = CUT_OFF if fault == "truncated" else 0
                choices.append((NEXT[at], REROLE, COST[REROLE] + more))
                if (to := _kept(at, initial)) is not None:
                    choices.append((to, KEEP, COST[KEEP] + more))
            for to, edit, price in choices:
                path = (spent + price, entry[1], INSERT * inserts + edit, place, inserts, edit)
                if to not in best or path < best[to]:
                    best[to] = path
    answer, user = best.get(ANSWER), best.get(USER)
    over = {EMPTY: (answer, COST[DELETE]), SYSTEM: (answer, 0), USER: (answer, COST[INSERT]), ANSWER: (user, COST[INSERT])}
    best = {at: path for at, path in best.items() if over[at][0] is None or path[0] <= over[at][0][0] + over[at][1]}
    least = min(path[0] for path in best.values())
    ranked = sorted(best, key=lambda at: best[at][1:3])
    after = tuple((best[at][0] - least, ranked.index(at)) if at in best else None for at in range(4))
    back = tuple(best[at][3] << 4 | best[at][4] << 2 | (DELETE, KEEP, REROLE).index(best[at][5]) if at in best else 255 for at in range(4))
    return after, least, back


@cache
def finish(layer: Layer) -> tuple[int, int, int]:
    """The cheapest end: extra cost, the place it comes from and the inserts behind the last row."""
    ends = [(entry[0] + inserts * COST[INSERT], entry[1], inserts, place) for place, entry in enumerate(layer) if entry is not None
            for inserts in range(3) if _inserted(place, inserts) in ENDS]
    cost, _, inserts, place = min(ends)
    return cost, place, inserts


def pack(back: tuple[int, ...]) -> int:
    return int.from_bytes(back, "big")


def unpack(code: int, place: int) -> tuple[int, int, str]:
    """Former place, inserts before the row and edit of the row, for the place behind it."""
    byte = code >> 8 * (3 - place) & 255
    return byte >> 4, byte >> 2 & 3, (DELETE, KEEP, REROLE)[byte & 3]


# ---- rows -------------------------------------------------------------------------------------
EDIT = "conv string, pos long, sub int, edit string, turn string, old_role string, role string, text string, fault string, illegal boolean, fresh boolean, cost int"
OUT = f"{EDIT}, back long"
NAMES = [c.strip().split()[0] for c in OUT.split(",")]


class _Sheet:
    """Output rows of one batch."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.chars = 0

    def add(self, *row) -> None:
        self.rows.append(row)
        self.chars += len(row[7] or "")

    def full(self) -> bool:
        return len(self.rows) >= BATCH_ROWS or self.chars >= BATCH_CHARS

    def take(self) -> pd.DataFrame:
        frame = pd.DataFrame(self.rows, columns=NAMES, dtype=object)
        self.__init__()
        return frame


def _edits(conv, pos: int, row: tuple | None, place: int, inserts: int, edit: str | None) -> list[tuple]:
    """Output rows of the inserts before a row and of the row itself (None: the end)."""
    out = []
    for sub in range(inserts):
        place = NEXT[place]
        out.append((conv, pos, sub, INSERT, None, None, ROLE[place], "", None, False, False, COST[INSERT], None))
    if row is not None:
        turn, role, text, fault, illegal, fresh, _ = row
        cost = COST[edit] + (CUT_OFF if fault == "truncated" and edit != DELETE else 0)
        new = None if edit == DELETE else role if edit == KEEP else ROLE[NEXT[place]]
        out.append((conv, pos, inserts, edit, turn, role, new, text, fault, illegal, fresh, cost, None))
    return out


def forward(batches: Iterator[pd.DataFrame], hold_rows: int = HOLD_ROWS, hold_chars: int = HOLD_CHARS) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn to edits; rows of giant conversations leave with
    their backpointers instead, followed by a row that tells the end."""
    sheet, started, conv = _Sheet(), False, None
    held: list[tuple] = []
    first = chars = 0          # place of the first held row
    layer, before, last = START, None, None

    def spill() -> Iterator[pd.DataFrame]:
        nonlocal first, chars
        for i, (turn, role, text, fault, illegal, fresh, code) in enumerate(held):
            sheet.add(conv, first + i, 0, None, turn, role, None, text, fault, illegal, fresh, 0, code)
            if sheet.full():
                yield sheet.take()
        first += len(held)
        held.clear()
        chars = 0

    def close() -> Iterator[pd.DataFrame]:
        _, place, inserts = finish(layer)
        if first:
            yield from spill()
            sheet.add(conv, first, 0, None, None, None, None, None, None, False, False, 0, place << 4 | inserts << 2)
            return
        ends, at = [(len(held), None, place, inserts, None)], place
        for i in reversed(range(len(held))):
            origin, inserts, edit = unpack(held[i][6], at)
            ends.append((i, held[i], origin, inserts, edit))
            at = origin
        for end in reversed(ends):
            for row in _edits(conv, *end):
                sheet.add(*row)
            if sheet.full():
                yield sheet.take()

    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv", "turn", "role", "text", "fault")]
        for key, turn, role, text, fault in zip(*columns, strict=True):
            if not started or key != conv:
                if started:
                    yield from close()
                started, conv, layer, before, last = True, key, START, None, None
                held.clear()
                first = chars = 0
            initial = (role or " ")[0]
            illegal = before is not None and before + initial not in ("su", "ua", "au")
            layer, _, back = step(layer, initial if initial in "sua" else "x", fault)
            held.append((turn, role, text, fault, illegal, turn is not None and turn != last, pack(back)))
            chars += len(text or "")
            before, last = initial, turn
            if len(held) >= hold_rows or chars >= hold_chars:
                yield from spill()
    if started:
        yield from close()
    if sheet.rows:
        yield sheet.take()


def backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spilled rows from the end to the start of each conversation: follows the backpointers."""
    sheet, place, end = _Sheet(), EMPTY, {}
    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv", "pos", "turn", "old_role", "text", "fault", "illegal", "fresh", "back", "last")]
        for conv, pos, turn, role, text, fault, illegal, fresh, code, last in zip(*columns, strict=True):
            if last:
                place, inserts, row, edit = int(code) >> 4, int(code) >> 2 & 3, None, None
            else:
                place, inserts, edit = unpack(int(code), place)
                row = (turn, role, text, fault, illegal, fresh, None)
            for out in _edits(conv, int(pos), row, place, inserts, edit):
                sheet.add(*out)
            if sheet.full():
                yield sheet.take()
    if sheet.rows:
        yield sheet.take()


def faults(rows: DataFrame) -> DataFrame:
    """Adds ``fault``: blank (nothing but white space), duplicate (role and text seen earlier in the
    conversation), truncated (does not end with ``.``, ``!`` or ``?``), else null."""
    bare = F.rtrim(F.coalesce("text", F.lit("")), F.lit(SPACE))
    again = F.expr("row_number() OVER (PARTITION BY conv, role, text ORDER BY turn ASC NULLS FIRST) > 1")
    return rows.withColumn("_again", again).withColumn("fault", F.when(bare == "", "blank").when(F.col("_again"), "duplicate").when(
        ~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))


def repair(rows: DataFrame, hold_rows: int = HOLD_ROWS, hold_chars: int = HOLD_CHARS) -> DataFrame:
    """conv_id, turn, role, text to edits, one row each: conv_id, pos and sub (their order), edit (K
    keep, R new role, D delete, I insert), turn, old_role, role and text after the edit (role null
    where deleted), fault, illegal (role initials that may not follow each other), fresh (first row
    of its turn), cost.

    Conversations are taken by turn (null first; ties by role and text), blank and duplicate rows
    must go, truncated ones that stay cost one.  Of the cheapest edits those whose initials come
    first in ASCII are taken.  A null text is blank, a null or empty role fits no place, rows
    with a null conv_id are one conversation; other columns are dropped; no rows give no edits."""
    kind = {f.name: f.dataType for f in rows.schema}
    keyed = rows.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    # one exchange by conversation serves the search for duplicates and the stream
    marked = faults(keyed.repartition("conv")).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "_again")
    streamed = marked.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "fault").mapInPandas(
        lambda batches: forward(batches, hold_rows, hold_chars), OUT)
    passed = stage(streamed, "repair")
    settled = passed.filter("edit IS NOT NULL").drop("back")
    giant = passed.filter("edit IS NULL")
    ends = giant.groupBy("conv").agg(F.max("pos").alias("end_pos"))
    last = F.col("pos") == F.col("end_pos")
    wide = (giant.join(ends.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).withColumn("last", last).drop("c", "end_pos")
            .repartition("conv").sortWithinPartitions("conv", F.desc("pos")))
    traced = wide.mapInPandas(backward, OUT).drop("back")
    return settled.unionByName(traced).select(
        F.col("conv").cast(kind["conv_id"]).alias("conv_id"), "pos", "sub", "edit", F.col("turn").cast(kind["turn"]).alias("turn"),
        "old_role", "role", "text", "fault", "illegal", "fresh", "cost")


def repaired(edits: DataFrame) -> DataFrame:
    """The conversations after their edits: conv_id, pos, sub, role, text."""
    return edits.filter(F.col("edit") != DELETE).select("conv_id", "pos", "sub", "role", "text")


COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


class _Report:
    """What the edits of one conversation add up to."""

    def __init__(self, conv: str | None):
        self.conv, self.counts = conv, dict.fromkeys(COUNTS, 0)
        self.low = self.high = None
        self.distinct = self.lines = 0
        self.audit, self.sha = bytearray(), hashlib.sha256()

    def add(self, edit, turn, role, text, fault, illegal, fresh, cost) -> None:
        self.audit += edit.encode()
        if fault is not None:
            self.counts[fault] += 1
        self.counts["illegal"] += bool(illegal)
        self.counts["cost"] += int(cost)
        self.distinct += bool(fresh)
        if turn is not None:
            self.low = int(turn) if self.low is None else min(self.low, int(turn))
            self.high = int(turn) if self.high is None else max(self.high, int(turn))
        if edit != DELETE:
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, *self.counts.values(), self.audit.decode(), self.sha.hexdigest())


def report(edits: DataFrame) -> DataFrame:
    """Per conversation: gaps between turns, faults, illegal neighbours, cost, the edits' initials and the
    SHA-256 of the repaired ``role:text`` lines.  A stream sorted by conversation; of a conversation
    only the initials are held."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, started = None, False
        for batch in batches:
            done = []
            columns = [batch[c].tolist() for c in ("conv", "edit", "turn", "role", "text", "fault", "illegal", "fresh", "cost")]
            for conv, *edit in zip(*columns, strict=True):
                if not started or conv != current.conv:
                    if started:
                        done.append(current.row())
                    current, started = _Report(conv), True
                current.add(*edit)
            yield pd.DataFrame(done, columns=columns_out, dtype=object)
        if started:
            yield pd.DataFrame([current.row()], columns=columns_out, dtype=object)

    columns_out = ["conv", "gaps", *COUNTS, "audit", "repaired_sha256"]
    kind = edits.schema["conv_id"].dataType
    rows = edits.select(F.col("conv_id").cast("string").alias("conv"), "pos", "sub", "edit", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "illegal", "fresh", "cost")
    sorted_rows = rows.repartition("conv").sortWithinPartitions("conv", "pos", "sub")
    schema = "conv string, gaps long, " + ", ".join(f"{n} long" for n in COUNTS) + ", audit string, repaired_sha256 string"
    return sorted_rows.mapInPandas(digest, schema).withColumn("conv_id", F.col("conv").cast(kind)).select(
        "conv_id", *columns_out[1:])


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the remainder of crc32(``conv_id:turn``) by 20: 0 leaves the
    row out, 1 empties its text, 2 takes its sentence marks, 3 doubles it, 4 makes it a user's.
    Null roles and texts read as one space, and so do null ids in the hashed text."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    h = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    marked = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), h.alias("h")).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """``report`` of the repair of ``rows`` for every conversation of ``original``; one without rows has
    zeros, no edits and the digest of the empty text."""
    found = report(repair(rows)).withColumnRenamed("conv_id", "c")
    every = original.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zeros = {n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in ("gaps", *COUNTS)}
    return joined.select("conv_id", *[c.alias(n) for n, c in zeros.items()], F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
