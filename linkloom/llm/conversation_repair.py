"""Structure repair of conversations at least cost, streamed in two passes over sorted rows.

A repaired conversation is empty, or an optional system row and then user and assistant in turn. Rows are kept (0), given the
role user or assistant (3) or deleted (4), which blank and repeated rows must be; rows without text of either role
are inserted anywhere (3); a truncated row that is not deleted costs 3 more. Of the cheapest edits those whose initials come
first in ASCII order are taken: D, I, K, R. An initial leads from a place and a role before it to one other, so the
costs to the end and one letter for each of four states say it all.

Both passes repartition by conversation, sort by turn and carry their state from one Arrow batch to the next, whatever
a conversation's length:

1. from the last row to the first, costs to the end of the four states. Each row leaves one byte, the letters of the
   four states; every ``BLOCK`` bytes (``size``) these backpointers leave the task as a row of a table in the shared folder. Only
   roles, faults and digests are moved for this, no texts.
2. from the first row to the last, blocks sorted in front of the rows they belong to: each row's letter is read off for the
   state reached, and the row edited and passed on, or hashed.

Repeated rows (same role and text in one conversation) are found by a window keyed by conversation, role and digest, so no
task remembers what a giant conversation has said.

Defined cases: a null role or text is one space; null ids are one conversation, null turns come first and are left out of
``gaps``; rows of one turn are in the order of role and the text's SHA-256, so equal rows stand side by side; any role other than
those starting with s, u or a must be given a role or deleted; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.session import stored

LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COSTS = {"rerole": 3, "delete": 4, "insert": 3, "truncated": 3}
BLANK_RE = r"^[\x20\x09-\x0D]*$"
CUT_RE = r"[.!?][\x20\x09-\x0D]*$"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
# States: nothing yet, after system, after user, after assistant; the state after an added user or assistant row.
ADDED = (2, 2, 3, 2)
# The state after a kept row, by its initial.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
LEGAL = {"su", "ua", "au"}
# Costs of the four states at the end of a conversation.
AT_END = (0, 2 * COSTS["insert"], COSTS["insert"], 0)
ROLE_OF = {2: "user", 3: "assistant"}
# Backpointers in one row of the table.
BLOCK = 1 << 16

KEY = ["has_turn", "at", "role", "digest"]


def normal_rows(rows: DataFrame) -> DataFrame:
    """``conv`` (text), the sort key of a row, its role and text."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("at"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.sha2(text, 256).alias("digest"),
        text.alias("text"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """The sort key of each row and its first fault."""
    sizes = rows.select("conv", *KEY, F.rlike("text", F.lit(BLANK_RE)).alias("blank"), F.rlike("text", F.lit(CUT_RE)).alias("ended"))
    same = Window.partitionBy("conv", "role", "digest").orderBy("has_turn", "at")
    return sizes.withColumn("earlier", F.row_number().over(same) > 1).select(
        "conv",
        *KEY,
        F.when(F.col("blank"), BLANK).when(F.col("earlier"), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(NONE).alias("fault"),
    )


def step(costs: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Costs of the four states before a row, from those after it, and the letters to go on with, two bits each."""
    found: list[tuple[int, int]] = []
    extra = COSTS["truncated"] if fault == TRUNCATED else 0
    for state in range(4):
        ways = [(COSTS["delete"] + costs[state], DELETE)]
        if fault not in (BLANK, DUPLICATE):
            after = KEPT.get(initial, (None,) * 4)[state]
            if after is not None:
                ways.append((extra + costs[after], KEEP))
            ways.append((extra + COSTS["rerole"] + costs[ADDED[state]], REROLE))
        found.append(min(ways))
    # Rows inserted in front: at most one more changes the state after user, and so on.
    best = list(found)
    for state in (2, 3, 2, 0, 1):
        best[state] = min(best[state], (COSTS["insert"] + best[ADDED[state]][0], INSERT))
    return tuple(c for c, _ in best), sum(letter << 2 * state for state, (_, letter) in enumerate(best))


def plan(marked: DataFrame, size: int = BLOCK) -> DataFrame:
    """First pass: the backpointers of each conversation in blocks, and its figures with the block of its first rows."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, tuple] = {}
        conv, going, tally = None, False, {}
        costs, base, pointers, blocks, key, last = AT_END, 0, bytearray(), 0, None, None

        made_blocks: list[tuple] = []

        def block(summary: str | None) -> None:
            made_blocks.append((conv, *key, -blocks, bytes(reversed(pointers)), summary))

        def taken() -> Iterator[pd.DataFrame]:
            if made_blocks:
                yield pd.DataFrame(made_blocks, columns=["conv", *KEY, "nth", "pointers", "summary"])
                made_blocks.clear()

        def summary() -> str:
            gaps = tally["top"] - tally["low"] + 1 - tally["turns"] if tally["turns"] else 0
            return json.dumps({**{k: tally[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "gaps": gaps, "cost": base + costs[0]})

        for batch in batches:
            columns = (batch[c].tolist() for c in ("conv", *KEY, "fault"))
            for this, has_turn, at, role, digest, fault in zip(*columns):
                if not going or this != conv:
                    if going:
                        block(summary())
                    conv, going = this, True
                    costs, base, pointers, blocks, last = AT_END, 0, bytearray(), 0, None
                    tally = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "top": at, "low": at, "seen": None}
                elif len(pointers) == size:
                    block(None)
                    pointers, blocks = bytearray(), blocks + 1
                initial = role[:1]
                if last is not None and initial + last not in LEGAL:
                    tally["illegal"] += 1
                last = initial
                if fault:
                    tally[("", "blank", "duplicate", "truncated")[fault]] += 1
                if has_turn and tally["seen"] != at:
                    # Turns come in falling order.
                    tally.update(turns=tally["turns"] + 1, low=at, seen=at)
                at_row = (costs, initial if initial in KEPT else "", fault)
                made = known.get(at_row)
                if made is None:
                    after, letters = step(*at_row)
                    least = min(after)
                    # Costs of states differ by a bounded amount, so few rows of costs less their least are ever met.
                    made = known[at_row] = (tuple(c - least for c in after), least, letters)
                costs = made[0]
                base += made[1]
                pointers.append(made[2])
                key = (has_turn, at, role, digest)
            yield from taken()
        if going:
            block(summary())
            yield from taken()

    # Of equal rows of one turn, the one that counts as the first comes last here.
    order = [F.desc("has_turn"), F.desc("at"), F.desc("role"), F.desc("digest"), (F.col("fault") == DUPLICATE).desc()]
    schema = "conv string, has_turn boolean, at long, role string, digest string, nth long, pointers binary, summary string"
    return marked.repartition("conv").sortWithinPartitions("conv", *order).mapInPandas(work, schema)


def walk(rows: DataFrame, sink: Callable[[], "Sink"], schema: str, size: int = BLOCK) -> DataFrame:
    """Second pass: rows with the letters planned for them, handed to a sink."""
    blocks = stored(plan(faults(rows), size), "backpointers")
    marked = blocks.select("conv", *KEY, F.lit(0).alias("kind"), "nth", "pointers", "summary", F.lit(None).cast("string").alias("text"))
    given = rows.select(
        "conv",
        *KEY,
        F.lit(1).alias("kind"),
        F.lit(0).cast("long").alias("nth"),
        F.lit(None).cast("binary").alias("pointers"),
        F.lit(None).cast("string").alias("summary"),
        "text",
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = sink()
        conv, going, state = None, False, 0
        letters: deque[Iterator[int]] = deque()

        def add(state: int) -> int:
            state = ADDED[state]
            out.row("I", ROLE_OF[state], "")
            return state

        def close(state: int) -> None:
            while AT_END[state]:
                state = add(state)
            out.end()

        for batch in batches:
            columns = (batch[c].tolist() for c in ("conv", "kind", "role", "pointers", "summary", "text"))
            for this, kind, role, pointers, summary, text in zip(*columns):
                if not going or this != conv:
                    if going:
                        close(state)
                    conv, going, state = this, True, 0
                    # The first to come is the block of the first rows, with the figures of all.
                    out.start(this, json.loads(summary))
                if kind == 0:
                    letters.append(iter(pointers))
                    continue
                pointer = next(letters[0], None)
                while pointer is None:
                    letters.popleft()
                    pointer = next(letters[0], None)
                letter = pointer >> 2 * state & 3
                while letter == INSERT:
                    state = add(state)
                    letter = pointer >> 2 * state & 3
                if letter == DELETE:
                    out.row("D", role, text)
                    continue
                if letter == REROLE:
                    state = ADDED[state]
                    out.row("R", ROLE_OF[state], text)
                else:
                    state = KEPT[role[:1]][state]
                    out.row("K", role, text)
            letters = deque(x for x in letters if x.__length_hint__())
            yield from out.taken()
        if going:
            close(state)
            yield from out.taken()

    both = marked.unionByName(given)
    return both.repartition("conv").sortWithinPartitions("conv", *KEY, "kind", "nth").mapInPandas(work, schema)


class Sink:
    """Takes the edited rows of one conversation after the other; ``taken`` gives what is ready."""

    columns: list[str] = []

    def __init__(self):
        self.ready: list[tuple] = []

    def start(self, conv: str | None, figures: dict) -> None: ...

    def row(self, edit: str, role: str, text: str) -> None: ...

    def end(self) -> None: ...

    def taken(self) -> Iterator[pd.DataFrame]:
        if self.ready:
            yield pd.DataFrame(self.ready, columns=self.columns)
            self.ready = []


class Rows(Sink):
    columns = ["conv", "place", "edit", "role", "text"]

    def start(self, conv, figures):
        self.conv, self.place = conv, 0

    def row(self, edit, role, text):
        self.ready.append((self.conv, self.place, edit, role, text))
        self.place += 1


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class Digests(Sink):
    columns = ["conv", *FIGURES, "audit", "repaired_sha256"]

    def start(self, conv, figures):
        self.conv, self.figures, self.audit, self.hash, self.first = conv, figures, bytearray(), hashlib.sha256(), True

    def row(self, edit, role, text):
        self.audit += edit.encode()
        if edit != "D":
            self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
            self.first = False

    def end(self):
        self.ready.append((self.conv, *(self.figures[k] for k in FIGURES), self.audit.decode(), self.hash.hexdigest()))


def repair(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """``conv_id, place, edit, role, text`` of every edit, deleted rows too (edit D), from ``conv_id, turn, role, text``."""
    made = walk(normal_rows(rows), Rows, "conv string, place long, edit string, role string, text string", size)
    return made.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), "place", "edit", "role", "text")


def audit(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Per conversation its faults, the cost and initials of its edits, and the hash of what is left (``role:text`` lines)."""
    numbers = ", ".join(f"{k} long" for k in FIGURES)
    made = walk(normal_rows(rows), Digests, f"conv string, {numbers}, audit string, repaired_sha256 string", size)
    return made.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), *made.columns[1:])


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` harmed by the checksum of ``conv_id:turn``: dropped, emptied, cut, repeated, given to the user."""

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(F.col("conv_id")), F.lit(":"), shown(F.col("turn")))) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return (
        rows.select("conv_id", "turn", "role", "text", kind.alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )
