"""Repair of conversations: the cheapest edits that make the roles take turns.

Rows are dealt by conversation, sorted by turn and streamed: a worker keeps the state of one
conversation from Arrow batch to Arrow batch, never the conversation. Two streams are needed,
because the cheapest edit of a row depends on what follows it and the repaired text is written
from the front:

- backwards, without texts: the cost of the best edits from a row to the end, for each of the four
  states that the rows before it can leave. Of a row only its best edit in each state is kept, one
  byte. The bytes leave the worker in pieces of ``PIECE`` rows, so a conversation of any length
  needs a bounded buffer; the pieces are rows of a Spark table, not files of the worker.
- forwards: each piece is sorted in front of the rows that it covers, and the edits are followed
  from the first state on while the texts stream past.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, staged

#: Rows whose edits are sent on together.
PIECE = 65_536

#: Edits in the order that breaks ties.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the one role that may be inserted or assigned.
FREE = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Cost of the rows that must follow the last one.
AT_END = (0, 6, 3, 0)

#: Faults; the first that applies counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

ORDER = ("rank", "place", "digest", "rid")


def kept_state(initial: str, state: int) -> int | None:
    """The state after a kept row, None where its role may not stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


class Backward:
    """Best edits row by row from the end; costs are kept relative, so few situations occur."""

    def __init__(self) -> None:
        self._known: dict[tuple, tuple[tuple, int]] = {}

    def step(self, after: tuple, initial: str, fault: int) -> tuple[tuple, int]:
        """(costs before the row, its edits): two bits per state, the index of the edit in EDITS."""
        key = (after, initial if initial in ("s", "u", "a") else "", fault)
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = self._compute(*key)
        return found

    @staticmethod
    def _compute(after: tuple, initial: str, fault: int) -> tuple[tuple, int]:
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        ways: list[dict[int, float]] = []
        for state in range(4):
            way = {DELETE: COST[DELETE] + after[state]}
            if fault not in (BLANK, DUPLICATE):
                to = kept_state(initial, state)
                if to is not None:
                    way[KEEP] = extra + after[to]
                way[REROLE] = COST[REROLE] + extra + after[FREE[state]]
            ways.append(way)
        now = [min(w.values()) for w in ways]
        for _ in range(2):  # a third insertion in a row comes back to a state it has left
            now = [min(now[s], COST[INSERT] + now[FREE[s]]) for s in range(4)]
        packed = 0
        for state in range(4):
            way = ways[state] | {INSERT: COST[INSERT] + now[FREE[state]]}
            packed |= min(e for e, c in way.items() if c == now[state]) << 2 * state
        least = min(now)
        return tuple(c - least for c in now), packed


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks,
    3 repeats it, 4 makes its role user. Nulls are written as one space, in the key as well.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.filter("kind != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their order, written once. Equal rows of a conversation share a digest."""
    named = rows.select(
        F.col("conv_id").isNotNull().alias("named"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").isNotNull().cast("int").alias("rank"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("place"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    stripped = F.rtrim(F.col("text"), F.lit(SPACES))
    ends_well = F.right(stripped, F.lit(1)).isin(".", "!", "?")
    return staged(
        named.withColumns(
            {
                "digest": F.unhex(F.md5(F.concat(F.octet_length("role"), F.lit(":"), F.col("role"), F.col("text")))),
                "rid": F.monotonically_increasing_id(),
                "initial": F.substring("role", 1, 1),
                "fault": F.when(stripped == "", BLANK).when(~ends_well, TRUNCATED).otherwise(SOUND).cast("int"),
            }
        ),
        "repair-rows",
    )


def _faults(rows: DataFrame) -> DataFrame:
    """The rows without role and text, later ones of equal rows marked as duplicates."""
    light = rows.select("named", "conv", *ORDER, "initial", "fault")
    order = F.struct("rank", "place", "rid")
    repeated = (
        light.filter(F.col("fault") != BLANK)
        .groupBy("named", "conv", "digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .drop("rows")
    )
    # the other side has one row for a row that is repeated very often, so a skewed key can be split
    fault = F.when((F.col("fault") != BLANK) & (order > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    return light.join(repeated, ["named", "conv", "digest"], "left").select(
        "named", "conv", *ORDER, "initial", fault.cast("int").alias("fault")
    )


def _runs(conv: np.ndarray, named: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches of one conversation in a batch."""
    if not len(conv):
        return
    cuts = np.flatnonzero((conv[1:] != conv[:-1]) | (named[1:] != named[:-1])) + 1
    edges = [0, *cuts.tolist(), len(conv)]
    yield from zip(edges[:-1], edges[1:])


def _pieces(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits and faults of rows that come conversation by conversation, last turn first.

    A piece is named by the order of its first row, its bytes are in the order of turns.
    """
    ways, current, after, at = Backward(), None, AT_END, None
    held, seen = bytearray(), bytearray()
    out: list[tuple] = []

    def close() -> None:
        if held:
            out.append((*current, *at, bytes(reversed(held)), bytes(reversed(seen))))
            held.clear()
            seen.clear()

    names = ["named", "conv", *ORDER, "edits", "faults"]
    for batch in batches:
        conv, named = batch["conv"].to_numpy(), batch["named"].to_numpy()
        order = list(zip(*(batch[c].tolist() for c in ORDER)))
        initials, faults = batch["initial"].tolist(), batch["fault"].tolist()
        for start, end in _runs(conv, named):
            if current != (bool(named[start]), conv[start]):
                close()
                current, after = (bool(named[start]), conv[start]), AT_END
            for i in range(start, end):
                after, packed = ways.step(after, initials[i], faults[i])
                held.append(packed)
                seen.append(faults[i])
                at = order[i]
                if len(held) == PIECE:
                    close()
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    close()
    if out:
        yield pd.DataFrame(out, columns=names)


class Walk:
    """One conversation, row by row; edits are handed to ``write`` as (edit, role, text)."""

    def __init__(self, write: Callable[[int, str, str], None]):
        self.write, self.state = write, START
        self.edits, self.faults, self.at = b"", b"", 0
        self.counts, self.illegal, self.cost, self.audit = [0, 0, 0, 0], 0, 0, bytearray()
        self.turns, self.first, self.last, self.before = 0, None, None, None

    def take(self, edits: bytes, faults: bytes) -> None:
        """The edits and faults of the rows that follow."""
        self.edits, self.faults, self.at = edits, faults, 0

    def _edit(self, edit: int, role: str, text: str) -> None:
        self.cost += COST[edit]
        self.audit.append(ord(EDITS[edit]))
        self.write(edit, role, text)

    def _insert(self) -> None:
        self.state = FREE[self.state]
        self._edit(INSERT, ROLE[self.state], "")

    def row(self, rank: int, place: int, role: str, text: str) -> None:
        initial, packed, fault = role[:1], self.edits[self.at], self.faults[self.at]
        self.at += 1
        if rank:
            if self.last != place or not self.turns:
                self.turns += 1
            self.first = place if self.first is None else self.first
            self.last = place
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.counts[fault] += 1
        while (edit := packed >> 2 * self.state & 3) == INSERT:
            self._insert()
        if edit == KEEP:
            self.state = kept_state(initial, self.state)
        elif edit == REROLE:
            self.state = FREE[self.state]
            role = ROLE[self.state]
        if edit != DELETE and fault == TRUNCATED:
            self.cost += TRUNCATED_COST
        self._edit(edit, role, text)

    def end(self) -> tuple[int, ...]:
        """gaps, blank, duplicate, truncated, illegal, cost."""
        while self.state in (SYSTEM, USER):
            self._insert()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, *self.counts[1:], self.illegal, self.cost)


def _walked(batches: Iterable[pd.DataFrame], begin: Callable, finish: Callable) -> Iterator[None]:
    """Follow the edits; yields after each batch. ``begin(id)`` gives a Walk, ``finish(id, walk)`` takes it back."""
    current, walk = None, None
    for batch in batches:
        conv, named = batch["conv"].to_numpy(), batch["named"].to_numpy()
        kinds, edits, faults = (batch[c].tolist() for c in ("kind", "edits", "faults"))
        cells = list(zip(*(batch[c].tolist() for c in ("rank", "place", "role", "text"))))
        for start, end in _runs(conv, named):
            own = (bool(named[start]), conv[start])
            if current != own:
                if walk is not None:
                    finish(current, walk)
                current, walk = own, begin(own)
            for i in range(start, end):
                if kinds[i] == 2:
                    walk.row(*cells[i])
                elif kinds[i] == 1:
                    walk.take(edits[i], faults[i])
        yield
    if walk is not None:
        finish(current, walk)
    yield


def _stream(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows, the pieces in front of the rows they cover, and a first row for each id, in order."""
    ordered = _ordered(rows)
    backwards = (
        _faults(ordered)
        .repartition("named", "conv")
        .sortWithinPartitions("named", "conv", *[F.desc(c) for c in ORDER])
    )
    pieces = backwards.mapInPandas(
        _pieces, "named boolean, conv string, rank int, place long, digest binary, rid long, edits binary, faults binary"
    )
    heads = ids.select(
        F.col("conv_id").isNotNull().alias("named"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    ).distinct()
    texts = {"role": F.lit(""), "text": F.lit("")}
    order = {"rank": F.lit(-1), "place": F.lit(0).cast("long"), "digest": F.lit(b""), "rid": F.lit(0).cast("long")}
    none = {"edits": F.lit(b""), "faults": F.lit(b"")}
    every = (
        ordered.drop("initial", "fault")
        .withColumns(none | {"kind": F.lit(2)})
        .unionByName(pieces.withColumns(texts | {"kind": F.lit(1)}))
        .unionByName(heads.withColumns(order | texts | none | {"kind": F.lit(0)}))
    )
    return every.repartition("named", "conv").sortWithinPartitions("named", "conv", *ORDER, "kind")


def _id(frame: DataFrame, ids: DataFrame) -> Column:
    return F.when(F.col("named"), F.col("conv").cast(ids.schema["conv_id"].dataType)).alias("conv_id")


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, pos, edit, role, text): every edit in order; deleted rows have no ``pos``.

    ``rows`` is (conv_id, turn, role, text). Same order and rules as ``audit``.
    """
    ids = rows if ids is None else ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []

        def begin(own: tuple) -> Walk:
            pos = iter(range(1 << 62))
            return Walk(
                lambda edit, role, text: out.append(
                    (*own, -1 if edit == DELETE else next(pos), EDITS[edit], role, text)
                )
            )

        for _ in _walked(batches, begin, lambda own, walk: walk.end()):
            if out:
                yield pd.DataFrame(out, columns=["named", "conv", "pos", "edit", "role", "text"])
                out.clear()

    found = _stream(rows, ids).mapInPandas(
        run, "named boolean, conv string, pos long, edit string, role string, text string"
    )
    return found.select(_id(found, ids), F.expr("nullif(pos, -1L)").alias("pos"), "edit", "role", "text")


def audit(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired text of each conversation.

    ``rows`` is (conv_id, turn, role, text); other columns are not read. ``ids`` is a frame with
    every ``conv_id`` to report, by default those of ``rows``; one without rows has zeros, an empty
    audit and the hash of the empty text. Rows are taken by turn, null turns first; rows of one turn
    by a digest of role and text. A null role or text is one space. A null id is a conversation of
    its own. Roles count by their first character, as it is written; a role with another initial
    than s, u or a can only be replaced or deleted. Texts are read whole. An empty table gives an
    empty result.

    One worker reads a conversation from end to end, as the hash runs over all of it, but keeps
    only its counters, the hash and the letters of the edits.
    """
    ids = rows if ids is None else ids
    names = ["named", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        digest, any_row = hashlib.sha256(), False

        def write(edit: int, role: str, text: str) -> None:
            nonlocal any_row
            if edit != DELETE:
                digest.update(f"{chr(10) if any_row else ''}{role}:{text}".encode())
                any_row = True

        def begin(own: tuple) -> Walk:
            nonlocal digest, any_row
            digest, any_row = hashlib.sha256(), False
            return Walk(write)

        def finish(own: tuple, walk: Walk) -> None:
            numbers = walk.end()
            out.append((*own, *numbers, walk.audit.decode(), digest.hexdigest()))

        for _ in _walked(batches, begin, finish):
            if out:
                yield pd.DataFrame(out, columns=names)
                out.clear()

    kinds = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = _stream(rows, ids).mapInPandas(run, f"named boolean, conv string, {kinds}")
    return found.select(_id(found, ids), *names[2:])
