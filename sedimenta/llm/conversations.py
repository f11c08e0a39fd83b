"""Conversation repair: the cheapest edits that make turns alternate, over sorted streams.

Turns are dealt out by conversation and sorted; each task goes once through its turns and carries
the costs of a conversation so far from batch to batch. What it has to remember of each turn is
two bytes, which say by which edits the cheapest ways go on, and the turn itself. Both are kept in
files of the task once they are large, so a conversation of any length needs little memory.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_code

# Bytes of a conversation that are held in memory, each for turns and for what is known of them.
IN_MEMORY = 8 << 20

# Turns of which the edits are traced at once.
STRETCH = 1 << 16

# Rows of results that leave together.
ROWS_OUT = 5_000

SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# --- fixed values: costs and roles -------------------------------------------------

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

# What has come so far: nothing, the system's turn, a user's turn, an assistant's turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# The state after a turn of the user or the assistant, whichever may come next.
NEXT = (USER, USER, ASSISTANT, USER)
FAR = 1 << 40

# Edits in the order of their initials.
EDITS = "DIKR"


def kept_state(state: int, initial: str) -> int | None:
    """The state after a turn that stays as it is, None where it may not stand there."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial in ROLES and ROLES[initial][0] == "sua"[NEXT[state] - 1]:
        return NEXT[state]
    return None


class Costs:
    """Least costs per state, one turn at a time.

    :meth:`after` gives the costs after a turn and which edits keep to them: four bits per state,
    from low to high, each a cheapest D, I, K or R from that state before the turn. Differences
    between costs are small, so few cases occur, and each is worked out once.
    """

    def __init__(self) -> None:
        self._known: dict[tuple, tuple] = {}

    def inserted(self, costs: list[int]) -> list[int]:
        """Costs before a turn when turns may be inserted; two are as many as ever help."""
        costs = list(costs)
        for _ in range(2):
            for state, cost in enumerate(tuple(costs)):
                costs[NEXT[state]] = min(costs[NEXT[state]], cost + INSERT)
        return costs

    def inserts(self, costs: list[int]) -> int:
        """The bits of inserts that keep to the costs."""
        return sum(
            2 << 4 * s for s, c in enumerate(costs) if c < FAR and c + INSERT == costs[NEXT[s]]
        )

    def after(self, costs: tuple, initial: str, must_go: bool, truncated: bool) -> tuple[int, tuple, int]:
        """(what to add to all costs, costs after the turn, bits before it); 0 is the least cost."""
        key = costs, initial, must_go, truncated
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = self._after(*key)
        return found

    def _after(self, costs: tuple, initial: str, must_go: bool, truncated: bool) -> tuple:
        before = self.inserted(costs)
        ways: list[tuple[int, int, int, int]] = []
        for state, cost in enumerate(before):
            if cost >= FAR:
                continue
            ways.append((state, 1, state, cost + DELETE))
            if not must_go:
                rest = TRUNCATED if truncated else 0
                kept = kept_state(state, initial)
                if kept is not None:
                    ways.append((state, 4, kept, cost + rest))
                ways.append((state, 8, NEXT[state], cost + REROLE + rest))
        after = [FAR] * 4
        for _, _, target, cost in ways:
            after[target] = min(after[target], cost)
        bits, best = self.inserts(before), self.inserted(after)
        for state, edit, target, cost in ways:
            # A state that an insert reaches for less is reached by no edit of this turn.
            if cost == best[target]:
                bits |= edit << 4 * state
        least = min(after)
        return least, tuple(c if c >= FAR else c - least for c in after), bits


def _target(state: int, edit: int, initial: str) -> int:
    if edit == 1:
        return state
    if edit == 4:
        return kept_state(state, initial)
    return NEXT[state]


class Conversation:
    """Turns in order; :meth:`add` them, then :meth:`finish` and go through :meth:`edits`."""

    def __init__(self, costs: Costs) -> None:
        self._costs, self._state = costs, (0, FAR, FAR, FAR)
        self._bits = SpooledTemporaryFile(IN_MEMORY)
        self._turns = SpooledTemporaryFile(IN_MEMORY)
        self._last: tuple[str | None, str, str] | None = None
        self._turn_span: list[int] = []
        self.n_turns = self.distinct = self.cost = 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: str | None, role: str, text: str, seen: bool) -> None:
        """``seen``: whether role and text stand at an earlier turn."""
        shown = text.strip(SPACE)
        blank = not shown
        duplicate = not blank and (seen or self._last == (turn, role, text))
        truncated = not blank and not duplicate and shown[-1] not in STOPS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1]
        if self._last is not None and self._last[1][:1] + initial not in LEGAL:
            self.illegal += 1
        if turn is not None and (self._last is None or self._last[0] != turn):
            self.distinct += 1
            self._turn_span = [self._turn_span[0] if self._turn_span else int(turn), int(turn)]
        self._last = turn, role, text
        kind = initial if initial in ("s", "u", "a") else ""
        more, self._state, bits = self._costs.after(
            self._state, kind, blank or duplicate, truncated
        )
        self.cost += more
        self.n_turns += 1
        self._bits.write(struct.pack("<HB", bits, ord(kind or "-")))
        r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
        self._turns.write(struct.pack("<QQ", len(r), len(t)) + r + t)

    @property
    def gaps(self) -> int:
        if not self._turn_span:
            return 0
        return self._turn_span[1] - self._turn_span[0] + 1 - self.distinct

    def finish(self) -> None:
        """Find the least cost, and trace which states the cheapest ways go through."""
        last = self._costs.inserted(list(self._state))
        end = min(last[NOTHING], last[ASSISTANT])
        self.cost += end
        live = sum(1 << s for s in (NOTHING, ASSISTANT) if last[s] == end)
        self._end_bits, self._end_live = self._costs.inserts(last), live
        live = _with_inserts(self._end_bits, live)
        # States on a cheapest way before each turn, from the last turn to the first.
        self._live = SpooledTemporaryFile(IN_MEMORY)
        self._live.truncate(0)
        for first in range((self.n_turns - 1) // STRETCH * STRETCH, -1, -STRETCH):
            n = min(STRETCH, self.n_turns - first)
            self._bits.seek(3 * first)
            stretch = self._bits.read(3 * n)
            found = bytearray(n)
            for i in range(n - 1, -1, -1):
                bits, kind = struct.unpack_from("<HB", stretch, 3 * i)
                before = 0
                for state in range(4):
                    for edit in (1, 4, 8):
                        if bits >> 4 * state & edit and live >> _target(state, edit, chr(kind)) & 1:
                            before |= 1 << state
                live = found[i] = _with_inserts(bits, before)
            self._live.seek(first)
            self._live.write(bytes(found))

    def edits(self) -> Iterator[tuple[str, str | None, str | None]]:
        """(edit, role, text) in order; role and text as repaired, None where deleted.

        Of all cheapest ways the one whose initials come first.
        """
        for file in (self._bits, self._live, self._turns):
            file.seek(0)
        state = NOTHING
        for first in range(0, self.n_turns, STRETCH):
            n = min(STRETCH, self.n_turns - first)
            bits_here, live_here = self._bits.read(3 * n), self._live.read(n)
            follows = self._live.read(1)
            self._live.seek(first + n)
            live_here += follows or bytes([_with_inserts(self._end_bits, self._end_live)])
            for i in range(n):
                bits, kind = struct.unpack_from("<HB", bits_here, 3 * i)
                role, text = self._next_turn()
                while True:
                    ways = bits >> 4 * state & 15
                    edit = next(
                        e for e in (1, 2, 4, 8)
                        if ways & e
                        and live_here[i + (e != 2)] >> _target(state, e, chr(kind)) & 1
                    )
                    state = _target(state, edit, chr(kind))
                    if edit != 2:
                        break
                    yield "I", _role(state), ""
                if edit == 1:
                    yield "D", None, None
                elif edit == 4:
                    yield "K", role, text
                else:
                    yield "R", _role(state), text
        while not self._end_live >> state & 1:
            state = NEXT[state]
            yield "I", _role(state), ""

    def _next_turn(self) -> tuple[str, str]:
        r, t = struct.unpack("<QQ", self._turns.read(16))
        found = self._turns.read(r), self._turns.read(t)
        return tuple(x.decode("utf-8", "surrogatepass") for x in found)

    def close(self) -> None:
        for file in (self._bits, self._live, self._turns):
            file.close()


def _role(state: int) -> str:
    return "user" if state == USER else "assistant"


def _with_inserts(bits: int, live: int) -> int:
    """States from which inserts that keep to the costs lead to a live one, and the live ones."""
    for _ in range(2):
        for state in range(4):
            if bits >> 4 * state & 2 and live >> NEXT[state] & 1:
                live |= 1 << state
    return live


# --- over tables ------------------------------------------------------------------


def sorted_turns(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, seen) as strings, by conversation and in order.

    ``seen``: whether role and text stand at an earlier turn of the conversation. That is known
    from counts by digest, of which only the repeated ones are joined, so no task has to remember
    what a conversation said.
    """
    space = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").alias("conv"), "turn",
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
    )
    digest = F.unhex(F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
    rows = rows.withColumn("_key", F.struct("conv", digest.alias("digest")))
    place: Column = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    counts = rows.groupBy("_key").agg(F.count("*").alias("n"), F.min(place).alias("_first"))
    repeated = counts.where("n > 1").select("_key", "_first")
    seen = F.coalesce(F.col("_first") < place, F.lit(False))
    return (
        rows.join(repeated, "_key", "left")
        .select("conv", "turn", "role", "text", seen.alias("seen"))
        .repartition("conv")
        .sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
        .select(
            F.col("conv").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"),
            "role", "text", "seen",
        )
    )


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, Conversation]]:
    costs, name, current = Costs(), None, None
    for batch in batches:
        columns = (batch[c].tolist() for c in ("conv", "turn", "role", "text", "seen"))
        for conv, turn, role, text, seen in zip(*columns, strict=True):
            if current is None or conv != name:
                if current is not None:
                    current.finish()
                    yield name, current
                name, current = conv, Conversation(costs)
            current.add(turn, role, text, seen)
    if current is not None:
        current.finish()
        yield name, current


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest cost, the edits and a digest.

    ``turns`` has ``conv_id``, ``turn`` (whole numbers), ``role`` and ``text``; other columns are
    left out. A NULL role or text is one space, NULL turns come first, turns with the same number
    are ordered by role and text, and rows without ``conv_id`` are one conversation.

    A turn is blank, or has stood before, or is truncated: its last sign is no stop. Blank and
    repeated turns have to go; others can be kept, get another role, or be deleted, and empty turns
    can be inserted, so that roles come as user, assistant, user, assistant... after at most one
    turn of the system, or that nothing is left. ``audit`` holds the initials of the cheapest edits
    (Delete, Insert, Keep, Rerole), the first in order of all that cost the same.
    ``repaired_sha256`` is that of the repaired ``role:text``, a line each.
    """
    ship_code(turns.sparkSession)
    layout = T.StructType().add("conv", "string")
    for name in COUNTS:
        layout = layout.add(name, "long")
    layout = layout.add("audit", "string").add("repaired_sha256", "string")

    def reported(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for name, conversation in _conversations(batches):
            digest, audit, separator = sha256(), bytearray(), b""
            for edit, role, text in conversation.edits():
                audit += edit.encode()
                if role is not None:
                    line = separator + f"{role}:{text}".encode("utf-8", "surrogatepass")
                    digest.update(line)
                    separator = b"\n"
            counts = [getattr(conversation, c) for c in COUNTS]
            held.append((name, *counts, audit.decode(), digest.hexdigest()))
            conversation.close()
            size += len(audit)
            if len(held) >= ROWS_OUT or size >= IN_MEMORY:
                yield pd.DataFrame(held, columns=layout.names)
                held, size = [], 0
        yield pd.DataFrame(held, columns=layout.names)

    kind = turns.schema["conv_id"].dataType
    return sorted_turns(turns).mapInPandas(reported, layout).select(
        F.col("conv").cast(kind).alias("conv_id"), *layout.names[1:]
    )


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 1), ``role``, ``text``, ``edit``.

    As :func:`repair_report` has it; ``edit`` is the initial of what made the turn, and deleted
    turns are no rows.
    """
    ship_code(turns.sparkSession)
    layout = "conv string, place long, role string, text string, edit string"
    names = ["conv", "place", "role", "text", "edit"]

    def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for name, conversation in _conversations(batches):
            place = 0
            for edit, role, text in conversation.edits():
                if role is None:
                    continue
                place += 1
                held.append((name, place, role, text, edit))
                size += len(text)
                if len(held) >= ROWS_OUT or size >= IN_MEMORY:
                    yield pd.DataFrame(held, columns=names)
                    held, size = [], 0
            conversation.close()
        yield pd.DataFrame(held, columns=names)

    kind = turns.schema["conv_id"].dataType
    return sorted_turns(turns).mapInPandas(repaired, layout).select(
        F.col("conv").cast(kind).alias("conv_id"), *names[1:]
    )
