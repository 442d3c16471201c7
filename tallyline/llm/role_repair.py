"""Chat formatting with minimum-cost repair of roles.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the
assistant. Turns that do not fit are merged into the one before, relabelled, or preceded by empty
turns; dynamic programming over the automaton's states finds the cheapest repair of the whole
conversation, and the repaired turns are rendered one by one, so a conversation of any length is
the concatenation of its rows.

A conversation is worked off in blocks of turn numbers. What a block does to the costs of the
states is a small matrix (minimum over sums), so the costs at the start of every block, and then
the state each block must end in, follow from the matrices alone; the blocks are repaired
independently after that. The result is the same for any block size. Conversations that fit in
one block, nearly all, skip those steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
STATES = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 1 << 40
FROM_START = [0, FAR, FAR, FAR]
BLOCK = 1024


@dataclass(frozen=True)
class Step:
    """How one turn takes the automaton from a state to the role it gets."""

    cost: int
    action: str
    inserted: tuple[int, ...] = ()


@dataclass(frozen=True)
class Costs:
    """Prices of the repairs; ``unknown`` is for giving a role to a turn that has none of the three."""

    merge: int = 1
    relabel: int = 2
    unknown: int = 1
    insert: int = 3
    steps: dict = field(init=False, compare=False, repr=False)

    def __post_init__(self) -> None:
        table = {}
        for role in (*ROLES[1:], None):
            for state in STATES:
                for label in (SYSTEM, USER, ASSISTANT):
                    if step := self._step(role, state, label):
                        table.setdefault((role, state), []).append((label, step))
        object.__setattr__(self, "steps", table)

    def _step(self, role: str | None, state: int, label: int) -> Step | None:
        named = 0 if role == ROLES[label] else self.unknown if role is None else self.relabel
        name = "relabel" if named else "keep"
        options = []
        if label in NEXT[state]:
            options.append(Step(named, name))
        if label == state:
            options.append(Step(named + self.merge, "relabel+merge" if named else "merge"))
        for between in NEXT[state]:
            if label in NEXT[between]:
                options.append(Step(named + self.insert, "relabel+insert" if named else "insert", (between,)))
        return min(options, key=lambda s: s.cost, default=None)

    def closing(self, state: int) -> Step:
        """What a conversation that ends in ``state`` still needs."""
        missing = {START: (), ASSISTANT: (), USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT)}[state]
        return Step(self.insert * len(missing), "close", missing)

    def forward(self, costs: list[int], role: str | None) -> tuple[list[int], list[int]]:
        """Costs after one more turn, and for each state the one it was best reached from."""
        after, came = [FAR] * 4, [START] * 4
        for state in STATES:
            if costs[state] < FAR:
                for label, step in self.steps[role, state]:
                    if costs[state] + step.cost < after[label]:
                        after[label], came[label] = costs[state] + step.cost, state
        return after, came

    def last_state(self, costs: list[int]) -> int:
        return min(STATES, key=lambda s: (costs[s] + self.closing(s).cost, s))


def traced(roles: list[str | None], costs: Costs, entry: list[int], end: int | None) -> list[int]:
    """The states before the first turn and after every turn on the cheapest way to ``end``."""
    back = []
    for role in roles:
        entry, came = costs.forward(entry, role)
        back.append(came)
    states = [costs.last_state(entry) if end is None else end]
    for came in reversed(back):
        states.append(came[states[-1]])
    return states[::-1]


def _opening(states: tuple[int, ...], first: bool) -> str:
    return "".join(("" if first and i == 0 else "<|end|>\n") + f"<|{ROLES[s]}|>\n" for i, s in enumerate(states))


def rendered(texts: list[str], roles: list[str | None], states: list[int], costs: Costs, last: bool) -> Iterator[tuple[str, str, str]]:
    """(role, action, piece) of each turn."""
    steps = [dict(costs.steps[r, a])[b] for r, a, b in zip(roles, states[:-1], states[1:], strict=True)]
    for i, (text, step, state, label) in enumerate(zip(texts, steps, states[:-1], states[1:], strict=True)):
        opening = "\n" if step.action.endswith("merge") else _opening((*step.inserted, label), state == START)
        end = ""
        if last and i == len(texts) - 1:
            end = _opening(costs.closing(label).inserted, False) + "<|end|>\n"
        yield ROLES[label], step.action, opening + text + end


def _known(role: str | None) -> str | None:
    role = (role or "").strip().lower()
    return role if role in ROLES[1:] else None


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows with equal keys, across batches."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for value, group in groupby(rows, key=lambda r: tuple(r[k] for k in key)):
        yield value, list(group)


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _out(held, schema)
            held = []
    if held:
        yield _out(held, schema)


_MATRIX = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("matrix", pa.list_(pa.int64()))])
_ENTRY = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("entry", pa.list_(pa.int64())), ("last", pa.bool_())])
_LEADS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("leads", pa.list_(pa.int64()))])
_ENDS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("ends", pa.int64())])
_PIECE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("action", pa.string()), ("rendered", pa.string())])


def _matrices(costs: Costs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (conv, block), turns in _groups(batches, ("conv_id", "block")):
                matrix = []
                for state in STATES:
                    entry = [FAR] * 4
                    entry[state] = 0
                    for turn in turns:
                        entry, _ = costs.forward(entry, _known(turn["role"]))
                    matrix += entry
                yield conv, block, matrix

        yield from _batched(rows(), _MATRIX)

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs of the states where each block of a conversation begins."""

    def rows():
        held, conv, entry = None, None, None
        for row in (r for batch in batches for r in batch.to_pylist()):
            if held and row["conv_id"] == conv:
                yield *held, False
            else:
                if held:
                    yield *held, True
                entry = FROM_START
            conv = row["conv_id"]
            held = (conv, row["block"], entry)
            entry = [min(FAR, min(entry[s] + row["matrix"][4 * s + e] for s in STATES)) for e in STATES]
        if held:
            yield *held, True

    yield from _batched(rows(), _ENTRY)


def _leads(costs: Costs):
    """For each block and end state the state it is entered in; after the last block the best end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (conv, block), turns in _groups(batches, ("conv_id", "block")):
                entry, back = turns[0]["entry"], []
                for turn in turns:
                    entry, came = costs.forward(entry, _known(turn["role"]))
                    back.append(came)
                leads = []
                for end in (*STATES, costs.last_state(entry)):
                    state = end
                    for came in reversed(back):
                        state = came[state]
                    leads.append(state)
                yield conv, block, [*leads, costs.last_state(entry)]

        yield from _batched(rows(), _LEADS)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The end state of each block, from the last block back."""

    def rows():
        conv, state, begun = None, None, False
        for row in (r for batch in batches for r in batch.to_pylist()):
            if not begun or row["conv_id"] != conv:
                conv, begun, state = row["conv_id"], True, row["leads"][5]
            yield conv, row["block"], state
            state = row["leads"][state]

    yield from _batched(rows(), _ENDS)


def _pieces(costs: Costs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (conv, _), turns in _groups(batches, ("conv_id", "block")):
                roles = [_known(t["role"]) for t in turns]
                head = turns[0]
                states = traced(roles, costs, head["entry"] or FROM_START, head["ends"])
                texts = [t["text"] or "" for t in turns]
                last = head["last"] is not False
                for turn, piece in zip(turns, rendered(texts, roles, states, costs, last), strict=True):
                    yield conv, turn["turn"], *piece

        yield from _batched(rows(), _PIECE)

    return run


def repaired(turns: DataFrame, costs: Costs | None = None, block: int = BLOCK) -> DataFrame:
    """(conv_id, turn, role, action, rendered) for every row of ``turns`` (conv_id, turn, role, text, ...).

    ``rendered``, concatenated in the order of turn, is the conversation as text. A role is
    trimmed and lowered; null and any other name are unknown and get the role that is cheapest.
    Null texts are empty, null turns come first, equal turns are ordered by their content, so
    repeated rows are turns of their own; rows without a conv_id form one conversation. Equal
    costs are decided for the state named first in ROLES.
    """
    costs = costs or Costs()
    tie = F.xxhash64("role", "text")
    part = F.coalesce(F.floor(F.col("turn") / block), F.lit(-(2**62))).cast("long")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", part.alias("block"), tie.alias("tie"))
    order = ("conv_id", "block", "turn", "tie")

    def same(a: str, b: str, *names: str) -> Column:
        found = F.lit(True)
        for n in names:
            found &= F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
        return found

    long = rows.groupBy("conv_id").agg(F.min("block").alias("first"), F.max("block").alias("final")).filter("first < final")
    names = rows.select("conv_id", "block", "turn", "tie", "role").alias("r").join(long.alias("l"), same("r", "l", "conv_id"), "left_semi")
    placed = names.repartition("conv_id", "block").sortWithinPartitions(*order)
    matrices = placed.mapInArrow(_matrices(costs), "conv_id long, block long, matrix array<long>")
    entries = matrices.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    entries = entries.mapInArrow(_entries, "conv_id long, block long, entry array<long>, last boolean")
    with_entry = names.alias("r").join(entries.alias("e"), same("r", "e", "conv_id", "block"))
    with_entry = with_entry.select("r.*", "e.entry").repartition("conv_id", "block").sortWithinPartitions(*order)
    leads = with_entry.mapInArrow(_leads(costs), "conv_id long, block long, leads array<long>")
    ends = leads.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.desc("block"))
    ends = ends.mapInArrow(_ends, "conv_id long, block long, ends long")
    known = entries.alias("e").join(ends.alias("d"), same("e", "d", "conv_id", "block")).select("e.*", "d.ends")
    joined = rows.alias("r").join(known.alias("k"), same("r", "k", "conv_id", "block"), "left").select("r.*", "k.entry", "k.last", "k.ends")
    whole = joined.repartition("conv_id", "block").sortWithinPartitions(*order)
    return whole.mapInArrow(_pieces(costs), "conv_id long, turn long, role string, action string, rendered string")
