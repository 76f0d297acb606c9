"""Repair of conversation structure: the cheapest edits that make turns alternate, by checkpointed dynamic programming.

Turns lie in ranges by conversation and order, so one conversation may spread over many tasks. The cost of finishing from a
state is known backwards; a range needs that vector only at its end, and inside a range it is kept only at every
square-rootth turn and computed again, block by block, while the edits are chosen walking forward.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import WORD, partitions
from skyframe.session import written

START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired turns so far end with
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5  # costs; an undeleted truncated turn adds the last
NEVER = 1 << 40
HEADS = ("s", "u", "a")
LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
PIECE = 1 << 20  # bytes of repaired text that a task passes on at a time
NARROW = "conv string, turn long, block int, n long, head string, fault string, same string"


def relaxed(costs: list[int]) -> tuple[int, ...]:
    """Costs of finishing when turns may be inserted first."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[s][0]]) for s, c in enumerate(costs)]
    return tuple(min(c, NEVER) for c in costs)


END = relaxed([0, NEVER, NEVER, 0])


def moves(state: int, head: str, fault: str | None):
    """Edits that take in one turn, in ASCII order: letter, cost, next state."""
    yield "D", DELETE, state
    if fault not in (BLANK, DUPLICATE):
        extra = CUT_OFF if fault == TRUNCATED else 0
        then = NEXT[state][0]
        if (head == "s" and state == START) or head == "ua"[then - USER]:
            yield "K", KEEP + extra, SYSTEM if head == "s" else then
        yield "R", REROLE + extra, then


@lru_cache(maxsize=1 << 16)
def back(head: str, fault: str | None, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Vector before a turn from the one after it, its least entry taken off, and that entry."""
    costs = relaxed([min(cost + after[then] for _, cost, then in moves(s, head, fault)) for s in range(4)])
    least = min(costs)
    return tuple(c if c >= NEVER // 2 else c - least for c in costs), least


def backwards(turns: list[tuple[str, str | None]], after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Vector before the first of the turns, and what was taken off on the way."""
    total = 0
    for head, fault in reversed(turns):
        after, least = back(head, fault, after)
        total += least
    return after, total


def costs_between(turns: list[tuple[str, str | None]]) -> list[list[int]]:
    """Least cost from every state before the turns to every state right after the last of them."""
    out = []
    for goal in range(4):
        costs, total = backwards(turns, tuple(0 if s == goal else NEVER for s in range(4)))
        out.append([min(NEVER, c + total) for c in costs])
    return [[out[goal][s] for goal in range(4)] for s in range(4)]


@lru_cache(maxsize=1 << 16)
def step(head: str, fault: str | None, state: int, after: tuple[int, ...]) -> tuple[str, int, int]:
    """The ASCII-least tight edits up to and including one turn: letters, cost, next state."""
    letters, spent = "", 0
    before, least = back(head, fault, after)
    while True:
        left = before[state] + least
        tight = [(letter, cost, then) for letter, cost, then in moves(state, head, fault) if cost + after[then] == left]
        then = NEXT[state][0]
        if INSERT + before[then] == before[state] and (not tight or tight[0][0] > "I"):
            letters, spent, state = letters + "I", spent + INSERT, then
        else:
            letter, cost, then = tight[0]
            return letters + letter, spent + cost, then


def walk(turns: list[tuple[str, str | None]], state: int, after: tuple[int, ...]):
    """Letters, cost and state after every turn, from ``state``, with ``after`` the vector behind the last.

    Only vectors at every square-rootth turn are stored; those between are computed again when the walk gets there.
    """
    size = max(1, math.isqrt(len(turns)))
    starts = list(range(0, len(turns), size))
    kept = [after]
    for start in reversed(starts):
        kept.append(backwards(turns[start:start + size], kept[-1])[0])
    for k, start in enumerate(starts):
        block = turns[start:start + size]
        vectors = [kept[len(starts) - 1 - k]]
        for head, fault in reversed(block[1:]):
            vectors.append(back(head, fault, vectors[-1])[0])
        for (head, fault), vector in zip(block, reversed(vectors)):
            letters, cost, state = step(head, fault, state, vector)
            yield letters, cost, state


def finish(state: int) -> str:
    """Insertions behind the last turn."""
    return "I" * (END[state] // INSERT)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The conversations after known damage: by the CRC-32 of ``conv:turn`` modulo 20 a turn is dropped (0), emptied (1), loses its
    ``[.!?]`` (2), comes twice (3) or is the user's (4). Nulls are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn)])
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    kind = F.col("_kind")
    out = rows.select(
        F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").cast("long").alias(turn), (F.crc32(key.cast("binary")) % 20).alias("_kind"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias(role), said.alias(text)).filter("_kind != 0")
    new_text = F.when(kind == 1, "").when(kind == 2, F.translate(F.col(text), ".!?", "")).otherwise(F.col(text))
    out = out.withColumns({text: new_text, role: F.when(kind == 4, "user").otherwise(F.col(role))})
    return out.withColumn("_copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_kind", "_copy")


def conversation_key(conv: str) -> Column:
    """The conversation's id as text; that of none differs from all others."""
    return F.coalesce(F.concat(F.lit("c"), F.col(f"`{conv}`").cast("string")), F.lit("n"))


def _ranged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """All turns in written ranges by conversation, turn and, among equal turns, role and text."""
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    who = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" "))
    shown = rows.select(conversation_key(conv).alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), who.alias("role"), said.alias("text"))
    last = F.right(F.expr(r"trim(TRAILING ' \u0009\u000A\u000B\u000C\u000D' FROM text)"), F.lit(1))
    fault = F.when(~F.col("text").rlike(WORD), BLANK).when(~last.isin(".", "!", "?"), TRUNCATED)
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    full = shown.withColumns({"head": F.left("role", F.lit(1)), "fault": fault, "same": same, "_id": F.monotonically_increasing_id()})
    # Ties are cut by their beginnings first, so that whole texts never go to the driver as bounds of ranges. Rows equal in all of
    # this are the same row several times and may change places.
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.left("role", F.lit(32)), F.left("text", F.lit(64)), F.col("same"), F.col("_id")]
    placed = full.repartitionByRange(partitions(rows), *order).sortWithinPartitions(*order)
    return written(placed.withColumns({"block": F.spark_partition_id(), "n": F.monotonically_increasing_id()}).drop("_id"), "turns")


def _repeats(turns: DataFrame) -> DataFrame:
    """``block``, ``conv``, ``same`` of turns that an earlier range holds too. A range sends one row for each of its distinct turns."""
    local = turns.groupBy("conv", "same", "block").agg(F.lit(1).alias("one"))
    first = local.groupBy("conv", "same").agg(F.min("block").alias("first"), F.count("*").alias("ranges")).filter("ranges > 1")
    return local.join(first, ["conv", "same"]).filter("block > first").select("block", "conv", "same")


def _segments(table: pa.Table, notes: pa.Table):
    """Every conversation's turns in a range: its id, indices of its rows, and its turns as heads and faults."""
    table = table.sort_by("n")
    elsewhere = {(c, s) for c, s in zip(notes.column("conv").to_pylist(), notes.column("same").to_pylist()) if s is not None}
    convs, heads, faults, sames = (table.column(c).to_pylist() for c in ("conv", "head", "fault", "same"))
    out, seen = [], set()
    for i, conv in enumerate(convs):
        if not i or convs[i - 1] != conv:
            seen = set()
            out.append((conv, [], []))
        fault = faults[i]
        if fault != BLANK and (sames[i] in seen or (conv, sames[i]) in elsewhere):
            fault = DUPLICATE
        seen.add(sames[i])
        out[-1][1].append(i)
        out[-1][2].append((heads[i] if heads[i] in HEADS else "-", fault))
    return table, out


def _joints(turns: DataFrame, repeats: DataFrame) -> DataFrame:
    """For conversations that go over more than one range: ``conv``, ``block``, the state at its start, the vector at its end,
    the head and turn before it, and whether it is the last. As many rows as cuts between ranges, twice at most."""
    spans = turns.groupBy("conv", "block").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.count("*").alias("ranges")).filter("ranges > 1").select("conv")
    # One conversation at most goes over any cut between two ranges, so there are fewer of them than ranges.
    split = turns.join(F.broadcast(spans), "conv", "left_semi").select("conv", "turn", "block", "n", "head", "fault", "same")
    notes = repeats.join(F.broadcast(spans), "conv", "left_semi")

    def between(table, notes):
        table, found = _segments(table, notes)
        block = table.column("block")[0].as_py()
        rows = [(conv, block, sum(costs_between(seen), []), seen[-1][0], table.column("turn")[at[-1]].as_py()) for conv, at, seen in found]
        return pa.table([list(x) for x in zip(*rows)], schema=pa.schema([("conv", pa.string()), ("block", pa.int32()), ("costs", pa.list_(pa.int64())), ("head", pa.string()), ("turn", pa.int64())]))

    def vectors(table):
        table = table.sort_by("block")
        conv, costs = table.column("conv")[0].as_py(), table.column("costs").to_pylist()
        after = [END]
        for c in reversed(costs[1:]):
            costs_here = [min(c[4 * s + t] + after[-1][t] for t in range(4)) for s in range(4)]
            after.append(tuple(min(NEVER, x - min(costs_here)) if x < NEVER else NEVER for x in costs_here))
        heads, at = table.column("head").to_pylist(), table.column("turn").to_pylist()
        last = len(costs) - 1
        return pa.table({
            "conv": pa.array([conv] * len(costs)), "block": table.column("block"), "after": pa.array([list(a) for a in reversed(after)], pa.list_(pa.int64())),
            "head_before": pa.array([None, *heads[:-1]], pa.string()), "turn_before": pa.array([None, *at[:-1]], pa.int64()),
            "first": pa.array([i == 0 for i in range(len(costs))]), "last": pa.array([i == last for i in range(len(costs))])})

    def leaves(table, notes):
        """State behind the segment for every state before it."""
        table, found = _segments(table, notes)
        after = {c: tuple(a) for c, a in zip(notes.column("conv").to_pylist(), notes.column("after").to_pylist()) if a is not None}
        rows = []
        for conv, _, seen in found:
            ends = []
            for state in range(4):
                for _, _, state in walk(seen, state, after[conv]):
                    pass
                ends.append(state)
            rows.append((conv, table.column("block")[0].as_py(), ends))
        return pa.table([list(x) for x in zip(*rows)], schema=pa.schema([("conv", pa.string()), ("block", pa.int32()), ("ends", pa.list_(pa.int32()))]))

    def enters(table):
        table = table.sort_by("block")
        states = [START]
        for ends in table.column("ends").to_pylist()[:-1]:
            states.append(ends[states[-1]])
        return table.drop_columns(["ends"]).append_column("state", pa.array(states, pa.int32()))

    by_block = split.groupBy("block")
    costs = by_block.cogroup(notes.groupBy("block")).applyInArrow(between, "conv string, block int, costs array<long>, head string, turn long")
    known = written(costs.groupBy("conv").applyInArrow(
        vectors, "conv string, block int, after array<long>, head_before string, turn_before long, first boolean, last boolean"), "vectors")
    both = notes.unionByName(known.select("block", "conv", "after"), allowMissingColumns=True)
    ends = by_block.cogroup(both.groupBy("block")).applyInArrow(leaves, "conv string, block int, ends array<int>")
    states = ends.groupBy("conv").applyInArrow(enters, "conv string, block int, state int")
    return known.join(states, ["conv", "block"])


def _edits(rows: DataFrame, conv: str, turn: str, role: str, text: str, emit, kind: str) -> DataFrame:
    """``emit(table, segments)`` of every range, where a segment is a conversation's part in the range with its edits."""
    turns = _ranged(rows, conv, turn, role, text)
    repeats = written(_repeats(turns), "repeats")
    notes = written(repeats.unionByName(_joints(turns, repeats), allowMissingColumns=True), "joints")

    def run(table, notes):
        table, found = _segments(table, notes)
        joints = {n["conv"]: n for n in notes.to_pylist() if n["after"] is not None}
        out = []
        for conv, at, seen in found:
            joint = joints.get(conv)
            state, after, last = (joint["state"], tuple(joint["after"]), joint["last"]) if joint else (START, END, True)
            steps = list(walk(seen, state, after))
            if last:
                steps.append((finish(steps[-1][2]), END[steps[-1][2]], ASSISTANT))
            out.append((conv, at, seen, state, steps, joint))
        return emit(table, out)

    return turns.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(run, kind)


def _said(state: int, letters: str, cost: int, role: str, text: str):
    """What the letters of one turn leave: ``edit``, ``role``, ``text`` each, and the state behind them."""
    out = []
    for letter in letters:
        then, name = NEXT[state]
        if letter == "D":
            out.append((letter, None, None))
        elif letter == "K":
            out.append((letter, role, text))
            state = SYSTEM if role[:1] == "s" else then
        else:
            out.append((letter, name, "" if letter == "I" else text))
            state = then
    return out, state


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per edit: ``conv_id`` (as text), ``block``, ``n`` and ``k`` (their order within a conversation), ``edit``
    (Keep, Rerole, Delete or Insert by initial), ``fault``, ``turn`` (null for an insertion), ``role`` and ``text`` after the edit (null
    where deleted). Rules as in ``audits``."""
    def emit(table, found):
        out = []
        block = table.column("block")[0].as_py() if table.num_rows else 0
        turns, roles, texts, places = (table.column(c).to_pylist() for c in ("turn", "role", "text", "n"))
        for conv, at, seen, state, steps, _ in found:
            for j, (letters, cost, _) in enumerate(steps):
                i = at[min(j, len(at) - 1)]
                said, state = _said(state, letters, cost, roles[i], texts[i])
                for k, (letter, who, what) in enumerate(said):
                    own = j < len(at) and letter != "I"
                    out.append((None if conv == "n" else conv[1:], block, places[i] + (j == len(at)), k, letter, seen[j][1] if own else None, turns[i] if own else None, who, what))
        schema = pa.schema([("conv_id", pa.string()), ("block", pa.int32()), ("n", pa.int64()), ("k", pa.int32()), ("edit", pa.string()),
                            ("fault", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        return pa.table([pa.array(list(x), f.type) for x, f in zip(zip(*out), schema)] if out else [[] for _ in schema], schema=schema)

    kind = "conv_id string, block int, n long, k int, edit string, fault string, turn long, role string, text string"
    return _edits(rows, conv, turn, role, text, emit, kind)


def audits(rows: DataFrame, originals: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    A turn's first fault counts: blank, duplicate (its role and text came earlier), truncated (no ``[.!?]`` at its end). ``illegal``
    counts neighbours whose role initials may not follow each other. ``audit`` has the initials of the cheapest edits, the
    ASCII-least of equal ones; what they leave has role initials ``(s?(ua)+)?``.

    Turns come by number, nulls first, equal numbers by role and text. A null role or text is one space; a null conversation is
    one of its own; repeated rows are duplicates of the first. ``originals`` names conversations that may have lost all
    turns: zeros, an empty audit and the digest of nothing. An empty table gives no rows. Other columns are not read.
    A range passes on counts, edits and repaired text, in bounded pieces, for each of its conversations. The digest of a
    conversation cannot be put together from parts, so its pieces go, in order, through one task that holds one at a time.
    """
    kind = "conv string, block int, piece int, gaps long, low long, high long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, body binary"
    schema = pa.schema([("conv", pa.string()), ("block", pa.int32()), ("piece", pa.int32()), *[(c, pa.int64()) for c in (
        "gaps", "low", "high", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("body", pa.binary())])

    def emit(table, found):
        out = []
        block = table.column("block")[0].as_py() if table.num_rows else 0
        turns, roles, texts = (table.column(c).to_pylist() for c in ("turn", "role", "text"))
        for conv, at, seen, state, steps, joint in found:
            known = [turns[i] for i in at if turns[i] is not None]
            before = joint["turn_before"] if joint else None
            distinct = len(set(known)) - (before is not None and before in known[:1])
            heads = ([joint["head_before"]] if joint and joint["head_before"] is not None else []) + [head for head, _ in seen]
            faults = [fault for _, fault in seen]
            counts = [-distinct, min(known, default=None), max(known, default=None), *[faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
                      sum(a + b not in LEGAL for a, b in zip(heads, heads[1:]))]
            body, size, letters, cost, piece = [], 0, [], 0, 0
            for j, (more, price, _) in enumerate(steps):
                i = at[min(j, len(at) - 1)]
                said, state = _said(state, more, price, roles[i], texts[i])
                new = [f"\n{who}:{what}".encode() for _, who, what in said if who is not None]
                body += new
                size += sum(map(len, new))
                letters.append(more)
                cost += price
                if size > PIECE:
                    out.append((conv, block, piece, *counts, cost, "".join(letters), b"".join(body)))
                    body, size, letters, cost, piece, counts = [], 0, [], 0, piece + 1, [0, None, None, 0, 0, 0, 0]
            out.append((conv, block, piece, *counts, cost, "".join(letters), b"".join(body)))
        return pa.table([pa.array(list(x), f.type) for x, f in zip(zip(*out), schema)] if out else [[] for _ in schema], schema=schema)

    def close(now):
        sums, low, high, letters, digest = now[1:]
        gaps = high - low + 1 + sums[0] if low is not None else 0
        return (now[0], gaps, *sums[1:], "".join(letters), digest.hexdigest())

    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]

    def join(batches):
        now = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if now is None or now[0] != row["conv"]:
                    if now:
                        out.append(close(now))
                    now = [row["conv"], [0] * 6, None, None, [], hashlib.sha256()]
                    started = False
                now[1] = [a + row[c] for a, c in zip(now[1], ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))]
                now[2] = min((x for x in (now[2], row["low"]) if x is not None), default=None)
                now[3] = max((x for x in (now[3], row["high"]) if x is not None), default=None)
                now[4].append(row["audit"])
                now[5].update(row["body"] if started else row["body"][1:])  # no newline before the first
                started = started or bool(row["body"])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(map(list, zip(*out)), kinds)], names=names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(close(now), kinds)], names=names)

    pieces = _edits(rows, conv, turn, role, text, emit, kind)
    ordered = pieces.repartition(partitions(rows), "conv").sortWithinPartitions("conv", "block", "piece")
    found = ordered.mapInArrow(join, "conv string, " + ", ".join(f"{c} {'string' if t == pa.string() else 'long'}" for c, t in list(zip(names, kinds))[1:]))
    id_type = dict((f.name, f.dataType) for f in rows.schema.fields)[conv]
    every = (originals if originals is not None else rows).select(conversation_key(conv).alias("conv")).distinct()
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names[1:7]}
    return every.join(found, "conv", "left").select(
        F.when(F.col("conv") != "n", F.substring("conv", 2, 1 << 30)).cast(id_type).alias("conv_id"), *zero.values(),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
